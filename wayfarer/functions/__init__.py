"""Column functions: survey recode rules (``recode``), helpers (``columns``), fixed codes (``codes``)."""
