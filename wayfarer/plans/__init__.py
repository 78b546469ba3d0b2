"""Table builders (``tables``), batch pipeline (``pipeline``), query registry (``queries``), oracles (``oracle``)."""
