"""Operators: spatial zone joins, relational helpers, surrogate keys."""
