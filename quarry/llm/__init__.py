"""Operators for preparing training data at scale, one module each, with their queries
and DuckDB twins in ``queries.py``.  Nothing else in the library imports this package."""
