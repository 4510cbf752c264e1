"""Registered queries over the supplied test tables, and the DuckDB text of each oracle."""
