"""Composed plans: the query catalog (Spark side + DuckDB twins) and flows."""
