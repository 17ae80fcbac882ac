"""Operators: DataFrame → DataFrame building blocks keyed by ``username``."""
