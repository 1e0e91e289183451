"""Registered queries: the house-valuation operators applied to the driver's
tables through a fixed column analogy (``views``), each with a DuckDB twin."""
