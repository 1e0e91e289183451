"""Readers and writers (parquet inside, CSV/JSON at the edges)."""
