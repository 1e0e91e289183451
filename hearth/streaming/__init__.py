"""Monitoring of scored traffic: batch forms (exact, oracle-checked) and
Structured Streaming forms of the same computations."""
