"""Operators of a training-data pipeline (tokenizing, decontamination, dedup,
filters, archives, scoring) and their registered queries.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
