"""The queries that SQL can express against their DuckDB twins."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from oracle_compare import compare  # noqa: E402

from hearth.llm.queries import ORACLE, QUERIES

from llm_data import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    problems, _, _ = compare(spark, name, QUERIES[name], ORACLE[name], SF)
    assert not problems, problems
