import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF = os.environ.get("HEARTH_ORACLE_SF", "/root/testdata/sf0.01")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs_rows(spark):
    """(doc_id, text) of the small documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def make_docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)
