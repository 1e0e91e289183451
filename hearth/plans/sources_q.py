"""Source and sink queries: a driver table written as CSV with its columns in
another order, and read back by header name (S2, S5, S6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.plans.registry import register
from hearth.session import ensure_checkpoint_dir
from hearth.sources.io import read_csv_text, read_house_csv, rejected_cells, write_table
from hearth.sources.tables import table

SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("Kind", T.StringType()),
    T.StructField("Size", T.IntegerType()), T.StructField("SalePrice", T.DoubleType()),
])


def _written(spark, sf) -> str:
    """Parts as a house file: null tokens in Kind, malformed cells in Size."""
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    size = F.when(key % 11 == 0, F.concat(F.lit("c. "), F.col("p_size").cast("string"))).when(key % 7 == 0, "NA").otherwise(F.col("p_size").cast("string"))
    out = p.select(
        F.col("p_retailprice").alias("SalePrice"), size.alias("Size"), F.lit("x").alias("Extra"), key.alias("Id"),
        F.when(key % 5 == 0, "None").otherwise(F.concat(F.lit(" "), F.col("p_type"))).alias("Kind"),
    )
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_table(out, path, "csv")
    return path


_CSV_SQL = """
SELECT p_partkey AS "Id", CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS "Kind",
       CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS INTEGER) END AS "Size",
       CAST(p_retailprice AS DOUBLE) AS "SalePrice"
FROM part
"""


@register("csv_round_trip", _CSV_SQL)
def csv_round_trip(spark, sf):
    return read_house_csv(spark, _written(spark, sf), SCHEMA)


_REJECT_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS key, 'Size' AS "column", 'c. ' || CAST(p_size AS VARCHAR) AS value
FROM part WHERE p_partkey % 11 = 0
"""


@register("csv_rejects", _REJECT_SQL)
def csv_rejects(spark, sf):
    return rejected_cells(read_csv_text(spark, _written(spark, sf)), SCHEMA, "Id")
