"""Validation queries over the driver tables: scoring requests, context by key,
deny lists, incomplete rows and one-sided keys (V1, V2, X16, X17, J3, J6, F2,
F5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators.linkage import one_sided
from hearth.operators.validate import apply_date_context, attach_context, check_training_frame, drop_ids, drop_incomplete, split_valid_requests
from hearth.plans.registry import register
from hearth.sources.tables import table


def _requests(spark, sf):
    """Orders as scoring requests: some lack a field, some have a 13th month or
    a valuation date that is no date."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 13 != 0, F.col("o_orderpriority")).alias("neighborhood"),
        F.lit(5).alias("overall_qual"), F.when(k % 17 != 0, F.col("o_totalprice")).alias("gr_liv_area"),
        F.year("o_orderdate").alias("yr_sold"), F.when(k % 19 == 0, 13).otherwise(F.month("o_orderdate")).alias("mo_sold"),
        F.when(k % 23 == 0, "soon").when(k % 3 == 0, F.concat(F.lit("2009-0"), (k % 9 + 1).cast("string"), F.lit("-15"))).alias("valuation_date"),
    )


_REQUEST_SQL = """
r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS neighborhood,
             CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS gr_liv_area,
             CAST(year(o_orderdate) AS INTEGER) AS yr_sold,
             CAST(CASE WHEN o_orderkey % 19 = 0 THEN 13 ELSE month(o_orderdate) END AS INTEGER) AS mo_sold,
             CASE WHEN o_orderkey % 23 = 0 THEN 'soon'
                  WHEN o_orderkey % 3 = 0 THEN '2009-0' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || '-15' END AS valuation_date
      FROM orders)
"""


@register("request_rejects", f"""WITH {_REQUEST_SQL}
SELECT o_orderkey, CASE WHEN neighborhood IS NULL OR gr_liv_area IS NULL THEN 'missing_required_field' ELSE 'month_out_of_range' END AS reject_reason
FROM r WHERE neighborhood IS NULL OR gr_liv_area IS NULL OR mo_sold NOT BETWEEN 1 AND 12""")
def request_rejects(spark, sf):
    """V2."""
    return split_valid_requests(_requests(spark, sf))[1].select("o_orderkey", "reject_reason")


@register("request_dates", f"""WITH {_REQUEST_SQL}, d AS (SELECT *, TRY_CAST(valuation_date AS DATE) AS d FROM r)
SELECT o_orderkey, CAST(coalesce(year(d), yr_sold) AS INTEGER) AS yr_sold, CAST(coalesce(month(d), mo_sold) AS INTEGER) AS mo_sold FROM d""")
def request_dates(spark, sf):
    """A row's valuation date beats its own year and month."""
    return apply_date_context(_requests(spark, sf)).select("o_orderkey", "yr_sold", "mo_sold")


@register("context_by_key", """
SELECT o_orderkey, o_custkey, c_nationkey, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def context_by_key(spark, sf):
    """The columns the orders lack, by customer."""
    source = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    return attach_context(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), source, "o_custkey")


@register("denied_ids", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def denied_ids(spark, sf):
    """orders on the list of those with a returned line are left out."""
    deny = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return drop_ids(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", deny)


@register("one_sided_keys", """
SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS n_left_only,
       (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_right_only""")
def one_sided_keys(spark, sf):
    """Customers without orders, and customers of orders that do not exist."""
    buyers = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return one_sided(table(spark, sf, "customer").select("c_custkey"), buyers, "c_custkey")


@register("complete_requests", f"WITH {_REQUEST_SQL} SELECT o_orderkey, neighborhood, gr_liv_area FROM r WHERE neighborhood IS NOT NULL AND gr_liv_area IS NOT NULL")
def complete_requests(spark, sf):
    """F5."""
    return drop_incomplete(_requests(spark, sf), ["neighborhood", "gr_liv_area"]).select("o_orderkey", "neighborhood", "gr_liv_area")


@register("training_frame_duplicates", "SELECT count(*) - count(DISTINCT l_orderkey) AS n_duplicates FROM lineitem")
def training_frame_duplicates(spark, sf):
    """V1: ids that repeat, as the check of a training frame counts them."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("sale_price"))
    return spark.createDataFrame([(check_training_frame(rows),)], "n_duplicates long")
