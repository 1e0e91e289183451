"""Cleaning-area queries: flagship slice, missing report, imputations,
dedup, leverage split, domain rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import clip_below_zero, flag, right_closed_bucket
from hearth.operators.clean import apply_group_median, domain_rules, fit_group_median, leverage_flag
from hearth.operators.dedup import duplicate_summary, keep_first
from hearth.operators.profile import missing_report
from hearth.operators.quantiles import mode_of
from hearth.plans import views as V
from hearth.plans.registry import register
from hearth.plans.sqltext import bucket_case, values_table
from hearth.shared import saved
from hearth.sources.tables import table

# ---------------------------------------------------------------------------
# flagship: sales -> neighbourhood-median frontage fill -> age with clip flag
# -> slice summary over every price bucket (empty buckets kept)
# ---------------------------------------------------------------------------

_SLICE_SQL = f"""
WITH sales AS ({V.sales_sql(neighborhood=True)}),
med AS (SELECT neighborhood, median(lot_frontage) AS gm FROM sales
        WHERE neighborhood IS NOT NULL GROUP BY neighborhood),
allmed AS (SELECT median(lot_frontage) AS g FROM sales),
x AS (
  SELECT s.sale_price,
         coalesce(s.lot_frontage, med.gm, (SELECT g FROM allmed)) AS lot_frontage,
         CASE WHEN s.lot_frontage IS NULL THEN 1 ELSE 0 END AS frontage_imputed,
         s.yr_sold - s.year_built AS age_at_sale,
         {bucket_case('s.sale_price', V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS, include_lowest=True)} AS price_bucket
  FROM sales s LEFT JOIN med ON s.neighborhood = med.neighborhood
),
agg AS (
  SELECT price_bucket, count(*) AS n,
         avg(sale_price) AS price_mean,
         avg(CASE WHEN age_at_sale < 0 THEN 0 ELSE age_at_sale END) AS age_mean,
         CAST(sum(CASE WHEN age_at_sale < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative_age,
         avg(lot_frontage) AS frontage_mean,
         CAST(sum(frontage_imputed) AS BIGINT) AS n_frontage_imputed
  FROM x WHERE price_bucket IS NOT NULL GROUP BY price_bucket
),
{values_table('dim', ['price_bucket'], [(b,) for b in V.SALE_PRICE_LABELS])}
SELECT dim.price_bucket, CAST(coalesce(n, 0) AS BIGINT) AS n,
       round(price_mean, 4) AS price_mean, round(age_mean, 4) AS age_mean,
       CAST(coalesce(n_negative_age, 0) AS BIGINT) AS n_negative_age,
       round(frontage_mean, 4) AS frontage_mean,
       CAST(coalesce(n_frontage_imputed, 0) AS BIGINT) AS n_frontage_imputed
FROM dim LEFT JOIN agg ON dim.price_bucket = agg.price_bucket
"""


@register("sales_slice_summary", _SLICE_SQL)
def sales_slice_summary(spark, sf):
    s = V.sales(spark, sf, neighborhood=True)
    medians, glob = fit_group_median(s, "lot_frontage", ["neighborhood"])
    x = apply_group_median(s, "lot_frontage", ["neighborhood"], medians, glob, flag="frontage_imputed")
    age = F.col("yr_sold") - F.col("year_built")
    x = x.select(
        "sale_price", "lot_frontage", "frontage_imputed",
        flag(age < 0).alias("age_negative_flag"),
        clip_below_zero(age).alias("age_clipped"),
        right_closed_bucket("sale_price", V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS, include_lowest=True).alias("price_bucket"),
    )
    agg = x.where(F.col("price_bucket").isNotNull()).groupBy("price_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("sale_price").alias("price_mean"),
        F.avg("age_clipped").alias("age_mean"),
        F.sum("age_negative_flag").cast("long").alias("n_negative_age"),
        F.avg("lot_frontage").alias("frontage_mean"),
        F.sum("frontage_imputed").cast("long").alias("n_frontage_imputed"),
    )
    # the bucket list is a fixed six-row dimension
    dim = spark.createDataFrame([(b,) for b in V.SALE_PRICE_LABELS], "price_bucket string")
    return dim.join(agg, "price_bucket", "left").select(
        "price_bucket",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.round("price_mean", 4).alias("price_mean"),
        F.round("age_mean", 4).alias("age_mean"),
        F.coalesce("n_negative_age", F.lit(0)).cast("long").alias("n_negative_age"),
        F.round("frontage_mean", 4).alias("frontage_mean"),
        F.coalesce("n_frontage_imputed", F.lit(0)).cast("long").alias("n_frontage_imputed"),
    )


# ---------------------------------------------------------------------------
# A1/A2 missing report
# ---------------------------------------------------------------------------

_SALES_COLS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sale_price", "gr_liv_area", "yr_sold",
    "mo_sold", "year_built", "lot_area", "kitchen_qual_code", "lot_frontage", "garage_area",
    "garage_type", "sale_condition", "l_discount", "l_tax",
]
_ABSENT = ["garage_area", "garage_type"]

_MISSING_SQL = f"""
WITH sales AS ({V.sales_sql()}),
tot AS (SELECT count(*) AS n FROM sales),
m AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM sales" for c in _SALES_COLS)}
)
SELECT column_name AS "column", CAST(n_missing AS BIGINT) AS n_missing,
       round_even(n_missing * 100.0 / (SELECT n FROM tot), 2) AS pct_missing,
       CASE WHEN column_name IN ({', '.join(repr(c) for c in _ABSENT)})
            THEN 'absent (NA = feature does not exist)' ELSE 'genuine missing (needs imputation)' END AS na_meaning
FROM m WHERE n_missing > 0
"""


@register("missing_report", _MISSING_SQL)
def missing_report_q(spark, sf):
    return missing_report(V.sales(spark, sf), absent_columns=_ABSENT)


# ---------------------------------------------------------------------------
# J5/A5 group-median imputation (row level)
# ---------------------------------------------------------------------------

_GROUP_MEDIAN_SQL = f"""
WITH sales AS ({V.sales_sql(neighborhood=True)}),
med AS (SELECT neighborhood, median(lot_frontage) AS gm FROM sales
        WHERE neighborhood IS NOT NULL GROUP BY neighborhood),
allmed AS (SELECT median(lot_frontage) AS g FROM sales)
SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.neighborhood,
       round(coalesce(s.lot_frontage, med.gm, (SELECT g FROM allmed)), 6) AS lot_frontage,
       CASE WHEN s.lot_frontage IS NULL THEN 1 ELSE 0 END AS frontage_imputed
FROM sales s LEFT JOIN med ON s.neighborhood = med.neighborhood
"""


@register("group_median_impute", _GROUP_MEDIAN_SQL)
def group_median_impute(spark, sf):
    s = V.sales(spark, sf, neighborhood=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "neighborhood", "lot_frontage"
    )
    medians, glob = fit_group_median(s, "lot_frontage", ["neighborhood"])
    out = apply_group_median(s, "lot_frontage", ["neighborhood"], medians, glob, flag="frontage_imputed")
    return out.withColumn("lot_frontage", F.round("lot_frontage", 6))


# ---------------------------------------------------------------------------
# A4/X26 mode imputation; grouped mode
# ---------------------------------------------------------------------------

def _orders_with_unknown_priority(spark, sf):
    o = table(spark, sf, "orders")
    # a pending order has no priority yet: the cell is genuinely missing
    return o.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("order_priority"),
    )


_ORDERS_UNKNOWN_SQL = (
    "SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END "
    "AS order_priority FROM orders"
)

_MODE_SQL = f"""
WITH o AS ({_ORDERS_UNKNOWN_SQL}),
c AS (SELECT order_priority AS v, count(*) AS n FROM o WHERE order_priority IS NOT NULL GROUP BY 1),
m AS (SELECT v FROM c ORDER BY n DESC, v ASC LIMIT 1)
SELECT o_orderkey, coalesce(order_priority, (SELECT v FROM m)) AS order_priority,
       CASE WHEN order_priority IS NULL THEN 1 ELSE 0 END AS priority_imputed
FROM o
"""


@register("mode_impute", _MODE_SQL)
def mode_impute(spark, sf):
    o = _orders_with_unknown_priority(spark, sf)
    fill = mode_of(o, "order_priority", name="m").collect()[0]["m"]  # one value
    return o.select(
        "o_orderkey",
        F.coalesce(F.col("order_priority"), F.lit(fill)).alias("order_priority"),
        F.col("order_priority").isNull().cast("int").alias("priority_imputed"),
    )


_GROUP_MODE_SQL = f"""
WITH o AS ({_ORDERS_UNKNOWN_SQL}),
c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, order_priority AS v, count(*) AS n
      FROM o WHERE order_priority IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY order_year ORDER BY n DESC, v ASC) AS rn FROM c)
SELECT order_year, v AS mode_priority, CAST(n AS BIGINT) AS mode_count FROM r WHERE rn = 1
"""


@register("group_mode", _GROUP_MODE_SQL)
def group_mode(spark, sf):
    o = _orders_with_unknown_priority(spark, sf).withColumn("order_year", F.year("o_orderdate"))
    return mode_of(o, "order_priority", by=["order_year"], name="mode_priority", count_name="mode_count")


# ---------------------------------------------------------------------------
# F1 leverage split
# ---------------------------------------------------------------------------

_LEVERAGE_SQL = f"""
WITH sales AS ({V.sales_sql(orders=False)}),
t AS (SELECT *, coalesce(gr_liv_area > {V.LEVERAGE_AREA} AND sale_price < {V.LEVERAGE_PRICE}, false) AS rule FROM sales)
SELECT CASE WHEN rule THEN 'removed' ELSE 'kept' END AS split, count(*) AS n,
       round(sum(sale_price), 2) AS total_price, round(avg(gr_liv_area), 6) AS area_mean
FROM t GROUP BY 1
"""


@register("leverage_split", _LEVERAGE_SQL)
def leverage_split_q(spark, sf):
    """Both sides of the split summarised from ONE scan (grouped by the rule)."""
    s = V.sales(spark, sf, orders=False)
    rule = leverage_flag("gr_liv_area", "sale_price", V.LEVERAGE_AREA, V.LEVERAGE_PRICE)
    return s.groupBy(F.when(rule, F.lit("removed")).otherwise(F.lit("kept")).alias("split")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("sale_price"), 2).alias("total_price"),
        F.round(F.avg("gr_liv_area"), 6).alias("area_mean"),
    )


# ---------------------------------------------------------------------------
# F3/F4 dedup keep-first, duplicate count (events by user & type, first by time)
# ---------------------------------------------------------------------------

_DEDUP_SQL = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, event_type, event_id, value FROM r WHERE rn = 1
"""


@register("dedup_keep_first", _DEDUP_SQL)
def dedup_keep_first(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return keep_first(ev, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


_DUPCOUNT_SQL = """
WITH k AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM k
"""


@register("duplicate_count", _DUPCOUNT_SQL)
def duplicate_count(spark, sf):
    return duplicate_summary(table(spark, sf, "events"), ["user_id", "event_type"])


# ---------------------------------------------------------------------------
# X19-X23 domain rules on a house-shaped frame
# ---------------------------------------------------------------------------

def _raw_house(spark, sf):
    li = table(spark, sf, "lineitem")
    od = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    pa = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    d = li.join(od, li.l_orderkey == od.o_orderkey).join(pa, li.l_partkey == pa.p_partkey)
    return d.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_tax") == 0, F.lit("NoFeature")).otherwise(F.col("l_returnflag")).alias("MasVnrType"),
        F.when(F.col("l_tax") == 0, F.lit(None)).when(F.col("l_discount") == 0, F.lit(0.0))
        .otherwise(F.col("l_quantity")).alias("MasVnrArea"),
        (F.col("l_linenumber") - 1).alias("Fireplaces"),
        F.col("l_linestatus").alias("FireplaceQu"),
        F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("PoolArea"),
        F.col("l_returnflag").alias("PoolQC"),
        F.when(F.col("l_tax") == 0.08, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("GarageType"),
        F.col("l_returnflag").alias("GarageFinish"),
        F.col("l_linestatus").alias("GarageQual"),
        F.col("o_orderstatus").alias("GarageCond"),
        (F.year("o_orderdate") + F.col("l_linenumber") - 3).alias("GarageYrBlt"),
        F.col("l_linenumber").alias("GarageCars"),
        (F.col("l_quantity") * 10).alias("GarageArea"),
        F.when(F.col("l_discount") == 0.1, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("BsmtFinSF1"),
        F.lit(0.0).alias("BsmtFinSF2"),
        F.when(F.col("l_discount") == 0.1, F.lit(0.0)).otherwise(F.lit(5.0)).alias("BsmtUnfSF"),
        F.when(F.col("l_discount") == 0.1, F.lit(None)).otherwise(F.col("l_quantity") + 5).alias("TotalBsmtSF"),
        F.col("p_type").alias("BsmtQual"),
        F.col("o_orderpriority").alias("BsmtCond"),
        F.col("l_returnflag").alias("BsmtExposure"),
        F.col("l_linestatus").alias("BsmtFinType1"),
        F.col("o_orderstatus").alias("BsmtFinType2"),
        F.year("o_orderdate").alias("YearBuilt"),
        F.year("l_shipdate").alias("YrSold"),
        F.col("p_size").alias("MSSubClass"),
    )


_RAW_HOUSE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_tax = 0 THEN 'NoFeature' ELSE l_returnflag END AS MasVnrType,
  CASE WHEN l_tax = 0 THEN NULL WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS MasVnrArea,
  l_linenumber - 1 AS Fireplaces, l_linestatus AS FireplaceQu,
  CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS PoolArea, l_returnflag AS PoolQC,
  CASE WHEN l_tax = 0.08 THEN NULL ELSE o_orderpriority END AS GarageType,
  l_returnflag AS GarageFinish, l_linestatus AS GarageQual, o_orderstatus AS GarageCond,
  CAST(year(o_orderdate) AS INTEGER) + l_linenumber - 3 AS GarageYrBlt,
  l_linenumber AS GarageCars, l_quantity * 10 AS GarageArea,
  CASE WHEN l_discount = 0.1 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS BsmtFinSF1,
  CAST(0 AS DOUBLE) AS BsmtFinSF2,
  CASE WHEN l_discount = 0.1 THEN CAST(0 AS DOUBLE) ELSE CAST(5 AS DOUBLE) END AS BsmtUnfSF,
  CASE WHEN l_discount = 0.1 THEN NULL ELSE l_quantity + 5 END AS TotalBsmtSF,
  p_type AS BsmtQual, o_orderpriority AS BsmtCond, l_returnflag AS BsmtExposure,
  l_linestatus AS BsmtFinType1, o_orderstatus AS BsmtFinType2,
  CAST(year(o_orderdate) AS INTEGER) AS YearBuilt, CAST(year(l_shipdate) AS INTEGER) AS YrSold,
  p_size AS MSSubClass
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

_RULES_SQL = f"""
WITH h AS ({_RAW_HOUSE_SQL}),
m1 AS (SELECT * REPLACE (CASE WHEN MasVnrType = 'NoFeature' THEN coalesce(MasVnrArea, CAST(0 AS DOUBLE)) ELSE MasVnrArea END AS MasVnrArea) FROM h),
m2 AS (SELECT * REPLACE (CASE WHEN MasVnrArea = 0 THEN 'NoFeature' ELSE MasVnrType END AS MasVnrType) FROM m1),
f AS (SELECT * REPLACE (CASE WHEN Fireplaces = 0 THEN 'NoFeature' ELSE FireplaceQu END AS FireplaceQu,
                        CASE WHEN PoolArea = 0 THEN 'NoFeature' ELSE PoolQC END AS PoolQC) FROM m2),
g AS (SELECT * REPLACE (
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 'NoFeature' ELSE GarageFinish END AS GarageFinish,
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 'NoFeature' ELSE GarageQual END AS GarageQual,
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 'NoFeature' ELSE GarageCond END AS GarageCond,
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 0 ELSE GarageYrBlt END AS GarageYrBlt,
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 0 ELSE GarageCars END AS GarageCars,
        CASE WHEN coalesce(GarageType, 'NoFeature') = 'NoFeature' THEN 0 ELSE GarageArea END AS GarageArea) FROM f),
b AS (SELECT * REPLACE (
        CASE WHEN coalesce(BsmtFinSF1,0)+coalesce(BsmtFinSF2,0)+coalesce(BsmtUnfSF,0)+coalesce(TotalBsmtSF,0) = 0 THEN 'NoFeature' ELSE BsmtQual END AS BsmtQual,
        CASE WHEN coalesce(BsmtFinSF1,0)+coalesce(BsmtFinSF2,0)+coalesce(BsmtUnfSF,0)+coalesce(TotalBsmtSF,0) = 0 THEN 'NoFeature' ELSE BsmtCond END AS BsmtCond,
        CASE WHEN coalesce(BsmtFinSF1,0)+coalesce(BsmtFinSF2,0)+coalesce(BsmtUnfSF,0)+coalesce(TotalBsmtSF,0) = 0 THEN 'NoFeature' ELSE BsmtExposure END AS BsmtExposure,
        CASE WHEN coalesce(BsmtFinSF1,0)+coalesce(BsmtFinSF2,0)+coalesce(BsmtUnfSF,0)+coalesce(TotalBsmtSF,0) = 0 THEN 'NoFeature' ELSE BsmtFinType1 END AS BsmtFinType1,
        CASE WHEN coalesce(BsmtFinSF1,0)+coalesce(BsmtFinSF2,0)+coalesce(BsmtUnfSF,0)+coalesce(TotalBsmtSF,0) = 0 THEN 'NoFeature' ELSE BsmtFinType2 END AS BsmtFinType2) FROM g),
y AS (SELECT * REPLACE (CASE WHEN GarageYrBlt > YrSold THEN YearBuilt ELSE GarageYrBlt END AS GarageYrBlt,
                        CAST(MSSubClass AS VARCHAR) AS MSSubClass) FROM b)
SELECT * FROM y
"""


@register("domain_rules", _RULES_SQL)
def domain_rules_q(spark, sf):
    return domain_rules(_raw_house(spark, sf))


# ---------------------------------------------------------------------------
# the whole cleaning job on the house frame (rows-only: every step above has
# its own oracle-checked query)
# ---------------------------------------------------------------------------

def _house_split(spark, sf):
    from hearth.operators.metrics import fold_of

    h = V.house(spark, sf, place=True).drop("_acctbal")
    h = h.withColumn("Id", F.concat_ws("-", *[F.col(k).cast("string") for k in V.HOUSE_KEYS]))
    # both sides, and the report on the raw rows, read the joined table once written
    h = saved(h.withColumn("_fold", fold_of(*V.HOUSE_KEYS)), "house")
    return h.where("_fold <> 0").drop("_fold"), h.where("_fold = 0").drop("_fold", "SalePrice")


def _cleaned(spark, sf):
    """The cleaning job and its inputs (checkpointed inside ``clean``)."""
    from hearth.operators.clean import clean

    train, test = _house_split(spark, sf)
    return train, test, clean(train, test, key="Id")


@register("clean_house")
def clean_house(spark, sf):
    """Tidy -> dedupe -> fit (frontage medians over train+test, modes,
    medians, month rates) -> transform -> leverage split; the cleaned train."""
    return _cleaned(spark, sf)[2].train


@register("cleaning_report_rows")
def cleaning_report_rows(spark, sf):
    """The cleaning audit report flattened to (section, metric, value)."""
    from hearth.operators.clean import cleaning_report
    from hearth.sources.io import report_to_long

    train, test, res = _cleaned(spark, sf)
    return report_to_long(spark, cleaning_report(train, test, res, key="Id"))


@register("post_clean_checks")
def post_clean_checks_q(spark, sf):
    """V4: the checklist over the cleaned frames, nothing collected."""
    from hearth.operators.clean import post_clean_checks

    train, test, res = _cleaned(spark, sf)
    return post_clean_checks(res.train, res.test, res.removed, test, key="Id")
