"""Profiling-area queries (EDA operators A7-A17, A20-A26, A31-A32)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth import constants as K
from hearth.functions.exprs import normal_quantile_sql, right_closed_bucket, round_sig
from hearth.operators import profile as P
from hearth.operators.enrich import dom_score
from hearth.operators.quantiles import exact_median
from hearth.plans import views as V
from hearth.plans.registry import register
from hearth.plans.sqltext import bucket_case
from hearth.plans.sqltext import round_sig as sql_sig
from hearth.sources.tables import table

NUM_COLS = ["sale_price", "gr_liv_area", "lot_area", "lot_frontage", "l_discount", "l_tax"]
TEXT_COLS = ["kitchen_qual_code", "garage_type", "sale_condition"]

# ---- A7 describe -------------------------------------------------------------

_DESCRIBE_SQL = f"""
WITH sales AS ({V.sales_sql()})
{' UNION ALL '.join(f'''SELECT '{c}' AS "column", count({c}) AS "count", {sql_sig(f"avg({c})")} AS mean,
  {sql_sig(f"stddev_samp({c})")} AS std, {sql_sig(f"min({c})")} AS "min", {sql_sig(f"quantile_cont({c}, 0.25)")} AS q25,
  {sql_sig(f"quantile_cont({c}, 0.5)")} AS q50, {sql_sig(f"quantile_cont({c}, 0.75)")} AS q75, {sql_sig(f"max({c})")} AS "max"
  FROM sales''' for c in NUM_COLS)}
"""


@register("describe_numeric", _DESCRIBE_SQL)
def describe_numeric(spark, sf):
    d = P.describe(V.sales(spark, sf), NUM_COLS)
    return d.select("column", "count", *[round_sig(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


_DESCRIBE_TEXT_SQL = f"""
WITH sales AS ({V.sales_sql()}),
long AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM sales" for c in TEXT_COLS)}),
c AS (SELECT col, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
top AS (SELECT col, v, n, row_number() OVER (PARTITION BY col ORDER BY n DESC, v ASC) AS rn FROM c),
cnt AS (SELECT col, count(v) AS "count", count(DISTINCT v) AS "unique" FROM long GROUP BY 1)
SELECT cnt.col AS "column", cnt."count", cnt."unique", top.v AS top, top.n AS freq
FROM cnt LEFT JOIN top ON cnt.col = top.col AND top.rn = 1
"""


@register("describe_text", _DESCRIBE_TEXT_SQL)
def describe_text(spark, sf):
    return P.describe_text(V.sales(spark, sf), TEXT_COLS)


# ---- A9 shape ------------------------------------------------------------------

_SHAPE_SQL = f"""
WITH sales AS ({V.sales_sql()})
{' UNION ALL '.join(f'''SELECT '{c}' AS "column", count({c}) AS n, round(skewness({c}), 6) AS skew,
  round(kurtosis({c}), 6) AS kurtosis, round(skewness(CASE WHEN {c} > -1 THEN ln(1 + {c}) END), 6) AS skew_log1p,
  round(kurtosis(CASE WHEN {c} > -1 THEN ln(1 + {c}) END), 6) AS kurtosis_log1p FROM sales''' for c in NUM_COLS)}
"""


@register("shape_stats", _SHAPE_SQL)
def shape_stats(spark, sf):
    s = P.shape_stats(V.sales(spark, sf), NUM_COLS)
    return s.select("column", "n", *[F.round(c, 6).alias(c) for c in ["skew", "kurtosis", "skew_log1p", "kurtosis_log1p"]])


# ---- A10-A14 outliers -------------------------------------------------------------

SCAN_COLS = ["sale_price", "gr_liv_area", "lot_area", "lot_frontage", "list_price", "distance_proxy"]


def _scan_frame(spark, sf):
    return V.sales(spark, sf, neighborhood=True, part=True)


def _bounds_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
            avg({c}) AS mu, stddev_samp({c}) AS sd FROM s""" for c in SCAN_COLS
    )


def _flag_sql(c: str) -> str:
    return (f"CASE WHEN {c} < (SELECT q1 - 1.5 * (q3 - q1) FROM b WHERE feature = '{c}') "
            f"OR {c} > (SELECT q3 + 1.5 * (q3 - q1) FROM b WHERE feature = '{c}') THEN 1 ELSE 0 END")


def _zflag_sql(c: str) -> str:
    return (f"CASE WHEN abs(({c} - (SELECT mu FROM b WHERE feature = '{c}')) / "
            f"(SELECT sd FROM b WHERE feature = '{c}')) > 3 THEN 1 ELSE 0 END")


_OUTLIER_SUMMARY_SQL = f"""
WITH s AS ({V.sales_sql(neighborhood=True, part=True)}),
b AS ({_bounds_sql()}),
f AS (SELECT {', '.join(f"{_flag_sql(c)} AS i_{c}, {_zflag_sql(c)} AS z_{c}" for c in SCAN_COLS)} FROM s),
n AS (SELECT count(*) AS n FROM s)
{' UNION ALL '.join(f'''SELECT '{c}' AS feature, CAST(sum(i_{c}) AS BIGINT) AS n_iqr,
  round_even(sum(i_{c}) * 100.0 / (SELECT n FROM n), 2) AS pct_iqr, CAST(sum(z_{c}) AS BIGINT) AS n_zscore,
  round_even(sum(z_{c}) * 100.0 / (SELECT n FROM n), 2) AS pct_zscore,
  round_even((SELECT q3 + 1.5 * (q3 - q1) FROM b WHERE feature = '{c}'), 1) AS iqr_high FROM f''' for c in SCAN_COLS)}
"""


@register("outlier_summary", _OUTLIER_SUMMARY_SQL)
def outlier_summary(spark, sf):
    return P.outlier_summary(_scan_frame(spark, sf), SCAN_COLS)


_FLAG_COUNT_SQL = " + ".join(_flag_sql(c) for c in SCAN_COLS)

_FLAG_DIST_SQL = f"""
WITH s AS ({V.sales_sql(neighborhood=True, part=True)}),
b AS ({_bounds_sql()}),
f AS (SELECT {_FLAG_COUNT_SQL} AS n_outlier_flags FROM s)
SELECT n_outlier_flags, count(*) AS n_rows FROM f GROUP BY 1
"""


@register("outlier_flag_distribution", _FLAG_DIST_SQL)
def outlier_flag_distribution(spark, sf):
    return P.flag_distribution(_scan_frame(spark, sf), SCAN_COLS)


_REPORT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sale_price", "gr_liv_area", "neighborhood"]
_LEV = f"(gr_liv_area > {V.LEVERAGE_AREA} AND sale_price < {V.LEVERAGE_PRICE})"

_CANDIDATES_SQL = f"""
WITH s AS ({V.sales_sql(neighborhood=True, part=True)}),
b AS ({_bounds_sql()}),
f AS (SELECT {', '.join(_REPORT)}, {_FLAG_COUNT_SQL} AS n_outlier_flags,
        concat_ws(',', {', '.join(f"CASE WHEN {_flag_sql(c)} = 1 THEN '{c}' END" for c in SCAN_COLS)}) AS flagged_features,
        coalesce({_LEV}, false) AS lev FROM s)
SELECT {', '.join(_REPORT)}, n_outlier_flags, flagged_features,
  CASE WHEN lev THEN '{P.LEVERAGE_REASON}'
       ELSE 'multivariate: IQR-outlier on ' || CAST(n_outlier_flags AS VARCHAR) || ' features (review)' END AS reason
FROM f WHERE lev OR n_outlier_flags >= 3
"""


@register("outlier_candidates", _CANDIDATES_SQL)
def outlier_candidates(spark, sf):
    s = _scan_frame(spark, sf)
    lev = (F.col("gr_liv_area") > V.LEVERAGE_AREA) & (F.col("sale_price") < V.LEVERAGE_PRICE)
    return P.outlier_candidates(s, SCAN_COLS, lev, min_flags=3, report=_REPORT, sort=[F.desc("sale_price")])


# ---- A16 / A17 correlation ---------------------------------------------------------

CORR_FEATURES = ["gr_liv_area", "lot_area", "lot_frontage", "list_price", "overall_qual", "distance_proxy",
                 "l_discount", "l_tax", "units"]


def _corr_frame(spark, sf):
    s = V.sales(spark, sf, neighborhood=True, part=True)
    return s.withColumn("units", F.lit(1.0))  # a constant column: r must be NULL, not an error


def _corr_sql(x: str, y: str) -> str:
    xm = f"CASE WHEN {y} IS NOT NULL THEN {x} END"
    ym = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return (f"CASE WHEN stddev_samp({xm}) = 0 OR stddev_samp({ym}) = 0 THEN NULL "
            f"ELSE covar_samp({xm}, {ym}) / (stddev_samp({xm}) * stddev_samp({ym})) END")


_TARGET_CORR_SQL = f"""
WITH s AS (SELECT *, CAST(1.0 AS DOUBLE) AS units FROM ({V.sales_sql(neighborhood=True, part=True)}))
{' UNION ALL '.join(f"SELECT '{c}' AS feature, round({_corr_sql(c, 'sale_price')}, 6) AS corr_with_saleprice FROM s" for c in CORR_FEATURES)}
"""


@register("target_correlation", _TARGET_CORR_SQL)
def target_correlation(spark, sf):
    t = P.target_correlation(_corr_frame(spark, sf), "sale_price", CORR_FEATURES, name="corr_with_saleprice")
    return t.select("feature", F.round("corr_with_saleprice", 6).alias("corr_with_saleprice"))


PAIR_FEATURES = ["sale_price", "net_price", "gross_price", "gr_liv_area", "lot_area", "list_price", "overall_qual", "p_size"]


def _pair_frame(spark, sf):
    s = V.sales(spark, sf, part=True)
    return s.withColumn("net_price", F.col("sale_price") * (1 - F.col("l_discount"))).withColumn(
        "gross_price", F.col("sale_price") * (1 + F.col("l_tax")))


_COLLINEAR_SQL = f"""
WITH s AS (SELECT *, sale_price * (1 - l_discount) AS net_price, sale_price * (1 + l_tax) AS gross_price
           FROM ({V.sales_sql(part=True)})),
p AS ({' UNION ALL '.join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {_corr_sql(a, b)} AS r FROM s"
                         for i, a in enumerate(PAIR_FEATURES) for b in PAIR_FEATURES[i + 1:])})
SELECT feature_1, feature_2, round(abs(r), 3) AS abs_corr FROM p WHERE abs(r) >= 0.70
"""


@register("collinear_pairs", _COLLINEAR_SQL)
def collinear_pairs(spark, sf):
    return P.collinear_pairs(_pair_frame(spark, sf), PAIR_FEATURES, threshold=0.70)


# ---- A20 / A21 group comparisons ------------------------------------------------------

_RATIO_SQL = f"""
WITH s AS ({V.sales_sql(neighborhood=True)}),
m AS (SELECT neighborhood, median(sale_price) AS median_price FROM s WHERE neighborhood IS NOT NULL GROUP BY 1),
t AS (SELECT 'top' AS side, neighborhood, median_price FROM m ORDER BY median_price DESC, neighborhood LIMIT 5),
bt AS (SELECT 'bottom' AS side, neighborhood, median_price FROM m ORDER BY median_price ASC, neighborhood LIMIT 5),
r AS (SELECT max(median_price) / min(median_price) AS ratio FROM m)
SELECT side, neighborhood, round(median_price, 4) AS median_price, round((SELECT ratio FROM r), 6) AS ratio_max_min
FROM (SELECT * FROM t UNION ALL SELECT * FROM bt)
"""


@register("group_price_ratio", _RATIO_SQL)
def group_price_ratio(spark, sf):
    s = V.sales(spark, sf, neighborhood=True)
    m = P.group_medians(s, "sale_price", ["neighborhood"], name="median_price")
    whole = Window.partitionBy()  # over the per-group table (one row per neighbourhood)
    ratio = (F.max("median_price").over(whole) / F.min("median_price").over(whole))
    m = m.withColumn("ratio_max_min", F.round(ratio, 6))
    tb = P.top_bottom_groups(m, "median_price", "neighborhood", 5)
    return tb.join(m.select("neighborhood", "ratio_max_min"), "neighborhood").select(
        "side", "neighborhood", F.round("median_price", 4).alias("median_price"), "ratio_max_min")


_GROUP_DIMS = ["bldg_type", "house_style", "overall_qual"]

_GROUP_MEDIANS_SQL = f"""
WITH s AS ({V.sales_sql(part=True)})
{' UNION ALL '.join(f'''SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS level, count(*) AS n,
  round(median(sale_price), 4) AS median_price FROM s WHERE {d} IS NOT NULL GROUP BY {d}''' for d in _GROUP_DIMS)}
"""


@register("group_medians", _GROUP_MEDIANS_SQL)
def group_medians(spark, sf):
    s = V.sales(spark, sf, part=True)
    long = s.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("level"), F.col("sale_price").alias("v"))
        for d in _GROUP_DIMS])).alias("_p")).select("_p.*").where(F.col("level").isNotNull())
    med = exact_median(long, "v", by=["dimension", "level"], name="median_price")
    cnt = long.groupBy("dimension", "level").agg(F.count(F.lit(1)).alias("n"))
    return cnt.join(med, ["dimension", "level"]).select(
        "dimension", "level", "n", F.round("median_price", 4).alias("median_price"))


def _bucket_labels(edges):
    return [f"({edges[i]}, {edges[i + 1]}]" for i in range(len(edges) - 1)]


_AGE_LABELS = _bucket_labels(K.AGE_BUCKET_EDGES)

_AGE_SQL = f"""
WITH s AS (SELECT *, yr_sold - year_built AS age FROM ({V.sales_sql()})),
b AS (SELECT {bucket_case('age', K.AGE_BUCKET_EDGES, _AGE_LABELS)} AS age_bucket, sale_price FROM s)
SELECT age_bucket, count(*) AS n, round(median(sale_price), 4) AS median_price FROM b
WHERE age_bucket IS NOT NULL GROUP BY 1
"""


@register("age_bucket_medians", _AGE_SQL)
def age_bucket_medians(spark, sf):
    s = V.sales(spark, sf).select(
        right_closed_bucket(F.col("yr_sold") - F.col("year_built"), K.AGE_BUCKET_EDGES, _AGE_LABELS).alias("age_bucket"),
        "sale_price").where(F.col("age_bucket").isNotNull())
    med = exact_median(s, "sale_price", by=["age_bucket"], name="median_price")
    cnt = s.groupBy("age_bucket").agg(F.count(F.lit(1)).alias("n"))
    return cnt.join(med, "age_bucket").select("age_bucket", "n", F.round("median_price", 4).alias("median_price"))


_DOM_LABELS = _bucket_labels(K.DOM_BUCKET_EDGES)
DOM_AREA_PER_UNIT = 60.0  # fixed value: living area per quantity unit in the analogy


def _dom_sql(q: str, a: str) -> str:
    return (f"greatest(round_even({K.DOM_BASE} + {K.DOM_QUAL_WEIGHT} * pow({q} - {K.DOM_QUAL_CENTRE}, 2) + "
            f"{K.DOM_AREA_WEIGHT} * pow((least({a}, {K.DOM_AREA_CAP}) - {K.DOM_AREA_CENTRE}) / {K.DOM_AREA_SCALE}, 2), 0), 1)")


_DOM_SQL = f"""
WITH s AS (SELECT *, {_dom_sql('overall_qual', f'gr_liv_area * {DOM_AREA_PER_UNIT}')} AS dom FROM ({V.sales_sql(part=True)})),
b AS (SELECT {bucket_case('dom', K.DOM_BUCKET_EDGES, _DOM_LABELS)} AS dom_bucket, sale_price FROM s)
SELECT dom_bucket, count(*) AS n, round(median(sale_price), 4) AS median_price FROM b
WHERE dom_bucket IS NOT NULL GROUP BY 1
"""


@register("dom_bucket_medians", _DOM_SQL)
def dom_bucket_medians(spark, sf):
    s = V.sales(spark, sf, part=True)
    dom = dom_score("overall_qual", F.col("gr_liv_area") * DOM_AREA_PER_UNIT)
    b = s.select(right_closed_bucket(dom, K.DOM_BUCKET_EDGES, _DOM_LABELS).alias("dom_bucket"), "sale_price") \
        .where(F.col("dom_bucket").isNotNull())
    med = exact_median(b, "sale_price", by=["dom_bucket"], name="median_price")
    cnt = b.groupBy("dom_bucket").agg(F.count(F.lit(1)).alias("n"))
    return cnt.join(med, "dom_bucket").select("dom_bucket", "n", F.round("median_price", 4).alias("median_price"))


# ---- A24 distinct rates per month; A26 series ---------------------------------------------

_RATE_VIOL_SQL = f"""
WITH s AS ({V.sales_sql(orders=False)}),
d AS (SELECT DISTINCT yr_sold, mo_sold, l_tax FROM s WHERE l_tax IS NOT NULL)
SELECT yr_sold, mo_sold, count(*) AS n_distinct FROM d GROUP BY 1, 2 HAVING count(*) >= 2
"""


@register("rate_violations", _RATE_VIOL_SQL)
def rate_violations(spark, sf):
    return P.distinct_per_group(V.sales(spark, sf, orders=False), "l_tax", ["yr_sold", "mo_sold"])


# ---- A25 Spearman over neighbourhood aggregates --------------------------------------------

_SPEARMAN_SQL = """
WITH g AS (
  SELECT n_name, avg(c_acctbal) AS mean_distance, median(o_totalprice) AS median_price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
r AS (SELECT rank() OVER (ORDER BY mean_distance) + (count(*) OVER (PARTITION BY mean_distance) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY median_price) + (count(*) OVER (PARTITION BY median_price) - 1) / 2.0 AS ry FROM g)
SELECT count(*) AS n_groups, round(covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)), 6) AS spearman_rho FROM r
"""


@register("spearman_groups", _SPEARMAN_SQL)
def spearman_groups(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))  # 25 rows, fixed
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    dist = j.groupBy("n_name").agg(F.avg("c_acctbal").alias("mean_distance"))
    med = exact_median(j, "o_totalprice", by=["n_name"], name="median_price")
    g = dist.join(med, "n_name")  # one row per neighbourhood
    rho = P.spearman(g, "mean_distance", "median_price", key="n_name")
    return rho.select("n_groups", F.round("spearman_rho", 6).alias("spearman_rho"))


_SERIES_SQL = """
WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  avg(o_totalprice) AS rate FROM orders GROUP BY 1, 2)
SELECT year, month, round(year + (month - 1) / 12.0, 6) AS t, round(rate, 4) AS rate FROM m
"""


@register("rate_series", _SERIES_SQL)
def rate_series(spark, sf):
    from hearth.operators.enrich import monthly_series

    m = monthly_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "rate")
    return m.select("year", "month", F.round(F.col("year") + (F.col("month") - 1) / 12.0, 6).alias("t"),
                    F.round("rate", 4).alias("rate")).orderBy("year", "month")


# ---- A31 / A32 ---------------------------------------------------------------------------

_HIST_SQL = """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 35 ELSE 1.0 END AS width FROM e),
c AS (SELECT CAST(least(floor((o_totalprice - (SELECT lo FROM w)) / (SELECT width FROM w)), 34) AS INTEGER) AS bin,
             count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(35))
SELECT g.bin, round((SELECT lo FROM w) + g.bin * (SELECT width FROM w), 4) AS bin_lo,
       round((SELECT lo FROM w) + (g.bin + 1) * (SELECT width FROM w), 4) AS bin_hi, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.bin = c.bin
"""


@register("histogram", _HIST_SQL)
def histogram(spark, sf):
    h = P.histogram(table(spark, sf, "orders"), "o_totalprice", 35)
    return h.select("bin", F.round("bin_lo", 4).alias("bin_lo"), F.round("bin_hi", 4).alias("bin_hi"), "n")


_BOX_SQL = """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
j AS (SELECT o.o_orderpriority, o.o_totalprice AS v, q1, med, q3,
             o.o_totalprice >= q1 - 1.5 * (q3 - q1) AND o.o_totalprice <= q3 + 1.5 * (q3 - q1) AS inside
      FROM orders o JOIN q ON o.o_orderpriority = q.o_orderpriority WHERE o.o_totalprice IS NOT NULL)
SELECT o_orderpriority, round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3,
       round(min(CASE WHEN inside THEN v END), 4) AS whisker_lo, round(max(CASE WHEN inside THEN v END), 4) AS whisker_hi,
       CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_fliers, count(*) AS n
FROM j GROUP BY o_orderpriority, q1, med, q3
"""


@register("box_stats", _BOX_SQL)
def box_stats(spark, sf):
    b = P.box_stats(table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"])
    return b.select("o_orderpriority", *[F.round(c, 4).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "n_fliers", "n")


_QQ_SQL = f"""
WITH o AS (SELECT row_number() OVER (ORDER BY o_totalprice) AS i, count(*) OVER () AS n, CAST(o_totalprice AS DOUBLE) AS ordered
           FROM orders WHERE o_totalprice IS NOT NULL),
m AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n)
                     ELSE (i - 0.3175) / (n + 0.365) END AS m FROM o),
t AS (SELECT *, {normal_quantile_sql("CAST(m AS DOUBLE)")} AS z FROM m)
SELECT i - 1 AS pos, {sql_sig("z")} AS theoretical, ordered FROM t
"""


@register("qq_points", _QQ_SQL)
def qq_points(spark, sf):
    """A33."""
    return P.qq_points(table(spark, sf, "orders"), "o_totalprice").withColumn("theoretical", round_sig("theoretical"))


_VC_SQL = "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1"


@register("value_counts", _VC_SQL)
def value_counts(spark, sf):
    """A15."""
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


_FIRST_SQL = """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS rate FROM orders),
r AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, rate,
             row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_orderkey) AS i
      FROM o WHERE rate IS NOT NULL)
SELECT year, month, rate AS first_rate FROM r WHERE i = 1
"""


@register("first_monthly_rate", _FIRST_SQL)
def first_monthly_rate(spark, sf):
    """A26."""
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("rate"))
    return P.first_value(o, "rate", ["year", "month"], ["o_orderkey"], "first_rate")


_SUPPLEMENTARY = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@register("supplementary_correlations", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 9) AS corr, round(corr({c}, ln(1 + l_extendedprice)), 9) AS corr_log FROM lineitem"
    for c in _SUPPLEMENTARY))
def supplementary_correlations(spark, sf):
    """A30."""
    r = P.supplementary_correlations(table(spark, sf, "lineitem"), "l_extendedprice", _SUPPLEMENTARY)
    return r.select("feature", F.round("corr", 9).alias("corr"), F.round("corr_log", 9).alias("corr_log"))


# ---- A34 the digest ---------------------------------------------------------------

_DIGEST_COLS = ["sale_price", "gr_liv_area", "lot_area", "lot_frontage", "list_price", "distance_proxy", "overall_qual",
                "garage_area", "garage_type", "l_discount", "l_tax", "neighborhood"]
_DIGEST_ABSENT = ["garage_area", "garage_type"]
_DIGEST_CORR = ["gr_liv_area", "lot_area", "lot_frontage", "list_price", "distance_proxy", "overall_qual", "garage_area", "l_discount", "l_tax"]


def _digest_sql() -> str:
    log = "CASE WHEN sale_price > -1 THEN ln(1 + sale_price) END"
    target = {"min": "min(sale_price)", "max": "max(sale_price)", "mean": "avg(sale_price)", "median": "median(sale_price)",
              "skew_raw": "skewness(sale_price)", "skew_log": f"skewness({log})", "kurtosis_raw": "kurtosis(sale_price)"}
    genuine = ", ".join(f"'{c}'" for c in _DIGEST_ABSENT)
    parts = [f"SELECT 'target' AS section, '{m}' AS metric, CAST(NULL AS DOUBLE) AS key, CAST({x} AS DOUBLE) AS value FROM s" for m, x in target.items()]
    parts += [
        "SELECT 'missing', 'n_cols_with_missing', NULL, count(*) FROM m WHERE n > 0",
        f"SELECT 'missing', 'n_genuine', NULL, count(*) FROM m WHERE n > 0 AND c NOT IN ({genuine})",
        "SELECT 'missing_columns', c, n, round_even(n * 100.0 / (SELECT count(*) FROM s), 2) FROM m WHERE n > 0",
        f"SELECT 'outliers', 'n_candidates', NULL, count(*) FROM s WHERE coalesce({_LEV}, false) OR {_FLAG_COUNT_SQL} >= 3",
        *[f"SELECT 'outlier_features', '{c}', sum({_flag_sql(c)}), sum({_flag_sql(c)}) FROM s" for c in SCAN_COLS],
        "SELECT 'correlation', c, coalesce(abs(round(r, 6)), -1), round(r, 6) FROM r",
        "SELECT 'collinear', c, round(abs(r), 3), round(abs(r), 3) FROM p WHERE abs(r) >= 0.70",
        "(SELECT 'groups_top', neighborhood, v, v FROM g ORDER BY v DESC, neighborhood LIMIT 5)",
        "(SELECT 'groups_bottom', neighborhood, -v, v FROM g ORDER BY v, neighborhood LIMIT 5)",
        "SELECT 'groups', 'ratio_max_min', NULL, max(v) / min(v) FROM g",
    ]
    pairs = [(a, b) for i, a in enumerate(_DIGEST_CORR) for b in _DIGEST_CORR[i + 1:]]
    return f"""
WITH s AS ({V.sales_sql(neighborhood=True, part=True)}),
b AS ({_bounds_sql()}),
m AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, count(*) - count({c}) AS n FROM s" for c in _DIGEST_COLS)}),
r AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, {_corr_sql('sale_price', c)} AS r FROM s" for c in _DIGEST_CORR)}),
p AS ({' UNION ALL '.join(f"SELECT '{a}|{b}' AS c, {_corr_sql(a, b)} AS r FROM s" for a, b in pairs)}),
g AS (SELECT neighborhood, median(sale_price) AS v FROM s WHERE neighborhood IS NOT NULL GROUP BY 1),
u AS ({' UNION ALL '.join(parts)})
SELECT section, metric, CAST(CASE WHEN key IS NOT NULL THEN row_number() OVER (PARTITION BY section ORDER BY key DESC NULLS LAST, metric) END AS INTEGER) AS position,
  {sql_sig('value', 6)} AS value FROM u"""


@register("eda_digest", _digest_sql())
def eda_digest(spark, sf):
    """The whole EDA summary as ranked rows."""
    from hearth.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    s = _scan_frame(spark, sf).select(*_DIGEST_COLS).checkpoint()  # the passes reread it instead of redoing the joins
    lev = (F.col("gr_liv_area") > V.LEVERAGE_AREA) & (F.col("sale_price") < V.LEVERAGE_PRICE)
    d = P.eda_digest_rows(s, "sale_price", _DIGEST_ABSENT, SCAN_COLS, _DIGEST_CORR, "neighborhood", lev)
    return d.select("section", "metric", "position", round_sig("value", 6).alias("value"))
