"""Evaluation-area queries: a deterministic out-of-fold baseline (per-part
mean log price) scored with the regression metrics, fold metrics, CV summary
and error slices (M1, A27-A29, A35)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import round_sig
from hearth.operators.metrics import (METRIC_NAMES, cv_summary, fold_of, metric_aggs, oof_group_mean,
                                      residual_frame, summarize_errors)
from hearth.plans import views as V
from hearth.plans.registry import register
from hearth.plans.sqltext import bucket_case, values_table
from hearth.plans.sqltext import round_sig as sql_sig
from hearth.sources.tables import table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _scored(spark, sf, with_quality: bool = False):
    li = table(spark, sf, "lineitem")
    s = li.select(*KEYS, F.log1p("l_extendedprice").alias("y"), fold_of(*KEYS).alias("fold"))
    p = oof_group_mean(s, "l_partkey", "y", "fold")
    if with_quality:
        pa = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.ceil(F.col("p_size") / 5).cast("int").alias("overall_qual"))
        p = p.join(pa, "l_partkey")
    return p


_BASE_SQL = """
s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ln(1 + l_extendedprice) AS y,
             CAST(CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold
      FROM lineitem),
gf AS (SELECT l_partkey, fold, sum(CAST(round(y * 1e10) AS HUGEINT)) AS sgf, count(*) AS ngf FROM s GROUP BY 1, 2),
g AS (SELECT l_partkey, sum(sgf) AS sg, sum(ngf) AS ng FROM gf GROUP BY 1),
f AS (SELECT fold, sum(CAST(round(y * 1e10) AS HUGEINT)) AS sf, count(*) AS nf FROM s GROUP BY 1),
t AS (SELECT sum(sf) AS st, sum(nf) AS nt FROM f),
p AS (SELECT s.*, CASE WHEN g.ng - gf.ngf > 0 THEN CAST(g.sg - gf.sgf AS DOUBLE) / 1e10 / (g.ng - gf.ngf)
                       ELSE CAST(t.st - f.sf AS DOUBLE) / 1e10 / (t.nt - f.nf) END AS pred_log
      FROM s JOIN gf ON s.l_partkey = gf.l_partkey AND s.fold = gf.fold JOIN g ON s.l_partkey = g.l_partkey
             JOIN f ON s.fold = f.fold CROSS JOIN t),
r AS (SELECT *, exp(y) - 1 AS actual, greatest(exp(pred_log) - 1, 0) AS predicted FROM p),
e AS (SELECT *, actual - predicted AS residual, abs(actual - predicted) AS abs_error,
             abs(actual - predicted) / greatest(actual, 1) AS abs_pct_error FROM r)
"""


def _metrics_sql() -> str:
    m = {
        "rmse": "sqrt(avg(residual * residual))",
        "mae": "avg(abs_error)",
        "mape": "avg(abs_pct_error)",
        "r2": "1 - sum(residual * residual) / (var_pop(actual) * count(*))",
        "within_10_pct": "avg(CASE WHEN abs_pct_error <= 0.10 THEN 1.0 ELSE 0.0 END)",
        "within_20_pct": "avg(CASE WHEN abs_pct_error <= 0.20 THEN 1.0 ELSE 0.0 END)",
        "log_rmse": "sqrt(avg((y - pred_log) * (y - pred_log)))",
    }
    return ", ".join(f"{sql_sig(v)} AS {k}" for k, v in m.items())


def _rounded(df, keep):
    return df.select(*keep, *[round_sig(m).alias(m) for m in METRIC_NAMES])


_METRICS_SQL = f"WITH {_BASE_SQL} SELECT count(*) AS n, {_metrics_sql()} FROM e"


@register("regression_metrics", _METRICS_SQL)
def regression_metrics(spark, sf):
    res = residual_frame(_scored(spark, sf), "y", "pred_log")
    agg = res.agg(F.count(F.lit(1)).alias("n"), *metric_aggs("actual", "predicted", "y", "pred_log"))
    return _rounded(agg, ["n"])


_FOLD_SQL = f"WITH {_BASE_SQL} SELECT fold, count(*) AS n, {_metrics_sql()} FROM e GROUP BY fold"


@register("oof_fold_metrics", _FOLD_SQL)
def oof_fold_metrics(spark, sf):
    res = residual_frame(_scored(spark, sf), "y", "pred_log", keep=["fold"])
    agg = res.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *metric_aggs("actual", "predicted", "y", "pred_log"))
    return _rounded(agg, ["fold", "n"])


_CV_SQL = f"""WITH {_BASE_SQL}, fm AS (SELECT fold, {_metrics_sql()} FROM e GROUP BY fold)
SELECT 'part_mean' AS model, {', '.join(f"{sql_sig(f'avg({m})')} AS cv_{m}_mean, {sql_sig(f'stddev_samp({m})')} AS cv_{m}_std" for m in METRIC_NAMES)}
FROM fm"""


@register("cv_summary", _CV_SQL)
def cv_summary_q(spark, sf):
    res = residual_frame(_scored(spark, sf), "y", "pred_log", keep=["fold"])
    fm = _rounded(res.groupBy("fold").agg(*metric_aggs("actual", "predicted", "y", "pred_log")), ["fold"])
    summ = cv_summary(fm.withColumn("model", F.lit("part_mean")))
    return summ.select("model", *[round_sig(c).alias(c) for c in summ.columns if c != "model"])


_SLICE_COLS = ["actual_mean", "predicted_mean", "residual_mean", "mae", "mape", "within_10_pct", "within_20_pct"]


def _slice_sql(key: str) -> str:
    return (f"count(*) AS n, {sql_sig('avg(actual)')} AS actual_mean, {sql_sig('avg(predicted)')} AS predicted_mean, "
            f"{sql_sig('avg(residual)')} AS residual_mean, {sql_sig('avg(abs_error)')} AS mae, "
            f"{sql_sig('avg(abs_pct_error)')} AS mape, "
            f"{sql_sig('avg(CASE WHEN abs_pct_error <= 0.10 THEN 1.0 ELSE 0.0 END)')} AS within_10_pct, "
            f"{sql_sig('avg(CASE WHEN abs_pct_error <= 0.20 THEN 1.0 ELSE 0.0 END)')} AS within_20_pct")


_BUCKET_SQL = f"""WITH {_BASE_SQL},
b AS (SELECT *, {bucket_case('actual', V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS, include_lowest=True)} AS price_bucket FROM e),
agg AS (SELECT price_bucket, {_slice_sql('price_bucket')} FROM b WHERE price_bucket IS NOT NULL GROUP BY 1),
{values_table('dim', ['price_bucket'], [(x,) for x in V.SALE_PRICE_LABELS])}
SELECT dim.price_bucket, coalesce(n, 0) AS n, {', '.join(_SLICE_COLS)} FROM dim LEFT JOIN agg ON dim.price_bucket = agg.price_bucket"""


@register("error_by_bucket", _BUCKET_SQL)
def error_by_bucket(spark, sf):
    res = residual_frame(_scored(spark, sf), "y", "pred_log", edges=V.SALE_PRICE_EDGES, labels=V.SALE_PRICE_LABELS)
    out = summarize_errors(res, "price_bucket", levels=V.SALE_PRICE_LABELS)
    return out.select("price_bucket", "n", *[round_sig(c).alias(c) for c in _SLICE_COLS])


_QUAL_SQL = f"""WITH {_BASE_SQL},
q AS (SELECT e.*, CAST(ceil(p_size / 5) AS INTEGER) AS overall_qual FROM e JOIN part ON e.l_partkey = p_partkey)
SELECT overall_qual, {_slice_sql('overall_qual')} FROM q GROUP BY overall_qual"""


@register("error_by_quality", _QUAL_SQL)
def error_by_quality(spark, sf):
    res = residual_frame(_scored(spark, sf, with_quality=True), "y", "pred_log", keep=["overall_qual"])
    out = summarize_errors(res, "overall_qual")
    return out.select("overall_qual", "n", *[round_sig(c).alias(c) for c in _SLICE_COLS])


def _conf_sql() -> str:
    bucket = bucket_case("predicted", V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS, include_lowest=True)
    return f"""WITH {_BASE_SQL},
sb AS (SELECT *, {bucket} AS b FROM e),
bands AS (SELECT b, quantile_cont(actual / predicted - 1, 0.05) AS lo, quantile_cont(actual / predicted - 1, 0.95) AS hi
          FROM sb WHERE predicted > 0 AND b IS NOT NULL GROUP BY b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_sig('predicted')} AS predicted,
       {sql_sig('greatest(predicted * (1 + lo), 0)')} AS range_low, {sql_sig('predicted * (1 + hi)')} AS range_high
FROM sb LEFT JOIN bands ON sb.b = bands.b"""


@register("confidence_range", _conf_sql())
def confidence_range_q(spark, sf):
    """Every sale scored by the out-of-fold baseline with the 5%-95%
    relative-error band of its predicted-price bucket."""
    from hearth.operators.ml import confidence_range

    from hearth.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # the residual table feeds the routing, band and scoring passes: written once
    res = residual_frame(_scored(spark, sf), "y", "pred_log", keep=KEYS).checkpoint()
    out = confidence_range(res, res.select(*KEYS, "predicted"), V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS)
    return out.select(*KEYS, *[round_sig(c).alias(c) for c in ["predicted", "range_low", "range_high"]])


_RES_NUM = ["actual", "predicted", "residual", "abs_error", "abs_pct_error"]


def _res_sql() -> str:
    num = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {sql_sig(f'avg({c})')} AS mean, {sql_sig(f'stddev_samp({c})')} AS std,
  {sql_sig(f'min({c})')} AS "min", {sql_sig(f'quantile_cont({c}, 0.25)')} AS q25, {sql_sig(f'quantile_cont({c}, 0.5)')} AS q50,
  {sql_sig(f'quantile_cont({c}, 0.75)')} AS q75, {sql_sig(f'max({c})')} AS "max",
  CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM b""" for c in _RES_NUM)
    return f"""WITH {_BASE_SQL},
b AS (SELECT *, {bucket_case('actual', V.SALE_PRICE_EDGES, V.SALE_PRICE_LABELS, include_lowest=True)} AS price_bucket FROM e),
pc AS (SELECT price_bucket AS v, count(*) AS n FROM b WHERE price_bucket IS NOT NULL GROUP BY 1),
top AS (SELECT v, n FROM pc ORDER BY n DESC, v ASC LIMIT 1)
{num}
UNION ALL SELECT 'price_bucket', count(price_bucket), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  count(DISTINCT price_bucket), (SELECT v FROM top), (SELECT n FROM top) FROM b"""


@register("residual_summary", _res_sql())
def residual_summary(spark, sf):
    """``describe(include='all')`` of the residual frame, one row per column
    (numeric statistics with exact quartiles; unique/top/freq for the bucket)."""
    from hearth.operators.profile import describe, describe_text
    from hearth.shared import saved

    res = residual_frame(_scored(spark, sf), "y", "pred_log", edges=V.SALE_PRICE_EDGES, labels=V.SALE_PRICE_LABELS)
    res = saved(res.select(*_RES_NUM, "price_bucket"), "residuals")  # moments, quartiles and texts reread columns, not the joins
    num = describe(res, _RES_NUM)
    num = num.select("column", "count", *[round_sig(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]],
                     F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
                     F.lit(None).cast("long").alias("freq"))
    txt = describe_text(res, ["price_bucket"]).select(
        "column", "count", *[F.lit(None).cast("double").alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]],
        "unique", "top", F.col("freq").cast("long").alias("freq"))
    return num.unionByName(txt)
