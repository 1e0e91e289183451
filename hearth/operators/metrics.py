"""Evaluation: regression metrics, residual frames, sliced error summaries,
CV summaries and deterministic fold assignment (A27-A29, A35, M1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.constants import PRICE_BUCKET_EDGES, PRICE_BUCKET_LABELS
from hearth.functions.exprs import right_closed_bucket

#: log prices are added up as whole numbers of 1 / _SCALE
_SCALE = 1e10
METRIC_NAMES = ["rmse", "mae", "mape", "r2", "within_10_pct", "within_20_pct", "log_rmse"]


def fold_of(*keys: str | Column, k: int = 5) -> Column:
    """Deterministic fold in ``0..k-1`` from the md5 of the key (not of the row
    position), so it is identical on every partitioning, on re-execution after
    an executor loss, and in DuckDB."""
    parts = [F.col(c) if isinstance(c, str) else c for c in keys]
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % k).cast("int")


def price_scale(log_col: str | Column) -> Column:
    return F.expm1(F.col(log_col) if isinstance(log_col, str) else log_col)


def residual_frame(df: DataFrame, actual_log: str, pred_log: str, keep: Sequence[str] = (),
                   edges: Sequence[float] = PRICE_BUCKET_EDGES,
                   labels: Sequence[str] = PRICE_BUCKET_LABELS) -> DataFrame:
    """actual, predicted (floored at 0), residual, abs_error, abs_pct_error, price_bucket."""
    actual = price_scale(actual_log)
    predicted = F.greatest(price_scale(pred_log), F.lit(0.0))
    out = df.select(*keep, actual.alias("actual"), predicted.alias("predicted"), F.col(actual_log), F.col(pred_log))
    out = out.withColumn("residual", F.col("actual") - F.col("predicted"))
    out = out.withColumn("abs_error", F.abs("residual"))
    out = out.withColumn("abs_pct_error", F.col("abs_error") / F.greatest(F.col("actual"), F.lit(1.0)))
    return out.withColumn("price_bucket", right_closed_bucket("actual", edges, labels, include_lowest=True))


def metric_aggs(actual: str = "actual", predicted: str = "predicted", actual_log: str | None = None,
                pred_log: str | None = None) -> list[Column]:
    """A27 as aggregate expressions over a residual frame (one pass, partial agg)."""
    a, p = F.col(actual), F.col(predicted)
    err = a - p
    ape = F.abs(err) / F.greatest(a, F.lit(1.0))
    n = F.count(F.lit(1))
    ss_tot = F.var_pop(a) * n
    aggs = [
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(ape).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), ss_tot)).alias("r2"),
        F.avg((ape <= 0.10).cast("double")).alias("within_10_pct"),
        F.avg((ape <= 0.20).cast("double")).alias("within_20_pct"),
    ]
    if actual_log and pred_log:
        d = F.col(actual_log) - F.col(pred_log)
        aggs.append(F.sqrt(F.avg(d * d)).alias("log_rmse"))
    return aggs


def regression_metrics(df: DataFrame, actual_log: str, pred_log: str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, mape, r2, within_10/20_pct on price scale (prediction floored
    at 0, APE denominator max(actual, 1)), log_rmse on the unfloored logs."""
    res = residual_frame(df, actual_log, pred_log, keep=by)
    return res.groupBy(*by).agg(*metric_aggs("actual", "predicted", actual_log, pred_log))


def summarize_errors(residuals: DataFrame, key: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Error slice per ``key``: n, means, mae, mape, within_10/20_pct.

    With ``levels`` (e.g. every price bucket) empty levels still appear, n = 0.
    """
    agg = residuals.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg("actual").alias("actual_mean"),
        F.avg("predicted").alias("predicted_mean"),
        F.avg("residual").alias("residual_mean"),
        F.avg("abs_error").alias("mae"),
        F.avg("abs_pct_error").alias("mape"),
        F.avg((F.col("abs_pct_error") <= 0.10).cast("double")).alias("within_10_pct"),
        F.avg((F.col("abs_pct_error") <= 0.20).cast("double")).alias("within_20_pct"),
    )
    if levels is None:
        return agg
    spark = residuals.sparkSession
    # the level list is a fixed, caller-supplied dimension: bounded by construction
    dim = spark.createDataFrame([(lv, i) for i, lv in enumerate(levels)], f"{key} string, _order int")
    return dim.join(agg, key, "left").select(
        key, F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        *[c for c in ["actual_mean", "predicted_mean", "residual_mean", "mae", "mape", "within_10_pct", "within_20_pct"]],
    )


def cv_summary(fold_metrics: DataFrame, by: Sequence[str] = ("model",),
               metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Mean and sample std over folds for each metric."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"cv_{m}_mean"), F.stddev_samp(m).alias(f"cv_{m}_std")]
    return fold_metrics.groupBy(*by).agg(*aggs)


def oof_group_mean(df: DataFrame, group: str, y: str, fold: str, name: str = "pred_log") -> DataFrame:
    """Out-of-fold baseline predictor: a row in fold k is predicted by the mean
    ``y`` of its group over the OTHER folds (all other-fold rows when the group
    has none there).

    Everything is a partial aggregation keyed by (group, fold), (group) and
    (fold); rows meet their statistics through two equi-joins.  Sums are kept in
    whole numbers of a fixed scale, so they do not depend on the order of addition: a
    residual near zero would magnify that.
    """
    gf = df.groupBy(group, fold).agg(F.sum(F.round(F.col(y) * _SCALE).cast("decimal(28,0)")).alias("_sgf"), F.count(F.lit(1)).alias("_ngf"))
    g = gf.groupBy(group).agg(F.sum("_sgf").alias("_sg"), F.sum("_ngf").alias("_ng"))
    per_fold = gf.groupBy(fold).agg(F.sum("_sgf").alias("_sf"), F.sum("_ngf").alias("_nf"))
    from pyspark.sql import Window

    everything = Window.partitionBy()  # over the k-row fold table only
    per_fold = per_fold.withColumn("_st", F.sum("_sf").over(everything)).withColumn("_nt", F.sum("_nf").over(everything))
    mean = lambda total, part, n, m: (F.col(total) - F.col(part)).cast("double") / _SCALE / (F.col(n) - F.col(m))
    stats = gf.join(g, group).join(F.broadcast(per_fold), fold).select(  # the fold table has k rows
        group, fold, F.when(F.col("_ng") > F.col("_ngf"), mean("_sg", "_sgf", "_ng", "_ngf")).otherwise(mean("_st", "_sf", "_nt", "_nf")).alias(name))
    j = df.join(stats, [group, fold])
    return j.select(*df.columns, name)
