"""Profiling: missingness, distribution shape, outliers, correlation, group
comparisons (A1-A26, A31-A32).

Wide statistics are computed as ONE aggregation over all requested columns
(one scan, partial aggregation) instead of one job per column; per-column
order statistics go through a long ``(column, value)`` view so a single
``exact_quantiles`` call serves every column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hearth.functions.exprs import any_null, normal_quantile_sql, pair_corr, sample_excess_kurtosis, sample_skewness
from hearth.operators.quantiles import column_quantiles, exact_median, exact_quantiles
from hearth.shared import saved, scratch

# fixed values: missing-report labels
NA_ABSENT_LABEL = "absent (NA = feature does not exist)"
NA_GENUINE_LABEL = "genuine missing (needs imputation)"
# fixed values: outlier-candidate reasons
LEVERAGE_REASON = "leverage: huge GrLivArea sold cheap (recommend REMOVE)"
MULTIVARIATE_REASON = "multivariate: IQR-outlier on {n} features (review)"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType) and f.name not in exclude]


def to_long(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value",
            keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``columns`` (cast to double) into ``(keep..., name, value)``; nulls kept."""
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(
        *keep, F.col("_p.n").alias(name), F.col("_p.v").alias(value)
    )


def quantiles_by_column(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                        names: Sequence[str]) -> DataFrame:
    """Exact quantiles of every column in one job over the long view."""
    return exact_quantiles(to_long(df, columns), "value", probs, by=["column"], names=names)


def _one_row_to_long(row_df: DataFrame, items: Sequence[tuple[Sequence[str], str]],
                     labels: Sequence[str], value: str) -> DataFrame:
    """Turn a one-row aggregate into rows ``(labels..., value)``."""
    structs = [
        F.struct(*[F.lit(t).alias(lab) for t, lab in zip(tags, labels)], F.col(alias).alias(value))
        for tags, alias in items
    ]
    return row_df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


# ---- A1 / A2 ----------------------------------------------------------------

def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_missing)`` for columns with at least one NULL, most first."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    long = _one_row_to_long(agg, [((c,), f"_m{i}") for i, c in enumerate(cols)], ["column"], "n_missing")
    return long.where(F.col("n_missing") > 0).orderBy(F.desc("n_missing"), "column")


def missing_report(df: DataFrame, absent_columns: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_missing, pct_missing, na_meaning)``; pct is half-even rounded to 2 dp."""
    cols = list(columns or df.columns)
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)],
    )
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("n_missing")) for i, c in enumerate(cols)]
    long = agg.select("_n", F.explode(F.array(*structs)).alias("_r")).select("_n", "_r.*")
    return long.where(F.col("n_missing") > 0).select(
        "column",
        F.col("n_missing").cast("long").alias("n_missing"),
        F.bround(F.col("n_missing") / F.col("_n") * 100, 2).alias("pct_missing"),
        F.when(F.col("column").isin(list(absent_columns)), F.lit(NA_ABSENT_LABEL))
        .otherwise(F.lit(NA_GENUINE_LABEL)).alias("na_meaning"),
    ).orderBy(F.desc("n_missing"), "column")


# ---- A7 / A8 / A9 -----------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``describe()`` with exact quartiles: ``(column, count, mean, std, min, q25, q50, q75, max)``."""
    long = to_long(df, columns)
    moments = long.groupBy("column").agg(
        F.count("value").cast("long").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    with scratch(df.sparkSession):  # the quartiles reread these columns
        found = column_quantiles(saved(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in dict.fromkeys(columns)]), "columns"), columns, [0.25, 0.5, 0.75])
    quarts = df.sparkSession.createDataFrame([(c, *q) for c, q in found[None].items()], "column string, q25 double, q50 double, q75 double")
    return moments.join(quarts, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text half of ``describe(include='all')``: ``(column, count, unique, top, freq)``."""
    from hearth.operators.quantiles import mode_of

    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("_p")).select("_p.*")
    counts = long.groupBy("column").agg(
        F.count("value").cast("long").alias("count"),
        F.count_distinct("value").cast("long").alias("unique"),
    )
    top = mode_of(long, "value", by=["column"], name="top", count_name="freq")
    return counts.join(top, "column", "left")


def shape_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-adjusted skewness / excess kurtosis, raw and after ``log1p``."""
    long = to_long(df, columns)
    logged = F.when(F.col("value") > -1, F.log1p("value"))
    return long.groupBy("column").agg(
        F.count("value").cast("long").alias("n"),
        sample_skewness("value").alias("skew"),
        sample_excess_kurtosis("value").alias("kurtosis"),
        sample_skewness(logged).alias("skew_log1p"),
        sample_excess_kurtosis(logged).alias("kurtosis_log1p"),
    )


# ---- A10 - A14: outliers ------------------------------------------------------

@dataclass(frozen=True)
class OutlierBounds:
    """Fitted per-column IQR fences and z-score moments (small: one entry per column)."""

    columns: tuple[str, ...]
    q1: dict
    q3: dict
    mean: dict
    std: dict
    k: float = 1.5

    def low(self, c: str) -> float | None:
        if self.q1[c] is None:
            return None
        return self.q1[c] - self.k * (self.q3[c] - self.q1[c])

    def high(self, c: str) -> float | None:
        if self.q3[c] is None:
            return None
        return self.q3[c] + self.k * (self.q3[c] - self.q1[c])


def fit_outlier_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> OutlierBounds:
    long = to_long(df, columns)
    quarts = quantiles_by_column(df, columns, [0.25, 0.75], ["q1", "q3"])
    moments = long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    rows = {r["column"]: r for r in moments.join(quarts, "column", "left").collect()}  # one row per column
    get = lambda key: {c: (rows[c][key] if c in rows else None) for c in columns}
    return OutlierBounds(tuple(columns), get("q1"), get("q3"), get("mean"), get("std"), k)


def iqr_flag(bounds: OutlierBounds, c: str) -> Column:
    lo, hi = bounds.low(c), bounds.high(c)
    if lo is None:
        return F.lit(0)
    x = F.col(c)
    return F.coalesce(((x < F.lit(lo)) | (x > F.lit(hi))), F.lit(False)).cast("int")


def zscore_flag(bounds: OutlierBounds, c: str) -> Column:
    mu, sd = bounds.mean[c], bounds.std[c]
    if mu is None or not sd:
        return F.lit(0)
    return F.coalesce(F.abs((F.col(c) - F.lit(mu)) / F.lit(sd)) > 3, F.lit(False)).cast("int")


def outlier_summary(df: DataFrame, columns: Sequence[str], bounds: OutlierBounds | None = None) -> DataFrame:
    """``(feature, n_iqr, pct_iqr, n_zscore, pct_zscore, iqr_high)``; pct over ALL rows."""
    b = bounds or fit_outlier_bounds(df, columns)
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(iqr_flag(b, c)).alias(f"_i{j}") for j, c in enumerate(columns)],
        *[F.sum(zscore_flag(b, c)).alias(f"_z{j}") for j, c in enumerate(columns)],
    )
    structs = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_i{j}").alias("ni"),
            F.col(f"_z{j}").alias("nz"),
            F.lit(b.high(c)).cast("double").alias("hi"),
        )
        for j, c in enumerate(columns)
    ]
    long = agg.select("_n", F.explode(F.array(*structs)).alias("_r")).select("_n", "_r.*")
    return long.select(
        "feature",
        F.col("ni").cast("long").alias("n_iqr"),
        F.bround(F.col("ni") / F.col("_n") * 100, 2).alias("pct_iqr"),
        F.col("nz").cast("long").alias("n_zscore"),
        F.bround(F.col("nz") / F.col("_n") * 100, 2).alias("pct_zscore"),
        F.bround("hi", 1).alias("iqr_high"),
    ).orderBy(F.desc("n_iqr"), "feature")


def with_outlier_flags(df: DataFrame, columns: Sequence[str], bounds: OutlierBounds) -> DataFrame:
    """Adds ``n_outlier_flags`` and ``flagged_features`` (scan-column order)."""
    flags = [iqr_flag(bounds, c) for c in columns]
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    names = F.concat_ws(",", *[F.when(f == 1, F.lit(c)) for f, c in zip(flags, columns)])
    return df.withColumn("n_outlier_flags", total).withColumn("flagged_features", names)


def flag_distribution(df: DataFrame, columns: Sequence[str], bounds: OutlierBounds | None = None) -> DataFrame:
    b = bounds or fit_outlier_bounds(df, columns)
    return with_outlier_flags(df, columns, b).groupBy("n_outlier_flags").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows")
    )


def outlier_candidates(df: DataFrame, columns: Sequence[str], leverage: Column, min_flags: int = 3,
                       report: Sequence[str] = (), bounds: OutlierBounds | None = None,
                       sort: Sequence[Column] = ()) -> DataFrame:
    """Rows hit by the leverage rule or flagged on ``min_flags`` or more columns."""
    b = bounds or fit_outlier_bounds(df, columns)
    flagged = with_outlier_flags(df, columns, b)
    lev = F.coalesce(leverage, F.lit(False))
    out = flagged.where(lev | (F.col("n_outlier_flags") >= min_flags)).select(
        *report, "n_outlier_flags", "flagged_features",
        F.when(lev, F.lit(LEVERAGE_REASON)).otherwise(
            F.format_string("multivariate: IQR-outlier on %d features (review)", F.col("n_outlier_flags"))
        ).alias("reason"),
    )
    return out.orderBy(F.desc("n_outlier_flags"), *sort) if sort else out


# ---- A16 / A17 ---------------------------------------------------------------

def pairwise_correlation(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson r for every pair over its complete rows (NULL in either column
    excludes the row for that pair only), from ONE pass.

    Each task turns its Arrow batches into, per pair, the count and the sums
    of x, x^2 and xy over rows where both are present (four matrix products
    with the presence mask); Spark adds the partial matrices, so only p x p
    numbers reach the driver.  Values are shifted by each column's minimum
    first (exact zeros for a constant column, whose r is then NaN -> NULL).
    """
    p = len(cols)
    mins = df.agg(*[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).collect()[0]
    shift = [float(mins[f"m{i}"]) if mins[f"m{i}"] is not None else 0.0 for i in range(p)]
    arr = F.array(*[(F.col(c).cast("double") - F.lit(sh)).alias(c) for c, sh in zip(cols, shift)])

    def partial(batches):
        acc = None
        for b in batches:
            if not len(b):
                continue
            x = np.vstack(b["x"].to_numpy()).astype(float)  # NULL elements -> NaN
            m = ~np.isnan(x)
            x0 = np.where(m, x, 0.0)
            mf = m.astype(float)
            parts = np.stack([mf.T @ mf, x0.T @ mf, (x0 * x0).T @ mf, x0.T @ x0])
            acc = parts if acc is None else acc + parts
        if acc is not None:
            k, i, j = np.indices(acc.shape)
            yield pd.DataFrame({"k": k.ravel().astype("int32"), "i": i.ravel().astype("int32"),
                                "j": j.ravel().astype("int32"), "v": acc.ravel()})

    rows = df.select(arr.alias("x")).mapInPandas(partial, "k int, i int, j int, v double") \
        .groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect()  # 4 p^2 numbers
    t = np.zeros((4, p, p))
    for r in rows:
        t[r["k"], r["i"], r["j"]] = r["v"]
    n, sx, sxx, sxy = t  # sx[i, j]: sum of x_i over rows where i and j are both present
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = n * sxy - sx * sx.T
        var_i = n * sxx - sx * sx
        r = cov / np.sqrt(var_i * var_i.T)
    r[(n < 2) | (var_i <= 0) | (var_i.T <= 0)] = np.nan
    return r


def target_correlation(df: DataFrame, target: str, features: Sequence[str], name: str = "corr_with_target") -> DataFrame:
    """``(feature, <name>)`` ordered by |r| descending; constant columns give NULL."""
    r = pairwise_correlation(df, [target, *features])
    rows = [(f, None if np.isnan(r[0, i + 1]) else float(r[0, i + 1])) for i, f in enumerate(features)]
    out = df.sparkSession.createDataFrame(rows, f"feature string, {name} double")
    return out.orderBy(F.abs(F.col(name)).desc_nulls_last(), "feature")


def supplementary_correlations(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """``(feature, corr, corr_log)`` with the target and with log(1 + it),
    from one aggregate; constant columns give NULL."""
    log = F.log1p(F.col(target).cast("double"))
    pair = lambda c, t: pair_corr(F.col(c).cast("double"), t)
    row = df.agg(*[e for i, c in enumerate(features) for e in (
        pair(c, F.col(target).cast("double")).alias(f"r{i}"), pair(c, log).alias(f"l{i}"))])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("corr"), F.col(f"l{i}").alias("corr_log")) for i, c in enumerate(features)]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def first_value(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], name: str = "first") -> DataFrame:
    """Per group the value that is not NULL and comes first by ``order``."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.min_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias(name))


def correlation_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All i<j Pearson correlations ``(feature_1, feature_2, corr)`` from one scan."""
    r = pairwise_correlation(df, features)
    rows = [(features[i], features[j], None if np.isnan(r[i, j]) else float(r[i, j]))
            for i in range(len(features)) for j in range(i + 1, len(features))]
    return df.sparkSession.createDataFrame(rows, "feature_1 string, feature_2 string, corr double")


def collinear_pairs(df: DataFrame, features: Sequence[str], threshold: float = 0.70, digits: int = 3) -> DataFrame:
    """Pairs with |r| >= threshold (tested before rounding), rounded, descending."""
    pairs = correlation_pairs(df, features)
    return pairs.where(F.abs("corr") >= threshold).select(
        "feature_1", "feature_2", F.round(F.abs("corr"), digits).alias("abs_corr")
    ).orderBy(F.desc("abs_corr"), "feature_1", "feature_2")


# ---- A20 - A26 -------------------------------------------------------------

def group_medians(df: DataFrame, value: str, by: Sequence[str], name: str = "median") -> DataFrame:
    """Exact median per group; NULL group keys are dropped (pandas groupby)."""
    keyed = df.where(~any_null(by)) if by else df
    return exact_median(keyed, value, by=by, name=name)


def top_bottom_groups(medians: DataFrame, value: str, key: str, k: int = 5) -> DataFrame:
    """``(side, key, value)`` for the k highest and k lowest groups (ties by key)."""
    top = medians.orderBy(F.desc(value), key).limit(k).withColumn("side", F.lit("top"))
    bottom = medians.orderBy(F.asc(value), key).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", key, value)


def distinct_per_group(df: DataFrame, value: str, by: Sequence[str], min_distinct: int = 2,
                       name: str = "n_distinct") -> DataFrame:
    """Groups whose non-null ``value`` takes ``min_distinct`` or more distinct values.

    Two-level distinct (``groupBy(g, v)`` then count) keeps a hot group spread.
    """
    pairs = df.where(F.col(value).isNotNull()).select(*by, value).distinct()
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias(name)).where(F.col(name) >= min_distinct)


def average_ranks(df: DataFrame, value: str, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` (non-null ``value`` rows) plus pandas-style average ranks (1-based,
    ties share the mean of their positions), without a single-task window:
    positions come from the distributed row index, ties from a per-value
    aggregate joined back on the value."""
    idx = with_global_index(df.where(F.col(value).isNotNull()), [value], "_pos", partitions)
    ties = idx.groupBy(value).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_c"))
    return idx.join(ties, value).withColumn(name, F.col("_first") + 1 + (F.col("_c") - 1) / 2.0) \
        .drop("_pos", "_first", "_c")


def spearman(table: DataFrame, x: str, y: str, key: str, name: str = "spearman_rho") -> DataFrame:
    """Spearman rho between two columns over rows where both are present:
    Pearson r of their average ranks (rows matched back by ``key``)."""
    both = table.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(key, x, y)
    rx = average_ranks(both.select(key, x), x, "_rx").select(key, "_rx")
    ry = average_ranks(both.select(key, y), y, "_ry").select(key, "_ry")
    return rx.join(ry, key).agg(F.count(F.lit(1)).alias("n_groups"), pair_corr("_rx", "_ry").alias(name))


# ---- A31 / A32 -------------------------------------------------------------

def histogram(df: DataFrame, value: str, bins: int = 35) -> DataFrame:
    """Equal-width histogram ``(bin, bin_lo, bin_hi, n)``, every bin present."""
    ext = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).collect()[0]  # two numbers
    lo, hi = ext["lo"], ext["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    width = (hi - lo) / bins if hi > lo else 1.0
    idx = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (extreme points inside the
    fences), flier count."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], by=by, names=["q1", "median", "q3"])
    fenced = df.select(*by, value).join(q, list(by)).withColumn("_iqr", F.col("q3") - F.col("q1"))
    inside = (F.col(value) >= F.col("q1") - k * F.col("_iqr")) & (F.col(value) <= F.col("q3") + k * F.col("_iqr"))
    return fenced.where(F.col(value).isNotNull()).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
        F.count_if(~inside).cast("long").alias("n_fliers"),
        F.count(F.lit(1)).cast("long").alias("n"),
    )


# ---- A33: Q-Q points ---------------------------------------------------------

def with_global_index(df: DataFrame, order: Sequence[str], name: str = "pos", partitions: int | None = None) -> DataFrame:
    """Every row plus its 0-based position in ``order`` (ascending), computed
    without a single-task window.

    Range-partition on (order..., hash tiebreak) so even a value repeated
    across a third of the rows is split over partitions, count rows per
    partition (tiny table), prefix-sum those counts, and add the local row
    number inside each range partition.  The partitioned frame is
    checkpointed so partition ids stay fixed if a task is re-run.
    """
    from hearth.session import ensure_checkpoint_dir

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    d = df.withColumn("_tb", F.xxhash64(*[F.col(c) for c in cols], F.monotonically_increasing_id()))
    d = d.repartitionByRange(n, *order, "_tb").withColumn("_pid", F.spark_partition_id())
    ensure_checkpoint_dir(spark)
    d = d.checkpoint()
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))  # one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order, "_tb")) - 1
    return d.withColumn("_local", local).join(F.broadcast(offsets), "_pid") \
        .select(*cols, (F.col("_off") + F.col("_local")).alias(name))


def global_positions(df: DataFrame, value: str, partitions: int | None = None) -> DataFrame:
    """``(v, pos)``: position of every non-null value in ascending order."""
    d = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    return with_global_index(d, ["v"], "pos", partitions)


def qq_points(df: DataFrame, value: str) -> DataFrame:
    """``(pos, theoretical, ordered)`` against the standard normal, using
    Filliben's order-statistic medians (the probability-plot convention)."""
    pos = global_positions(df, value)
    total = pos.count()  # n: one number
    i = F.col("pos") + 1
    last = F.pow(F.lit(0.5), F.lit(1.0 / total)) if total else F.lit(0.5)
    m = F.when(i == total, last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (F.lit(total) + 0.365))
    return pos.withColumn("_m", m).select("pos", F.expr(normal_quantile_sql("_m")).alias("theoretical"), F.col("v").alias("ordered"))


def qq_fit(points: DataFrame) -> DataFrame:
    """Least-squares line through the Q-Q points and its correlation."""
    return points.agg(
        (F.covar_pop("theoretical", "ordered") / F.var_pop("theoretical")).alias("slope"),
        (F.avg("ordered") - F.covar_pop("theoretical", "ordered") / F.var_pop("theoretical") * F.avg("theoretical")).alias("intercept"),
        pair_corr("theoretical", "ordered").alias("r"),
    )


# ---- A34: the EDA digest ----------------------------------------------------------

def eda_digest_rows(df: DataFrame, target: str, absent_columns: Sequence[str], scan_columns: Sequence[str],
                    corr_features: Sequence[str], group: str, leverage: Column, min_flags: int = 3,
                    top_k: int = 5, threshold: float = 0.70) -> DataFrame:
    """The summary of the EDA step as ``(section, metric, position, value)``;
    ``position`` counts from 1 in the sections that are ranked, ties by metric.

    Moments, missing counts and outlier counts of all columns are one aggregate,
    all correlations one pass; quartiles, the target's median and the medians
    per group are one quantile job each.  An empty table has null moments and
    no ranked rows but the counts of 0."""
    bounds = fit_outlier_bounds(df, scan_columns)
    x = F.col(target).cast("double")
    logged = F.when(x > -1, F.log1p(x))
    share = lambda c: F.bround(F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))) * 100, 2)
    gaps = lambda cols: sum(((F.count_if(F.col(c).isNull()) > 0).cast("int") for c in cols), F.lit(0))
    flags = sum((iqr_flag(bounds, c) for c in scan_columns), F.lit(0))
    candidate = F.coalesce(leverage, F.lit(False)) | (flags >= min_flags)
    none = F.lit(None)
    cells = [
        ("target", "min", none, F.min(x)), ("target", "max", none, F.max(x)), ("target", "mean", none, F.avg(x)),
        ("target", "skew_raw", none, sample_skewness(x)), ("target", "skew_log", none, sample_skewness(logged)),
        ("target", "kurtosis_raw", none, sample_excess_kurtosis(x)),
        ("missing", "n_cols_with_missing", none, gaps(df.columns)),
        ("missing", "n_genuine", none, gaps(c for c in df.columns if c not in set(absent_columns))),
        ("outliers", "n_candidates", none, F.count_if(candidate)),
        *[("missing_columns", c, F.count_if(F.col(c).isNull()), share(c)) for c in df.columns],
        *[("outlier_features", c, F.coalesce(F.sum(iqr_flag(bounds, c)), F.lit(0)), F.coalesce(F.sum(iqr_flag(bounds, c)), F.lit(0))) for c in scan_columns],
    ]
    one = df.agg(*[k.cast("double").alias(f"k{i}") for i, (_, _, k, _) in enumerate(cells)], *[v.cast("double").alias(f"v{i}") for i, (*_, v) in enumerate(cells)])
    named = [F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), F.col(f"k{i}").alias("_key"), F.col(f"v{i}").alias("value"))
             for i, (s, m, _, _) in enumerate(cells)]
    rows = one.select(F.explode(F.array(*named)).alias("_r")).select("_r.*").where("section <> 'missing_columns' OR _key > 0")

    r = pairwise_correlation(df, [target, *corr_features])
    small = []
    for i, a in enumerate(corr_features):
        c = r[0, i + 1]
        small.append(("correlation", a, -1.0, None) if np.isnan(c) else ("correlation", a, round(abs(float(c)), 6), round(float(c), 6)))
        for j in range(i + 1, len(corr_features)):
            c = abs(float(r[i + 1, j + 1]))
            if c >= threshold:
                small.append(("collinear", f"{a}|{corr_features[j]}", round(c, 3), round(c, 3)))
    rows = rows.unionByName(df.sparkSession.createDataFrame(small, rows.schema))

    middle = exact_quantiles(df, target, [0.5], names=["value"])
    rows = rows.unionByName(middle.select(F.lit("target").alias("section"), F.lit("median").alias("metric"), none.cast("double").alias("_key"), "value"))
    med = group_medians(df, target, [group], name="median")
    ends = top_bottom_groups(med, "median", group, top_k)
    rows = rows.unionByName(ends.select(
        F.concat(F.lit("groups_"), "side").alias("section"), F.col(group).cast("string").alias("metric"),
        F.when(F.col("side") == "top", F.col("median")).otherwise(-F.col("median")).alias("_key"), F.col("median").alias("value")))
    low = F.min("median")
    rows = rows.unionByName(med.agg(F.when(low != 0, F.max("median") / low).alias("value")).select(
        F.lit("groups").alias("section"), F.lit("ratio_max_min").alias("metric"), none.cast("double").alias("_key"), "value"))
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("_key"), "metric"))  # rows per column or group end
    return rows.select("section", "metric", F.when(F.col("_key").isNotNull(), place).alias("position"), "value")


def eda_digest(df: DataFrame, *args, **kwargs) -> dict:
    """``eda_digest_rows`` as a document ``{section: {metric: value}}``, ranked
    sections in their order (bounded by the number of columns, never rows)."""
    out: dict = {}
    for r in eda_digest_rows(df, *args, **kwargs).orderBy("section", "position", "metric").collect():
        out.setdefault(r["section"], {})[r["metric"]] = r["value"]
    return out
