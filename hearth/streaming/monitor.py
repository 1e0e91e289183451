"""Monitoring.

The prediction log holds scored requests; actual sale prices arrive later.
Batch forms are exact and run over whole tables; streaming forms express the
same logic with watermarks so state stays bounded.

* ``attach_actuals`` (T5): for every prediction, the FIRST actual of the same
  subject within ``(ts, ts + horizon]``.  Skew-safe: a window ordered by time
  inside (subject, day) finds same-day successors with a running frame (O(n),
  no pairs), and the earliest actual of the following day comes from a
  partial aggregation.
* ``rolling_performance`` (T4): sliding-window error metrics incl. exact
  median residual, streamed by ``stream_rolling_performance``; ``prediction_drift`` (T3); ``input_drift`` (T2, PSI over
  training deciles); ``retrain_triggers`` (T7).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.quantiles import exact_quantiles

# fixed values: retraining thresholds from the monitoring contract (MAPE band
# upper end, within-10% floor) plus our drift and volume choices
MAPE_LIMIT = 0.12
WITHIN_10_FLOOR = 0.50
PSI_LIMIT = 0.20
MIN_NEW_ACTUALS = 50

PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("raw_input_json", T.StringType()),
    T.StructField("predicted_sale_price", T.DoubleType()),
    T.StructField("valuation_year", T.IntegerType()),
    T.StructField("valuation_month", T.IntegerType()),
    T.StructField("neighborhood", T.StringType()),
    T.StructField("overall_qual", T.IntegerType()),
    T.StructField("gr_liv_area", T.DoubleType()),
    T.StructField("actual_sale_price", T.DoubleType()),
])


def attach_actuals(preds: DataFrame, actuals: DataFrame, subject: str, ts: str, pid: str, aid: str,
                   value: str, horizon_seconds: int = 86400, bucket: str = "hour") -> DataFrame:
    """``preds`` rows + ``actual_id``, ``actual``, ``actual_ts`` of the first
    actual of the same subject strictly after ``ts`` and at most
    ``horizon_seconds`` later (NULLs when none); ties on time go to the
    smaller actual id.

    Time is cut into ``date_trunc`` buckets (default one hour):
    * inside a (subject, bucket), a descending running frame hands every
      prediction the next actual (O(n), no pairs);
    * otherwise the answer is the first actual of the subject's next
      non-empty bucket: first actuals per (subject, bucket) come from a
      partial aggregation, and "next non-empty bucket" is a window over the
      per-(subject, bucket) table, whose size is bounded by the time span, not
      by the number of events.
    """
    bkt = F.date_trunc(bucket, F.col("_t"))  # on timestamp_ntz: independent of the session time zone
    p = preds.select(F.col(subject).alias("_s"), F.col(ts).alias("_t"), F.col(pid).alias("_id"),
                     F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_is_pred"), F.col(pid).alias("_pid"))
    a = actuals.select(F.col(subject).alias("_s"), F.col(ts).alias("_t"), F.col(aid).alias("_id"),
                       F.col(value).cast("double").alias("_v"), F.lit(0).alias("_is_pred"),
                       F.lit(None).cast(preds.schema[pid].dataType).alias("_pid"))
    u = p.unionByName(a).withColumn("_b", bkt)
    # descending time; at equal times predictions come first so an actual with
    # the very same timestamp is not "after" the prediction
    w = Window.partitionBy("_s", "_b").orderBy(F.col("_t").desc(), F.col("_is_pred").desc(), F.col("_id").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    act = F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"), F.col("_v").alias("v"))
    same = u.withColumn("_next", F.last(F.when(F.col("_is_pred") == 0, act), ignorenulls=True).over(w)) \
        .where(F.col("_is_pred") == 1).select("_pid", "_s", "_b", "_t", "_next")
    firsts = u.where(F.col("_is_pred") == 0).groupBy("_s", "_b").agg(
        F.min_by(act, F.struct("_t", "_id")).alias("_first"))
    pred_buckets = same.select("_s", "_b").distinct().withColumn("_first", F.lit(None).cast(firsts.schema["_first"].dataType))
    later = Window.partitionBy("_s").orderBy(F.col("_b").desc(), F.col("_first").isNull().desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    nb = pred_buckets.withColumn("_k", F.lit(1)).unionByName(firsts.withColumn("_k", F.lit(0))) \
        .withColumn("_later", F.last("_first", ignorenulls=True).over(later)) \
        .where(F.col("_k") == 1).select("_s", "_b", "_later")
    j = same.join(nb, ["_s", "_b"], "left")
    limit = F.col("_t") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(horizon_seconds)))
    chosen = F.when(F.col("_next").isNotNull() & (F.col("_next.t") <= limit), F.col("_next")) \
        .when(F.col("_next").isNull() & F.col("_later").isNotNull() & (F.col("_later.t") <= limit), F.col("_later"))
    matched = j.select(F.col("_pid").alias(pid), chosen.alias("_m"))
    return preds.join(matched, pid, "left").select(
        *preds.columns, F.col("_m.id").alias("actual_id"), F.col("_m.v").alias("actual"), F.col("_m.t").alias("actual_ts"))


def error_columns(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    return df.withColumn("residual", a - p).withColumn("abs_error", F.abs(a - p)).withColumn(
        "ape", F.abs(a - p) / F.greatest(a, F.lit(1.0)))


#: Sums are kept in whole numbers of 1 / _UNIT, so they do not depend on the order of addition.
_UNIT = 1e8
#: Cells of the value range in which the rows of a window's median are looked for.
_CELLS = 1024


def _units(c: Column) -> Column:
    return F.sum(F.round(c * _UNIT).cast("decimal(28,0)"))


def _mean(total: str, n: str = "n") -> Column:
    return F.col(total).cast("double") / _UNIT / F.col(n)


#: What a day keeps of its errors: name -> value that is added up.
_PARTIALS = {
    "s_actual": lambda: F.col("actual").cast("double"),
    "s_predicted": lambda: F.col("predicted").cast("double"),
    "s_residual": lambda: F.col("residual"),
    "s_abs": lambda: F.col("abs_error"),
    "s_ape": lambda: F.col("ape"),
    "s_square": lambda: F.col("residual") * F.col("residual"),
}


def _day_sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[_units(v()).alias(k) for k, v in _PARTIALS.items()],
            F.count_if(F.col("ape") <= 0.10).alias("n10"), F.count_if(F.col("ape") <= 0.20).alias("n20")]


def day_partials(matched: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Error sums per day, or per day and each slice key in turn (one aggregate
    over ``GROUPING SETS``): ``day``, ``slice_key``, ``level``, n, the sums and
    the rows within 10 and 20 percent.  A row with a NULL level is left out of
    that key's slices."""
    m = error_columns(matched.where(F.col("actual").isNotNull())).withColumn("day", F.to_date(ts))
    aggs = _day_sums()
    if not keys:
        return m.groupBy("day").agg(*aggs).select("day", F.lit(None).cast("string").alias("slice_key"), F.lit(None).cast("string").alias("level"), "*")
    named = m.select("*", *[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)])
    levels = [f"_k{i}" for i in range(len(keys))]
    sets = named.groupingSets([["day", c] for c in levels], "day", *levels).agg(F.grouping_id().alias("_g"), *aggs)
    which, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        mine = F.col("_g").bitwiseAND(1 << (len(keys) - 1 - i)) == 0
        which, level = F.when(mine, F.lit(k)).otherwise(which), F.when(mine, F.col(levels[i])).otherwise(level)
    return sets.select("day", which.alias("slice_key"), level.alias("level"), *[c for c in sets.columns if c not in ("day", "_g", *levels)]).where("level IS NOT NULL")


def in_windows(days: DataFrame, length_days: int, slide_days: int) -> DataFrame:
    """Rows of a small per-day table, once per sliding window that has the day;
    window starts are whole multiples of ``slide_days`` from 1970-01-01 on."""
    d = F.unix_date("day")
    last = d - F.pmod(d, F.lit(slide_days))
    first = last - slide_days * F.floor((F.lit(length_days - 1) - F.pmod(d, F.lit(slide_days))) / slide_days).cast("int")
    start = F.explode(F.sequence(first, last, F.lit(slide_days)))
    rows = days.where(F.lit(length_days - 1) >= F.pmod(d, F.lit(slide_days))).withColumn("_start", start)
    return rows.withColumn("window_start", F.date_format(F.date_from_unix_date("_start"), "yyyy-MM-dd")).drop("_start")


def window_sums(partials: DataFrame, length_days: int, slide_days: int) -> DataFrame:
    """Day partials added up per window and slice."""
    sums = [*_PARTIALS, "n", "n10", "n20"]
    rows = in_windows(partials, length_days, slide_days)
    return rows.groupBy("window_start", "slice_key", "level").agg(*[F.sum(c).alias(c) for c in sums])


def window_medians(df: DataFrame, ts: str, value: str, length_days: int, slide_days: int, name: str, weight: str | None = None) -> DataFrame:
    """Exact median of ``value`` per sliding window without copying rows into
    windows: counts per day and cell of the value range, added up per window,
    tell in which cells a window's middle ranks lie; only the rows of these are
    looked at again.  A row stands for ``weight`` equal ones."""
    m = df.where(F.col(value).isNotNull()).select(
        F.to_date(ts).alias("day"), F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
    ends = m.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()  # two numbers
    lo, width = ends["lo"] or 0.0, max((ends["hi"] or 0.0) - (ends["lo"] or 0.0), 1e-300) / _CELLS
    m = m.withColumn("_cell", F.least(F.floor((F.col("_v") - lo) / width), F.lit(_CELLS - 1)).cast("int"))
    cells = in_windows(m.groupBy("day", "_cell").agg(F.sum("_w").alias("_c")), length_days, slide_days)
    cells = cells.groupBy("window_start", "_cell").agg(F.sum("_c").alias("_c"))
    line = Window.partitionBy("window_start")  # at most _CELLS rows
    cells = cells.withColumn("_n", F.sum("_c").over(line)).withColumn(
        "_upto", F.sum("_c").over(line.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # ranks from 0
    holds = lambda rank: (rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto"))
    wanted = cells.where(holds(low) | holds(high)).select(
        "window_start", "_cell", (F.col("_upto") - F.col("_c")).alias("_before"), low.alias("_low"), high.alias("_high"))
    start = F.to_date("window_start")
    days = F.explode(F.sequence(start, F.date_add(start, length_days - 1)))
    asked = wanted.withColumn("day", days)
    values = m.join(asked, ["day", "_cell"]).groupBy("window_start", "_cell", "_before", "_low", "_high", "_v").agg(F.sum("_w").alias("_c"))
    run = Window.partitionBy("window_start", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_upto", F.col("_before") + F.sum("_c").over(run))
    at = lambda rank: F.max(F.when((F.col(rank) >= F.col("_upto") - F.col("_c")) & (F.col(rank) < F.col("_upto")), F.col("_v")))
    both = values.groupBy("window_start").agg(at("_low").alias("_a"), at("_high").alias("_b"))
    return both.select("window_start", (F.col("_a") + (F.col("_b") - F.col("_a")) * 0.5).alias(name))


def _performance(partials: DataFrame, medians: DataFrame, length_days: int, slide_days: int) -> DataFrame:
    agg = window_sums(partials, length_days, slide_days).select(
        "window_start", "n", F.sqrt(_mean("s_square")).alias("rmse"), _mean("s_abs").alias("mae"), _mean("s_ape").alias("mape"),
        (F.col("n10") / F.col("n")).alias("within_10_pct"), _mean("s_residual").alias("residual_mean"))
    return agg.join(medians, "window_start", "left")


def rolling_performance(matched: DataFrame, ts: str, length_days: int = 7, slide_days: int = 1) -> DataFrame:
    """T4 over predictions that have an actual: n, rmse, mae, mape,
    within_10_pct, residual_mean and exact residual_median per window, from
    sums per day."""
    m = error_columns(matched.where(F.col("actual").isNotNull()))
    medians = window_medians(m, ts, "residual", length_days, slide_days, "residual_median")
    return _performance(day_partials(matched, ts), medians, length_days, slide_days)


def training_profile(df: DataFrame, value: str, probs: Sequence[float] = (0.01, 0.99)) -> dict:
    """Exact reference quantiles of the training-period predictions (few numbers)."""
    names = [f"p{i}" for i in range(len(probs))]
    row = exact_quantiles(df, value, list(probs), names=names).collect()
    return {p: (row[0][n] if row else None) for p, n in zip(probs, names)}


def prediction_drift(log: DataFrame, ts: str, value: str, by: Sequence[str], low: float, high: float) -> DataFrame:
    """Per day and key: n, mean, share below ``low`` and above ``high``."""
    return log.groupBy(F.date_format(F.col(ts), "yyyy-MM-dd").alias("day"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean_value"),
        F.avg((F.col(value) < low).cast("double")).alias("share_low"),
        F.avg((F.col(value) > high).cast("double")).alias("share_high"),
    )


def decile_edges(train: DataFrame, value: str) -> list[float]:
    probs = [i / 10 for i in range(1, 10)]
    row = exact_quantiles(train, value, probs, names=[f"d{i}" for i in range(1, 10)]).collect()[0]
    return [row[f"d{i}"] for i in range(1, 10)]


def decile_of(value: str | Column, edges: Sequence[float]) -> Column:
    """Bin index 0..len(edges): number of edges strictly below the value."""
    v = F.col(value) if isinstance(value, str) else value
    idx = F.lit(0)
    for e in edges:
        idx = idx + (v > F.lit(e)).cast("int")
    return idx


def input_drift(log: DataFrame, train: DataFrame, ts: str, value: str, eps: float = 1e-4) -> DataFrame:
    """Population Stability Index per day against the training deciles.

    Training side: 9 exact decile edges and 10 bin shares (a few numbers).
    Serving side: ONE grouped aggregation per day with a conditional count per
    bin; empty bins count as share ``eps``.
    """
    edges, shares = training_bins(train, value, eps)
    b = decile_of(value, edges)
    agg = log.where(F.col(value).isNotNull()).groupBy(F.date_format(F.col(ts), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("_nd"), *[F.count_if(b == i).alias(f"_c{i}") for i in range(len(shares))])
    return agg.select("day", psi_expression("_c", "_nd", shares, eps).alias("psi"))


def level_drift(log: DataFrame, train: DataFrame, ts: str, column: str, eps: float = 1e-4) -> DataFrame:
    """T2 for a text column: Population Stability Index per day over its levels.

    A level that a day or the training data lacks counts as share ``eps``.  Days
    and levels are not crossed: every day starts from the sum of the terms that
    all training levels would have if absent, and its present levels replace
    theirs.  An empty training table gives no rows."""
    seen = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_q"))
    total = seen.agg(F.sum("_q").alias("t")).first()["t"]  # one number
    term = lambda p, q: (p - q) * F.log(p / q)
    seen = seen.withColumn("_q", F.greatest(F.col("_q") / F.lit(total or 1), F.lit(eps)))
    absent = seen.agg(F.sum(term(F.lit(eps), F.col("_q"))).alias("a")).first()["a"]  # one number
    days = log.where(F.col(column).isNotNull()).groupBy(F.date_format(F.col(ts), "yyyy-MM-dd").alias("day"), column).agg(
        F.count(F.lit(1)).alias("_n"))
    if absent is None:
        return days.select("day", F.lit(0.0).alias("psi")).limit(0)
    sizes = days.groupBy("day").agg(F.sum("_n").alias("_d"))
    both = days.join(sizes, "day").join(seen, column, "left")
    p, q = F.greatest(F.col("_n") / F.col("_d"), F.lit(eps)), F.coalesce("_q", F.lit(eps))
    change = term(p, q) - F.when(F.col("_q").isNotNull(), term(F.lit(eps), q)).otherwise(0.0)
    return both.groupBy("day").agg((F.lit(absent) + F.sum(change)).alias("psi"))


def drift_all(log: DataFrame, train: DataFrame, ts: str, numbers: Sequence[str], texts: Sequence[str], eps: float = 1e-4) -> DataFrame:
    """T2 over all monitored columns at once: ``(day, column, psi)``.

    Numbers are read as their training decile, text as its level, so every
    column is a list of bins; one aggregate counts (column, day, bin) over the
    log and one over the training rows.  Nothing is crossed: a day starts from
    what all training bins would add if absent, and its bins replace theirs."""
    probs = [i / 10 for i in range(1, 10)]
    edges: dict = {}
    if numbers:
        long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in numbers])).alias("p")).select("p.*")
        for r in exact_quantiles(long, "v", probs, by=["c"], names=[f"d{i}" for i in range(9)]).collect():  # one row a column
            edges[r["c"]] = [r[f"d{i}"] for i in range(9)]

    def binned(df: DataFrame, *keep: Column) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), decile_of(F.col(c).cast("double"), edges[c]).cast("string")).alias("bin"))
                 for c in numbers if c in edges]
        cells += [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("bin")) for c in texts]
        rows = df.select(*keep, F.explode(F.array(*cells)).alias("p"))
        return rows.select(*[c for c in rows.columns if c != "p"], "p.*").where("bin IS NOT NULL")

    term = lambda p, q: (p - q) * F.log(p / q)
    seen = binned(train).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("_q"))
    every = Window.partitionBy("column")  # bins of a column
    seen = seen.withColumn("_q", F.greatest(F.col("_q") / F.sum("_q").over(every), F.lit(eps)))
    # a decile that ties leave empty has the least share, too
    if edges:
        deciles = train.sparkSession.createDataFrame([(c, str(i)) for c in edges for i in range(10)], "column string, bin string")
        seen = seen.unionByName(deciles.join(seen, ["column", "bin"], "left_anti").withColumn("_q", F.lit(eps)))
    absent = seen.groupBy("column").agg(F.sum(term(F.lit(eps), F.col("_q"))).alias("_absent"))
    days = binned(log, F.date_format(F.col(ts), "yyyy-MM-dd").alias("day")).groupBy("day", "column", "bin").agg(F.count(F.lit(1)).alias("_n"))
    sizes = days.groupBy("day", "column").agg(F.sum("_n").alias("_d"))
    both = days.join(sizes, ["day", "column"]).join(seen, ["column", "bin"], "left")
    p, q = F.greatest(F.col("_n") / F.col("_d"), F.lit(eps)), F.coalesce("_q", F.lit(eps))
    change = term(p, q) - F.when(F.col("_q").isNotNull(), term(F.lit(eps), q)).otherwise(0.0)
    out = both.groupBy("day", "column").agg(F.sum(change).alias("_c")).join(absent, "column")
    return out.select("day", "column", (F.col("_absent") + F.col("_c")).alias("psi"))


def retrain_triggers(perf: DataFrame, drift: DataFrame) -> DataFrame:
    """``(window_start, trigger, value, threshold, fired)`` rows from the
    rolling metrics and the daily input drift."""
    d = drift.select(F.col("day").alias("window_start"), F.lit("input_psi").alias("trigger"), F.col("psi").alias("value"),
                     F.lit(PSI_LIMIT).alias("threshold"), (F.col("psi") > PSI_LIMIT).alias("fired"))
    return trigger_rows(perf).unionByName(d)


# ---- streaming forms -------------------------------------------------------------

def read_prediction_log(spark, path: str, schema: T.StructType = PREDICTION_LOG_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """The log as a stream with an explicit schema (no inference)."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def dedupe_requests(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """At-least-once producers resend: keep one row per request id; state is
    dropped once the watermark passes."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_first_actuals(preds: DataFrame, actuals: DataFrame, subject: str, ts: str, pid: str, aid: str, value: str,
                         delay: str = "1 day", preds_have_watermark: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """T5 streaming: one row per request - (pid, ts, actual_id, actual,
    actual_ts) of the first actual of its subject after it, within a day, NULLs
    when there is none; ties on time go to the smaller actual id.

    A left-outer interval join gives every actual of a request; an aggregation
    by request and event time keeps the first.  Both are closed by watermarks,
    so a request comes out once, when no earlier actual can still arrive, and
    requests of the last day or so stay in state until the stream moves on.
    Pass ``preds_have_watermark`` when the prediction stream already declares
    one (e.g. after ``dedupe_requests``); columns of the request named in ``carry``
    come with it."""
    p = (preds if preds_have_watermark else preds.withWatermark(ts, delay)).alias("p")
    a = actuals.withWatermark(ts, delay).alias("a")
    cond = (F.col(f"p.{subject}") == F.col(f"a.{subject}")) & (F.col(f"a.{ts}") > F.col(f"p.{ts}")) & \
        (F.col(f"a.{ts}") <= F.col(f"p.{ts}") + F.expr("INTERVAL 1 DAY"))
    joined = p.join(a, cond, "leftOuter").select(
        F.col(f"p.{pid}").alias(pid), F.col(f"p.{ts}").alias(ts), *[F.col(f"p.{c}").alias(c) for c in carry], F.col(f"a.{aid}").alias("_id"),
        F.col(f"a.{value}").alias("_v"), F.col(f"a.{ts}").alias("_t"))
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct(F.col("_t").cast("timestamp_ntz").alias("t"), F.col("_id").alias("id"), F.col("_v").alias("v"))))
    return joined.groupBy(pid, ts, *carry).agg(first.alias("_f")).select(
        pid, ts, *carry, F.col("_f.id").alias("actual_id"), F.col("_f.v").alias("actual"), F.col("_f.t").alias("actual_ts"))


def stream_rolling_metrics(matched: DataFrame, ts: str, length: str = "7 days", slide: str = "1 day",
                           delay: str = "1 day") -> DataFrame:
    """T4 streaming: sliding-window metrics in append mode (median residual via
    the mergeable ``percentile_approx`` sketch; ``stream_rolling_performance``
    has the exact one)."""
    m = error_columns(matched)
    return m.withWatermark(ts, delay).groupBy(F.window(ts, length, slide)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
        F.avg("abs_error").alias("mae"),
        F.avg("ape").alias("mape"),
        F.avg((F.col("ape") <= 0.10).cast("double")).alias("within_10_pct"),
        F.avg("residual").alias("residual_mean"),
        F.percentile_approx("residual", 0.5, 10000).alias("residual_median_approx"),
    )


def stream_day_values(matched: DataFrame, ts: str, delay: str | None = "1 day") -> DataFrame:
    """T4 streaming state: one row per (day, distinct residual) with its error
    sums, appended once the watermark closes the day and then dropped from
    state.  A row is in state once, not once per window, and no state row grows
    with the data.  Without ``delay`` the stream has a watermark on ``ts``
    already."""
    m = error_columns(matched.where(F.col("actual").isNotNull()))
    days = (m.withWatermark(ts, delay) if delay else m).groupBy(F.window(ts, "1 day"), "residual").agg(*_day_sums())
    return days.select(F.to_date("window.start").alias("day"), *[c for c in days.columns if c != "window"])


def closed_windows(days: DataFrame, before: date | None, upto: date, length_days: int, slide_days: int) -> DataFrame:
    """Rolling performance, exact median included, of the windows whose last
    day is after ``before`` (None: from the start) and not after ``upto``, from
    rows of ``stream_day_values``."""
    if before is not None:
        days = days.where(F.col("day") > F.lit(before - timedelta(days=length_days - 1)))
    sums = [*_PARTIALS, "n", "n10", "n20"]
    none = F.lit(None).cast("string")
    partials = days.groupBy("day").agg(*[F.sum(c).alias(c) for c in sums]).select("*", none.alias("slice_key"), none.alias("level"))
    medians = window_medians(days, "day", "residual", length_days, slide_days, "residual_median", weight="n")
    last = F.date_add(F.to_date("window_start"), length_days - 1)
    closed = (last <= F.lit(upto)) if before is None else (last <= F.lit(upto)) & (last > F.lit(before))
    return _performance(partials, medians, length_days, slide_days).where(closed)


def stream_rolling_performance(matched: DataFrame, ts: str, path: str, checkpoint: str, length_days: int = 7, slide_days: int = 1,
                               delay: str | None = "1 day"):
    """T4 streaming with exact medians: the started query.

    Closed days go to ``path/days``, and the windows that they complete to
    ``path/windows``, one folder per epoch that a retry overwrites.  Days close
    in order, so an epoch's windows end after the last day of the epochs before
    it.  A row later than ``delay`` counts in no window, and a window whose last
    days are empty comes with the next day that has rows."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/days/epoch={epoch}")
        every = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("epoch", T.LongType())])).parquet(f"{path}/days")
        every = every.where(F.col("epoch") <= epoch)
        ends = every.agg(F.max(F.when(F.col("epoch") < epoch, F.col("day"))).alias("before"), F.max("day").alias("upto")).first()
        if ends["upto"] is not None and ends["upto"] != ends["before"]:
            rows = closed_windows(every.drop("epoch"), ends["before"], ends["upto"], length_days, slide_days)
            rows.write.mode("overwrite").parquet(f"{path}/windows/epoch={epoch}")

    return stream_day_values(matched, ts, delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()


def windowed_error_slices(matched: DataFrame, ts: str, key: str, length_days: int = 7, slide_days: int = 1) -> DataFrame:
    """Error summary per (window, slice key) - A29 keyed by time window."""
    out = windowed_error_slices_by(matched, ts, [key], length_days, slide_days)
    return out.drop("slice_key").withColumnRenamed("level", key)


def windowed_error_slices_by(matched: DataFrame, ts: str, keys: Sequence[str], length_days: int = 7, slide_days: int = 1) -> DataFrame:
    """T6 over several slice keys at once: ``window_start``, ``slice_key``,
    ``level`` and the error summary, from one aggregate per day."""
    w = window_sums(day_partials(matched, ts, keys), length_days, slide_days)
    return w.select(
        "window_start", "slice_key", "level", "n", _mean("s_actual").alias("actual_mean"), _mean("s_predicted").alias("predicted_mean"),
        _mean("s_residual").alias("residual_mean"), _mean("s_abs").alias("mae"), _mean("s_ape").alias("mape"),
        (F.col("n10") / F.col("n")).alias("within_10_pct"), (F.col("n20") / F.col("n")).alias("within_20_pct"))


def stream_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming query to completion over what is available now, into a
    parquet table in a shared folder (never the driver-memory sink)."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def trigger_rows(metrics: DataFrame, window_col: str = "window_start") -> DataFrame:
    """T7 over windowed metrics rows (mape, within_10_pct, n)."""
    t = F.array(
        F.struct(F.lit("mape").alias("trigger"), F.col("mape").alias("value"), F.lit(MAPE_LIMIT).alias("threshold"),
                 (F.col("mape") > MAPE_LIMIT).alias("fired")),
        F.struct(F.lit("within_10_pct").alias("trigger"), F.col("within_10_pct").alias("value"),
                 F.lit(WITHIN_10_FLOOR).alias("threshold"), (F.col("within_10_pct") < WITHIN_10_FLOOR).alias("fired")),
        F.struct(F.lit("new_actuals").alias("trigger"), F.col("n").cast("double").alias("value"),
                 F.lit(float(MIN_NEW_ACTUALS)).alias("threshold"), (F.col("n") >= MIN_NEW_ACTUALS).alias("fired")),
    )
    return metrics.select(F.col(window_col).alias("window_start"), F.explode(t).alias("_r")).select("window_start", "_r.*")


def stream_retrain_triggers(matched: DataFrame, ts: str, path: str, checkpoint: str, length: str = "7 days",
                            slide: str = "1 day", delay: str = "1 day"):
    """T7 streaming: closed sliding windows of the rolling metrics are turned
    into trigger rows inside ``foreachBatch`` and written per epoch
    (``epoch=<id>`` partition overwritten on a retry: exactly-once output)."""
    metrics = stream_rolling_metrics(matched, ts, length, slide, delay)

    def write(batch: DataFrame, epoch: int) -> None:
        rows = trigger_rows(batch.withColumn("window_start", F.date_format("window.start", "yyyy-MM-dd")))
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return metrics.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()


def psi_expression(counts_prefix: str, total: str, shares: Sequence[float], eps: float = 1e-4) -> Column:
    """PSI from per-bin count columns ``<prefix><i>`` and a total."""
    psi = F.lit(0.0)
    for i, pt in enumerate(shares):
        pd_ = F.greatest(F.col(f"{counts_prefix}{i}") / F.col(total), F.lit(eps))
        psi = psi + (pd_ - F.lit(pt)) * F.log(pd_ / F.lit(pt))
    return psi


def training_bins(train: DataFrame, value: str, eps: float = 1e-4) -> tuple[list[float], list[float]]:
    """Decile edges of the training values and each bin's share (floored at eps)."""
    edges = decile_edges(train, value)
    counts = {r["bin"]: r["n"] for r in train.where(F.col(value).isNotNull())
              .groupBy(decile_of(value, edges).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}  # <= 10 rows
    total = sum(counts.values())
    return edges, [max(counts.get(i, 0) / total, eps) for i in range(len(edges) + 1)]


def stream_input_drift(stream: DataFrame, ts: str, value: str, edges: Sequence[float], shares: Sequence[float],
                       window: str = "1 day", delay: str = "1 day", eps: float = 1e-4) -> DataFrame:
    """T2 streaming: tumbling-window bin counts (one conditional count per
    training decile) -> PSI, emitted once the watermark closes the window."""
    b = decile_of(value, edges)
    agg = stream.where(F.col(value).isNotNull()).withWatermark(ts, delay).groupBy(F.window(ts, window)).agg(
        F.count(F.lit(1)).alias("_nd"), *[F.count_if(b == i).alias(f"_c{i}") for i in range(len(shares))])
    return agg.select(F.col("window.start").alias("window_start"), psi_expression("_c", "_nd", shares, eps).alias("psi"))


def stream_prediction_drift(stream: DataFrame, ts: str, value: str, by: Sequence[str], low: float, high: float,
                            window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """T3 streaming: per tumbling window and key, n / mean / share outside the
    training p1-p99 band."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, window), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean_value"),
        F.avg((F.col(value) < low).cast("double")).alias("share_low"),
        F.avg((F.col(value) > high).cast("double")).alias("share_high"),
    ).withColumn("window_start", F.col("window.start")).drop("window")
