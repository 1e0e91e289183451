"""Monitoring-area queries over the ``events`` log: ``view`` events are scored
requests (value = predicted price), ``purchase`` events are the later actuals
of the same user (T2-T5, T7); batch forms with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import round_sig
from hearth.plans.registry import register
from hearth.plans.sqltext import round_sig as sql_sig
from hearth.sources.tables import table
from hearth.streaming import monitor as M

TRAIN_END = "2024-01-08"  # fixed value: the first week is the training profile


def _matched(spark, sf):
    ev = table(spark, sf, "events")
    preds = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("request_id"), "user_id", "ts", F.col("value").alias("predicted"))
    acts = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    return M.attach_actuals(preds, acts, "user_id", "ts", "request_id", "event_id", "value")


_MATCH_SQL = """
v AS (SELECT event_id AS request_id, user_id, ts, value AS predicted FROM events WHERE event_type = 'view'),
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
c AS (SELECT v.request_id, p.event_id AS actual_id, p.value AS actual,
             row_number() OVER (PARTITION BY v.request_id ORDER BY p.ts, p.event_id) AS rn
      FROM v JOIN p ON v.user_id = p.user_id AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL 1 DAY),
mt AS (SELECT v.request_id, v.user_id, v.ts, v.predicted, c.actual_id, c.actual
       FROM v LEFT JOIN c ON v.request_id = c.request_id AND c.rn = 1)
"""


@register("late_actual_join", f"WITH {_MATCH_SQL} SELECT request_id, user_id, predicted, actual_id, actual FROM mt")
def late_actual_join(spark, sf):
    return _matched(spark, sf).select("request_id", "user_id", "predicted", "actual_id", "actual")


_PERF_COLS = ["rmse", "mae", "mape", "within_10_pct", "residual_mean", "residual_median"]

def _avg(x: str) -> str:
    """The mean from sums in whole numbers of 1e-8, in any order the same."""
    return f"(CAST(sum(CAST(round({x} * 1e8) AS DECIMAL(38,0))) AS DOUBLE) / 1e8 / count(*))"


_PERF_SQL = f"""
e AS (SELECT *, actual - predicted AS residual, abs(actual - predicted) AS abs_error,
             abs(actual - predicted) / greatest(actual, 1) AS ape FROM mt WHERE actual IS NOT NULL),
w AS (SELECT e.*, strftime(CAST(ts AS DATE) - CAST(k AS INTEGER), '%Y-%m-%d') AS window_start FROM e CROSS JOIN range(0, 7) AS t(k)),
perf AS (SELECT window_start, count(*) AS n, {sql_sig('sqrt(' + _avg('residual * residual') + ')')} AS rmse, {sql_sig(_avg('abs_error'))} AS mae,
  {sql_sig(_avg('ape'))} AS mape, {sql_sig('avg(CASE WHEN ape <= 0.10 THEN 1.0 ELSE 0.0 END)')} AS within_10_pct,
  {sql_sig(_avg('residual'))} AS residual_mean, {sql_sig('median(residual)')} AS residual_median
  FROM w GROUP BY window_start)
"""


def _perf(spark, sf):
    p = M.rolling_performance(_matched(spark, sf), "ts", 7, 1)
    return p.select("window_start", "n", *[round_sig(c).alias(c) for c in _PERF_COLS])


@register("rolling_performance", f"WITH {_MATCH_SQL}, {_PERF_SQL} SELECT * FROM perf")
def rolling_performance(spark, sf):
    return _perf(spark, sf)


_DRIFT_SQL = f"""
WITH tr AS (SELECT value FROM events WHERE ts < TIMESTAMP '{TRAIN_END}'),
q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM tr)
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, {sql_sig('avg(value)')} AS mean_value,
  {sql_sig('avg(CASE WHEN value < (SELECT lo FROM q) THEN 1.0 ELSE 0.0 END)')} AS share_low,
  {sql_sig('avg(CASE WHEN value > (SELECT hi FROM q) THEN 1.0 ELSE 0.0 END)')} AS share_high
FROM events GROUP BY 1, 2
"""


@register("prediction_drift", _DRIFT_SQL)
def prediction_drift(spark, sf):
    ev = table(spark, sf, "events")
    prof = M.training_profile(ev.where(F.col("ts") < F.lit(TRAIN_END).cast("timestamp_ntz")), "value")
    d = M.prediction_drift(ev, "ts", "value", ["event_type"], prof[0.01], prof[0.99])
    return d.select("day", "event_type", "n", *[round_sig(c).alias(c) for c in ["mean_value", "share_low", "share_high"]])


_EPS = 1e-4


def _psi_sql() -> str:
    edges = ", ".join(f"quantile_cont(value, {i / 10}) AS e{i}" for i in range(1, 10))
    binexpr = " + ".join(f"CASE WHEN value > (SELECT e{i} FROM ed) THEN 1 ELSE 0 END" for i in range(1, 10))
    pt = ", ".join(f"greatest(avg(CASE WHEN b = {i} THEN 1.0 ELSE 0.0 END), {_EPS}) AS pt{i}" for i in range(10))
    cur = ", ".join(f"greatest(avg(CASE WHEN b = {i} THEN 1.0 ELSE 0.0 END), {_EPS}) AS pd{i}" for i in range(10))
    psi = " + ".join(f"(pd{i} - (SELECT pt{i} FROM base)) * ln(pd{i} / (SELECT pt{i} FROM base))" for i in range(10))
    return f"""
tr AS (SELECT value FROM events WHERE ts < TIMESTAMP '{TRAIN_END}' AND value IS NOT NULL),
ed AS (SELECT {edges} FROM tr),
trb AS (SELECT {binexpr} AS b FROM tr),
base AS (SELECT {pt} FROM trb),
cb AS (SELECT strftime(ts, '%Y-%m-%d') AS day, {binexpr} AS b FROM events WHERE value IS NOT NULL),
cd AS (SELECT day, {cur} FROM cb GROUP BY day),
psi AS (SELECT day, {psi} AS psi FROM cd)
"""


def _psi(spark, sf):
    ev = table(spark, sf, "events")
    train = ev.where(F.col("ts") < F.lit(TRAIN_END).cast("timestamp_ntz"))
    return M.input_drift(ev, train, "ts", "value", eps=_EPS)


@register("input_drift", f"WITH {_psi_sql()} SELECT day, {sql_sig('psi')} AS psi FROM psi")
def input_drift(spark, sf):
    return _psi(spark, sf).select("day", round_sig("psi").alias("psi"))


# twelve areas of users stand for neighbourhoods; after training they shift by three
_LEVEL_SQL = f"""
WITH ev AS (SELECT strftime(ts, '%Y-%m-%d') AS day, ts, 'area ' || CAST((user_id + CASE WHEN ts >= TIMESTAMP '{TRAIN_END}' THEN 3 ELSE 0 END) % 12 AS VARCHAR) AS level FROM events),
t AS (SELECT level, count(*) AS c FROM ev WHERE ts < TIMESTAMP '{TRAIN_END}' GROUP BY 1),
q AS (SELECT level, greatest(c / (SELECT sum(c) FROM t), {_EPS}) AS q FROM t),
d AS (SELECT day, level, count(*) AS n FROM ev GROUP BY 1, 2), s AS (SELECT day, sum(n) AS d FROM d GROUP BY 1),
lv AS (SELECT level FROM q UNION SELECT level FROM d), x AS (SELECT s.day, s.d, lv.level FROM s CROSS JOIN lv),
y AS (SELECT x.day, greatest(coalesce(d.n, 0) / x.d, {_EPS}) AS p, coalesce(q.q, {_EPS}) AS q
      FROM x LEFT JOIN d ON x.day = d.day AND x.level = d.level LEFT JOIN q ON x.level = q.level)
SELECT day, round(sum((p - q) * ln(p / q)), 8) AS psi FROM y GROUP BY 1
"""


@register("level_drift", _LEVEL_SQL)
def level_drift(spark, sf):
    """T2 on a text column."""
    end = F.lit(TRAIN_END).cast("timestamp_ntz")
    user = F.col("user_id") + F.when(F.col("ts") >= end, 3).otherwise(0)
    ev = table(spark, sf, "events").select("ts", F.concat(F.lit("area "), (user % 12).cast("string")).alias("level"))
    return M.level_drift(ev, ev.where(F.col("ts") < end), "ts", "level", _EPS).select("day", F.round("psi", 8).alias("psi"))


_TRIGGER_SQL = f"""
WITH {_MATCH_SQL}, {_PERF_SQL}, {_psi_sql()}
SELECT window_start, 'mape' AS trigger, mape AS value, {M.MAPE_LIMIT} AS threshold, mape > {M.MAPE_LIMIT} AS fired FROM perf
UNION ALL SELECT window_start, 'within_10_pct', within_10_pct, {M.WITHIN_10_FLOOR}, within_10_pct < {M.WITHIN_10_FLOOR} FROM perf
UNION ALL SELECT window_start, 'new_actuals', CAST(n AS DOUBLE), {float(M.MIN_NEW_ACTUALS)}, n >= {M.MIN_NEW_ACTUALS} FROM perf
UNION ALL SELECT day, 'input_psi', {sql_sig('psi')}, {M.PSI_LIMIT}, {sql_sig('psi')} > {M.PSI_LIMIT} FROM psi
"""


@register("retrain_triggers", _TRIGGER_SQL.replace(f"{M.MAPE_LIMIT} AS threshold", f"CAST({M.MAPE_LIMIT} AS DOUBLE) AS threshold"))
def retrain_triggers(spark, sf):
    perf = _perf(spark, sf)
    psi = _psi(spark, sf).select("day", round_sig("psi").alias("psi"))
    return M.retrain_triggers(perf, psi)


# requests before the last event by more than this are out of state when the run
# ends: the delay of the watermark, the horizon, and one day of slack
CLOSED_DAYS = 3

_STREAM_SQL = f"""
WITH {_MATCH_SQL}, last AS (SELECT max(ts) AS t FROM events)
SELECT mt.request_id, mt.actual_id, mt.actual
FROM mt, last WHERE mt.ts < last.t - INTERVAL {CLOSED_DAYS} DAY
"""


def _streamed_actuals(spark, sf):
    """The events table, and its predictions with their first later actual, both
    read as streams with watermarks on either side."""
    batch = table(spark, sf, "events")
    path = f"{sf.rstrip('/')}/events.parque[t]"  # a glob: the file source needs a pattern or a folder
    ev = spark.readStream.schema(batch.schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    preds = M.dedupe_requests(
        ev.where(F.col("event_type") == "view").select(F.col("event_id").alias("request_id"), "user_id", "ts",
                                                       F.col("value").alias("predicted")),
        "request_id", "ts", "1 day")
    acts = ev.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("actual_id"), "user_id", "ts",
                                                              F.col("value").alias("actual"))
    return batch, preds, acts


def _stream_folder(spark) -> str:
    import uuid

    from hearth.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hearth-stream-{uuid.uuid4().hex}"


@register("stream_actual_pairs", _STREAM_SQL)
def stream_first_actuals(spark, sf):
    """T1/T5 as Structured Streaming: the events table read as a stream, each
    prediction joined to its first later actual with watermarks on both sides,
    run to completion with ``availableNow`` into a parquet table in the shared
    checkpoint folder, then read back; one row per closed request."""
    batch, preds, acts = _streamed_actuals(spark, sf)
    first = M.stream_first_actuals(preds, acts, "user_id", "ts", "request_id", "actual_id", "actual", preds_have_watermark=True)
    base = _stream_folder(spark)
    M.stream_to_table(first, f"{base}/out", f"{base}/state")
    close = batch.agg((F.max("ts") - F.expr(f"INTERVAL {CLOSED_DAYS} DAYS")).alias("t")).first()["t"]  # one value
    done = spark.read.schema(first.schema).parquet(f"{base}/out")
    return done.where(F.col("ts").cast("timestamp_ntz") < F.lit(close)).select("request_id", "actual_id", "actual")


_STREAM_PERF_SQL = f"""
WITH {_MATCH_SQL}, {_PERF_SQL}, last AS (SELECT max(ts) AS t FROM events)
SELECT perf.* FROM perf, last WHERE CAST(window_start AS DATE) + INTERVAL 7 DAY <= last.t - INTERVAL {CLOSED_DAYS} DAY
"""


@register("stream_rolling_performance", _STREAM_PERF_SQL)
def stream_rolling_performance(spark, sf):
    """T4 as Structured Streaming over the streamed actuals of T5: day states
    of distinct residuals, windows with exact medians written as they close."""
    batch, preds, acts = _streamed_actuals(spark, sf)
    pairs = M.stream_first_actuals(preds, acts, "user_id", "ts", "request_id", "actual_id", "actual", preds_have_watermark=True,
                                   carry=["predicted"])
    base = _stream_folder(spark)
    M.stream_rolling_performance(pairs, "ts", base, f"{base}/state", 7, 1, delay=None).awaitTermination()
    close = batch.agg((F.max("ts") - F.expr(f"INTERVAL {CLOSED_DAYS} DAYS")).alias("t")).first()["t"]  # one value
    done = spark.read.parquet(f"{base}/windows").where((F.to_date("window_start") + F.expr("INTERVAL 7 DAYS")).cast("timestamp_ntz") <= F.lit(close))
    return done.select("window_start", "n", *[round_sig(c).alias(c) for c in _PERF_COLS])


# fixed values: predicted-value slices for the windowed error table
PRED_EDGES = [0, 50, 100, 200, float("inf")]
PRED_LABELS = ["<=50", "50-100", "100-200", "200+"]

_SLICE_COLS = ["actual_mean", "predicted_mean", "residual_mean", "mae", "mape", "within_10_pct", "within_20_pct"]


def _t6_sql() -> str:
    from hearth.plans.sqltext import bucket_case

    return f"""WITH {_MATCH_SQL},
e AS (SELECT *, actual - predicted AS residual, abs(actual - predicted) AS abs_error,
             abs(actual - predicted) / greatest(actual, 1) AS ape,
             {bucket_case('predicted', PRED_EDGES, PRED_LABELS, include_lowest=True)} AS pred_slice
      FROM mt WHERE actual IS NOT NULL),
w AS (SELECT e.*, strftime(CAST(ts AS DATE) - CAST(k AS INTEGER), '%Y-%m-%d') AS window_start FROM e CROSS JOIN range(0, 7) AS t(k))
SELECT window_start, pred_slice, count(*) AS n, {sql_sig(_avg('actual'))} AS actual_mean, {sql_sig(_avg('predicted'))} AS predicted_mean,
  {sql_sig(_avg('residual'))} AS residual_mean, {sql_sig(_avg('abs_error'))} AS mae, {sql_sig(_avg('ape'))} AS mape,
  {sql_sig('avg(CASE WHEN ape <= 0.10 THEN 1.0 ELSE 0.0 END)')} AS within_10_pct,
  {sql_sig('avg(CASE WHEN ape <= 0.20 THEN 1.0 ELSE 0.0 END)')} AS within_20_pct
FROM w GROUP BY 1, 2"""


@register("windowed_error_slices", _t6_sql())
def windowed_error_slices(spark, sf):
    """Error slices per 7-day window and predicted-value slice."""
    from hearth.functions.exprs import right_closed_bucket

    m = _matched(spark, sf).withColumn(
        "pred_slice", right_closed_bucket("predicted", PRED_EDGES, PRED_LABELS, include_lowest=True))
    out = M.windowed_error_slices(m, "ts", "pred_slice", 7, 1)
    return out.select("window_start", "pred_slice", "n", *[round_sig(c).alias(c) for c in _SLICE_COLS])


_BY_KEYS = ["pred_slice", "area", "quality"]


def _t6_by_sql() -> str:
    one = _t6_sql()
    head, tail = one.split("SELECT window_start, pred_slice, count(*) AS n,")
    head = head.replace("w AS (SELECT e.*", "k AS (SELECT *, CAST(user_id % 12 AS VARCHAR) AS area, CAST(user_id % 5 + 1 AS VARCHAR) AS quality FROM e),\nw AS (SELECT k.*") \
        .replace("FROM e CROSS JOIN range(0, 7)", "FROM k CROSS JOIN range(0, 7)").replace("AS t(k))", "AS t(j))").replace("CAST(k AS INTEGER)", "CAST(j AS INTEGER)")
    parts = [f"SELECT window_start, '{k}' AS slice_key, {k} AS level, count(*) AS n," + tail.replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3") for k in _BY_KEYS]
    return head + " UNION ALL ".join(parts)


@register("windowed_error_slices_by", _t6_by_sql())
def windowed_error_slices_by(spark, sf):
    """Error slices per 7-day window by predicted value, area and quality,
    from one aggregate."""
    from hearth.functions.exprs import right_closed_bucket

    m = _matched(spark, sf).select(
        "*", right_closed_bucket("predicted", PRED_EDGES, PRED_LABELS, include_lowest=True).alias("pred_slice"),
        (F.col("user_id") % 12).cast("string").alias("area"), (F.col("user_id") % 5 + 1).cast("string").alias("quality"))
    out = M.windowed_error_slices_by(m, "ts", _BY_KEYS, 7, 1)
    return out.select("window_start", "slice_key", "level", "n", *[round_sig(c).alias(c) for c in _SLICE_COLS])


# the eleven monitored columns: seven numbers and four texts of a scored request
_SHIFT = f"CASE WHEN ts >= TIMESTAMP_NTZ '{TRAIN_END}' THEN 3 ELSE 0 END"
_DRIFT_NUMBERS = {
    "value": "value", "user": "CAST(user_id AS DOUBLE)", "id_tail": "CAST(event_id % 1000 AS DOUBLE)", "hour": "CAST(hour(ts) AS DOUBLE)",
    "minute": "CAST(minute(ts) AS DOUBLE)", "per_user": "value / (1 + user_id % 7)", "shifted": f"value + {_SHIFT}",
}
_DRIFT_TEXTS = {
    "event_type": "event_type", "area": f"CONCAT('area ', CAST((user_id + {_SHIFT}) % 12 AS STRING))",
    "quality": "CAST(user_id % 5 + 1 AS STRING)", "month": "CAST(month(ts) AS STRING)",
}


def _drift_all_sql() -> str:
    duck = lambda x: x.replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("AS STRING", "AS VARCHAR")
    ev = ", ".join(f"{duck(x)} AS c_{n}" for n, x in (_DRIFT_NUMBERS | _DRIFT_TEXTS).items())
    ed = ", ".join(f"quantile_cont(c_{n}, [{', '.join(f'{i / 10}' for i in range(1, 10))}]) AS e_{n}" for n in _DRIFT_NUMBERS)
    cells = [f"SELECT day, ts, '{n}' AS col, CAST(len([x for x in e_{n} if c_{n} > x]) AS VARCHAR) AS bin FROM ev, ed WHERE c_{n} IS NOT NULL" for n in _DRIFT_NUMBERS]
    cells += [f"SELECT day, ts, '{n}' AS col, c_{n} AS bin FROM ev WHERE c_{n} IS NOT NULL" for n in _DRIFT_TEXTS]
    nums = ", ".join(f"('{n}')" for n in _DRIFT_NUMBERS)
    return f"""
WITH ev AS (SELECT strftime(ts, '%Y-%m-%d') AS day, ts, {ev} FROM events),
ed AS (SELECT {ed} FROM ev WHERE ts < TIMESTAMP '{TRAIN_END}'),
b AS ({' UNION ALL '.join(cells)}),
t AS (SELECT col, bin, count(*) AS c FROM b WHERE ts < TIMESTAMP '{TRAIN_END}' GROUP BY 1, 2),
q AS (SELECT col, bin, greatest(c / sum(c) OVER (PARTITION BY col), {_EPS}) AS q FROM t),
d AS (SELECT day, col, bin, count(*) AS n FROM b GROUP BY 1, 2, 3),
s AS (SELECT day, col, sum(n) AS d FROM d GROUP BY 1, 2),
lv AS (SELECT col, bin FROM q UNION SELECT col, bin FROM d UNION SELECT col, CAST(i AS VARCHAR) FROM (VALUES {nums}) v(col), range(0, 10) r(i)),
x AS (SELECT s.day, s.col, s.d, lv.bin FROM s JOIN lv ON s.col = lv.col),
y AS (SELECT x.day, x.col, greatest(coalesce(d.n, 0) / x.d, {_EPS}) AS p, coalesce(q.q, {_EPS}) AS q
      FROM x LEFT JOIN d ON x.day = d.day AND x.col = d.col AND x.bin = d.bin LEFT JOIN q ON x.col = q.col AND x.bin = q.bin)
SELECT day, col AS "column", round(sum((p - q) * ln(p / q)), 8) AS psi FROM y GROUP BY 1, 2"""


@register("drift_all_columns", _drift_all_sql())
def drift_all_columns(spark, sf):
    """T2 over eleven columns in one pass of the log."""
    ev = table(spark, sf, "events")
    log = ev.select("ts", *[F.expr(x).alias(f"c_{n}") for n, x in (_DRIFT_NUMBERS | _DRIFT_TEXTS).items()])
    train = log.where(F.col("ts") < F.lit(TRAIN_END).cast("timestamp_ntz"))
    out = M.drift_all(log, train, "ts", [f"c_{n}" for n in _DRIFT_NUMBERS], [f"c_{n}" for n in _DRIFT_TEXTS], _EPS)
    return out.select("day", F.substring("column", 3, 99).alias("column"), F.round("psi", 8).alias("psi"))
