import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hearth.streaming import monitor as M

from conftest import SF_SMALL


def _run(stream_df, name, mode="append"):
    ckpt = tempfile.mkdtemp(prefix="hearth-stream-")
    q = stream_df.writeStream.format("memory").queryName(name).outputMode(mode) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def _event_stream(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{SF_SMALL}/events.parque[t]") \
        .withColumn("ts", F.col("ts").cast("timestamp"))


def test_first_actuals_stream_equals_batch_on_closed_windows(spark):
    """One row per request, unmatched ones included, as the batch form has it."""
    ev = _event_stream(spark)
    preds = ev.where("event_type = 'view'").select(F.col("event_id").alias("request_id"), "user_id", "ts",
                                                    F.col("value").alias("predicted"))
    acts = ev.where("event_type = 'purchase'").select(F.col("event_id").alias("actual_id"), "user_id", "ts",
                                                       F.col("value").alias("actual"))
    _run(M.stream_first_actuals(preds, acts, "user_id", "ts", "request_id", "actual_id", "actual"), "first_out")
    b = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    close = b.agg((F.max("ts") - F.expr("INTERVAL 3 DAYS")).alias("t")).first()["t"]
    rows = spark.sql("SELECT request_id, CAST(ts AS timestamp_ntz) AS ts, actual_id, actual FROM first_out").where(F.col("ts") < F.lit(close)).collect()
    p = b.where("event_type = 'view'").select(F.col("event_id").alias("request_id"), "user_id", "ts", F.col("value").alias("predicted"))
    a = b.where("event_type = 'purchase'").select(F.col("event_id").alias("actual_id"), "user_id", "ts", "value")
    want = M.attach_actuals(p, a, "user_id", "ts", "request_id", "actual_id", "value").where(F.col("ts") < F.lit(close)).collect()
    assert len(rows) == len({r["request_id"] for r in rows})
    assert {(r["request_id"], r["actual_id"], r["actual"]) for r in rows} == {(r["request_id"], r["actual_id"], r["actual"]) for r in want}
    assert any(r["actual_id"] is None for r in rows) and any(r["actual_id"] is not None for r in rows)


def test_rolling_metrics_stream_equals_batch_for_closed_windows(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    preds = ev.where("event_type = 'view'").select(F.col("event_id").alias("request_id"), "user_id", "ts",
                                                    F.col("value").alias("predicted"))
    acts = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    matched = M.attach_actuals(preds, acts, "user_id", "ts", "request_id", "event_id", "value") \
        .where("actual IS NOT NULL").select("request_id", F.col("ts").cast("timestamp").alias("ts"), "predicted", "actual")
    d = tempfile.mkdtemp(prefix="hearth-matched-")
    matched.write.mode("overwrite").parquet(os.path.join(d, "m"))
    stream = spark.readStream.schema(matched.schema).parquet(os.path.join(d, "m"))
    _run(M.stream_rolling_metrics(stream, "ts", "7 days", "1 day", delay="0 seconds"), "roll_out")
    got = {r["window"]["start"].strftime("%Y-%m-%d"): r for r in spark.sql("SELECT * FROM roll_out").collect()}
    batch = {r["window_start"]: r for r in M.rolling_performance(matched, "ts", 7, 1).collect()}
    assert got, "no closed window emitted"
    for k, r in got.items():
        assert r["n"] == batch[k]["n"]
        assert r["mae"] == pytest.approx(batch[k]["mae"], rel=1e-9)


def test_request_dedupe(spark):
    ev = _event_stream(spark).select(F.col("user_id").cast("string").alias("request_id"), "ts")
    _run(M.dedupe_requests(ev, "request_id", "ts", "30 days"), "dedup_out")
    rows = spark.sql("SELECT * FROM dedup_out").collect()
    assert len(rows) == len({r["request_id"] for r in rows})


@pytest.mark.parametrize("horizon", [86400, 7200])
def test_attach_actuals_against_brute_force(spark, horizon):
    import datetime as dt
    import random

    rnd = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    preds, acts = [], []
    for i in range(300):
        u = rnd.choice([1, 1, 1, 2, 3])  # user 1 is hot
        t = start + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400) // 600 * 600)  # coarse grid -> ties
        (preds if rnd.random() < 0.5 else acts).append((i, u, t, float(i)))
    # an actual exactly at the horizon edge and one just after it
    preds.append((1000, 9, start, 0.0))
    acts.append((1001, 9, start + dt.timedelta(seconds=horizon), 1.0))
    preds.append((1002, 8, start, 0.0))
    acts.append((1003, 8, start + dt.timedelta(seconds=horizon + 1), 1.0))
    schema = "id long, user long, ts timestamp_ntz, value double"
    p = spark.createDataFrame(preds, schema)
    a = spark.createDataFrame(acts, schema)
    got = {r["id"]: r["actual_id"] for r in
           M.attach_actuals(p, a, "user", "ts", "id", "id", "value", horizon_seconds=horizon).collect()}
    for pid, u, t, _ in preds:
        cands = [(at, aid) for aid, au, at, _ in acts if au == u and t < at <= t + dt.timedelta(seconds=horizon)]
        want = min(cands)[1] if cands else None
        assert got[pid] == want, (pid, got[pid], want)


def test_stream_retrain_triggers_equal_batch_for_closed_windows(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    preds = ev.where("event_type = 'view'").select(F.col("event_id").alias("request_id"), "user_id", "ts",
                                                    F.col("value").alias("predicted"))
    acts = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    matched = M.attach_actuals(preds, acts, "user_id", "ts", "request_id", "event_id", "value") \
        .where("actual IS NOT NULL").select("request_id", F.col("ts").cast("timestamp").alias("ts"), "predicted", "actual")
    d = tempfile.mkdtemp(prefix="hearth-trig-")
    matched.write.mode("overwrite").parquet(os.path.join(d, "m"))
    stream = spark.readStream.schema(matched.schema).parquet(os.path.join(d, "m"))
    q = M.stream_retrain_triggers(stream, "ts", os.path.join(d, "out"), os.path.join(d, "ckpt"), delay="0 seconds")
    q.awaitTermination(300)
    got = {(r["window_start"], r["trigger"]): r["fired"] for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    batch = {(r["window_start"], r["trigger"]): r["fired"] for r in
             M.trigger_rows(M.rolling_performance(matched, "ts", 7, 1)).collect()}
    assert got and all(batch[k] == v for k, v in got.items())


def test_stream_drift_equals_batch_for_closed_windows(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    train = ev.where("ts < timestamp'2024-01-08'")
    edges, shares = M.training_bins(train, "value")
    prof = M.training_profile(train, "value")
    stream = _event_stream(spark)
    _run(M.stream_input_drift(stream, "ts", "value", edges, shares, delay="0 seconds"), "psi_out")
    got = {r["window_start"].strftime("%Y-%m-%d"): r["psi"] for r in spark.sql("SELECT * FROM psi_out").collect()}
    want = {r["day"]: r["psi"] for r in M.input_drift(ev, train, "ts", "value").collect()}
    assert got and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    _run(M.stream_prediction_drift(_event_stream(spark), "ts", "value", ["event_type"], prof[0.01], prof[0.99],
                                   delay="0 seconds"), "drift_out")
    got2 = {(r["window_start"].strftime("%Y-%m-%d"), r["event_type"]): r["n"] for r in spark.sql("SELECT * FROM drift_out").collect()}
    want2 = {(r["day"], r["event_type"]): r["n"] for r in
             M.prediction_drift(ev, "ts", "value", ["event_type"], prof[0.01], prof[0.99]).collect()}
    assert got2 and all(want2[k] == v for k, v in got2.items())


def test_window_medians_and_sums_equal_copied_rows(spark):
    """Against rows copied into every window, for several lengths and slides."""
    import random
    from datetime import datetime, timedelta

    rnd = random.Random(11)
    rows = [(datetime(2024, 1, 1) + timedelta(hours=rnd.randint(0, 500)), rnd.choice([5.0, rnd.random() * 100]), float(rnd.randint(1, 200)),
             rnd.choice(["a", "b", None]), rnd.randint(1, 3)) for _ in range(700)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, actual double, predicted double, area string, quality int")
    for length, slide in ((7, 1), (3, 2), (1, 1)):
        m = M.error_columns(df)
        copied = m.withColumn("_w", F.window(F.col("ts").cast("timestamp"), f"{length} days", f"{slide} days")).withColumn(
            "window_start", F.date_format("_w.start", "yyyy-MM-dd"))
        want = {r.window_start: r for r in copied.groupBy("window_start").agg(
            F.count(F.lit(1)).alias("n"), F.avg("ape").alias("mape"), F.percentile("residual", 0.5).alias("med")).collect()}
        got = {r.window_start: r for r in M.rolling_performance(df, "ts", length, slide).collect()}
        assert got.keys() == want.keys()
        for w in want:
            assert got[w].n == want[w].n
            assert got[w].mape == pytest.approx(want[w].mape, abs=1e-7) and got[w].residual_median == pytest.approx(want[w].med, abs=1e-12)
        by = {(r.window_start, r.slice_key, r.level): r.n for r in M.windowed_error_slices_by(df, "ts", ["area", "quality"], length, slide).collect()}
        for key in ("area", "quality"):
            for r in copied.where(F.col(key).isNotNull()).groupBy("window_start", F.col(key).cast("string").alias("k")).count().collect():
                assert by.pop((r.window_start, key, r.k)) == r["count"]
        assert not by


def test_drift_of_many_columns_equals_one_at_a_time(spark):
    import random
    from datetime import datetime, timedelta

    rnd = random.Random(12)
    rows = [(datetime(2024, 1, 1 + i % 6), rnd.choice([None, rnd.random()]), float(rnd.randint(0, 3)), rnd.choice(["x", "y", None] + ["z"] * (i % 6))) for i in range(600)]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, a double, b double, t string")
    train = log.where("ts < '2024-01-03'")
    got = {(r.day, r.column): r.psi for r in M.drift_all(log, train, "ts", ["a", "b"], ["t"]).collect()}
    for c in ("a", "b"):
        for r in M.input_drift(log, train, "ts", c).collect():
            assert got.pop((r.day, c)) == pytest.approx(r.psi, abs=1e-12)
    for r in M.level_drift(log, train, "ts", "t").collect():
        assert got.pop((r.day, "t")) == pytest.approx(r.psi, abs=1e-12)
    assert not got


@pytest.mark.parametrize("length, slide", [(7, 1), (3, 2)])
def test_streamed_performance_equals_batch_over_many_epochs(spark, length, slide):
    """Exact medians included; one file of a few days per epoch, two days empty,
    one hot residual; a retry of the last epoch writes the same rows."""
    import random
    from datetime import date, datetime, timedelta

    rnd = random.Random(5)
    base, d = datetime(2024, 3, 1), tempfile.mkdtemp(prefix="hearth-epochs-")
    schema = "ts timestamp, actual double, predicted double"
    rows = []
    for part in range(8):
        some = [(base + timedelta(days=3 * part, minutes=rnd.randrange(3 * 1440)), rnd.choice([100.0, 50 + rnd.random() * 100, None]), float(rnd.randint(90, 110))) for _ in range(60)]
        some = [r for r in some if r[0].day not in (9, 10)]
        rows += some
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    M.stream_rolling_performance(stream, "ts", f"{d}/out", f"{d}/state", length, slide, delay="0 seconds").awaitTermination(300)
    got = spark.read.parquet(f"{d}/out/windows")
    assert got.select("epoch").distinct().count() > 2
    seen = {r.window_start: r for r in got.collect()}
    assert len(seen) == got.count()
    batch = {r.window_start: r for r in M.rolling_performance(spark.createDataFrame(rows, schema), "ts", length, slide).collect()}
    closed = spark.read.parquet(f"{d}/out/days").agg(F.max("day")).first()[0]
    want = {w for w in batch if date.fromisoformat(w) + timedelta(days=length - 1) <= closed}
    assert set(seen) == want and len(want) > 5
    for w in want:
        assert all(seen[w][c] == batch[w][c] for c in batch[w].asDict()), w
