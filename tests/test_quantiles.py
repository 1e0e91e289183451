import random

import pytest
from pyspark.sql import functions as F

from hearth.operators.quantiles import exact_median, exact_quantiles, mode_of


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("partitions", [None, 1, 50])
def test_exact_quantiles_match_percentile_on_skewed_groups(spark, partitions):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(6000)]
    rows += [("cold", float(rnd.random())) for _ in range(37)]
    rows += [("one", 4.0), ("pair", 1.0), ("pair", 2.0), ("nulls", None), ("nulls", 3.0), (None, 5.0), (None, 8.0)]
    df = _frame(spark, rows)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, by=["g"], partitions=partitions).collect()}
    want = {
        r["g"]: r["qs"]
        for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("qs")).collect()
    }
    assert set(got) == set(want)
    for g, qs in want.items():
        for i, p in enumerate(probs):
            name = f"q{p:g}".replace(".", "_")
            assert got[g][name] == pytest.approx(qs[i], rel=1e-12, abs=1e-12), (g, p)


def test_global_median_and_mode(spark):
    df = _frame(spark, [("a", float(x)) for x in [5, 1, 3, 2, 4, 100]] + [("a", None)])
    assert exact_median(df, "v").collect()[0]["median"] == pytest.approx(3.5)
    t = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("x", "a"), ("x", None), ("y", None)], "g string, s string")
    got = {r["g"]: (r["mode"], r["n"]) for r in mode_of(t, "s", by=["g"], count_name="n").collect()}
    assert got == {"x": ("a", 2)}


@pytest.mark.parametrize("partitions", [None, 30])
def test_global_quantiles_one_row_and_no_cross_join(spark, partitions):
    import contextlib
    import io

    df = spark.range(1000).selectExpr("cast(id as double) as v")
    q = exact_quantiles(df, "v", [0.5, 0.9], partitions=partitions)
    rows = q.collect()
    assert len(rows) == 1
    assert rows[0]["q0_5"] == pytest.approx(499.5) and rows[0]["q0_9"] == pytest.approx(899.1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "NestedLoopJoin" not in buf.getvalue() and "CartesianProduct" not in buf.getvalue()
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


@pytest.mark.parametrize("conf", [{}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false"}])
@pytest.mark.parametrize("held", ["plain", "cached", "persisted", "joined", "distinct", "limited", "aggregated"])
def test_quantiles_do_not_depend_on_how_the_input_is_held(spark, conf, held):
    """Against ``percentile``, on inputs for which two range exchanges would
    draw different bounds."""
    from pyspark import StorageLevel

    df = spark.range(20_000, numPartitions=7).select((F.rand(5) * 1000).alias("v"), (F.col("id") % 3).alias("g"))
    frame = {
        "plain": lambda: df,
        "cached": lambda: df.cache(),
        "persisted": lambda: df.persist(StorageLevel.DISK_ONLY),
        "joined": lambda: df.cache().join(spark.range(3).withColumnRenamed("id", "g"), "g"),
        "distinct": lambda: df.cache().distinct(),
        "limited": lambda: df.coalesce(1).limit(15_000).cache(),
        "aggregated": lambda: df.cache().groupBy("g", F.round("v").alias("v")).count(),
    }[held]()
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for partitions in (None, 23):
            got = {r.g: (r.a, r.b) for r in exact_quantiles(frame, "v", [0.5, 0.9], by=["g"], names=["a", "b"], partitions=partitions).collect()}
            want = {r.g: tuple(r.q) for r in frame.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.9))).alias("q")).collect()}
            assert got.keys() == want.keys()
            assert all(got[g] == pytest.approx(want[g], abs=1e-9) for g in want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.catalog.clearCache()


def test_bin_edges(spark):
    from hearth.operators.quantiles import bin_edges

    rows = [("a", float(i)) for i in range(100)] + [("b", 1.0)] * 90 + [("b", 2.0)] * 10 + [("c", None)]
    got = {(r.g, r.bin): r.edge for r in bin_edges(_frame(spark, rows), "v", ["g"], 4).collect()}
    assert got == {("a", 0): 24.0, ("a", 1): 49.0, ("a", 2): 74.0, ("a", 3): 99.0, ("b", 3): 2.0}


def test_column_quantiles_equal_the_ranked_ones_on_odd_columns(spark):
    import math

    import numpy as np

    from hearth.operators.quantiles import column_quantiles

    rnd = np.random.default_rng(5)
    n = 4000
    cols = {
        "even": rnd.normal(size=n).tolist(), "wide": (10.0 ** rnd.uniform(-300, 300, n) * rnd.choice([-1, 1], n)).tolist(), "few": [float(x) for x in rnd.integers(-3, 3, n)],
        "close": [1.0 + 2.0**-52 * float(x) for x in rnd.integers(0, 5, n)], "zeros": [(-0.0, 0.0, 1.0)[x] for x in rnd.integers(0, 3, n)],
        "odd": [(math.nan, math.inf, -math.inf, 5.0, None)[x] for x in rnd.integers(0, 5, n)], "none": [None] * n,
    }
    names = list(cols)
    rows = [(i % 4 if i % 50 else None, *[float(v) if v is not None else None for v in x]) for i, x in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in names)).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = column_quantiles(df, names, probs, "fold", [0, 1, 2, 3], ["even", "few", "none"])
    assert set(got) == {None, 0, 1, 2, 3} and set(got[None]) == set(names) - {"none"} and all(set(got[f]) == {"even", "few"} for f in range(4))

    def plain(values):
        v = sorted(values, key=lambda x: (math.isnan(x), x))
        at = [p * (len(v) - 1) for p in probs]
        return [v[math.floor(x)] + (x - math.floor(x)) * (v[math.ceil(x)] - v[math.floor(x)]) for x in at]

    for s, by in got.items():
        for c, q in by.items():
            mine = [r[1 + names.index(c)] for r in rows if s is None or r[0] not in (s, None)]
            assert np.array_equal(q, plain([x for x in mine if x is not None]), equal_nan=True), (s, c)
    assert column_quantiles(df.where("fold = 9"), names, probs) == {None: {}}


def test_describe_reads_its_input_twice_at_most(spark):
    from hearth.operators.profile import describe

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(100)], "a double, b double").repartition(2).mapInPandas(count, "a double, b double")
    got = {r["column"]: r for r in describe(df, ["a", "b"]).collect()}
    assert (got["a"]["q25"], got["a"]["q50"], got["b"]["q75"]) == (24.75, 49.5, 5.0)
    assert seen.value <= 200
