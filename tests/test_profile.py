from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import profile as P

from conftest import SF_SMALL


def test_global_positions_and_qq_against_brute_force(spark):
    vals = [5.0] * 40 + [1.0, 2.0, 3.0] + [float(i) for i in range(100, 160)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    pos = P.global_positions(df, "x", partitions=5).orderBy("pos").collect()
    assert [r["pos"] for r in pos] == list(range(103))
    assert [r["v"] for r in pos] == sorted(v for v in vals if v is not None)
    qq = P.qq_points(df, "x").orderBy("pos").collect()
    n = 103
    m = np.array([(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)])
    m[-1] = 0.5 ** (1 / n)
    m[0] = 1 - m[-1]
    want = [NormalDist().inv_cdf(p) for p in m]
    assert [r["theoretical"] for r in qq] == pytest.approx(want, rel=1e-12)


def test_shape_stats_match_pandas(spark):
    import pandas as pd

    ord_ = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    s = P.shape_stats(ord_, ["o_totalprice"]).collect()[0]
    pdf = ord_.select("o_totalprice").toPandas()["o_totalprice"]
    assert s["skew"] == pytest.approx(pdf.skew(), rel=1e-9)
    assert s["kurtosis"] == pytest.approx(pdf.kurt(), rel=1e-9)
    assert s["skew_log1p"] == pytest.approx(np.log1p(pdf).skew(), rel=1e-9)
    assert isinstance(pd.Series([1]), pd.Series)


def test_missing_report_and_constant_correlation(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 1.0), (2.0, "a", None, 1.0), (3.0, None, 6.0, 1.0)],
                               "a double, b string, c double, k double")
    rep = {r["column"]: r for r in P.missing_report(df, ["b"]).collect()}
    assert rep["b"]["n_missing"] == 2 and rep["b"]["pct_missing"] == 66.67 and rep["b"]["na_meaning"].startswith("absent")
    assert rep["c"]["na_meaning"].startswith("genuine")
    corr = {r["feature"]: r["corr_with_target"] for r in P.target_correlation(df, "a", ["c", "k"]).collect()}
    assert corr["k"] is None and corr["c"] == pytest.approx(1.0)
    assert F is not None


def test_eda_digest_on_driver_tables(spark):
    from hearth.plans import views as V

    s = V.sales(spark, SF_SMALL, neighborhood=True)
    lev = (F.col("gr_liv_area") > 45) & (F.col("sale_price") < 30000)
    d = P.eda_digest(s, "sale_price", ["garage_area", "garage_type"], ["sale_price", "gr_liv_area", "lot_area"],
                     ["gr_liv_area", "lot_area", "l_discount"], "neighborhood", lev)
    assert d["missing"]["n_cols_with_missing"] == 3 and d["missing"]["n_genuine"] == 1
    assert d["outliers"]["n_candidates"] > 0 and d["groups"]["ratio_max_min"] >= 1
    assert d["target"]["min"] <= d["target"]["median"] <= d["target"]["max"]


def test_eda_digest_rows_rank_ties_and_take_empty_tables(spark):
    rows = [(float(v), v % 3 + 0.5, None if v % 2 else 1.0, 7.0, "g%d" % (v % 2)) for v in range(1, 21)] + [(500.0, 1.5, None, 7.0, None)]
    df = spark.createDataFrame(rows, "price double, a double, b double, c double, area string")
    args = ("price", ["b"], ["price", "a"], ["a", "c"], "area", F.col("price") > 400)
    got = {(r.section, r.metric): (r.position, r.value) for r in P.eda_digest_rows(df, *args).collect()}
    assert got["target", "median"] == (None, 11.0) and got["target", "max"] == (None, 500.0)
    assert got["missing", "n_cols_with_missing"] == (None, 2.0) and got["missing", "n_genuine"] == (None, 1.0)
    assert got["missing_columns", "b"] == (1, round(11 / 21 * 100, 2)) and got["missing_columns", "area"][0] == 2
    assert got["outliers", "n_candidates"] == (None, 1.0) and got["outlier_features", "price"] == (1, 1.0)
    assert got["correlation", "c"] == (2, None)  # a constant column comes last
    assert got["groups_top", "g0"] == (1, 11.0) and got["groups_bottom", "g1"] == (1, 10.0)
    assert got["groups", "ratio_max_min"] == (None, pytest.approx(1.1))
    none = {(r.section, r.metric): r.value for r in P.eda_digest_rows(df.limit(0), *args).collect()}
    assert none["missing", "n_cols_with_missing"] == 0 and none["outliers", "n_candidates"] == 0 and none["target", "mean"] is None
    assert not any(s.startswith("groups_") for s, _ in none)


def test_submission_ids_follow_explicit_order(spark):
    from hearth.sources.io import submission

    df = spark.createDataFrame([(3.0, 0.5), (1.0, 2.0), (2.0, -20.0)], "k double, p double")
    rows = submission(df, "p", id_col=None, order=["k"]).orderBy("Id").collect()
    assert [r["Id"] for r in rows] == [1, 2, 3]
    assert rows[0]["SalePrice"] == pytest.approx(np.expm1(2.0)) and rows[1]["SalePrice"] == 0.0


def test_pairwise_correlation_matches_pandas_with_nulls(spark):
    import pandas as pd

    rnd = np.random.default_rng(4)
    n = 500
    a = rnd.normal(size=n) * 1000 + 1e6
    b = a * 0.5 + rnd.normal(size=n) * 100
    c = rnd.normal(size=n)
    a[::7] = np.nan
    b[::11] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": 3.0})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double, k double")
    r = P.pairwise_correlation(df, ["a", "b", "c", "k"])
    want = pdf.corr()
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert r[i, j] == pytest.approx(want.loc[x, y], abs=1e-9)
    assert np.isnan(r[0, 3]) and np.isnan(r[3, 3])
    pairs = {(p["feature_1"], p["feature_2"]): p["abs_corr"] for p in P.collinear_pairs(df, ["a", "b", "c", "k"]).collect()}
    assert list(pairs) == [("a", "b")]


def test_average_ranks_and_spearman_match_pandas(spark):
    import pandas as pd

    vals = [3.0, 1.0, 3.0, 2.0, 5.0, 3.0, 1.0, 9.0]
    other = [1.0, 2.0, 2.0, 4.0, 3.0, 8.0, 0.5, 7.0]
    df = spark.createDataFrame([(i, v, o) for i, (v, o) in enumerate(zip(vals, other))], "k int, v double, o double")
    got = {r["k"]: r["r"] for r in P.average_ranks(df, "v", "r", partitions=3).collect()}
    want = pd.Series(vals).rank(method="average")
    assert [got[i] for i in range(len(vals))] == list(want)
    rho = P.spearman(df, "v", "o", key="k").collect()[0]["spearman_rho"]
    assert rho == pytest.approx(pd.Series(vals).rank().corr(pd.Series(other).rank()), abs=1e-12)


def test_normal_quantile_arithmetic(spark):
    from statistics import NormalDist

    from hearth.functions.exprs import normal_quantile_sql

    ps = [1e-300, 1e-12, 1e-5, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in ps], "p double").selectExpr("p", normal_quantile_sql("p") + " AS z").collect()
    assert all(abs(r.z - NormalDist().inv_cdf(r.p)) <= 1e-9 * max(1, abs(r.z)) for r in got)
