import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.constants import PRICE_BUCKET_EDGES, PRICE_BUCKET_LABELS
from hearth.functions.exprs import right_closed_bucket
from hearth.operators.metrics import cv_summary, regression_metrics, residual_frame, summarize_errors
from hearth.operators.vif import vif_inverse_corr, vif_report


def test_metrics_floor_and_ape_denominator(spark):
    df = spark.createDataFrame([(math.log1p(0.0), -0.9), (math.log1p(100000.0), math.log1p(95000.0)),
                                (math.log1p(150000.0), math.log1p(150000.0))], "y double, p double")
    m = regression_metrics(df, "y", "p").collect()[0]
    # prediction for the first row is expm1(-0.9) < 0 -> floored at 0; APE denominator max(actual, 1)
    assert m["mae"] == pytest.approx((0 + 5000 + 0) / 3, rel=1e-6)
    assert m["within_10_pct"] == pytest.approx(1.0)
    res = residual_frame(df, "y", "p").withColumn(  # exact actual prices for the edge check
        "actual", F.when(F.col("actual") < 1, 0.0).when(F.col("actual") < 120000, 100000.0).otherwise(150000.0)) \
        .withColumn("price_bucket", right_closed_bucket("actual", PRICE_BUCKET_EDGES, PRICE_BUCKET_LABELS, include_lowest=True))
    levels = {r["price_bucket"]: r["n"] for r in summarize_errors(res, "price_bucket", PRICE_BUCKET_LABELS).collect()}
    assert levels["<100k"] == 2 and levels["100k-150k"] == 1 and levels["500k+"] == 0  # edges inclusive on the right


def test_cv_summary_sample_std(spark):
    fm = spark.createDataFrame([("m", float(i), 1.0) for i in range(1, 6)], "model string, rmse double, mae double")
    r = cv_summary(fm, metrics=["rmse"]).collect()[0]
    assert r["cv_rmse_mean"] == pytest.approx(3.0) and r["cv_rmse_std"] == pytest.approx(np.std([1, 2, 3, 4, 5], ddof=1))


def test_vif_constant_dropped_and_copy_is_infinite(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=200)
    z = rnd.normal(size=200)
    rows = [(float(a), float(a), float(b), 1.0, float(a + b + 0.1 * c)) for a, b, c in zip(x, z, rnd.normal(size=200))]
    df = spark.createDataFrame(rows, "a double, a_copy double, b double, const double, mix double")
    rep = {r["feature"]: r for r in vif_report(df).collect()}
    assert "const" not in rep
    assert rep["a"]["vif"] == float("inf") and rep["a_copy"]["note"] == "high_multicollinearity"
    assert rep["b"]["n_features_used"] == 4
    inv = {r["feature"]: r["vif"] for r in vif_inverse_corr(df.drop("a_copy", "const"), ["a", "b", "mix"]).collect()}
    assert all(v > 1 for v in inv.values())


def test_factor_equals_brute_force_on_nearly_collinear_columns(spark):
    """R^2 against a long-precision projection; the Gram matrix would lose these digits."""
    from hearth.operators.vif import r_squared_from_factor, triangular_factor

    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(500, 3)) * [1, 50, 1e4] + [0, 2000, 1e6]
    near = x[:, 0] + 1e-5 * rnd.normal(size=500)
    all_x = np.column_stack([x, near, 2 * x[:, 1] - x[:, 0]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in all_x], "a double, b double, c double, d double, e double")
    for parts in (1, 7, 70):
        n, r = triangular_factor(df.repartition(parts), list("abcde"))
        centred = all_x - all_x.mean(0)
        assert n == 500 and np.allclose(r.T @ r, centred.T @ centred, rtol=1e-9, atol=1e-6)
        got = r_squared_from_factor(r)
        for j in range(5):
            others = np.delete(centred, j, axis=1) / np.linalg.norm(np.delete(centred, j, axis=1), axis=0)
            fit = others @ np.linalg.lstsq(others, centred[:, j], rcond=None)[0]
            left = ((centred[:, j] - fit) ** 2).sum() / (centred[:, j] ** 2).sum()
            assert 1 - got[j] == pytest.approx(left, rel=1e-3, abs=1e-13)
        assert 1e-11 < 1 - got[3] < 1e-9  # told from an exact copy
    assert triangular_factor(df.limit(0), ["a", "b"])[0] == 0
