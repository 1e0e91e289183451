import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hearth.operators.ml import (LinearFit, ModelSpec, ScoringBundle, design_gram_by_fold, fit_fill_values,
                                 fit_linear_design, leave_one_out_alphas, linear_expression, linear_fits, linear_oof,
                                 preprocessing_pipeline, sample_param_maps, select_alpha, solve_linear)


def _data(spark, n=300, seed=1, collinear=True):
    """x0..x2 (x2 twice x0 if collinear) and a text column with three levels."""
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 3)) * np.array([1.0, 30.0, 0.2])
    if collinear:
        x[:, 2] = x[:, 0] * 2.0
    t = rnd.integers(0, 3, n)
    y = 1.5 + x @ np.array([1.0, -0.05, 0.5]) + np.array([0.0, 0.7, -0.4])[t] + rnd.normal(scale=0.1, size=n)
    rows = [(i, int(i % 5), *map(float, x[i]), "abc"[t[i]], float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, fold int, x0 double, x1 double, x2 double, t string, label double"), x, t, y


def _one_hot(x, t, scaled=True):
    """Numeric block standardised, one-hot block as it is; both centred."""
    z = (x - x.mean(0)) / (x.std(0) if scaled else 1.0)
    d = np.eye(3)[t]
    return np.column_stack([z, d - d.mean(0)])


def test_ridge_scales_the_numeric_block_only(spark):
    df, x, t, y = _data(spark, collinear=False)
    design = fit_linear_design(df, ["x0", "x1", "x2"], ["t"])
    gram = design.collapse(sum(design_gram_by_fold(df, design, "label", "fold").values()))
    fit = solve_linear(gram, "ridge", 50.0, len(design.numeric))
    z = _one_hot(x, t)
    w = np.linalg.solve(z.T @ z + 50.0 * np.eye(6), z.T @ (y - y.mean()))
    w[:3] /= x.std(0)
    assert np.allclose(fit.coef, w, atol=1e-8)
    assert fit.intercept == pytest.approx(y.mean() - x.mean(0) @ w[:3] - np.eye(3)[t].mean(0) @ w[3:], abs=1e-8)


def test_lasso_with_one_hot_matches_spark(spark):
    df, x, t, y = _data(spark, n=400, seed=3, collinear=False)
    design = fit_linear_design(df, ["x0", "x1", "x2"], ["t"])
    gram = design.collapse(sum(design_gram_by_fold(df, design, "label", "fold").values()))
    z = _one_hot(x, t)
    sdf = spark.createDataFrame([(Vectors.dense(z[i].tolist()), float(y[i])) for i in range(len(y))], ["features", "label"])
    for alpha in (0.01, 0.05, 0.3):
        fit = solve_linear(gram, "lasso", alpha, len(design.numeric))
        ref = LinearRegression(elasticNetParam=1.0, regParam=alpha, standardization=False, tol=1e-13, maxIter=5000).fit(sdf)
        w = ref.coefficients.toArray()
        objective = lambda v: ((y - y.mean() - z @ v) ** 2).sum() / (2 * len(y)) + alpha * np.abs(v).sum()
        ours = np.concatenate([fit.coef[:3] * x.std(0), fit.coef[3:]])
        assert objective(ours) <= objective(w) + 1e-6


def test_ols_min_norm_predictions(spark):
    df, x, t, y = _data(spark)
    design = fit_linear_design(df, ["x0", "x1", "x2"], ["t"])
    fit = linear_fits(df, design, ModelSpec("l", "linear", scale_numeric=True))[None][1]
    pred = [r[0] for r in df.select(linear_expression(design, fit).alias("p"), "id").orderBy("id").collect()]
    full = np.column_stack([np.ones(len(y)), x, np.eye(3)[t]])
    assert np.allclose(pred, full @ np.linalg.lstsq(full, y, rcond=None)[0], atol=1e-6)


def test_leave_one_out_alpha_equals_refitting(spark):
    df, x, t, y = _data(spark, n=60, seed=4, collinear=False)
    alphas = (0.01, 0.3, 3.0, 30.0, 300.0)
    design = fit_linear_design(df, ["x0", "x1", "x2"], ["t"], "fold")
    grams = design_gram_by_fold(df, design, "label", "fold")
    problems = {k: (design, design.collapse(sum(g for f, g in grams.items() if f != k))) for k in (None, 0, 3)}
    got = leave_one_out_alphas(df, problems, alphas, 3, "label", "fold")
    fold = np.arange(60) % 5
    for key in problems:
        keep = np.flatnonzero(fold != key) if key is not None else np.arange(60)
        z, yy = _one_hot(x[keep], t[keep]), y[keep]
        errors = []
        for a in alphas:  # centring and scaling stay those of the training set, the intercept is refitted
            sse = 0.0
            for i in range(len(keep)):
                m = np.arange(len(keep)) != i
                zi = z[m] - z[m].mean(0)
                w = np.linalg.solve(zi.T @ zi + a * np.eye(6), zi.T @ (yy[m] - yy[m].mean()))
                sse += (yy[i] - yy[m].mean() - (z[i] - z[m].mean(0)) @ w) ** 2
            errors.append(sse)
        assert got[key] == alphas[int(np.argmin(errors))]


def test_fills_and_alpha_come_from_the_training_rows(spark):
    """A fold with wild values and many NULLs does not touch the model that
    predicts it."""
    rows, rnd = [], np.random.default_rng(6)
    for i in range(200):
        f = i % 5
        x = None if i % 7 == 0 else float(rnd.normal()) + (1000.0 if f == 0 else 0.0)
        t = None if i % 9 == 0 else ("z" if f == 0 else "ab"[i % 2])
        rows.append((i, f, x, t, 2.0 + 0.5 * (x or 0.0) / 1000 + float(rnd.normal(scale=0.1))))
    schema = "id int, fold int, x double, t string, label double"
    df = spark.createDataFrame(rows, schema)
    spec = ModelSpec("r", "ridge", scale_numeric=True, alphas=(0.1, 1.0, 10.0))
    design = fit_linear_design(df, ["x"], ["t"], "fold")
    d0, fit0 = linear_fits(df, design, spec)[0]
    rest = df.where("fold != 0")
    alone = fit_linear_design(rest, ["x"], ["t"])
    assert d0.fills["x"] == alone.fills["x"] and d0.fills["t"] == alone.fills["t"]
    fit = linear_fits(rest, alone, spec)[None][1]
    assert fit0.alpha == fit.alpha
    a = [r[0] for r in df.select(linear_expression(d0, fit0)).collect()]
    b = [r[0] for r in df.select(linear_expression(alone, fit)).collect()]
    assert np.allclose(a, b, atol=1e-8)


def test_lasso_alpha_path_and_convergence(spark):
    df, x, t, y = _data(spark)
    design = fit_linear_design(df, ["x0", "x1", "x2"], ["t"])
    grams = {f: design.collapse(g) for f, g in design_gram_by_fold(df, design, "label", "fold").items()}
    best, scores = select_alpha(grams, "lasso", [0.001, 0.01, 10.0], 3)
    assert best in (0.001, 0.01) and scores[10.0] > scores[best]
    assert np.allclose(solve_linear(sum(grams.values()), "lasso", 10.0, 3).coef, 0.0)


def test_preprocessing_unseen_level_is_all_zero_and_bundle_roundtrip(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "a", 10.0), (None, "b", 12.0), (3.0, "a", 14.0), (4.0, None, 16.0)],
                                  "x double, t string, label double").withColumn("fold", F.lit(0))
    fills = fit_fill_values(train, ["x"], ["t"])
    assert fills == {"x": 3.0, "t": "a"}
    prep = preprocessing_pipeline(["x"], ["t"], fills).fit(train)
    batch = spark.createDataFrame([(2.0, "zzz")], "x double, t string")
    v = prep.transform(batch).first()["features"].toArray()
    assert list(v) == [2.0, 0.0, 0.0]  # numeric, then one slot per seen level, unseen -> zeros
    design = fit_linear_design(train, ["x"], ["t"])
    fit = linear_fits(train, design, ModelSpec("r", "ridge"))[None][1]
    assert isinstance(fit, LinearFit)
    bundle = ScoringBundle(None, fit, ["x", "t"], design.fills, "v-test", design=design)
    path = str(tmp_path / "bundle")
    bundle.save(path)
    a = bundle.score(batch).first()
    b = ScoringBundle.load(spark, path).score(batch.drop("x")).first()  # x absent -> default (median) filled
    assert a["model_version"] == b["model_version"] == "v-test"
    assert a["predicted_price"] >= 0 and b["predicted_price"] >= 0


def test_param_sampling_is_seeded_and_distinct():
    grid = {"a": [1, 2, 3], "b": ["x", "y"]}
    s1, s2 = sample_param_maps(grid, 4), sample_param_maps(grid, 4)
    assert s1 == s2 and len({tuple(sorted(d.items())) for d in s1}) == 4
    assert len(sample_param_maps(grid, 50)) == 6


def test_random_search_tuning_small(spark):
    from hearth.operators.ml import tune_trees

    df, _, _, _ = _data(spark, n=200, seed=7)
    data = preprocessing_pipeline(["x0", "x1", "x2"], [], {}).fit(df).transform(df)
    spec = ModelSpec("rf", "forest", params={"numTrees": 3, "maxDepth": 2})
    model, best, score = tune_trees(data, spec, {"numTrees": [3, 5], "maxDepth": [2, 3]}, n_iter=2, folds=2,
                                    key=("id",), parallelism=2)
    assert set(best) == {"numTrees", "maxDepth"} and score > 0


def test_sub_design_equals_direct_fit(spark):
    from hearth.operators.ml import sub_design

    rnd = np.random.default_rng(9)
    rows = [(i, i % 5, float(rnd.normal()), float(rnd.normal()), ["a", "b", None][i % 3], float(rnd.normal()))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, fold int, x1 double, x2 double, t string, label double")
    spec = ModelSpec("r", "ridge", scale_numeric=True, alphas=(0.5, 5.0))
    full = fit_linear_design(df, ["x1", "x2"], ["t"])
    grams = design_gram_by_fold(df, full, "label", "fold")
    sub, sub_grams = sub_design(full, grams, ["x2", "t"])
    a, _ = linear_oof(df, sub, spec, grams=sub_grams)
    direct = fit_linear_design(df, ["x2"], ["t"])
    b, _ = linear_oof(df, direct, spec)
    pa = {r["id"]: r["prediction"] for r in a.collect()}
    pb = {r["id"]: r["prediction"] for r in b.collect()}
    assert all(abs(pa[k] - pb[k]) < 1e-9 for k in pa)
