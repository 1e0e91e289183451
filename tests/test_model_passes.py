"""Fits of several designs in one pass, and what a fit leaves on disk."""

import numpy as np
from hearth.operators.ml import ModelSpec, design_gram_by_fold, fit_linear_design, linear_fits, linear_fits_together, sub_design
from hearth.operators.training import cross_validate


def _frame(spark, n=240):
    rnd = np.random.default_rng(5)
    rows = [(i % 3, float(rnd.normal()), float(rnd.normal()) if i % 7 else None, "xyz"[i % 3], float(rnd.normal())) for i in range(n)]
    return spark.createDataFrame(rows, "fold int, x1 double, x2 double, t string, label double").checkpoint()


def test_fits_of_several_designs_together_are_those_of_each_alone(spark):
    df, spec = _frame(spark), ModelSpec("r", "ridge", scale_numeric=True, alphas=(0.01, 1.0, 30.0))
    whole = fit_linear_design(df, ["x1", "x2"], ["t"], "fold")
    grams = design_gram_by_fold(df, whole, "label", "fold")
    parts = {name: sub_design(whole, grams, cols) for name, cols in {"p": ["x2", "t"], "q": ["x1"], "r": ["x1", "x2", "t"]}.items()}
    both = linear_fits_together(df, whole, parts, spec)
    for name, (design, g) in parts.items():
        alone = linear_fits(df, design, spec, grams=g)
        assert alone.keys() == both[name].keys()
        for key, (_, fit) in alone.items():
            assert fit.alpha == both[name][key][1].alpha and np.allclose(fit.coef, both[name][key][1].coef, atol=1e-10)


def test_forest_does_not_checkpoint_its_vectors(spark, monkeypatch):
    """They were written once per fold, uncompressed."""
    df, written = _frame(spark), []
    real = type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a, **k: written.append(self.columns) or real(self, *a, **k))
    e = cross_validate(df, ["x1", "x2"], ["t"], ModelSpec("m", "forest", params={"numTrees": 2, "maxDepth": 2}))
    assert e.oof.count() == 240 and e.oof.columns == ["fold", "label", "prediction"]
    assert not [c for c in written if "features" in c]


def test_fills_of_all_training_sets_come_from_a_few_passes(spark):
    import statistics

    from hearth.operators.ml import fit_linear_design

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [(i % 5, float(i * 7 % 23) if i % 4 else None, float(i), "abc"[i * i % 3] if i % 6 else None) for i in range(60)]
    schema = "fold int, x double, z double, t string"
    df = spark.createDataFrame(rows, schema).repartition(2).mapInPandas(count, schema)
    d = fit_linear_design(df, ["x", "z"], ["t"], "fold")
    assert seen.value <= 10 * len(rows)
    assert (d.missing, d.levels["t"], d.fills["z"]) == (["x", "t"], sorted({r[3] for r in rows if r[3]}), 29.5)
    for f, fills in [(None, d.fills), *d.fills_without.items()]:
        rest = [r for r in rows if r[0] != f]
        texts = [r[3] for r in rest if r[3]]
        assert fills["x"] == statistics.median(r[1] for r in rest if r[1] is not None)
        assert fills["t"] == min(set(texts), key=lambda v: (-texts.count(v), v))
    assert set(d.fills_without) == set(range(5)) and all(set(v) == {"x", "t"} for v in d.fills_without.values())


def test_vectors_of_a_projection_are_those_of_the_fitted_pipeline(spark):
    """Fills, levels, order and attributes of the slots; each training set lacks a fold."""
    from hearth.operators.ml import dense_features, feature_names, fit_fill_values, preprocessing_pipeline, training_sets

    rows = [(i % 3, i * 5 % 7 if i % 4 else None, float(i) if i % 9 else float("nan"), "abc"[i % 3] if i % 5 else None, ["x", None, "\U0001f600", "\uffee"][i % 4], None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "fold int, n int, x double, t string, u string, w string").checkpoint()
    numeric, text = ["n", "x"], ["t", "u", "w"]
    for f, (fills, levels) in training_sets(df, numeric, text, "fold", [0, 1, 2]).items():
        rest = df.where(df.fold != f)
        old = preprocessing_pipeline(numeric, text, fit_fill_values(rest, numeric, text)).fit(rest).transform(df)
        new = dense_features(df, numeric, text, fills, levels, ["fold"])
        assert feature_names(new) == feature_names(old)
        binary = lambda d: {a["idx"] for a in d.schema["features"].metadata["ml_attr"]["attrs"]["binary"]}
        assert binary(new) == binary(old)
        got, want = ([r.features.toArray() for r in d.select("features").collect()] for d in (new, old))
        assert np.array_equal(got, want, equal_nan=True)


def test_a_forest_reads_the_rows_a_few_times_beside_its_fits(spark):
    """Fills and levels of each training set were fitted in passes of their own."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = _frame(spark).where("fold IS NOT NULL")
    counted = df.mapInPandas(count, df.schema)
    cross_validate(counted, ["x1", "x2"], ["t"], ModelSpec("m", "forest", params={"numTrees": 2, "maxDepth": 2})).oof.count()
    assert seen.value <= 21 * 240


def test_metrics_of_a_linear_spec_come_without_written_predictions(spark, monkeypatch):
    import hearth.operators.training as T
    from hearth.operators.features import FeatureConfig

    df, spec = _frame(spark), ModelSpec("r", "ridge", scale_numeric=True, alphas=(0.01, 1.0, 30.0))
    e = cross_validate(df, ["x1", "x2"], ["t"], spec)
    hold, train = T.fold_metrics(e.oof.where("fold = 0"), by=()).first(), T.fold_metrics(e.train, by=()).first()
    cv = [r.rmse for r in T.fold_metrics(e.oof).collect()]
    written = []
    monkeypatch.setattr(T, "saved", lambda d, *a, **k: written.append(d) or d)
    got = T.evaluate_spec(df, ["x1", "x2"], ["t"], spec, FeatureConfig()).first()
    assert not written and got.n_valid == hold.n and got.alpha == e.alpha
    assert np.allclose([got.valid_rmse, got.valid_r2, got.train_rmse, got.cv_rmse_mean, got.cv_rmse_std], [hold.rmse, hold.r2, train.rmse, np.mean(cv), np.std(cv, ddof=1)])


def test_a_table_of_one_file_is_dealt_out_if_it_has_the_rows(spark, tmp_path, monkeypatch):
    from hearth import shared

    spark.range(1000).selectExpr("id AS k", "id * 2 AS v").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert shared.dealt_out(df, ["k"]).rdd.getNumPartitions() == df.rdd.getNumPartitions()
    monkeypatch.setattr(shared, "TASK_ROWS", 300)
    out = shared.dealt_out(df, ["k"])
    assert out.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    assert sorted(out.collect()) == sorted(df.collect())
