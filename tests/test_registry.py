import pytest

from hearth.operators import model_registry as R
from hearth.operators.ml import LinearDesign, LinearFit, ScoringBundle


def _bundle(spark):
    import numpy as np

    return ScoringBundle(None, LinearFit(1.0, np.array([2.0]), 0.5, "ridge"), ["x"], {"x": 3.0}, "v1", mape=0.1,
                         design=LinearDesign(["x"], [], {"x": 3.0}, {}))


def test_a_version_is_published_whole_and_once(spark, tmp_path):
    root = str(tmp_path / "models")
    assert R.versions(spark, root) == []
    folder = R.publish(spark, root, "v1", [_bundle(spark).save], {"metrics": spark.range(5)}, {"training_scope": "all rows"})
    assert R.versions(spark, root) == ["v1"]
    doc = R.read_manifest(spark, root, "v1")
    assert doc["facts"] == {"training_scope": "all rows"} and doc["tables"] == ["metrics"]
    loaded = ScoringBundle.load(spark, folder)
    assert loaded.mape == 0.1 and loaded.score(spark.createDataFrame([(2.0,)], "x double")).count() == 1
    with pytest.raises(FileExistsError):
        R.publish(spark, root, "v1", tables={"metrics": spark.range(1)})
    assert spark.read.parquet(f"{folder}/metrics").count() == 5


def test_a_lost_writer_leaves_nothing_and_the_rerun_succeeds(spark, tmp_path):
    root = str(tmp_path / "models")

    def lost(folder):
        spark.range(3).write.parquet(f"{folder}/half")
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError, match="driver lost"):
        R.publish(spark, root, "v1", [_bundle(spark).save, lost])
    assert R.versions(spark, root) == []
    R.publish(spark, root, "v1", [_bundle(spark).save])
    assert R.versions(spark, root) == ["v1"]
    assert R.sweep(spark, root) == 1 and R.sweep(spark, root) == 0
    R.read_manifest(spark, root, "v1")


def test_a_cut_file_is_found(spark, tmp_path):
    root = str(tmp_path / "models")
    folder = R.publish(spark, root, "v1", tables={"t": spark.range(100).coalesce(1)})
    (part,) = [p for p in (tmp_path / "models" / "v1" / "t").iterdir() if p.name.startswith("part-")]
    part.write_bytes(part.read_bytes()[:-1])
    with pytest.raises(ValueError, match="differ from the manifest"):
        R.read_manifest(spark, root, "v1")
    assert folder.endswith("/v1")
    for bad in ("", "_x", "a/b"):
        with pytest.raises(ValueError, match="version name"):
            R.publish(spark, root, bad)


def test_union_and_choice(spark):
    a = spark.createDataFrame([("m1", 2.0, 0.1), ("m2", None, 0.2)], "model string, valid_rmse double, valid_mape double")
    b = spark.createDataFrame([("t", 1.0, 7.0)], "model string, valid_rmse double, score double")
    u = R.union_metrics([a, b])
    assert [(r.model, r.valid_mape, r.score) for r in u.orderBy("rank").collect()] == [("t", None, 7.0), ("m1", 0.1, None), ("m2", 0.2, None)]
    assert R.chosen_metrics(u, "m2").first().valid_mape == 0.2
    assert (R.chosen_metrics(u, "gone").first().model, R.chosen_metrics(u, "gone").first().is_fallback) == ("t", True)


def test_aligned_batch_names_what_it_filled(spark):
    batch = spark.createDataFrame([(1, "a")], "id int, t string")
    out, lacking = R.aligned_batch(batch, ["x", "t", "u"], {"x": 2.5}, keep=["id"])
    assert out.columns == ["id", "x", "t", "u"] and lacking == ["x", "u"]
    assert tuple(out.first()) == (1, 2.5, "a", "NoFeature")
    assert {tuple(r) for r in R.defaulted_report(spark, lacking, {"x": 2.5}).collect()} == {("x", 2.5, None), ("u", None, None)}
