import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.validate import apply_date_context, attach_context, drop_ids, split_valid_requests
from hearth.sources.io import (feature_list_frame, load_train_test, load_training_data, read_csv_text, read_house_csv,
                               rejected_cells, report_to_long, write_json_report)

SCHEMA = T.StructType([T.StructField("Id", T.IntegerType()), T.StructField("Alley", T.StringType()),
                       T.StructField("LotFrontage", T.DoubleType()), T.StructField("SalePrice", T.DoubleType())])


def _csv(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_null_tokens_and_v2_preference(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    _csv(d, "train.csv", "Id,Alley,LotFrontage,SalePrice\n9,x,1,1\n")
    _csv(d, "train_v2.csv", 'Id,Alley,LotFrontage,SalePrice\n1,NA,65,200000\n2,None,NA,180000\n3," Grvl ",,150000\n4,,bad,1\n')
    _csv(d, "test.csv", "Id,Alley,LotFrontage\n5,Pave,70\n")
    tr, te, files = load_train_test(spark, d, SCHEMA)
    assert files["train"].endswith("train_v2.csv") and files["test"].endswith("test.csv")
    r = {x["Id"]: x for x in tr.collect()}
    assert r[1]["Alley"] is None and r[2]["Alley"] is None and r[3]["Alley"] == "Grvl"
    assert r[2]["LotFrontage"] is None and r[3]["LotFrontage"] is None and r[4]["LotFrontage"] is None
    assert "SalePrice" not in te.columns and te.count() == 1


def test_training_loader_fallback_deny_list_and_context(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    raw = _csv(d, "raw.csv", "Id,Alley,LotFrontage,SalePrice\n1,a,1,10\n2,b,2,20\n3,c,3,30\n")
    deny = spark.createDataFrame([(2,)], "Id int")
    ctx = spark.createDataFrame([(1, 0.5), (3, 0.7)], "Id int, MortgageRate double")
    df = load_training_data(spark, None, SCHEMA, fallback_path=raw, deny_ids=deny, context=ctx)
    assert sorted((r["Id"], r["MortgageRate"]) for r in df.collect()) == [(1, 0.5), (3, 0.7)]
    with pytest.raises(FileNotFoundError):
        load_training_data(spark, os.path.join(d, "missing.csv"), SCHEMA)
    with pytest.raises(ValueError):
        attach_context(df.drop("MortgageRate"), ctx.unionByName(ctx), "Id")
    assert drop_ids(df, "Id", deny).count() == 2


def test_date_context_precedence_and_rejects(spark):
    df = spark.createDataFrame([(1, "NAmes", 5, 1500.0, 2008, 5), (2, None, 6, 1400.0, 2009, 13)],
                               "id int, neighborhood string, overall_qual int, gr_liv_area double, yr_sold int, mo_sold int")
    d1 = apply_date_context(df, valuation_date="2010-03-15").select("yr_sold", "mo_sold").distinct().collect()
    assert [(r[0], r[1]) for r in d1] == [(2010, 3)]
    d2 = apply_date_context(df, search_year=2007, search_month=2).select("yr_sold").distinct().collect()
    assert d2[0][0] == 2007
    assert apply_date_context(df).count() == 2
    with pytest.raises(ValueError):
        apply_date_context(df.drop("yr_sold", "mo_sold"))
    ok, bad = split_valid_requests(df)
    assert [r["id"] for r in ok.collect()] == [1]
    assert [r["reject_reason"] for r in bad.collect()] == ["missing_required_field"]
    with pytest.raises(ValueError):
        split_valid_requests(df.drop("overall_qual"))


def test_report_sinks(spark):
    rep = {"a": {"b": 1, "c": {}}, "d": [1, 2]}
    rows = {(r["section"], r["metric"]) for r in report_to_long(spark, rep).collect()}
    assert rows == {("a", "b"), ("a", "c"), ("d", "d")}
    p = os.path.join(tempfile.mkdtemp(prefix="hearth-json-"), "r")
    write_json_report(spark, rep, p)
    assert spark.read.text(p).count() == 1
    assert [r["feature"] for r in feature_list_frame(spark, ["x", "y"]).orderBy("position").collect()] == ["x", "y"]
    assert F is not None


def test_manifest_and_submission_with_ids(spark):
    import math

    from hearth.sources.io import artifact_manifest, submission

    m = artifact_manifest(spark, [("ridge", True, "/p/prep", "/p/model", "all_rows"),
                                  ("lasso", False, "/q/prep", "/q/model", "all_rows")])
    assert [r["model"] for r in m.where("is_best_model").collect()] == ["ridge"]
    df = spark.createDataFrame([(7, math.log1p(150000.0)), (8, -3.0)], "Id int, p double")
    rows = {r["Id"]: r["SalePrice"] for r in submission(df, "p").collect()}
    assert rows[7] == pytest.approx(150000.0) and rows[8] == 0.0
    with pytest.raises(ValueError):
        submission(df.drop("Id"), "p", id_col=None)


def test_columns_are_found_by_name_and_labelled_test_is_read(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    _csv(d, "train.csv", "SalePrice,Extra,Id,LotFrontage,Alley\n7,q,100,65,a\n")
    _csv(d, "test_v2.csv", "Alley,Id,SalePrice,LotFrontage\nb,5,8,c.70\n")
    tr, te, files = load_train_test(spark, d, SCHEMA)
    assert [tuple(r) for r in tr.collect()] == [(100, "a", 65.0, 7.0)]
    assert [tuple(r) for r in te.collect()] == [(5, "b", None, 8.0)] and files["test"].endswith("test_v2.csv")
    bad = rejected_cells(read_csv_text(spark, files["test"]), SCHEMA, "Id").collect()
    assert [tuple(r) for r in bad] == [("5", "LotFrontage", "c.70")]
    short = _csv(d, "short.csv", "Id,Alley\n1,a\n")
    with pytest.raises(ValueError):
        read_house_csv(spark, short, SCHEMA)


def test_explicit_missing_path_raises_even_with_a_fallback(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    raw = _csv(d, "raw.csv", "Id,Alley,LotFrontage,SalePrice\n1,a,1,10\n")
    with pytest.raises(FileNotFoundError):
        load_training_data(spark, os.path.join(d, "missing.csv"), SCHEMA, fallback_path=raw)


def test_files_of_a_folder_must_share_their_header(spark, tmp_path):
    from hearth.sources.io import read_csv_text

    folder = tmp_path / "same"
    folder.mkdir()
    (folder / "a.csv").write_text("Id,SalePrice\n1,100\n")
    (folder / "b.csv").write_text("Id,SalePrice\n2,200\n")
    assert {tuple(r) for r in read_csv_text(spark, str(folder)).collect()} == {("1", "100"), ("2", "200")}
    other = tmp_path / "other"
    other.mkdir()
    (other / "a.csv").write_text("Id,SalePrice\n1,100\n")
    (other / "b.csv").write_text("SalePrice,Id\n200,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, str(other)).collect()
