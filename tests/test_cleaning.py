import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from house_fixture import frames  # noqa: E402

from hearth.operators.clean import (clean, cleaning_report, domain_rules, enrichment_checks,  # noqa: E402
                                    leverage_split, post_clean_checks, tidy_text)
from hearth.operators.dedup import duplicate_summary, keep_first  # noqa: E402


def by_id(df):
    return {r["Id"]: r for r in df.collect()}


def test_tidy_and_dedup(spark):
    tr, _ = frames(spark)
    t = by_id(keep_first(tidy_text(tr), ["Id"], ["Id", "SalePrice"]))
    assert t[1]["MSZoning"] == "RL" and t[2]["MSZoning"] is None
    assert t[3]["SalePrice"] == 120000.0  # first by (Id, SalePrice)
    d = duplicate_summary(tr, ["Id"]).collect()[0]
    assert (d["n_rows"], d["n_keys"], d["n_duplicates"]) == (11, 10, 1)


def test_leverage_rule_keeps_null_rows(spark):
    tr, _ = frames(spark)
    kept, removed = leverage_split(tr, "GrLivArea", "SalePrice")
    assert [r["Id"] for r in removed.collect()] == [4]
    assert 5 in {r["Id"] for r in kept.collect()}


def test_full_cleaning(spark):
    tr, te = frames(spark)
    res = clean(tr, te)
    t = by_id(res.train)
    s = by_id(res.test)
    # group median (NAmes train+test frontage: 70, 80) -> 75; StoneBr all null -> global median
    assert t[2]["LotFrontage"] == 75.0
    glob = res.model.frontage_global
    assert t[8]["LotFrontage"] == glob and s[102]["LotFrontage"] == glob
    # absence fill and garage rule
    assert t[3]["GarageType"] == "NoFeature" and t[3]["GarageArea"] == 0.0 and t[3]["GarageYrBlt"] == 0.0
    # garage year after sale -> year built
    assert t[7]["GarageYrBlt"] == 1950.0
    # basement areas sum to 0 -> codes absent; pool area 0 -> quality absent; fireplaces 0 -> absent
    assert t[8]["BsmtQual"] == "NoFeature" and t[8]["PoolQC"] == "NoFeature" and t[8]["FireplaceQu"] == "NoFeature"
    # veneer area 0 -> type absent; no type -> area 0
    assert t[8]["MasVnrType"] == "NoFeature" and t[10]["MasVnrArea"] == 0.0
    # mode fill (MSZoning tie RL/RM... train mode) and Functional -> Typ
    assert t[8]["Functional"] == "Typ"
    assert s[102]["MSZoning"] == res.model.mode_fills["MSZoning"]
    assert s[102]["KitchenQual"] == res.model.mode_fills["KitchenQual"]
    # leverage outlier removed from train only
    assert 4 not in t and 5 in t
    assert t[1]["MSSubClass"] == "60"
    checks = {r["check"]: r["ok"] for r in post_clean_checks(res.train.drop("SalePrice"), res.test, res.removed, te).collect()}
    assert checks["removed_outliers_absent"] and checks["test_ids_unchanged"]


def test_checks_count_what_is_wrong(spark):
    """Nulls, repeated ids, removed rows that are back, ids that changed."""
    frame = lambda rows: spark.createDataFrame(rows, "Id int, v string")
    train, test = frame([(1, "a"), (1, None), (2, "b"), (9, None)]), frame([(5, "a"), (6, "a"), (6, "a"), (8, "a")])
    rows = post_clean_checks(train, test, frame([(2, "b"), (1, "a")]), frame([(5, "x"), (5, "x"), (6, "x"), (7, "x")])).collect()
    assert {r["check"]: r["n"] for r in rows} == {
        "train_has_no_nulls": 2, "test_has_no_nulls": 0, "train_ids_unique": 1, "test_ids_unique": 1,
        "removed_outliers_absent": 3, "test_ids_unchanged": 3}  # ids 6 twice, 7 gone, 8 new
    assert all(r["ok"] == (r["n"] == 0) for r in rows)
    none = frame([])
    assert all(r["ok"] and r["n"] == 0 for r in post_clean_checks(none, none, none, none).collect())


def test_report_equals_counts_taken_one_by_one(spark):
    tr, te = frames(spark)
    res = clean(tr, te)
    rep = cleaning_report(tr, te, res)
    assert rep["raw_shape"]["train"] == [tr.count(), len(tr.columns)] and rep["clean_shape"]["test"] == [res.test.count(), len(res.test.columns)]
    want = {c: tr.where(F.col(c).isNull()).count() for c in tr.columns}
    assert rep["missing_before"]["train"] == {c: n for c, n in want.items() if n}
    checks = enrichment_checks(res.train).collect()
    assert rep["augmented_features"]["validation"]["train"] == (checks[0].asDict() if checks else {})


def test_modes_break_ties_by_smallest(spark):
    from hearth.operators.quantiles import mode_of

    df = spark.createDataFrame([("RL",), ("RM",), ("RM",), ("RL",), (None,)], "z string")
    assert mode_of(df, "z").collect()[0]["mode"] == "RL"


def test_enrichment_checks_and_report(spark):
    tr, te = frames(spark)
    x = tr.withColumn("AgeAtSale", F.col("YrSold") - F.col("YearBuilt")).withColumn(
        "YearsSinceRemodel", F.when(F.col("Id") == 1, 99).otherwise(F.col("YrSold") - F.col("YearRemodAdd")))
    c = enrichment_checks(x).collect()[0]
    assert c["AgeAtSaleMismatch"] == 0 and c["NegativeAgeAtSale"] == 1
    assert c["YearsSinceRemodelMismatch"] == 1 and c["NegativeYearsSinceRemodel"] == 1
    res = clean(tr, te)
    rep = cleaning_report(tr, te, res)
    assert rep["duplicate_ids_before"]["train"] == 1
    assert rep["removed_training_outliers"]["count"] == 1 and [r["Id"] for r in res.removed.collect()] == [4]
    assert rep["missing_after"]["test"] == {}


def test_garage_rule_skipped_without_garage_type(spark):
    tr, _ = frames(spark)
    out = by_id(domain_rules(tr.drop("GarageType")))
    assert out[1]["GarageArea"] == 400.0


def test_tidy_strips_all_ascii_whitespace(spark):
    df = spark.createDataFrame([("\t RL \n",), (" \r\n ",), ("a b",), (None,)], "z string")
    assert [r["z"] for r in tidy_text(df).collect()] == ["RL", None, "a b", None]
