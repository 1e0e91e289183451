import datetime as dt

import pytest

from hearth.operators.enrich import dom_score, enrich_sales, unmapped_keys


def test_enrichment_on_base_fixture(spark):
    weeks = spark.createDataFrame([
        (dt.date(2008, 5, 1), 6.0), (dt.date(2008, 5, 8), 6.2), (dt.date(2008, 5, 15), 6.4),  # three weeks in May
        (dt.date(2008, 6, 5), 6.1),                                                          # one week in June
    ], "Week date, rate double")
    base = spark.createDataFrame([
        (1, "NAmes", 7, 1500, 2008, 5, 2000, 2000),
        (2, "OldTown", 5, 3500, 2008, 6, 2009, 2010),   # sold before built and before remodel
        (3, "Nowhere", 10, 800, 2008, 7, 1990, 1995),    # month without any week; unmapped area
    ], "Order int, Neighborhood string, `Overall Qual` int, `Gr Liv Area` int, `Yr Sold` int, `Mo Sold` int, "
       "`Year Built` int, `Year Remod/Add` int")
    r = {x["Order"]: x for x in enrich_sales(base, weeks).collect()}
    assert r[1]["Mortgage Rate"] == pytest.approx(6.2) and r[2]["Mortgage Rate"] == pytest.approx(6.1)
    assert r[3]["Mortgage Rate"] is None
    assert r[2]["Age At Sale"] == -1 and r[2]["Years Since Remodel"] == -2
    # 30 + 2(7-5.5)^2 + 10((1500-1500)/500)^2 = 34.5 -> half-even 34; area capped at 3000
    assert r[1]["Days on Market"] == 34 and r[2]["Days on Market"] == 30 + 2 * 0.25 + 90 - 0.5
    assert r[1]["Distance to Center"] == 2.0 and r[3]["Distance to Center"] is None
    assert [x["Neighborhood"] for x in unmapped_keys(base, "Neighborhood", {"NAmes": 2.0, "OldTown": 0.8}).collect()] == ["Nowhere"]
    assert spark.range(1).select(dom_score(5.5, 1500.0).alias("d")).first()["d"] == 30.0
