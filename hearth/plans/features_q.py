"""Feature-area queries: ordinal encoding, derived totals and flags, age
clipping, interactions, time features, liquidity score, zone lookups and the
monthly macro-rate join (X1-X11, X18, J1, J2, J4, A6, F6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth import constants as K
from hearth.operators.enrich import (attach_monthly, distance_to_center, dom_score, fill_from_month_median,
                                     lookup, monthly_series, unmapped_keys)
from hearth.operators.features import FeatureConfig, fit_features, transform_features
from hearth.plans import views as V
from hearth.plans.registry import register
from hearth.plans.sqltext import values_table
from hearth.sources.tables import table

KEYS = V.HOUSE_KEYS
_KEYS_SQL = ", ".join(KEYS)


def _engineered(spark, sf, config: FeatureConfig = FeatureConfig()):
    h = V.house(spark, sf)
    params = fit_features(h, config)
    return transform_features(h, params, config, keep=KEYS + ["sale_price"])


_H = f"h AS ({V.house_sql()})"

# ---- X5-X7 totals and flags --------------------------------------------------------

_FLAGS = ["total_sf", "total_above_ground_sf", "total_bath", "total_porch_sf", "has_basement", "has_garage",
          "has_pool", "has_fireplace", "has_porch", "has_fence", "is_new_house"]

_FLAGS_SQL = f"""
WITH {_H},
t AS (SELECT *, coalesce(TotalBsmtSF, 0) + coalesce("1stFlrSF", 0) + coalesce("2ndFlrSF", 0) AS total_sf,
             coalesce(WoodDeckSF, 0) + coalesce(OpenPorchSF, 0) + coalesce(ScreenPorch, 0) AS total_porch_sf FROM h)
SELECT {_KEYS_SQL}, total_sf,
  coalesce("1stFlrSF", 0) + coalesce("2ndFlrSF", 0) AS total_above_ground_sf,
  coalesce(FullBath, 0) + CAST(0.5 AS DOUBLE) * coalesce(HalfBath, 0) + CAST(1.0 AS DOUBLE) * coalesce(BsmtFullBath, 0) AS total_bath,
  total_porch_sf,
  CASE WHEN TotalBsmtSF > 0 THEN 1 ELSE 0 END AS has_basement,
  CASE WHEN coalesce(GarageArea, 0) > 0 OR coalesce(GarageCars, 0) > 0 THEN 1 ELSE 0 END AS has_garage,
  CASE WHEN PoolArea > 0 THEN 1 ELSE 0 END AS has_pool,
  CASE WHEN Fireplaces > 0 THEN 1 ELSE 0 END AS has_fireplace,
  CASE WHEN total_porch_sf > 0 THEN 1 ELSE 0 END AS has_porch,
  CASE WHEN coalesce(Fence, 'NoFeature') NOT IN ('NoFeature', 'None', 'NA') THEN 1 ELSE 0 END AS has_fence,
  CASE WHEN SaleType = 'New' OR SaleCondition = 'Partial' THEN 1 ELSE 0 END AS is_new_house
FROM t
"""


@register("derived_flags", _FLAGS_SQL)
def derived_flags(spark, sf):
    return _engineered(spark, sf).select(*KEYS, *_FLAGS)


# ---- X1/X2/X9 ages with clip flags ------------------------------------------------------

_AGES_SQL = f"""
WITH {_H},
a AS (SELECT {_KEYS_SQL}, YrSold - YearBuilt AS age, YrSold - YearRemodAdd AS remod,
             YrSold - coalesce(GarageYrBlt, 0) AS gage FROM h)
SELECT {_KEYS_SQL},
  CASE WHEN age < 0 THEN 0 ELSE age END AS age_at_sale,
  CASE WHEN remod < 0 THEN 0 ELSE remod END AS years_since_remodel,
  CASE WHEN gage < 0 THEN 0 ELSE gage END AS garage_age_at_sale,
  CASE WHEN age < 0 THEN 1 ELSE 0 END AS age_negative_flag,
  CASE WHEN remod < 0 THEN 1 ELSE 0 END AS remodel_negative_flag,
  CASE WHEN gage < 0 THEN 1 ELSE 0 END AS garage_age_negative_flag
FROM a
"""


@register("clip_age", _AGES_SQL)
def clip_age(spark, sf):
    return _engineered(spark, sf).select(
        *KEYS, "age_at_sale", "years_since_remodel", "garage_age_at_sale",
        "age_negative_flag", "remodel_negative_flag", "garage_age_negative_flag")


# ---- X8 interactions -------------------------------------------------------------------------

_INTER_SQL = f"""
WITH {_H}
SELECT {_KEYS_SQL}, OverallQual * GrLivArea AS qual_gr_liv_area,
  OverallQual * (coalesce(TotalBsmtSF, 0) + coalesce("1stFlrSF", 0) + coalesce("2ndFlrSF", 0)) AS qual_total_sf,
  (YrSold - YearBuilt) * OverallQual AS age_qual_interaction
FROM h
"""


@register("interactions", _INTER_SQL)
def interactions(spark, sf):
    return _engineered(spark, sf).select(*KEYS, "qual_gr_liv_area", "qual_total_sf", "age_qual_interaction")


# ---- X3/X4 time features (min year fitted) ----------------------------------------------------

_TIME_SQL = f"""
WITH {_H}
SELECT {_KEYS_SQL}, YrSold AS sale_year, MoSold AS sale_month, CAST(ceil(MoSold / 3) AS INTEGER) AS sale_quarter,
  CAST((YrSold - (SELECT min(YrSold) FROM h)) * 12 + MoSold AS DOUBLE) AS sale_ym_index
FROM h
"""


@register("time_features", _TIME_SQL)
def time_features(spark, sf):
    return _engineered(spark, sf).select(*KEYS, "sale_year", "sale_month", "sale_quarter", "sale_ym_index")


# ---- X11 ordinal encoding ----------------------------------------------------------------------

def _scale_case(col: str, scale: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in scale.items())
    return f"CAST(CASE coalesce({col}, 'NoFeature') {whens} ELSE 0.0 END AS DOUBLE)"


_ORD_SQL = f"""
WITH {_H}
SELECT {_KEYS_SQL}, {_scale_case('KitchenQual', K.QUALITY_SCALE)} AS kitchen_qual,
  {_scale_case('Functional', K.FUNCTIONAL_SCALE)} AS functional,
  {_scale_case('GarageFinish', K.GARAGE_FINISH_SCALE)} AS garage_finish
FROM h
"""


@register("ordinal_encode", _ORD_SQL)
def ordinal_encode(spark, sf):
    return _engineered(spark, sf).select(*KEYS, "kitchen_qual", "functional", "garage_finish")


# ---- X10 liquidity score ------------------------------------------------------------------------

AREA_PER_SIZE = 60.0  # fixed value: living area per part-size unit in the analogy

_DOM_SQL = f"""
SELECT p_partkey, greatest(round_even({K.DOM_BASE} + {K.DOM_QUAL_WEIGHT} * pow(ceil(p_size / 5) - {K.DOM_QUAL_CENTRE}, 2)
  + {K.DOM_AREA_WEIGHT} * pow((least(p_size * {AREA_PER_SIZE}, {K.DOM_AREA_CAP}) - {K.DOM_AREA_CENTRE}) / {K.DOM_AREA_SCALE}, 2), 0), 1)
  AS days_on_market
FROM part
"""


@register("liquidity_score", _DOM_SQL)
def liquidity_score(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", dom_score(F.ceil(F.col("p_size") / 5), F.col("p_size") * AREA_PER_SIZE).alias("days_on_market"))


# ---- J2/X18/F6 zone lookup -----------------------------------------------------------------------

# Own values: nation k lies 1/4 mile further out than nation k - 1; nations
# from MAPPED_NATIONS on are unmapped on purpose.
MAPPED_NATIONS = 20
NATION_BASE_DISTANCE = {f"NATION_{k}": 0.5 + 0.25 * k for k in range(MAPPED_NATIONS)}
_DIST_VALUES = values_table("d", ["n_name", "base_distance"], list(NATION_BASE_DISTANCE.items()))


def _customers(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))  # 25 rows, fixed
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("neighborhood"), "c_acctbal")


_DIST_SQL = f"""
WITH {_DIST_VALUES}
SELECT c_custkey, n_name AS neighborhood, d.base_distance,
  CASE WHEN d.base_distance IS NULL THEN NULL
       ELSE round(greatest(d.base_distance + (c_acctbal / 10000 - 0.5), 0.1), 2) END AS distance_to_center
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN d USING (n_name)
"""


@register("distance_lookup", _DIST_SQL)
def distance_lookup(spark, sf):
    c = _customers(spark, sf)
    base = lookup("neighborhood", NATION_BASE_DISTANCE)
    return c.select("c_custkey", "neighborhood", base.alias("base_distance"),
                    distance_to_center(base, F.col("c_acctbal") / 10000 - 0.5).alias("distance_to_center"))


_UNMAPPED_SQL = f"""
WITH {_DIST_VALUES}
SELECT n_name AS neighborhood, count(*) AS n_rows
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT IN (SELECT n_name FROM d) GROUP BY 1
"""


@register("lookup_unmapped", _UNMAPPED_SQL)
def lookup_unmapped(spark, sf):
    return unmapped_keys(_customers(spark, sf), "neighborhood", NATION_BASE_DISTANCE)


# ---- A6/J1/J4 monthly macro rate -------------------------------------------------------------------

_RATE_SQL = f"""
WITH s AS ({V.sales_sql()}),
m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS mth,
             avg(o_totalprice) AS rate FROM orders GROUP BY 1, 2),
j AS (SELECT s.yr_sold, s.mo_sold, m.rate FROM s LEFT JOIN m ON s.yr_sold = m.y AND s.mo_sold = m.mth),
mm AS (SELECT yr_sold, mo_sold, median(rate) AS month_rate FROM j WHERE rate IS NOT NULL GROUP BY 1, 2),
g AS (SELECT median(rate) AS gr FROM j WHERE rate IS NOT NULL)
SELECT j.yr_sold, j.mo_sold, count(*) AS n_sales, round(max(j.rate), 4) AS rate,
  round(max(coalesce(j.rate, mm.month_rate, (SELECT gr FROM g))), 4) AS rate_filled,
  CAST(sum(CASE WHEN j.rate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_filled
FROM j LEFT JOIN mm ON j.yr_sold = mm.yr_sold AND j.mo_sold = mm.mo_sold
GROUP BY j.yr_sold, j.mo_sold
"""


@register("monthly_rate_join", _RATE_SQL)
def monthly_rate_join(spark, sf):
    series = monthly_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "rate")
    s = V.sales(spark, sf).select("yr_sold", "mo_sold")
    j = attach_monthly(s, series, "yr_sold", "mo_sold", "rate")
    filled = fill_from_month_median(j.withColumn("rate_filled", F.col("rate")), j.withColumnRenamed("rate", "rate_filled"),
                                    "rate_filled", "yr_sold", "mo_sold")
    return filled.groupBy("yr_sold", "mo_sold").agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.round(F.max("rate"), 4).alias("rate"),
        F.round(F.max("rate_filled"), 4).alias("rate_filled"),
        F.count_if(F.col("rate").isNull()).cast("long").alias("n_filled"),
    )


# ---- V3 enrichment counters and V5 validation of an enriched table ------------------

def _enriched_raw_house(spark, sf):
    from hearth.operators.clean import augmented_columns

    h, _ = augmented_columns(V.house(spark, sf))
    series = monthly_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "MortgageRate")
    return attach_monthly(h, series, "YrSold", "MoSold", "MortgageRate")


_CHECKS_SQL = f"""
WITH {_H},
m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS mth,
             avg(o_totalprice) AS rate FROM orders GROUP BY 1, 2),
e AS (SELECT h.*, YrSold - YearBuilt AS AgeAtSale, YrSold - YearRemodAdd AS YearsSinceRemodel, m.rate AS MortgageRate
      FROM h LEFT JOIN m ON h.YrSold = m.y AND h.MoSold = m.mth),
multi AS (SELECT count(*) AS n FROM (SELECT YrSold, MoSold FROM e WHERE MortgageRate IS NOT NULL
          GROUP BY 1, 2 HAVING count(DISTINCT MortgageRate) > 1))
SELECT CAST(sum(CASE WHEN AgeAtSale IS NOT DISTINCT FROM YrSold - YearBuilt THEN 0 ELSE 1 END) AS BIGINT) AS AgeAtSaleMismatch,
       CAST(sum(CASE WHEN AgeAtSale < 0 THEN 1 ELSE 0 END) AS BIGINT) AS NegativeAgeAtSale,
       CAST(sum(CASE WHEN YearsSinceRemodel IS NOT DISTINCT FROM YrSold - YearRemodAdd THEN 0 ELSE 1 END) AS BIGINT) AS YearsSinceRemodelMismatch,
       CAST(sum(CASE WHEN YearsSinceRemodel < 0 THEN 1 ELSE 0 END) AS BIGINT) AS NegativeYearsSinceRemodel,
       (SELECT n FROM multi) AS MortgageRateMonthPairsWithMultipleRates
FROM e
"""


@register("enrichment_checks", _CHECKS_SQL)
def enrichment_checks_q(spark, sf):
    from hearth.operators.clean import enrichment_checks

    return enrichment_checks(_enriched_raw_house(spark, sf))


_V5_SQL = """
WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS mth,
                  avg(o_totalprice) AS rate FROM orders GROUP BY 1, 2),
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
en AS (SELECT o.*, m.rate FROM o LEFT JOIN m ON CAST(year(o.o_orderdate) AS INTEGER) = m.y
       AND CAST(month(o.o_orderdate) AS INTEGER) = m.mth),
p AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM en)
SELECT 'original_rows_missing' AS "check", (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM p)) AS value
UNION ALL SELECT 'original_rows_changed', (SELECT count(*) FROM (SELECT * FROM p EXCEPT ALL SELECT * FROM o))
UNION ALL SELECT 'duplicate_keys', (SELECT count(*) FROM (SELECT o_orderkey FROM en GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'nulls_in_rate', (SELECT count(*) - count(rate) FROM en)
"""


@register("enrichment_validation", _V5_SQL)
def enrichment_validation_q(spark, sf):
    from hearth.operators.linkage import enrichment_validation

    o = table(spark, sf, "orders")
    series = monthly_series(o, "o_orderdate", "o_totalprice", "rate")
    en = attach_monthly(o.withColumn("_y", F.year("o_orderdate")).withColumn("_m", F.month("o_orderdate")),
                        series, "_y", "_m", "rate").drop("_y", "_m")
    return enrichment_validation(o, en, "o_orderkey", ["rate"])


# ---- P11: the whole engineered frame (names, absence fill, derived, ordinals,
# ms_sub_class text, leakage drop) --------------------------------------------------

_ENG_SQL = f"""
WITH {_H},
f AS (SELECT *, coalesce(GarageYrBlt, 0) AS gyb, coalesce(GarageArea, 0) AS ga, coalesce(GarageCars, 0) AS gc,
             coalesce(TotalBsmtSF, 0) AS tb, coalesce(BsmtFullBath, 0) AS bfb, coalesce(PoolArea, 0) AS pa,
             coalesce(MasVnrArea, 0) AS mva, coalesce(GarageType, 'NoFeature') AS gt, coalesce(Fence, 'NoFeature') AS fe,
             YrSold - YearBuilt AS age, YrSold - YearRemodAdd AS remod FROM h),
t AS (SELECT *, YrSold - gyb AS gage, coalesce(tb, 0) + coalesce("1stFlrSF", 0) + coalesce("2ndFlrSF", 0) AS tsf,
             coalesce(WoodDeckSF, 0) + coalesce(OpenPorchSF, 0) + coalesce(ScreenPorch, 0) AS tps FROM f)
SELECT {_KEYS_SQL},
  YrSold AS yr_sold, MoSold AS mo_sold, YearBuilt AS year_built, YearRemodAdd AS year_remod_add, gyb AS garage_yr_blt,
  OverallQual AS overall_qual, GrLivArea AS gr_liv_area, tb AS total_bsmt_sf, "1stFlrSF" AS first_flr_sf,
  "2ndFlrSF" AS second_flr_sf, FullBath AS full_bath, HalfBath AS half_bath, bfb AS bsmt_full_bath,
  ga AS garage_area, gc AS garage_cars, gt AS garage_type, {_scale_case('GarageFinish', K.GARAGE_FINISH_SCALE)} AS garage_finish,
  pa AS pool_area, Fireplaces AS fireplaces, fe AS fence, WoodDeckSF AS wood_deck_sf, OpenPorchSF AS open_porch_sf,
  ScreenPorch AS screen_porch, SaleType AS sale_type, SaleCondition AS sale_condition,
  {_scale_case('KitchenQual', K.QUALITY_SCALE)} AS kitchen_qual, {_scale_case('Functional', K.FUNCTIONAL_SCALE)} AS functional,
  CAST(MSSubClass AS VARCHAR) AS ms_sub_class, LotArea AS lot_area, mva AS mas_vnr_area, LotFrontage AS lot_frontage,
  YrSold AS sale_year, MoSold AS sale_month, CAST(ceil(MoSold / 3) AS INTEGER) AS sale_quarter,
  CAST((YrSold - (SELECT min(YrSold) FROM h)) * 12 + MoSold AS DOUBLE) AS sale_ym_index,
  CASE WHEN age < 0 THEN 0 ELSE age END AS age_at_sale, CASE WHEN remod < 0 THEN 0 ELSE remod END AS years_since_remodel,
  CASE WHEN gage < 0 THEN 0 ELSE gage END AS garage_age_at_sale,
  tsf AS total_sf, coalesce("1stFlrSF", 0) + coalesce("2ndFlrSF", 0) AS total_above_ground_sf,
  coalesce(FullBath, 0) + CAST(0.5 AS DOUBLE) * coalesce(HalfBath, 0) + CAST(1.0 AS DOUBLE) * coalesce(bfb, 0) AS total_bath,
  tps AS total_porch_sf,
  CASE WHEN tb > 0 THEN 1 ELSE 0 END AS has_basement,
  CASE WHEN coalesce(ga, 0) > 0 OR coalesce(gc, 0) > 0 THEN 1 ELSE 0 END AS has_garage,
  CASE WHEN pa > 0 THEN 1 ELSE 0 END AS has_pool, CASE WHEN Fireplaces > 0 THEN 1 ELSE 0 END AS has_fireplace,
  CASE WHEN fe NOT IN ('NoFeature', 'None', 'NA') THEN 1 ELSE 0 END AS has_fence,
  CASE WHEN tps > 0 THEN 1 ELSE 0 END AS has_porch,
  CASE WHEN SaleType = 'New' OR SaleCondition = 'Partial' THEN 1 ELSE 0 END AS is_new_house,
  OverallQual * GrLivArea AS qual_gr_liv_area, OverallQual * tsf AS qual_total_sf, age * OverallQual AS age_qual_interaction,
  CASE WHEN age < 0 THEN 1 ELSE 0 END AS age_negative_flag, CASE WHEN remod < 0 THEN 1 ELSE 0 END AS remodel_negative_flag,
  CASE WHEN gage < 0 THEN 1 ELSE 0 END AS garage_age_negative_flag
FROM t
"""


@register("engineered_features", _ENG_SQL)
def engineered_features(spark, sf):
    """P11 end to end: every engineered column of every sale (no sale price:
    it is a leakage column)."""
    h = V.house(spark, sf)
    cfg = FeatureConfig()
    return transform_features(h, fit_features(h, cfg), cfg, keep=KEYS)
