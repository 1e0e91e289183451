"""Fixed values the results depend on (column lists, ordinal scales, bucket
edges, lookup tables). They are data, not logic: every operator takes them as
arguments with these as defaults.
"""

from __future__ import annotations

ABSENT = "NoFeature"
NULL_TOKENS = ("", "NA", "None")

# ---- fixed values: cleaning column lists (raw CamelCase spelling) ----------
ABSENT_TEXT_COLUMNS_RAW = [
    "Alley", "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2",
    "FireplaceQu", "GarageType", "GarageFinish", "GarageQual", "GarageCond", "PoolQC",
    "Fence", "MiscFeature", "MasVnrType",
]
ZERO_NUMERIC_COLUMNS_RAW = [
    "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath",
    "BsmtHalfBath", "GarageCars", "GarageArea", "GarageYrBlt",
]
MODE_TEXT_COLUMNS_RAW = [
    "MSZoning", "Utilities", "Exterior1st", "Exterior2nd", "Electrical", "KitchenQual",
    "Functional", "SaleType",
]
AUGMENTED_COLUMNS_RAW = ["AgeAtSale", "YearsSinceRemodel", "MortgageRate", "DaysOnMarket", "DistanceToCenter"]
LEVERAGE_RULE_TEXT = "(GrLivArea > 4000) & (SalePrice < 300000)"

# ---- fixed values: feature-stage column lists (snake_case spelling) --------
STRUCTURAL_TEXT_COLUMNS = [
    "alley", "pool_qc", "fence", "fireplace_qu", "misc_feature", "garage_type", "garage_finish",
    "garage_qual", "garage_cond", "bsmt_qual", "bsmt_cond", "bsmt_exposure", "bsmt_fin_type_1",
    "bsmt_fin_type_2", "mas_vnr_type",
]
STRUCTURAL_NUMERIC_COLUMNS = [
    "garage_yr_blt", "garage_area", "garage_cars", "bsmt_fin_sf_1", "bsmt_fin_sf_2", "bsmt_unf_sf",
    "total_bsmt_sf", "bsmt_full_bath", "bsmt_half_bath", "mas_vnr_area", "pool_area",
]

# ---- fixed values: ordinal scales used by feature engineering --------------
QUALITY_SCALE = {"None": 0, "NA": 0, "NoFeature": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
EXPOSURE_SCALE = {"None": 0, "NA": 0, "NoFeature": 0, "No": 1, "Mn": 2, "Av": 3, "Gd": 4}
FINISH_TYPE_SCALE = {
    "None": 0, "NA": 0, "NoFeature": 0, "Unf": 1, "LwQ": 2, "Rec": 3, "BLQ": 4, "ALQ": 5, "GLQ": 6,
}
GARAGE_FINISH_SCALE = {"None": 0, "NA": 0, "NoFeature": 0, "Unf": 1, "RFn": 2, "Fin": 3}
FUNCTIONAL_SCALE = {"Sal": 0, "Sev": 1, "Maj2": 2, "Maj1": 3, "Mod": 4, "Min2": 5, "Min1": 6, "Typ": 7}
PAVED_DRIVE_SCALE = {"N": 0, "P": 1, "Y": 2}
LOT_SHAPE_SCALE = {"IR3": 0, "IR2": 1, "IR1": 2, "Reg": 3}
LAND_SLOPE_SCALE = {"Sev": 0, "Mod": 1, "Gtl": 2}

ORDINAL_SCALES = {
    "exter_qual": QUALITY_SCALE,
    "exter_cond": QUALITY_SCALE,
    "bsmt_qual": QUALITY_SCALE,
    "bsmt_cond": QUALITY_SCALE,
    "heating_qc": QUALITY_SCALE,
    "kitchen_qual": QUALITY_SCALE,
    "fireplace_qu": QUALITY_SCALE,
    "garage_qual": QUALITY_SCALE,
    "garage_cond": QUALITY_SCALE,
    "pool_qc": QUALITY_SCALE,
    "bsmt_exposure": EXPOSURE_SCALE,
    "bsmt_fin_type_1": FINISH_TYPE_SCALE,
    "bsmt_fin_type_2": FINISH_TYPE_SCALE,
    "garage_finish": GARAGE_FINISH_SCALE,
    "functional": FUNCTIONAL_SCALE,
    "paved_drive": PAVED_DRIVE_SCALE,
    "lot_shape": LOT_SHAPE_SCALE,
    "land_slope": LAND_SLOPE_SCALE,
}

# ---- fixed values: the EDA scale set (Functional runs 8..1, missing -> 8) --
EDA_QUALITY_SCALE = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1}
EDA_FUNCTIONAL_SCALE = {"Typ": 8, "Min1": 7, "Min2": 6, "Mod": 5, "Maj1": 4, "Maj2": 3, "Sev": 2, "Sal": 1}
EDA_FUNCTIONAL_MISSING = 8

# ---- fixed values: feature-set lists ---------------------------------------
SKEWED_COLUMNS = [
    "lot_area", "gr_liv_area", "total_bsmt_sf", "first_flr_sf", "garage_area", "mas_vnr_area",
    "total_sf", "total_porch_sf",
]
LEAKAGE_COLUMNS = ["sale_price", "price_per_sqft", "price_per_square_foot", "price_per_m2", "price_per_square_meter"]
PRICE_LIKE_NAMES = {"saleprice", "sale_price_log", "log_sale_price"}
REDUCED_LINEAR_DROP = [
    "garage_area", "garage_cond", "pool_area", "pool_qc", "fireplace_qu", "garage_yr_blt",
    "tot_rms_abv_grd", "first_flr_sf", "second_flr_sf", "total_above_ground_sf", "total_bsmt_sf",
    "bsmt_fin_sf_1", "bsmt_fin_sf_2", "bsmt_unf_sf", "low_qual_fin_sf", "full_bath", "half_bath",
    "bsmt_full_bath", "bsmt_half_bath", "wood_deck_sf", "open_porch_sf", "enclosed_porch",
    "three_ssn_porch", "screen_porch", "year_built", "year_remod_add", "garage_age_at_sale",
    "sale_year", "sale_month", "sale_ym_index",
]
CONTEXT_COLUMNS = ["mortgage_rate", "days_on_market", "distance_to_center"]
TIME_COLUMNS = ["yr_sold", "mo_sold", "sale_year", "sale_month", "sale_quarter", "sale_ym_index"]
DERIVED_COLUMNS = [
    "age_at_sale", "years_since_remodel", "years_since_remod", "garage_age_at_sale", "total_sf",
    "total_above_ground_sf", "total_bath", "total_porch_sf", "has_basement", "has_garage",
    "has_pool", "has_fireplace", "has_porch", "has_fence", "is_new_house", "qual_gr_liv_area",
    "qual_total_sf", "age_qual_interaction", "age_negative_flag", "remodel_negative_flag",
    "garage_age_negative_flag",
]

# ---- fixed values: report buckets ------------------------------------------
PRICE_BUCKET_EDGES = [0, 100000, 150000, 200000, 300000, 500000, float("inf")]
PRICE_BUCKET_LABELS = ["<100k", "100k-150k", "150k-200k", "200k-300k", "300k-500k", "500k+"]
AGE_BUCKET_EDGES = [-1, 5, 10, 20, 30, 50, 100, 200]
DOM_BUCKET_EDGES = [0, 30, 45, 60, 90, 200]
OUTLIER_SCAN_COLUMNS = [
    "SalePrice", "GrLivArea", "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "LotArea", "GarageArea",
    "MasVnrArea", "BsmtFinSF1", "WoodDeckSF", "OpenPorchSF", "LotFrontage",
]

# ---- fixed values: neighbourhood -> base distance to centre (miles) --------
NEIGHBORHOOD_BASE_DISTANCE = {
    "OldTown": 0.8, "IDOTRR": 0.9, "BrkSide": 1.2, "SWISU": 1.0, "Blueste": 1.3,
    "NAmes": 2.0, "CollgCr": 2.2, "Crawfor": 2.5, "Edwards": 2.8, "Sawyer": 2.4, "SawyerW": 2.6,
    "Mitchel": 2.9, "ClearCr": 2.7, "BrDale": 2.1, "NPkVill": 2.3, "Blmngtn": 2.5, "MeadowV": 2.5,
    "Landmrk": 2.3,
    "NoRidge": 4.5, "NridgHt": 4.8, "StoneBr": 4.2, "Timber": 4.0, "Veenker": 4.3, "Somerst": 3.5,
    "Gilbert": 3.8, "NWAmes": 3.6, "Greens": 4.1, "GrnHill": 4.6,
}

# ---- fixed values: days-on-market deterministic part -----------------------
DOM_BASE = 30.0
DOM_QUAL_CENTRE = 5.5
DOM_QUAL_WEIGHT = 2.0
DOM_AREA_CENTRE = 1500.0
DOM_AREA_SCALE = 500.0
DOM_AREA_WEIGHT = 10.0
DOM_AREA_CAP = 3000.0
DISTANCE_FLOOR = 0.1

# ---- fixed values: what shows that a house lacks a feature, and what that decides --
# (test, columns it reads, text columns that become "NoFeature", numbers that become 0)
FEATURE_ABSENCE = [
    ("MasVnrArea = 0", ["MasVnrArea"], ["MasVnrType"], []),
    ("MasVnrType = 'NoFeature' AND MasVnrArea IS NULL", ["MasVnrType", "MasVnrArea"], [], ["MasVnrArea"]),
    ("Fireplaces = 0", ["Fireplaces"], ["FireplaceQu"], []),
    ("PoolArea = 0", ["PoolArea"], ["PoolQC"], []),
    ("coalesce(GarageType, 'NoFeature') = 'NoFeature'", ["GarageType"],
     ["GarageFinish", "GarageQual", "GarageCond"], ["GarageYrBlt", "GarageCars", "GarageArea"]),
    ("coalesce(BsmtFinSF1, 0) + coalesce(BsmtFinSF2, 0) + coalesce(BsmtUnfSF, 0) + coalesce(TotalBsmtSF, 0) = 0",
     ["BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF"],
     ["BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2"], []),
]
# (test, columns it reads, column it corrects, value)
CORRECTIONS = [
    ("GarageYrBlt > YrSold", ["GarageYrBlt", "YrSold", "YearBuilt"], "GarageYrBlt", "YearBuilt"),
]
TEXT_CODES = ["MSSubClass"]
# (report key, columns it reads, rows it counts)
ENRICHMENT_COUNTS = [
    ("AgeAtSaleMismatch", ["AgeAtSale", "YrSold", "YearBuilt"], "NOT (AgeAtSale <=> YrSold - YearBuilt)"),
    ("NegativeAgeAtSale", ["AgeAtSale", "YrSold", "YearBuilt"], "AgeAtSale < 0"),
    ("YearsSinceRemodelMismatch", ["YearsSinceRemodel", "YrSold", "YearRemodAdd"], "NOT (YearsSinceRemodel <=> YrSold - YearRemodAdd)"),
    ("NegativeYearsSinceRemodel", ["YearsSinceRemodel", "YrSold", "YearRemodAdd"], "YearsSinceRemodel < 0"),
]
# (report key, month columns, the value of which a month may have only one)
ENRICHMENT_MONTHS = ("MortgageRateMonthPairsWithMultipleRates", ["YrSold", "MoSold"], "MortgageRate")
