from hearth.functions.names import canonical_name, normalize_columns, to_snake_case


def test_snake_case_examples():
    assert to_snake_case("GrLivArea") == "gr_liv_area"
    assert to_snake_case("1stFlrSF") == "first_flr_sf"
    assert to_snake_case("2ndFlrSF") == "second_flr_sf"
    assert to_snake_case("3SsnPorch") == "three_ssn_porch"
    assert to_snake_case("Yr Sold") == "yr_sold"
    assert to_snake_case("Year Remod/Add") == "year_remod_add"
    assert canonical_name("MSSubClass") == "ms_sub_class"
    assert canonical_name("BsmtFinSF1") == "bsmt_fin_sf_1"
    assert canonical_name("Exterior1st") == "exterior_first"


def test_normalisation_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "Exterior1st int, BsmtFinType1 int, `3SsnPorch` int, YearsSinceRemod int, SalePrice int")
    once = normalize_columns(df)
    assert once.columns == ["exterior_first", "bsmt_fin_type_1", "three_ssn_porch", "years_since_remodel", "sale_price"]
    assert normalize_columns(once).columns == once.columns
