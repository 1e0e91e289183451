"""House-shaped views over the driver tables.

Analogy (fixed): a ``lineitem`` row is a sale; ``l_extendedprice`` is the sale
price; ``l_quantity`` the living area; the customer's nation the
neighbourhood; ``l_shipdate`` the sale date; ``year(o_orderdate)`` the year
built; ``ceil(p_size / 5)`` the overall quality (1-10); ``p_brand`` /
``p_type`` the building type / style; ``o_totalprice`` the lot area.
Cells whose driver value is a zero sentinel are read as missing:
``l_tax = 0`` -> lot frontage unknown (genuinely missing), ``l_discount = 0``
-> no garage (structurally absent).

Every view has a Spark builder and the same mapping as SQL text, so the DuckDB
oracle reads exactly what Spark reads.  Dimension joins are opt-in: a query
that needs no neighbourhood does not pay for the customer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.shared import dealt_out
from hearth.sources.tables import table

# fixed values: price buckets rescaled to the driver's price range
SALE_PRICE_EDGES = [0, 10000, 25000, 50000, 75000, 100000, float("inf")]
SALE_PRICE_LABELS = ["<10k", "10k-25k", "25k-50k", "50k-75k", "75k-100k", "100k+"]
# fixed values: leverage rule on the analogy's scale (huge area sold cheap)
LEVERAGE_AREA = 45.0
LEVERAGE_PRICE = 30000.0


def _line_only():
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_extendedprice").alias("sale_price"), F.col("l_quantity").alias("gr_liv_area"),
            F.year("l_shipdate").alias("yr_sold"), F.month("l_shipdate").alias("mo_sold"), "l_discount", "l_tax"]


def sales(spark: SparkSession, sf: str, neighborhood: bool = False, part: bool = False,
          orders: bool = True) -> DataFrame:
    """``orders=False`` (line columns only) skips the orders join entirely."""
    li = table(spark, sf, "lineitem")
    if not orders:
        return li.select(*_line_only())
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    df = li.join(od, li.l_orderkey == od.o_orderkey)
    cols = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("sale_price"),
        F.col("l_quantity").alias("gr_liv_area"),
        F.year("l_shipdate").alias("yr_sold"),
        F.month("l_shipdate").alias("mo_sold"),
        F.year("o_orderdate").alias("year_built"),
        F.col("o_totalprice").alias("lot_area"),
        F.col("o_orderpriority").alias("kitchen_qual_code"),
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_tax") * 1000).alias("lot_frontage"),
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_discount") * 10000).alias("garage_area"),
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("garage_type"),
        F.col("l_linestatus").alias("sale_condition"),
        F.col("l_discount"), F.col("l_tax"),
    ]
    if neighborhood:
        cu = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
        # nation has a fixed, tiny cardinality (25 rows): broadcasting it is bounded
        na = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
        df = df.join(cu, df.o_custkey == cu.c_custkey).join(na, F.col("c_nationkey") == na.n_nationkey)
        cols += [F.col("n_name").alias("neighborhood"), F.col("c_acctbal").alias("distance_proxy")]
    if part:
        pa = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
        df = df.join(pa, df.l_partkey == pa.p_partkey)
        cols += [
            F.ceil(F.col("p_size") / 5).cast("int").alias("overall_qual"),
            F.col("p_brand").alias("bldg_type"),
            F.col("p_type").alias("house_style"),
            F.col("p_retailprice").alias("list_price"),
            F.col("p_size"),
        ]
    return df.select(*cols)


def sales_sql(neighborhood: bool = False, part: bool = False, orders: bool = True) -> str:
    if not orders:
        return ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS sale_price, "
                "l_quantity AS gr_liv_area, CAST(year(l_shipdate) AS INTEGER) AS yr_sold, "
                "CAST(month(l_shipdate) AS INTEGER) AS mo_sold, l_discount, l_tax FROM lineitem")
    cols = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice AS sale_price",
        "l_quantity AS gr_liv_area",
        "CAST(year(l_shipdate) AS INTEGER) AS yr_sold",
        "CAST(month(l_shipdate) AS INTEGER) AS mo_sold",
        "CAST(year(o_orderdate) AS INTEGER) AS year_built",
        "o_totalprice AS lot_area",
        "o_orderpriority AS kitchen_qual_code",
        "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 1000 END AS lot_frontage",
        "CASE WHEN l_discount = 0 THEN NULL ELSE l_discount * 10000 END AS garage_area",
        "CASE WHEN l_discount = 0 THEN NULL ELSE l_returnflag END AS garage_type",
        "l_linestatus AS sale_condition",
        "l_discount", "l_tax",
    ]
    joins = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    if neighborhood:
        joins += " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
        cols += ["n_name AS neighborhood", "c_acctbal AS distance_proxy"]
    if part:
        joins += " JOIN part ON l_partkey = p_partkey"
        cols += [
            "CAST(ceil(p_size / 5) AS INTEGER) AS overall_qual",
            "p_brand AS bldg_type", "p_type AS house_style", "p_retailprice AS list_price", "p_size",
        ]
    return f"SELECT {', '.join(cols)} FROM {joins}"


# ---- a raw, CamelCase house frame for the feature stage -----------------------
# fixed values: kitchen quality code per order priority
PRIORITY_TO_QUALITY = {"1-URGENT": "Ex", "2-HIGH": "Gd", "3-MEDIUM": "TA", "4-NOT SPECIFIED": "Fa", "5-LOW": "Po"}
HOUSE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def house(spark: SparkSession, sf: str, place: bool = False, spread: bool = False) -> DataFrame:
    """``place=True`` extends the same join chain to customer and nation and
    adds ``Neighborhood`` and the customer balance (the distance proxy).
    ``spread``: the sales are dealt out over all cores first."""
    li = table(spark, sf, "lineitem")
    li = dealt_out(li, HOUSE_KEYS) if spread else li
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus",
                                           "o_orderpriority")
    pa = table(spark, sf, "part").select("p_partkey", "p_size")
    d = li.join(od, li.l_orderkey == od.o_orderkey).join(pa, li.l_partkey == pa.p_partkey)
    extra = []
    if place:
        cu = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
        na = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))  # 25 rows, fixed
        d = d.join(cu, F.col("o_custkey") == cu.c_custkey).join(na, F.col("c_nationkey") == na.n_nationkey)
        extra = [F.col("n_name").alias("Neighborhood"), F.col("c_acctbal").alias("_acctbal")]
    no_disc = F.col("l_discount") == 0
    qual = F.lit(None).cast("string")
    for k, v in PRIORITY_TO_QUALITY.items():
        qual = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(qual)
    return d.select(
        *HOUSE_KEYS,
        F.col("l_extendedprice").alias("SalePrice"),
        F.year("l_shipdate").alias("YrSold"),
        F.month("l_shipdate").alias("MoSold"),
        F.year("o_orderdate").alias("YearBuilt"),
        (F.year("o_orderdate") + F.col("l_linenumber") - 1).alias("YearRemodAdd"),
        F.when(no_disc, F.lit(None)).otherwise(F.year("o_orderdate") + 1).alias("GarageYrBlt"),
        F.ceil(F.col("p_size") / 5).cast("int").alias("OverallQual"),
        (F.col("l_quantity") * 60).alias("GrLivArea"),
        (F.col("l_quantity") * 20).alias("TotalBsmtSF"),
        (F.col("l_quantity") * 40).alias("1stFlrSF"),
        (F.col("l_quantity") * 20).alias("2ndFlrSF"),
        F.least(F.col("l_linenumber"), F.lit(3)).alias("FullBath"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("HalfBath"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("BsmtFullBath"),
        F.when(no_disc, F.lit(None)).otherwise(F.col("l_discount") * 10000).alias("GarageArea"),
        F.when(no_disc, F.lit(None)).otherwise(F.ceil(F.col("l_discount") * 30).cast("int")).alias("GarageCars"),
        F.when(no_disc, F.lit(None)).otherwise(F.lit("Attchd")).alias("GarageType"),
        F.when(no_disc, F.lit(None)).otherwise(F.lit("RFn")).alias("GarageFinish"),
        F.when(F.col("l_tax") == 0.08, F.col("l_quantity")).otherwise(F.lit(0.0)).alias("PoolArea"),
        (F.col("l_linenumber") - 1).alias("Fireplaces"),
        F.when(F.col("l_linestatus") == "O", F.lit("MnPrv")).alias("Fence"),
        (F.col("l_tax") * 1000).alias("WoodDeckSF"),
        (F.col("l_discount") * 500).alias("OpenPorchSF"),
        F.when(F.col("l_returnflag") == "A", F.lit(10.0)).otherwise(F.lit(0.0)).alias("ScreenPorch"),
        F.when(F.col("o_orderstatus") == "O", F.lit("New")).otherwise(F.lit("WD")).alias("SaleType"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Partial")).otherwise(F.lit("Normal")).alias("SaleCondition"),
        qual.alias("KitchenQual"),
        F.when(F.col("l_returnflag") == "N", F.lit("Typ")).when(F.col("l_returnflag") == "A", F.lit("Min1")).alias("Functional"),
        (F.col("p_size") * 10).alias("MSSubClass"),
        F.col("o_totalprice").alias("LotArea"),
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_quantity") * 5).alias("MasVnrArea"),
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_tax") * 1000).alias("LotFrontage"),
        *extra,
    )


def house_sql() -> str:
    qual = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_TO_QUALITY.items()) + " END"
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice AS SalePrice,
  CAST(year(l_shipdate) AS INTEGER) AS YrSold, CAST(month(l_shipdate) AS INTEGER) AS MoSold,
  CAST(year(o_orderdate) AS INTEGER) AS YearBuilt,
  CAST(year(o_orderdate) AS INTEGER) + l_linenumber - 1 AS YearRemodAdd,
  CASE WHEN l_discount = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) + 1 END AS GarageYrBlt,
  CAST(ceil(p_size / 5) AS INTEGER) AS OverallQual,
  l_quantity * 60 AS GrLivArea, l_quantity * 20 AS TotalBsmtSF, l_quantity * 40 AS "1stFlrSF", l_quantity * 20 AS "2ndFlrSF",
  least(l_linenumber, 3) AS FullBath,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS HalfBath,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS BsmtFullBath,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_discount * 10000 END AS GarageArea,
  CASE WHEN l_discount = 0 THEN NULL ELSE CAST(ceil(l_discount * 30) AS INTEGER) END AS GarageCars,
  CASE WHEN l_discount = 0 THEN NULL ELSE 'Attchd' END AS GarageType,
  CASE WHEN l_discount = 0 THEN NULL ELSE 'RFn' END AS GarageFinish,
  CASE WHEN l_tax = 0.08 THEN l_quantity ELSE CAST(0 AS DOUBLE) END AS PoolArea,
  l_linenumber - 1 AS Fireplaces,
  CASE WHEN l_linestatus = 'O' THEN 'MnPrv' END AS Fence,
  l_tax * 1000 AS WoodDeckSF, l_discount * 500 AS OpenPorchSF,
  CASE WHEN l_returnflag = 'A' THEN CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ScreenPorch,
  CASE WHEN o_orderstatus = 'O' THEN 'New' ELSE 'WD' END AS SaleType,
  CASE WHEN o_orderstatus = 'P' THEN 'Partial' ELSE 'Normal' END AS SaleCondition,
  {qual} AS KitchenQual,
  CASE l_returnflag WHEN 'N' THEN 'Typ' WHEN 'A' THEN 'Min1' END AS Functional,
  p_size * 10 AS MSSubClass, o_totalprice AS LotArea,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity * 5 END AS MasVnrArea,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 1000 END AS LotFrontage
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
