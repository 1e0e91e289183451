"""Hand-made house rows covering the edge cases of FIXTURES.md section 5."""

from pyspark.sql import types as T

COLUMNS = [
    ("Id", T.IntegerType()), ("MSZoning", T.StringType()), ("Neighborhood", T.StringType()),
    ("LotFrontage", T.DoubleType()), ("GrLivArea", T.IntegerType()), ("OverallQual", T.IntegerType()),
    ("YearBuilt", T.IntegerType()), ("YearRemodAdd", T.IntegerType()), ("YrSold", T.IntegerType()),
    ("MoSold", T.IntegerType()), ("GarageType", T.StringType()), ("GarageFinish", T.StringType()),
    ("GarageQual", T.StringType()), ("GarageCond", T.StringType()), ("GarageYrBlt", T.DoubleType()),
    ("GarageCars", T.DoubleType()), ("GarageArea", T.DoubleType()), ("BsmtFinSF1", T.DoubleType()),
    ("BsmtFinSF2", T.DoubleType()), ("BsmtUnfSF", T.DoubleType()), ("TotalBsmtSF", T.DoubleType()),
    ("BsmtQual", T.StringType()), ("BsmtCond", T.StringType()), ("BsmtExposure", T.StringType()),
    ("BsmtFinType1", T.StringType()), ("BsmtFinType2", T.StringType()), ("PoolArea", T.IntegerType()),
    ("PoolQC", T.StringType()), ("Fireplaces", T.IntegerType()), ("FireplaceQu", T.StringType()),
    ("MasVnrType", T.StringType()), ("MasVnrArea", T.DoubleType()), ("KitchenQual", T.StringType()),
    ("Functional", T.StringType()), ("MSSubClass", T.IntegerType()), ("SalePrice", T.DoubleType()),
]
SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in COLUMNS])

_G = ("Attchd", "RFn", "TA", "TA", 2000.0, 2.0, 400.0)   # garage present
_NOG = (None, None, None, None, None, None, None)       # no garage
_B = (100.0, 0.0, 200.0, 300.0, "Gd", "TA", "No", "GLQ", "Unf")
_B0 = (0.0, 0.0, 0.0, 0.0, "Gd", "TA", "No", "GLQ", "Unf")  # areas 0 but codes present


def row(i, zoning, nb, lf, area, q, built, remod, ys, ms, g=_G, b=_B, pool=(0, None), fire=(1, "Gd"),
        mas=("BrkFace", 100.0), kq="TA", func="Typ", sub=60, price=180000.0):
    return (i, zoning, nb, lf, area, q, built, remod, ys, ms, *g, *b, *pool, *fire, *mas, kq, func, sub, price)


TRAIN = [
    row(1, " RL ", "NAmes", 70.0, 1500, 6, 2000, 2000, 2008, 5, price=100000.0),
    row(2, "", "NAmes", None, 1600, 7, 1990, 1995, 2008, 6, kq="Gd", price=150000.0),
    row(3, "NA", "NAmes", 80.0, 1700, 5, 1980, 1980, 2009, 7, g=_NOG, price=120000.0),
    row(3, "RL", "NAmes", 80.0, 1700, 5, 1980, 1980, 2009, 7, price=999999.0),       # duplicate Id
    row(4, "RM", "Edwards", 60.0, 4500, 10, 2007, 2007, 2008, 1, price=250000.0),     # leverage -> removed
    row(5, "RM", "Edwards", 65.0, 4500, 10, 2007, 2007, 2008, 1, price=None),         # rule NULL -> kept
    row(6, "None", "OldTown", 50.0, 1200, 4, 2009, 2010, 2008, 3, price=90000.0),     # sold before built/remod
    row(7, "RL", "OldTown", 55.0, 1300, 4, 1950, 1950, 2007, 4,
        g=("Detchd", "Unf", "Fa", "Fa", 2012.0, 1.0, 200.0), price=95000.0),          # garage year after sale
    row(8, "RL", "StoneBr", None, 2500, 9, 2005, 2005, 2010, 6, b=_B0, pool=(0, "Ex"), fire=(0, "Gd"),
        mas=("Stone", 0.0), kq="Ex", func=None, price=480000.0),
    row(9, "RL", "StoneBr", None, 2400, 9, 2004, 2004, 2010, 2, kq="Ex", price=470000.0),
    row(10, "RM", "Blueste", 75.0, 1400, 5, 1970, 1980, 2009, 8, mas=(None, None), kq="Fa", price=130000.0),
]
TEST = [
    row(101, "RL", "NAmes", None, 1550, 6, 2001, 2001, 2008, 5, price=None),
    row(102, None, "StoneBr", None, 2450, 8, 2003, 2003, 2010, 9, g=_NOG, kq=None, price=None),
    row(103, "RM", "Nowhere", 62.0, 1450, 5, 1960, 1960, 2006, 1, price=None),        # unmapped area
]


def frames(spark):
    tr = spark.createDataFrame(TRAIN, SCHEMA)
    te = spark.createDataFrame(TEST, SCHEMA).drop("SalePrice")
    return tr, te
