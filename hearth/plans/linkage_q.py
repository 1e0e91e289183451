"""Linkage-area queries: exact null-safe linkage with twin pairing, wildcard
nearest linkage of blanked cells, and split validation (J7-J10, V5, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators.linkage import exact_link, link_records, split_checks, wildcard_link
from hearth.operators.metrics import fold_of
from hearth.plans.registry import register
from hearth.sources.tables import table

COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
BLOCK = ["o_custkey", "o_orderdate"]
# fixed values: the published copy blanks rare values (cheap orders lose their
# priority, the dearest lose their status)
BLANK_PRIORITY_BELOW = 50000.0
BLANK_STATUS_ABOVE = 480000.0


def _sides(spark, sf):
    o = table(spark, sf, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").alias("price_cents")
    a = o.select(F.col("o_orderkey").alias("a_id"), *COLUMNS, cents)
    b = o.select(
        F.col("o_orderkey").alias("b_id"), "o_custkey",
        F.when(F.col("o_totalprice") > BLANK_STATUS_ABOVE, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") < BLANK_PRIORITY_BELOW, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderdate", cents)
    return a, b


_SIDES_SQL = f"""
a AS (SELECT o_orderkey AS a_id, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
             CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents FROM orders),
b AS (SELECT o_orderkey AS b_id, o_custkey,
             CASE WHEN o_totalprice > {BLANK_STATUS_ABOVE} THEN NULL ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_totalprice < {BLANK_PRIORITY_BELOW} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
             o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents FROM orders),
ar AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority, o_orderdate, price_cents ORDER BY a_id) AS rk FROM a),
br AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority, o_orderdate, price_cents ORDER BY b_id) AS rk FROM b),
ex AS (SELECT br.b_id, ar.a_id FROM br JOIN ar
         ON br.o_custkey IS NOT DISTINCT FROM ar.o_custkey AND br.o_orderstatus IS NOT DISTINCT FROM ar.o_orderstatus
        AND br.o_orderpriority IS NOT DISTINCT FROM ar.o_orderpriority AND br.o_orderdate IS NOT DISTINCT FROM ar.o_orderdate
        AND br.price_cents IS NOT DISTINCT FROM ar.price_cents AND br.rk = ar.rk)
"""

_EXACT_SQL = f"WITH {_SIDES_SQL} SELECT b_id, a_id FROM ex"


@register("null_safe_link", _EXACT_SQL)
def null_safe_link(spark, sf):
    a, b = _sides(spark, sf)
    return exact_link(a, b, "a_id", "b_id", COLUMNS, tiebreak=["price_cents"])


_WILD_SQL = f"""WITH {_SIDES_SQL},
brest AS (SELECT * FROM b WHERE b_id NOT IN (SELECT b_id FROM ex)),
arest AS (SELECT * FROM a WHERE a_id NOT IN (SELECT a_id FROM ex)),
cand AS (SELECT brest.b_id, arest.a_id, abs(arest.price_cents - brest.price_cents) AS far FROM brest JOIN arest
           ON brest.o_custkey = arest.o_custkey AND brest.o_orderdate = arest.o_orderdate
          AND (brest.o_orderstatus IS NULL OR brest.o_orderstatus = arest.o_orderstatus)
          AND (brest.o_orderpriority IS NULL OR brest.o_orderpriority = arest.o_orderpriority)),
near AS (SELECT b_id, a_id FROM cand QUALIFY far = min(far) OVER (PARTITION BY b_id)),
one AS (SELECT b_id, min(a_id) AS a_id FROM near GROUP BY b_id HAVING count(*) = 1)
SELECT min(b_id) AS b_id, a_id FROM one GROUP BY a_id HAVING count(*) = 1"""


@register("wildcard_link", _WILD_SQL)
def wildcard_link_q(spark, sf):
    a, b = _sides(spark, sf)
    links = link_records(a, b, "a_id", "b_id", COLUMNS, BLOCK, tiebreak=["price_cents"])
    return links.where(F.col("step") == "wildcard").select("b_id", "a_id")


_SPLIT_SQL = """
WITH o AS (SELECT * FROM orders),
f AS (SELECT *, CAST(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM o),
tr AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM f WHERE fold <> 0),
te AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM f WHERE fold = 0),
g AS (SELECT * FROM tr UNION ALL SELECT * FROM te)
SELECT (SELECT count(*) FROM tr) AS n_a, (SELECT count(*) FROM te) AS n_b,
       (SELECT count(*) FROM tr WHERE o_orderkey IN (SELECT o_orderkey FROM te)) AS n_overlap,
       (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM g)) AS n_missing,
       (SELECT count(*) FROM (SELECT * FROM g EXCEPT ALL SELECT * FROM o)) AS n_extra
"""


@register("overlap_check", _SPLIT_SQL)
def overlap_check(spark, sf):
    o = table(spark, sf, "orders")
    f = fold_of("o_orderkey")
    return split_checks(o, o.where(f != 0), o.where(f == 0), "o_orderkey")
