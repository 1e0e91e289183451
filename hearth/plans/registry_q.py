"""Queries on metric tables, scoring defaults and the model registry (U2, O1,
M18, P9, P10, S10), and of the feature sets and the submission (X14, P7, S11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hearth.functions.exprs import round_sig
from hearth.operators.features import FeatureConfig, fit_features, transform_features
from hearth.operators.ml import fit_fill_values
from hearth.operators.model_registry import aligned_batch, chosen_metrics, defaulted_report, publish, read_manifest, union_metrics
from hearth.plans import views as V
from hearth.plans.registry import register
from hearth.plans.sqltext import round_sig as sql_sig
from hearth.session import ensure_checkpoint_dir
from hearth.sources.io import submission
from hearth.sources.tables import table

_UNIT = 1e6


def _mean(x):
    """From sums in whole numbers, in any order the same."""
    return F.sum(F.round(x * _UNIT).cast("decimal(28,0)")).cast("double") / _UNIT / F.count(F.lit(1))


def _mean_sql(x: str) -> str:
    return f"(CAST(sum(CAST(round({x} * {_UNIT:.0f}) AS DECIMAL(38,0))) AS DOUBLE) / {_UNIT:.0f} / count(*))"


def _two_tables(spark, sf):
    """Return flags and line states stand for models that predict a price of 1,500
    a unit; the second table has a tuning score and no MAPE."""
    li = table(spark, sf, "lineitem").withColumn("err", F.col("l_extendedprice") - 1500 * F.col("l_quantity"))
    rmse = F.sqrt(_mean(F.col("err") * F.col("err")))
    first = li.groupBy(F.col("l_returnflag").alias("model")).agg(
        rmse.alias("valid_rmse"), _mean(F.abs("err") / F.greatest(F.col("l_extendedprice"), F.lit(1.0))).alias("valid_mape"))
    tuned = li.groupBy(F.concat(F.lit("tuned "), F.col("l_linestatus")).alias("model")).agg(rmse.alias("valid_rmse"), _mean(F.abs("err")).alias("tuning_score"))
    return [t.select("model", *[round_sig(c).alias(c) for c in t.columns if c != "model"]) for t in (first, tuned)]


_METRICS_SQL = f"""
li AS (SELECT *, l_extendedprice - 1500 * l_quantity AS err FROM lineitem),
u AS (SELECT l_returnflag AS model, {sql_sig('sqrt(' + _mean_sql('err * err') + ')')} AS valid_rmse,
             {sql_sig(_mean_sql('abs(err) / greatest(l_extendedprice, 1.0)'))} AS valid_mape, CAST(NULL AS DOUBLE) AS tuning_score
      FROM li GROUP BY 1
      UNION ALL SELECT 'tuned ' || l_linestatus, {sql_sig('sqrt(' + _mean_sql('err * err') + ')')}, NULL, {sql_sig(_mean_sql('abs(err)'))} FROM li GROUP BY 1),
m AS (SELECT *, CAST(row_number() OVER (ORDER BY valid_rmse NULLS LAST, model) AS INTEGER) AS rank FROM u)
"""


@register("metrics_union", f"WITH {_METRICS_SQL} SELECT * FROM m")
def metrics_union(spark, sf):
    """Metric tables with different columns as one, with the rank."""
    return union_metrics(_two_tables(spark, sf))


_CHOSEN = [("A", "named"), ("no such model", "fallback")]


@register("scoring_mape", f"WITH {_METRICS_SQL} " + " UNION ALL ".join(
    f"SELECT '{label}' AS asked, model, valid_rmse, valid_mape, is_fallback FROM (SELECT *, model <> '{name}' AS is_fallback FROM m ORDER BY model <> '{name}', rank LIMIT 1)"
    for name, label in _CHOSEN))
def scoring_mape(spark, sf):
    """The chosen model's error, and the first row where it is missing."""
    m = union_metrics(_two_tables(spark, sf))
    a, b = (chosen_metrics(m, name).select(F.lit(label).alias("asked"), "model", "valid_rmse", "valid_mape", "is_fallback") for name, label in _CHOSEN)
    return a.unionByName(b)


_TRAIN = ["o_totalprice", "o_custkey", "o_orderpriority", "o_orderstatus"]


@register("defaulted_columns", """
SELECT 'o_totalprice' AS feature, CAST(quantile_cont(o_totalprice, 0.5) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text FROM orders
UNION ALL SELECT 'o_orderpriority', NULL, (SELECT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")
def defaulted_columns(spark, sf):
    """What a batch lacked and what it got (exact median, mode)."""
    o = table(spark, sf, "orders")
    defaults = fit_fill_values(o, ["o_totalprice", "o_custkey"], ["o_orderpriority", "o_orderstatus"])
    _, lacking = aligned_batch(o.select("o_orderkey", "o_custkey", "o_orderstatus"), _TRAIN, defaults)
    return defaulted_report(spark, lacking, defaults)


@register("aligned_batch", """
SELECT o_orderkey, (SELECT CAST(quantile_cont(o_totalprice, 0.5) AS DOUBLE) FROM orders) AS o_totalprice, o_custkey,
       (SELECT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o_orderpriority, o_orderstatus
FROM orders""")
def aligned_batch_q(spark, sf):
    """The batch with the training columns."""
    o = table(spark, sf, "orders")
    defaults = fit_fill_values(o, ["o_totalprice", "o_custkey"], ["o_orderpriority", "o_orderstatus"])
    return aligned_batch(o.select("o_orderkey", "o_custkey", "o_orderstatus"), _TRAIN, defaults, keep=["o_orderkey"])[0]


@register("registry_round_trip", f"WITH {_METRICS_SQL} SELECT * FROM m")
def registry_round_trip(spark, sf):
    """A metric table published as part of a version and read back through
    its manifest."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    folder = publish(spark, root, "v1", tables={"metrics": union_metrics(_two_tables(spark, sf))}, facts={"training_scope": "all rows"})
    (name,) = read_manifest(spark, root, "v1")["tables"]
    return spark.read.parquet(f"{folder}/{name}")


@register("submission_rows", f"""
SELECT CAST(o_orderkey AS INTEGER) AS "Id", {sql_sig('greatest(exp(ln(1 + o_totalprice) - 12 * (o_orderkey % 2)) - 1, 0.0)')} AS "SalePrice" FROM orders""")
def submission_rows(spark, sf):
    """Ids and prices from log predictions, floored at 0."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("Id"), (F.log(1 + F.col("o_totalprice")) - 12 * (F.col("o_orderkey") % 2)).alias("p"))
    return submission(o, "p").select("Id", round_sig("SalePrice").alias("SalePrice"))


_KEYS = ", ".join(f'"{k}"' for k in V.HOUSE_KEYS)


@register("log_skewed_columns", f"""WITH h AS ({V.house_sql()})
SELECT {_KEYS}, round(ln(1 + CAST("LotArea" AS DOUBLE)), 8) AS lot_area, round(ln(1 + CAST("GrLivArea" AS DOUBLE)), 8) AS gr_liv_area,
       CAST("OverallQual" AS INTEGER) AS overall_qual FROM h""")
def log_skewed_columns(spark, sf):
    """Skewed columns as logs in the reduced set, others as they are."""
    h = V.house(spark, sf)
    cfg = FeatureConfig(feature_set="reduced_linear", log_skewed=True)
    e = transform_features(h, fit_features(h, cfg), cfg, keep=V.HOUSE_KEYS)
    return e.select(*V.HOUSE_KEYS, F.round("lot_area", 8).alias("lot_area"), F.round("gr_liv_area", 8).alias("gr_liv_area"), F.col("overall_qual").cast("int"))
