"""Variance inflation factors.

The data pass is a tall-skinny QR: each task reduces its Arrow batches to one
triangular factor R of ``[1 X]``, factors are stacked and reduced again in groups
of at most 64, and one (p+1) x (p+1) factor reaches the driver, over at most
``max_features`` columns in the report (those beyond are left out by name).  No
product X'X is formed, so a column that its neighbours explain to a part in
10**10 is told from an exact copy.  Rows are never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


VIF_COLUMNS = ["feature", "vif", "r_squared", "n_features_used", "note"]
SCHEMA = "feature string, vif double, r_squared double, n_features_used int, note string"


def triangular_factor(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray]:
    """Number of rows and the factor R (p x p) of the centred columns: X'X = R'R.
    Rows with a NULL are expected to be filled beforehand."""
    p = len(cols)

    def reduced(x: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(x, mode="r")
        return np.vstack([r, np.zeros((p + 1 - len(r), p + 1))]) if len(r) < p + 1 else r

    def partial(batches):
        from pyspark import TaskContext

        n, r = 0, np.zeros((0, p + 1))
        for b in batches:
            if len(b):
                n += len(b)
                r = reduced(np.vstack([r, np.column_stack([np.ones(len(b)), b.to_numpy(dtype=float)])]))
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "r": [r.tobytes()]})

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        r = reduced(np.vstack([np.frombuffer(x).reshape(p + 1, p + 1) for x in rows.sort_values("r")["r"]]))
        return pd.DataFrame({"part": rows["part"].iloc[:1], "n": [int(rows["n"].sum())], "r": [r.tobytes()]})

    schema = "part long, n long, r binary"
    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInPandas(partial, schema)
    for _ in range(2):
        parts = parts.withColumn("part", F.floor(F.col("part") / 64)).groupBy("part").applyInPandas(merge, schema)
    got = parts.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInPandas(merge, schema).collect()  # one row
    if not got:
        return 0, np.zeros((p, p))
    return got[0]["n"], np.frombuffer(got[0]["r"]).reshape(p + 1, p + 1)[1:, 1:]


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Population covariance, from the factor."""
    n, r = triangular_factor(df, cols)
    return r.T @ r / n if n else np.zeros((len(cols), len(cols)))


def r_squared_from_factor(r: np.ndarray) -> np.ndarray:
    """R^2 of each column on all the others: its part outside their span, from
    an orthogonal basis of the others' factor."""
    size = np.linalg.norm(r, axis=0)
    unit = r / np.where(size > 0, size, 1.0)
    out = np.zeros(r.shape[1])
    for j in range(r.shape[1]):
        u, s, _ = np.linalg.svd(np.delete(unit, j, axis=1), full_matrices=False)
        basis = u[:, s > 1e-12 * s.max(initial=0.0)]
        left = unit[:, j] - basis @ (basis.T @ unit[:, j])
        out[j] = float(np.clip(1.0 - left @ left, 0.0, 1.0))
    return out


def correlation_from_cov(cov: np.ndarray) -> np.ndarray:
    sd = np.sqrt(np.clip(np.diag(cov), 0, None))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = cov / np.outer(sd, sd)
    r[~np.isfinite(r)] = 0.0
    np.fill_diagonal(r, 1.0)
    return r


def vif_inverse_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """VIF = diag(R^-1) of the correlation matrix, computed as
    1 / (1 - R^2_j) so exactly collinear columns come out +inf (NULL) instead
    of failing the inversion."""
    r2 = r_squared_from_factor(triangular_factor(df, cols)[1])
    rows = [(c, None if x >= 0.999999 else float(1.0 / (1.0 - x))) for c, x in zip(cols, r2)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def _note(v: float) -> str:
    return "high_multicollinearity" if v >= 10 else ("moderate_multicollinearity" if v >= 5 else "ok")


def vif_report(df: DataFrame, max_features: int = 80, exclude: Sequence[str] = ()) -> DataFrame:
    """``(feature, vif, r_squared, n_features_used, note)``.

    numeric columns -> +-inf to NULL -> drop all-NULL -> exact-median fill ->
    drop constants -> keep the ``max_features`` with the largest max |r| to any
    other column -> R^2 of each column on the others -> VIF (inf when
    R^2 >= 0.999999).  Two passes: extremes and counts of all columns (medians
    only of those that have NULLs), then the factor.
    """
    spark = df.sparkSession
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
    if not num:
        return spark.createDataFrame([], SCHEMA)
    clean = df.select(*[F.when(F.abs(F.col(c).cast("double")) == float("inf"), F.lit(None))
                        .otherwise(F.col(c).cast("double")).alias(c) for c in num])
    ext = clean.agg(F.count(F.lit(1)).alias("n"), *[
        e for i, c in enumerate(num) for e in (F.count(c).alias(f"c{i}"), F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"))
    ]).first()  # one row
    varying = [c for i, c in enumerate(num) if ext[f"c{i}"] and ext[f"mn{i}"] != ext[f"mx{i}"]]
    holes = [c for i, c in enumerate(num) if c in varying and ext[f"c{i}"] < ext["n"]]
    meds: dict = {}
    if holes:
        from hearth.operators.profile import quantiles_by_column

        meds = {r["column"]: r["m"] for r in quantiles_by_column(clean, holes, [0.5], ["m"]).collect()}  # one per column
    filled = clean.select(*[F.coalesce(F.col(c), F.lit(meds[c])).alias(c) if c in meds else F.col(c) for c in varying])
    if len(varying) < 2:
        return spark.createDataFrame([], SCHEMA)
    n, factor = triangular_factor(filled, varying)
    off = np.abs(correlation_from_cov(factor.T @ factor / n))
    np.fill_diagonal(off, np.nan)
    priority = np.nanmax(off, axis=0)
    order = sorted(range(len(varying)), key=lambda i: (-priority[i], i))[:max_features]
    rows = []
    for i, r2 in zip(order, r_squared_from_factor(factor[:, order]), strict=True):
        vif = float("inf") if r2 >= 0.999999 else float(1.0 / max(1.0 - r2, 1e-12))
        rows.append((varying[i], vif, float(r2), len(order), _note(vif)))
    out = spark.createDataFrame(rows, SCHEMA)
    return out.orderBy(F.desc("vif"), "feature")
