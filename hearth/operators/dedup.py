"""Key-based deduplication and duplicate accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType,))]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest by ``order`` (ties broken by the remaining
    columns, so the result is deterministic).

    ``min_by`` over a packed struct is a partial aggregate: each map task keeps
    one candidate per key, so a key holding a third of the table is reduced
    map-side instead of being sorted inside one window partition.
    """
    cols = df.columns
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    tiebreak = [F.col(c) for c in _orderable(df) if c not in keys]
    packed = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*order_cols, *tiebreak)
    return df.groupBy(*keys).agg(F.min_by(packed, ordering).alias("_kept")).select(
        *[F.col(f"_kept.{c}").alias(c) for c in cols]
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(n_rows, n_keys, n_duplicates)`` measured before any dedup.

    Counts per key are combined map-side, then summed; no distinct set is held
    in one task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.sum("_c").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_keys"),
        F.sum(F.col("_c") - 1).cast("long").alias("n_duplicates"),
    )
