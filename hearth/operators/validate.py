"""Input validation and context handling for training and scoring frames
(V1, V2, X16, X17, J3, F2, F5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.exprs import any_null
from hearth.operators.dedup import duplicate_summary

# fixed values: fields a scoring request must carry (after name normalisation)
REQUIRED_SCORING_FIELDS = ["neighborhood", "overall_qual", "gr_liv_area"]


def check_training_frame(df: DataFrame, target: str = "sale_price", key: str = "id") -> int:
    """V1: the target must exist (plan-time error); returns the number of
    duplicate ids (a warning, not an error)."""
    if target not in df.columns:
        raise ValueError(f"training data has no target column {target!r}")
    if key not in df.columns:
        return 0
    return int(duplicate_summary(df, [key]).collect()[0]["n_duplicates"] or 0)


def apply_date_context(df: DataFrame, valuation_date: str | None = None, search_year: int | None = None,
                       search_month: int | None = None) -> DataFrame:
    """``valuation_date`` beats ``search_year/month`` beats existing
    ``yr_sold/mo_sold``; without any of them this is an error (never today).
    A per-row ``valuation_date`` column is honoured too (unparseable -> NULL,
    caught by ``split_valid_requests``)."""
    cols = set(df.columns)
    if valuation_date is not None:
        d = F.to_date(F.lit(valuation_date))
        return df.withColumn("yr_sold", F.year(d)).withColumn("mo_sold", F.month(d))
    if "valuation_date" in cols:
        d = F.try_to_timestamp(F.col("valuation_date").cast("string"))
        out = df.withColumn("yr_sold", F.coalesce(F.year(d), F.col("yr_sold") if "yr_sold" in cols else F.lit(None)))
        return out.withColumn("mo_sold", F.coalesce(F.month(d), F.col("mo_sold") if "mo_sold" in cols else F.lit(None)))
    if search_year is not None and search_month is not None:
        return df.withColumn("yr_sold", F.lit(int(search_year))).withColumn("mo_sold", F.lit(int(search_month)))
    if {"search_year", "search_month"} <= cols:
        return df.withColumn("yr_sold", F.col("search_year").cast("int")).withColumn("mo_sold", F.col("search_month").cast("int"))
    if {"yr_sold", "mo_sold"} <= cols:
        return df
    raise ValueError("no valuation date: pass valuation_date or search_year/search_month")


def split_valid_requests(df: DataFrame, required: Sequence[str] = REQUIRED_SCORING_FIELDS) -> tuple[DataFrame, DataFrame]:
    """V2: (valid, rejects). A missing required COLUMN is a plan-time error;
    rows with a NULL required field or a month outside 1..12 go to the reject
    table with a reason instead of failing the batch."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"scoring batch lacks required fields: {missing}")
    bad_month = ~F.coalesce(F.col("mo_sold").between(1, 12), F.lit(False)) if "mo_sold" in df.columns else F.lit(False)
    reason = F.when(any_null(list(required)), F.lit("missing_required_field")).when(bad_month, F.lit("month_out_of_range"))
    tagged = df.withColumn("_reason", reason)
    return tagged.where(F.col("_reason").isNull()).drop("_reason"), tagged.where(F.col("_reason").isNotNull()) \
        .withColumnRenamed("_reason", "reject_reason")


def attach_context(df: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Add the columns of ``source`` that ``df`` lacks, by key (left join).
    The key must be unique on the source side (checked)."""
    extra = [c for c in source.columns if c not in df.columns and c != key]
    if not extra:
        return df
    dups = int(duplicate_summary(source.select(key), [key]).collect()[0]["n_duplicates"] or 0)
    if dups:
        raise ValueError(f"context key {key!r} is not unique ({dups} duplicates)")
    return df.join(source.select(key, *extra), key, "left")


def drop_ids(df: DataFrame, key: str, deny: DataFrame) -> DataFrame:
    """remove deny-listed ids (anti join; AQE broadcasts a small list)."""
    return df.join(deny.select(key).distinct(), key, "left_anti")


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """rows with a NULL in any of ``subset`` removed."""
    return df.dropna(subset=list(subset))
