"""Enrichment: macro series aggregation and attachment, zone lookups, derived
market features (A6, J1, J2, J4, F6, X10, X16, X18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth import constants as K
from hearth.functions.exprs import col_or_lit, scale_map
from hearth.operators.quantiles import exact_median


def monthly_series(df: DataFrame, date_col: str, value_col: str, name: str = "rate") -> DataFrame:
    """Weekly (or any) observations -> one mean per calendar (year, month)."""
    return df.groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(
        F.avg(value_col).alias(name)
    )


def attach_monthly(df: DataFrame, series: DataFrame, year: str, month: str, name: str = "rate") -> DataFrame:
    """Left join of a monthly series on (year, month); no match -> NULL.  The
    series is small; AQE sees its size at run time and picks the join."""
    s = series.select(F.col("year").alias(year), F.col("month").alias(month), F.col(name))
    return df.join(s, [year, month], "left")


def fill_from_month_median(df: DataFrame, source: DataFrame, value: str, year: str, month: str,
                           flag: str | None = None) -> DataFrame:
    """Missing ``value`` <- source's (year, month) median <- source's global median."""
    src = source.where(F.col(value).isNotNull())
    per_month = exact_median(src, value, by=[year, month], name="_month_median")
    glob = exact_median(src, value, name="m").collect()  # one number
    g = glob[0]["m"] if glob else None
    cols = df.columns
    out = df.join(per_month, [year, month], "left")
    filled = F.coalesce(F.col(value), F.col("_month_median"), F.lit(g))
    sel = [filled.alias(value) if c == value else F.col(c) for c in cols]
    if flag:
        sel.append(F.col(value).isNull().cast("int").alias(flag))
    return out.select(*sel)


def lookup(key: str | Column, mapping: Mapping[str, float]) -> Column:
    """Dictionary lookup as a literal map: a projection, no join at all."""
    return F.element_at(scale_map(mapping), col_or_lit(key))


def unmapped_keys(df: DataFrame, key: str, mapping: Mapping[str, float], count_name: str = "n_rows") -> DataFrame:
    """keys absent from the mapping, with how many rows carry each."""
    return df.where(F.col(key).isNotNull() & ~F.col(key).isin(list(mapping))).groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name)
    )


def dom_score(quality: str | Column, area: str | Column) -> Column:
    """Deterministic days-on-market: ``30 + 2(q-5.5)^2 + 10((min(a,3000)-1500)/500)^2``,
    rounded half-even, floored at 1 (the random noise term is not reproduced)."""
    q, a = col_or_lit(quality), col_or_lit(area)
    raw = (F.lit(K.DOM_BASE) + F.lit(K.DOM_QUAL_WEIGHT) * F.pow(q - F.lit(K.DOM_QUAL_CENTRE), 2)
           + F.lit(K.DOM_AREA_WEIGHT) * F.pow((F.least(a, F.lit(K.DOM_AREA_CAP)) - F.lit(K.DOM_AREA_CENTRE))
                                                / F.lit(K.DOM_AREA_SCALE), 2))
    return F.greatest(F.bround(raw, 0), F.lit(1.0))


def distance_to_center(base: str | Column, offset: str | Column | None = None) -> Column:
    """``max(0.1, base + offset)`` rounded to 2 dp (offset defaults to 0); an
    unmapped area (NULL base) stays NULL (``greatest`` alone would give 0.1)."""
    b = col_or_lit(base)
    x = b if offset is None else b + col_or_lit(offset)
    return F.when(x.isNotNull(), F.round(F.greatest(x, F.lit(K.DISTANCE_FLOOR)), 2))


def sale_year_month(date_col: str | Column) -> list[Column]:
    d = col_or_lit(date_col)
    return [F.year(d).alias("yr_sold"), F.month(d).alias("mo_sold")]


def derive_ages(df: DataFrame, sold: str = "yr_sold", built: str = "year_built",
                remod: str | None = "year_remod_add") -> DataFrame:
    """age_at_sale / years_since_remodel only when absent (supplied wins); negatives kept."""
    out = df
    if "age_at_sale" not in df.columns and {sold, built} <= set(df.columns):
        out = out.withColumn("age_at_sale", F.col(sold) - F.col(built))
    if remod and "years_since_remodel" not in df.columns and {sold, remod} <= set(df.columns):
        out = out.withColumn("years_since_remodel", F.col(sold) - F.col(remod))
    return out


def enrich_sales(sales: DataFrame, weekly_rates: DataFrame, week_col: str = "Week", rate_col: str = "rate",
                 neighborhood: str = "Neighborhood", quality: str = "Overall Qual", area: str = "Gr Liv Area",
                 sold_year: str = "Yr Sold", sold_month: str = "Mo Sold", built: str = "Year Built",
                 remod: str = "Year Remod/Add", distances: Mapping[str, float] = K.NEIGHBORHOOD_BASE_DISTANCE,
                 distance_offset: str | Column | None = None) -> DataFrame:
    """The dataset-construction job on the base table (spaced names): ages
    (negatives kept), monthly mortgage rate (NULL when the month has no
    week), deterministic days on market and distance to the centre.  All
    projections plus one broadcast join of the monthly series."""
    series = monthly_series(weekly_rates, week_col, rate_col, "Mortgage Rate")
    out = sales
    if {sold_year, built} <= set(sales.columns):
        out = out.withColumn("Age At Sale", F.col(sold_year) - F.col(built))
    if {sold_year, remod} <= set(sales.columns):
        out = out.withColumn("Years Since Remodel", F.col(sold_year) - F.col(remod))
    out = attach_monthly(out, series, sold_year, sold_month, "Mortgage Rate")
    out = out.withColumn("Days on Market", dom_score(quality, area).cast("int"))
    return out.withColumn("Distance to Center", distance_to_center(lookup(neighborhood, distances), distance_offset))


def multi_value_months(df: DataFrame, value: str, year: str, month: str) -> DataFrame:
    """(year, month) pairs whose non-null value takes more than one distinct value."""
    from hearth.operators.profile import distinct_per_group

    return distinct_per_group(df, value, [year, month])


__all__: Sequence[str] = [
    "monthly_series", "attach_monthly", "fill_from_month_median", "lookup", "unmapped_keys",
    "dom_score", "distance_to_center", "derive_ages", "enrich_sales", "multi_value_months",
]
