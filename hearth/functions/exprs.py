"""Reusable column expressions. All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.constants import ABSENT, NULL_TOKENS


def col_or_lit(c) -> Column:
    """Column name -> column; Column -> itself; plain value -> literal."""
    if isinstance(c, str):
        return F.col(c)
    return c if isinstance(c, Column) else F.lit(c)


# fixed values: the ASCII whitespace set stripped from text cells
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_whitespace(c: str | Column) -> Column:
    """Strip leading/trailing whitespace (tab, newline, ... not only spaces,
    unlike ``trim``); ``btrim`` with an explicit set stays in codegen."""
    return F.btrim(col_or_lit(c), F.lit(WHITESPACE))


def blank_to_null(c: str | Column, tokens: Iterable[str] = ("",)) -> Column:
    """Trimmed text, with the given tokens turned into NULL."""
    t = strip_whitespace(c)
    return F.when(t.isin(list(tokens)), F.lit(None).cast("string")).otherwise(t)


def null_tokens_to_null(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Reader-side null normalisation: ``""``, ``NA``, ``None`` -> NULL."""
    return blank_to_null(c, tokens)


def flag(predicate: Column) -> Column:
    """Boolean -> 0/1 int, NULL predicate counted as 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def clip_below_zero(c: str | Column) -> Column:
    """``clip(lower=0)`` that keeps NULL as NULL (``greatest`` would not)."""
    x = col_or_lit(c)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def scale_map(scale: Mapping[str, float]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in scale.items()))


def ordinal(c: str | Column, scale: Mapping[str, float], missing: str | None = ABSENT,
            unknown: float = 0.0) -> Column:
    """Map text codes to ranks; NULL -> ``missing`` code first; unknown -> ``unknown``."""
    x = col_or_lit(c)
    if missing is not None:
        x = F.coalesce(x, F.lit(missing))
    return F.coalesce(F.element_at(scale_map(scale), x), F.lit(float(unknown)))


def right_closed_bucket(c: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None,
                        include_lowest: bool = False) -> Column:
    """``pd.cut`` semantics: bins ``(e[i], e[i+1]]``; values outside -> NULL.

    With ``include_lowest`` the first bin also takes ``e[0]``.
    """
    x = col_or_lit(c)
    if labels is None:
        labels = [f"({edges[i]}, {edges[i + 1]}]" for i in range(len(edges) - 1)]
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (x >= F.lit(lo)) if (include_lowest and i == 0) else (x > F.lit(lo))
        cond = lower_ok & (x <= F.lit(hi)) if hi != float("inf") else lower_ok
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def bucket_index(c: str | Column, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """0-based index of the right-closed bin, NULL outside."""
    x = col_or_lit(c)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (x >= F.lit(lo)) if (include_lowest and i == 0) else (x > F.lit(lo))
        cond = lower_ok & (x <= F.lit(hi)) if hi != float("inf") else lower_ok
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


# ---- statistics as aggregate expressions -----------------------------------

def sample_skewness(c: str | Column) -> Column:
    """Bias-adjusted skewness G1 (pandas ``skew``): g1 * sqrt(n(n-1)) / (n-2)."""
    x = col_or_lit(c)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_excess_kurtosis(c: str | Column) -> Column:
    """Bias-adjusted excess kurtosis G2 (pandas ``kurt``)."""
    x = col_or_lit(c)
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def pair_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson r over complete pairs; NULL (not an error) when a side is constant."""
    xc, yc = col_or_lit(x), col_or_lit(y)
    xm = F.when(yc.isNotNull(), xc)
    ym = F.when(xc.isNotNull(), yc)
    return F.try_divide(F.covar_samp(xm, ym), F.stddev_samp(xm) * F.stddev_samp(ym))


def any_null(columns: Sequence[str]) -> Column:
    """TRUE when any of the columns is NULL."""
    cond = F.col(columns[0]).isNull()
    for c in columns[1:]:
        cond = cond | F.col(c).isNull()
    return cond


def round_sig(c: str | Column, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits with exact power-of-ten scaling.

    Exact values with short decimal expansions (means of cent amounts) then
    never sit on a rounding boundary, unlike a fixed number of decimals.
    """
    x = col_or_lit(c)
    e = F.floor(F.log10(F.abs(x)))
    up = F.lit(digits - 1) - e  # scale >= 0: multiply; < 0: divide
    scaled_up = F.round(x * F.pow(F.lit(10.0), up)) / F.pow(F.lit(10.0), up)
    scaled_dn = F.round(x / F.pow(F.lit(10.0), -up)) * F.pow(F.lit(10.0), -up)
    return F.when((x == 0) | x.isNull() | F.isnan(x), x).when(up >= 0, scaled_up).otherwise(scaled_dn)


def merge_single_rows(frames):
    """Put several ONE-row DataFrames side by side without a join: union them
    as tagged structs, then one global aggregation picks each struct back."""
    from functools import reduce

    packed = []
    for i, f in enumerate(frames):
        cols = [F.lit(None).cast(_struct_type(frames[j])).alias(f"_s{j}") if j != i
                else F.struct(*[F.col(c) for c in f.columns]).alias(f"_s{j}") for j in range(len(frames))]
        packed.append(f.select(*cols))
    u = reduce(lambda a, b: a.unionByName(b), packed)
    return u.agg(*[F.first(f"_s{j}", ignorenulls=True).alias(f"_s{j}") for j in range(len(frames))]).select(
        *[F.col(f"_s{j}.{c}").alias(c) for j, f in enumerate(frames) for c in f.columns])


def _struct_type(df):
    from pyspark.sql.types import StructType

    return StructType(list(df.schema.fields))


# fixed values: Wichura's rational approximations of the normal quantile (AS 241),
# numerator and denominator by range, highest power first
NORMAL_QUANTILE = {
    "centre": (
        (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
         13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
        (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
         5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0)),
    "near": (
        (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
         3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
        (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
         0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0)),
    "far": (
        (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
         0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
        (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
         0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0)),
}


def _horner(coefficients, x: str) -> str:
    out = f"{coefficients[0]:.17e}"  # with an exponent a literal is a double in both
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c:.17e})"
    return out


def normal_quantile_sql(p: str) -> str:
    """The standard normal quantile of ``p`` (an SQL expression, between 0 and
    1) as arithmetic that Spark and DuckDB evaluate alike."""
    ratio = lambda part, x: f"{_horner(NORMAL_QUANTILE[part][0], x)} / {_horner(NORMAL_QUANTILE[part][1], x)}"
    q, tail = f"(({p}) - 0.5e0)", f"sqrt(-ln(least(({p}), 1e0 - ({p}))))"
    return (
        f"CASE WHEN abs{q} <= 0.425e0 THEN {q} * {ratio('centre', f'(0.180625e0 - {q} * {q})')} "
        f"ELSE sign{q} * CASE WHEN {tail} <= 5e0 THEN {ratio('near', f'({tail} - 1.6e0)')} "
        f"ELSE {ratio('far', f'({tail} - 5e0)')} END END"
    )
