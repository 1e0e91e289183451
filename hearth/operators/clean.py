"""Cleaning: text tidy-up, group/global median fills, structural-absence fills,
mode/median imputation, cross-column domain rules, leverage-outlier split,
enrichment validation and the audit report (S5, X13, X15, X19-X23, X25, X26,
J4, J5, F1, F3-F5, V3, V4, A3).

Fitting computes a handful of statistics (partial aggregations; per-column
results are one value per column, group medians stay a DataFrame) and
transforming is one narrow projection plus small lookup joins, identical for
train, test and scoring batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from hearth import constants as K
from hearth.functions.exprs import any_null, blank_to_null, merge_single_rows
from hearth.operators.dedup import keep_first
from hearth.operators.quantiles import exact_median, mode_of
from hearth.session import ensure_checkpoint_dir
from hearth.shared import saved

# ---- building blocks ------------------------------------------------------

def tidy_text(df: DataFrame, tokens: Sequence[str] = ("",)) -> DataFrame:
    """Strip whitespace from every string column; listed tokens become NULL."""
    exprs = [
        blank_to_null(f.name, tokens).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*exprs)


def fit_group_median(source: DataFrame, value: str, by: Sequence[str]) -> tuple[DataFrame, float | None]:
    """Per-group exact medians (a checkpointed DataFrame, one row per group) and
    the global median, from ONE quantile computation: every row is listed once
    under its group and once under the global level."""

    lvl = F.explode(F.array(
        F.struct(F.lit(0).alias("_lvl"), *[F.col(k).alias(k) for k in by]),
        F.struct(F.lit(1).alias("_lvl"), *[F.lit(None).cast(source.schema[k].dataType).alias(k) for k in by]),
    )).alias("_t")
    tagged = source.where(~any_null(by)).select(F.col(value).alias("_x"), lvl).select("_x", "_t.*") \
        if by else source.select(F.col(value).alias("_x"), F.lit(1).alias("_lvl"))
    both = exact_median(tagged, "_x", by=["_lvl", *by], name=f"_{value}_group_median")
    ensure_checkpoint_dir(source.sparkSession)
    both = both.checkpoint()  # read for the global median and again for the fill
    glob = both.where(F.col("_lvl") == 1).collect()  # one row
    medians = both.where(F.col("_lvl") == 0).drop("_lvl")
    return medians, (glob[0][f"_{value}_group_median"] if glob else None)


def apply_group_median(df: DataFrame, value: str, by: Sequence[str], medians: DataFrame,
                       global_median: float | None, flag: str | None = None) -> DataFrame:
    """``coalesce(value, group median, global median)``; original column order kept.

    ``medians`` has one row per group; Spark (AQE) broadcasts it when it is
    small at run time and shuffles otherwise.
    """
    gm = f"_{value}_group_median"
    joined = df.join(medians, list(by), "left")
    filled = F.coalesce(F.col(value), F.col(gm), F.lit(global_median))
    if global_median is not None:
        filled = filled.cast(df.schema[value].dataType)
    out = [filled.alias(value) if c == value else F.col(c) for c in df.columns]
    if flag:
        out.append(F.col(value).isNull().cast("int").alias(flag))
    return joined.select(*out)


def leverage_flag(area: str, price: str, max_area: float = 4000.0, min_price: float = 300000.0) -> Column:
    """TRUE for ``area > max_area AND price < min_price``; a NULL rule is FALSE."""
    return F.coalesce((F.col(area) > max_area) & (F.col(price) < min_price), F.lit(False))


def leverage_split(df: DataFrame, area: str, price: str, max_area: float = 4000.0,
                   min_price: float = 300000.0) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) for the leverage rule.

    A row whose rule evaluates to NULL is KEPT (pandas ``~mask`` semantics).
    """
    rule = leverage_flag(area, price, max_area, min_price)
    return df.where(~rule), df.where(rule)


def absence_fill(df: DataFrame, text_cols: Sequence[str], numeric_cols: Sequence[str]) -> DataFrame:
    """Structural absence: text -> ``NoFeature``, numbers -> 0 (only present columns)."""
    fills: dict[str, Any] = {c: K.ABSENT for c in text_cols if c in df.columns}
    fills.update({c: 0 for c in numeric_cols if c in df.columns})
    return df.fillna(fills) if fills else df


def domain_rules(df: DataFrame) -> DataFrame:
    """Cross-column consistency (raw CamelCase names) as one projection: every
    column that a rule of ``FEATURE_ABSENCE`` or ``CORRECTIONS`` decides becomes
    the first of its rules' values whose test holds on the input row.  A rule
    whose columns are not all there is left out."""
    types = {f.name: f.dataType for f in df.schema.fields}
    absent, zero = f"'{K.ABSENT}'", "0"
    decided = [(test, reads, c, v) for test, reads, text, numbers in K.FEATURE_ABSENCE for cols, v in ((text, absent), (numbers, zero)) for c in cols]
    branches: dict[str, list[str]] = {}
    for test, reads, target, value in [*decided, *K.CORRECTIONS]:
        if {*reads, target} <= types.keys():
            branches.setdefault(target, []).append(f"WHEN {test} THEN {value}")

    def ruled(name: str) -> Column:
        if name in branches:
            kind = types[name].simpleString()
            cases = " ".join(b.rsplit(" THEN ", 1)[0] + f" THEN CAST({b.rsplit(' THEN ', 1)[1]} AS {kind})" for b in branches[name])
            return F.expr(f"CASE {cases} ELSE `{name}` END").alias(name)
        return F.col(f"`{name}`").cast("string").alias(name) if name in K.TEXT_CODES else F.col(f"`{name}`")

    return df.select(*[ruled(c) for c in df.columns])


def augmented_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Derive AgeAtSale / YearsSinceRemodel when absent (a supplied column wins)."""
    notes: dict[str, str] = {}
    out = df
    if "AgeAtSale" not in df.columns and {"YrSold", "YearBuilt"} <= set(df.columns):
        out = out.withColumn("AgeAtSale", F.col("YrSold") - F.col("YearBuilt"))
        notes["AgeAtSale"] = "derived_from_YrSold_minus_YearBuilt"
    if "YearsSinceRemodel" not in df.columns and {"YrSold", "YearRemodAdd"} <= set(df.columns):
        out = out.withColumn("YearsSinceRemodel", F.col("YrSold") - F.col("YearRemodAdd"))
        notes["YearsSinceRemodel"] = "derived_from_YrSold_minus_YearRemodAdd"
    return out, notes


def enrichment_checks(df: DataFrame) -> DataFrame:
    """V3: one row of counters.  Rows are counted per month first, where a month
    with several rates shows as different extremes, and the months are added up:
    one pass, no table of distinct rates."""
    have = set(df.columns)
    counts = [(key, test) for key, reads, test in K.ENRICHMENT_COUNTS if have.issuperset(reads)]
    several, month, value = K.ENRICHMENT_MONTHS
    with_months = have.issuperset([*month, value])
    keys = [k for k, _ in counts] + ([several] if with_months else [])
    if not keys:
        return df.sparkSession.range(1).select()
    per = [F.count_if(F.expr(test)).alias(key) for key, test in counts]
    if with_months:
        dated = " AND ".join(f"max({m}) IS NOT NULL" for m in month)
        per.append(F.expr(f"CAST(min({value}) <> max({value}) AND {dated} AS BIGINT)").alias(several))
    months = df.groupBy(*(month if with_months else [])).agg(*per)
    return months.agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in keys])


# ---- the fitted cleaner ---------------------------------------------------

@dataclass
class CleaningModel:
    """Statistics learned from train (and train + test for frontage)."""

    frontage_medians: DataFrame | None
    frontage_global: float | None
    mode_fills: dict[str, Any]
    numeric_fills: dict[str, float]
    month_rates: DataFrame | None = None
    global_rate: float | None = None
    context_fills: dict[str, float] = field(default_factory=dict)
    notes: dict[str, Any] = field(default_factory=dict)


def fit_cleaning(train: DataFrame, test: DataFrame, target: str = "SalePrice", key: str = "Id",
                 group: str = "Neighborhood", frontage: str = "LotFrontage") -> CleaningModel:
    """Learn every statistic the cleaner needs.

    Order follows the reference: frontage medians over train UNION test (feature
    values only); absence fills come before mode fills, so the mode/median
    statistics are fitted on absence-filled frames.
    """
    notes: dict[str, Any] = {}
    train_a, n1 = augmented_columns(train)
    test_a, n2 = augmented_columns(test)
    notes.update({f"train.{k}": v for k, v in n1.items()})
    notes.update({f"test.{k}": v for k, v in n2.items()})

    med, glob = None, None
    if {group, frontage} <= set(train_a.columns) | set(test_a.columns) and frontage in train_a.columns:
        feats = [c for c in (group, frontage) if c in train_a.columns]
        both = train_a.select(*feats).unionByName(test_a.select(*[c for c in feats if c in test_a.columns]), allowMissingColumns=True)
        med, glob = fit_group_median(both, frontage, [group])

    # month-rate fill for a test frame lacking rates
    month_rates, global_rate = None, None
    if "MortgageRate" in train_a.columns and {"YrSold", "MoSold"} <= set(train_a.columns):
        src = train_a.where(F.col("MortgageRate").isNotNull())
        month_rates = exact_median(src, "MortgageRate", by=["YrSold", "MoSold"], name="_month_rate")
        r = exact_median(src, "MortgageRate", name="m").collect()
        global_rate = r[0]["m"] if r else None

    context_fills: dict[str, float] = {}
    for c in ["DaysOnMarket", "DistanceToCenter"]:
        if c in train_a.columns and c not in test_a.columns:
            r = exact_median(train_a, c, name="m").collect()
            context_fills[c] = r[0]["m"] if r else None
            notes[f"test.{c}"] = "test_v2_missing; filled_with_train_median_for_schema_alignment"
            notes[f"test.{c}.fill_value"] = context_fills[c]

    tr = absence_fill(train_a, K.ABSENT_TEXT_COLUMNS_RAW, K.ZERO_NUMERIC_COLUMNS_RAW)
    te = absence_fill(test_a, K.ABSENT_TEXT_COLUMNS_RAW, K.ZERO_NUMERIC_COLUMNS_RAW)

    mode_cols = [c for c in K.MODE_TEXT_COLUMNS_RAW if c in tr.columns]
    mode_fills: dict[str, Any] = {}
    if mode_cols:
        tr_modes = _column_modes(tr, mode_cols)
        te_modes = _column_modes(te, [c for c in mode_cols if c in te.columns])
        for c in mode_cols:
            mode_fills[c] = "Typ" if c == "Functional" else (tr_modes.get(c) if tr_modes.get(c) is not None else te_modes.get(c))

    num_cols = [f.name for f in tr.schema.fields if isinstance(f.dataType, NumericType) and f.name not in {key, target}]
    numeric_fills: dict[str, float] = {}
    if num_cols:
        null_any = _null_flags(tr, num_cols)
        null_any_te = _null_flags(te, [c for c in num_cols if c in te.columns])
        needs = [c for c in num_cols if null_any.get(c) or null_any_te.get(c)]
        if needs:
            meds = _column_medians(tr, needs)
            numeric_fills = {c: meds.get(c) for c in needs}
    return CleaningModel(med, glob, mode_fills, numeric_fills, month_rates, global_rate, context_fills, notes)


def _column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, Any]:
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_p")).select("_p.*")
    return {r["column"]: r["mode"] for r in mode_of(long, "value", by=["column"]).collect()}  # one row per column


def _column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    from hearth.operators.profile import quantiles_by_column

    return {r["column"]: r["m"] for r in quantiles_by_column(df, cols, [0.5], ["m"]).collect()}  # one row per column


def _null_flags(df: DataFrame, cols: Sequence[str]) -> dict[str, bool]:
    if not cols:
        return {}
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"_{i}") for i, c in enumerate(cols)]).collect()[0]
    return {c: bool(row[f"_{i}"]) for i, c in enumerate(cols)}


def transform_cleaning(model: CleaningModel, df: DataFrame, is_test: bool = False,
                       group: str = "Neighborhood", frontage: str = "LotFrontage") -> DataFrame:
    out, _ = augmented_columns(df)
    if is_test and model.month_rates is not None:
        if "MortgageRate" not in out.columns:
            out = out.withColumn("MortgageRate", F.lit(None).cast("double"))
        cols = out.columns
        out = out.join(model.month_rates, ["YrSold", "MoSold"], "left").select(
            *[F.coalesce(F.col("MortgageRate"), F.col("_month_rate"), F.lit(model.global_rate)).alias(c)
              if c == "MortgageRate" else F.col(c) for c in cols]
        )
    if is_test:
        for c, v in model.context_fills.items():
            out = out.withColumn(c, F.lit(v).cast("double"))
    if model.frontage_medians is not None and frontage in out.columns:
        out = apply_group_median(out, frontage, [group], model.frontage_medians, model.frontage_global)
    out = absence_fill(out, K.ABSENT_TEXT_COLUMNS_RAW, K.ZERO_NUMERIC_COLUMNS_RAW)
    fills = {c: v for c, v in model.mode_fills.items() if c in out.columns and v is not None}
    fills.update({c: v for c, v in model.numeric_fills.items() if c in out.columns and v is not None})
    if fills:
        out = out.fillna(fills)
    return domain_rules(out)


@dataclass
class CleaningResult:
    train: DataFrame
    test: DataFrame
    removed: DataFrame
    model: CleaningModel


def clean(train_raw: DataFrame, test_raw: DataFrame, key: str = "Id", target: str = "SalePrice",
          order: Sequence[str] | None = None, checkpoint: bool = True) -> CleaningResult:
    """The whole cleaning job: tidy -> dedupe -> fit -> transform -> outliers.

    Fitting makes several passes (medians, modes, null flags); with
    ``checkpoint`` the deduplicated frames are written once to the shared
    checkpoint folder, as columns, so those passes reread them instead of recomputing the
    upstream joins and the dedup shuffle.
    """
    tr = tidy_text(train_raw)
    te = tidy_text(test_raw)
    tr = keep_first(tr, [key], order or [key])
    te = keep_first(te, [key], order or [key])
    if checkpoint:
        tr, te = saved(tr, "train"), saved(te, "test")
    model = fit_cleaning(tr, te, target=target, key=key)
    ctr = transform_cleaning(model, tr)
    cte = transform_cleaning(model, te, is_test=True)
    kept, removed = (ctr, ctr.limit(0))
    if {"GrLivArea", target} <= set(ctr.columns):
        kept, removed = leverage_split(ctr, "GrLivArea", target)
    return CleaningResult(kept, cte, removed, model)


def frame_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(frame, column, n)``: rows of each frame (column null) and its NULLs
    per column, from one aggregate a frame, all in one job."""
    parts = []
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
        cells = [F.struct(F.lit(None).cast("string").alias("column"), F.col("n").alias("n"))]
        cells += [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n")) for i, c in enumerate(df.columns)]
        parts.append(one.select(F.lit(name).alias("frame"), F.explode(F.array(*cells)).alias("_r")).select("frame", "_r.*"))
    return reduce(DataFrame.unionByName, parts)


def key_counts(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Per key how often each frame has it (columns named like the frames), from
    one shuffle; counts are combined map-side, so a repeated key is one row a task."""
    tagged = [df.select(F.col(key).cast("string").alias("_key"), F.lit(name).alias("_frame")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("_key").agg(*[F.count_if(F.col("_frame") == name).alias(name) for name in frames])


def repeats(name: str) -> Column:
    """Rows beyond the first of each key, over ``key_counts``."""
    return F.coalesce(F.sum(F.greatest(F.col(name) - 1, F.lit(0))), F.lit(0))


def cleaning_report(raw_train: DataFrame, raw_test: DataFrame, result: CleaningResult, key: str = "Id",
                    input_files: dict[str, str] | None = None) -> dict[str, Any]:
    """The audit report (A3) as a nested dict from three jobs: rows and NULLs of
    all frames, repeated ids, enrichment checks.

    Duplicates are counted BEFORE dedup (the reference counted after, always 0).
    """
    frames = {"raw_train": raw_train, "raw_test": raw_test, "train": result.train, "test": result.test, "removed": result.removed}
    counts = {(r["frame"], r["column"]): int(r["n"]) for r in frame_counts(frames).collect()}  # a row per column
    repeated = key_counts({"train": raw_train, "test": raw_test}, key).agg(*[repeats(n).alias(n) for n in ("train", "test")]).first()
    checks = enrichment_checks(result.train).withColumn("_frame", F.lit("train")).unionByName(
        enrichment_checks(result.test).withColumn("_frame", F.lit("test")), allowMissingColumns=True).collect()  # two rows
    checks = {r["_frame"]: {k: v for k, v in r.asDict().items() if k != "_frame" and v is not None} for r in checks}

    def shape(name: str) -> list[int]:
        return [counts[name, None], len(frames[name].columns)]

    def missing(name: str) -> dict[str, int]:
        found = {c: n for (f, c), n in counts.items() if f == name and c is not None and n > 0}
        return dict(sorted(found.items(), key=lambda x: (-x[1], x[0])))

    return {
        "raw_shape": {"train": shape("raw_train"), "test": shape("raw_test")},
        "clean_shape": {"train": shape("train"), "test": shape("test")},
        "input_files": input_files or {},
        "augmented_features": {
            "available_columns": [c for c in K.AUGMENTED_COLUMNS_RAW if c in result.train.columns or c in result.test.columns],
            "handling": result.model.notes,
            "validation": {
                "train": checks.get("train", {}),
                "test": checks.get("test", {}),
            },
        },
        "missing_before": {"train": missing("raw_train"), "test": missing("raw_test")},
        "missing_after": {"train": missing("train"), "test": missing("test")},
        "duplicate_ids_before": {"train": repeated["train"], "test": repeated["test"]},
        "removed_training_outliers": {
            "rule": K.LEVERAGE_RULE_TEXT,
            "count": counts["removed", None],
            "ids": "the removed-rows table",
        },
        "imputations": {**result.model.mode_fills, **result.model.numeric_fills},
    }


def post_clean_checks(train: DataFrame, test: DataFrame, removed: DataFrame, raw_test: DataFrame,
                      key: str = "Id") -> DataFrame:
    """V4 checklist as a small ``(check, ok, n)`` DataFrame: one aggregate a
    frame and one shuffle of the ids of all four, nothing collected."""
    nulls = frame_counts({"train": train, "test": test}).where(F.col("column").isNotNull()).groupBy("frame").agg(F.sum("n").alias("n"))
    nulls = nulls.select(F.concat("frame", F.lit("_has_no_nulls")).alias("check"), "n")
    ids = key_counts({"train": train, "test": test, "removed": removed, "raw": raw_test}, key)
    cells = {
        "train_ids_unique": repeats("train"),
        "test_ids_unique": repeats("test"),
        "removed_outliers_absent": F.coalesce(F.sum(F.when(F.col("removed") > 0, F.col("train"))), F.lit(0)),
        "test_ids_unchanged": F.coalesce(F.sum(F.abs(F.col("test") - F.least(F.col("raw"), F.lit(1)))), F.lit(0)),
    }
    one = ids.agg(*[c.alias(n) for n, c in cells.items()])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in cells])).alias("_r")).select("_r.*")
    return nulls.unionByName(rows).select("check", (F.col("n") == 0).alias("ok"), F.col("n").cast("long").alias("n"))
