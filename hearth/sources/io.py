"""CSV / JSON edges: house-data readers with explicit schemas and null-token
normalisation, and the sinks (tables, JSON reports, feature lists,
submissions, artifact manifests) - S1-S8, S10-S12.

Everything is read with an explicit schema (no inference pass) and written by
Spark's writers: nothing is funnelled through the driver except the small
report documents, which are single rows by construction.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.constants import NULL_TOKENS
from hearth.functions.exprs import null_tokens_to_null
from hearth.functions.names import normalize_columns


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the file's own header (Spark's CSV reader
    has one ``nullValue`` and keeps the literal ``None``: tokens are normalised
    afterwards).  Only the header line is read to learn the names.  In a folder
    every file must have the first one's header: a file with other names or
    another order is an error when its rows are read, not a swap of columns."""
    return spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def _token_free(name: str, tokens: Sequence[str]) -> Column:
    return null_tokens_to_null(F.col(f"`{name}`").cast("string"), tokens)


def apply_schema(df: DataFrame, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """The schema's columns that ``df`` has, in the schema's order:
    ``""``/``NA``/``None`` -> NULL, then ``try_cast`` to the declared types (a
    malformed cell becomes NULL; ``rejected_cells`` lists those)."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            v = _token_free(f.name, tokens)
            out.append((v if isinstance(f.dataType, T.StringType) else v.try_cast(f.dataType)).alias(f.name))
    return df.select(*out)


def rejected_cells(text: DataFrame, schema: T.StructType, key: str, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """The reject table of a text frame: ``(key, column, value)`` of cells that
    hold something but not a value of their declared type."""
    cells = [
        F.struct(F.lit(f.name).alias("column"), _token_free(f.name, tokens).alias("value"),
                 _token_free(f.name, tokens).try_cast(f.dataType).isNull().alias("bad"))
        for f in schema.fields if f.name in text.columns and not isinstance(f.dataType, T.StringType)
    ]
    if not cells:
        return text.select(F.col(f"`{key}`").alias("key"), F.lit("").alias("column"), F.lit("").alias("value")).limit(0)
    long = text.select(F.col(f"`{key}`").alias("key"), F.explode(F.array(*cells)).alias("c"))
    return long.where("c.bad and c.value is not null").select("key", "c.column", "c.value")


def read_house_csv(spark: SparkSession, path: str, schema: T.StructType, normalise: bool = False,
                   optional: Sequence[str] = ()) -> DataFrame:
    """Columns found by header name, typed by the schema, null tokens
    normalised, names optionally in snake case.  A column of the schema that
    the file lacks is an error unless it is ``optional``; columns beyond the
    schema are left out."""
    text = read_csv_text(spark, path)
    missing = [f.name for f in schema.fields if f.name not in text.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    df = apply_schema(text, schema)
    return normalize_columns(df) if normalise else df


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the path names a file or folder, in any file system Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_train_test(spark: SparkSession, raw_dir: str, schema: T.StructType, train_file: str | None = None,
                    test_file: str | None = None, target: str = "SalePrice") -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Prefer ``*_v2.csv`` over the plain files unless paths are given; a
    missing input raises.  The test file may or may not carry the target.
    Returns the lineage (which files were read)."""

    def pick(explicit: str | None, stem: str) -> str:
        names = [explicit] if explicit else [f"{raw_dir.rstrip('/')}/{stem}{suffix}.csv" for suffix in ("_v2", "")]
        for p in names:
            if _exists(spark, p):
                return p
        raise FileNotFoundError(" or ".join(names))

    tr, te = pick(train_file, "train"), pick(test_file, "test")
    return read_house_csv(spark, tr, schema), read_house_csv(spark, te, schema, optional=[target]), {"train": tr, "test": te}


def read_weekly_rates(spark: SparkSession, path: str, week_col: str = "Week", rate_col: str = "U.S. 30 yr FRM") -> DataFrame:
    """The weekly macro series with a parsed date."""
    raw = read_csv_text(spark, path)
    return raw.select(F.to_date(F.col(f"`{week_col}`")).alias("Week"),
                      F.col(f"`{rate_col}`").try_cast("double").alias("rate"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table (parquet inside, CSV at the edges)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_report(spark: SparkSession, report: Mapping[str, Any], path: str) -> None:
    """One JSON document, written as a one-row text table."""
    spark.createDataFrame([(json.dumps(report, default=str, sort_keys=True),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def report_to_long(spark: SparkSession, report: Mapping[str, Any]) -> DataFrame:
    """A nested report flattened to ``(section, metric, value)`` rows."""
    rows: list[tuple[str, str, str]] = []

    def walk(prefix: str, node: Any) -> None:
        if isinstance(node, Mapping) and node:
            for k, v in node.items():
                walk(f"{prefix}.{k}" if prefix else str(k), v)
        else:
            section, _, metric = prefix.partition(".")
            rows.append((section, metric or section, json.dumps(node, default=str)))

    walk("", report)
    return spark.createDataFrame(rows, "section string, metric string, value string")


def feature_list_frame(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """One column ``feature`` in projection order (plus its position)."""
    return spark.createDataFrame([(c, i) for i, c in enumerate(columns)], "feature string, position int")


def submission(df: DataFrame, pred_log: str, id_col: str | None = "Id", order: Sequence[str] = ()) -> DataFrame:
    """``(Id int, SalePrice >= 0)``; without an id column, ids 1..n follow
    an explicit ordering (never the physical row order)."""
    price = F.greatest(F.expm1(F.col(pred_log)), F.lit(0.0)).alias("SalePrice")
    if id_col and id_col in df.columns:
        return df.select(F.col(id_col).cast("int").alias("Id"), price)
    if not order:
        raise ValueError("an explicit ordering is needed to generate ids")
    from hearth.operators.profile import with_global_index

    indexed = with_global_index(df.select(*order, F.col(pred_log)), list(order), "_pos")
    return indexed.select((F.col("_pos") + 1).cast("int").alias("Id"),
                          F.greatest(F.expm1(F.col(pred_log)), F.lit(0.0)).alias("SalePrice"))


def artifact_manifest(spark: SparkSession, rows: Sequence[tuple[str, bool, str, str, str]]) -> DataFrame:
    """``(model, is_best_model, pipeline_path, model_path, training_scope)``."""
    return spark.createDataFrame(list(rows), "model string, is_best_model boolean, pipeline_path string, "
                                             "model_path string, training_scope string")


def load_training_data(spark: SparkSession, path: str | None, schema: T.StructType, key: str = "Id",
                       target: str = "SalePrice", fallback_path: str | None = None,
                       deny_ids: DataFrame | None = None, context: DataFrame | None = None) -> DataFrame:
    """S3: the cleaned training table, else the raw one (with the id
    deny-list applied, F2); context columns it lacks are attached by key (J3);
    the target must be present (V1).  An explicit path that does not exist
    raises instead of silently falling through."""
    from hearth.operators.validate import attach_context, check_training_frame, drop_ids

    source = path or fallback_path
    if source is None or not _exists(spark, source):
        raise FileNotFoundError(source or "no training data path given")
    added = [c for c in context.columns if c != key] if context is not None else []
    df = read_house_csv(spark, source, schema, optional=added)
    if path is None and deny_ids is not None:
        df = drop_ids(df, key, deny_ids)
    if context is not None:
        df = attach_context(df, context, key)
    check_training_frame(df, target, key)
    return df
