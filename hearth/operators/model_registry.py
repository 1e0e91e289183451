"""Model registry (S10, M18): versions that are there whole or not at all.

A version is a folder ``<root>/<version>`` with a bundle, tables and
``manifest.json``, which names every file and its length.  Everything is written
below ``<root>/_staging-<id>``; the manifest is written last, and one rename of
the folder makes the version visible.  A driver or executor that is lost before
leaves a staging folder, which no reader looks at and ``sweep`` removes; the
rerun writes another.  (The file system's rename must be atomic, as HDFS's and a
local disk's are.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STAGING = "_staging-"
MANIFEST = "manifest.json"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """{relative path: bytes} of what lies below, checksum files left out."""
    fs, p = _fs(spark, path)
    base, found = fs.makeQualified(p).toString().rstrip("/") + "/", {}
    it = fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        name = f.getPath().toString()
        if not f.getPath().getName().startswith("."):
            found[name.removeprefix(base)] = f.getLen()
    return found


def publish(spark: SparkSession, root: str, version: str, save: Sequence[Callable[[str], None]] = (),
            tables: Mapping[str, DataFrame] | None = None, facts: Mapping | None = None) -> str:
    """Writes a version and returns its folder.  ``save``: functions that write
    below the folder they are given (a bundle's ``save``); ``tables`` are written
    as Parquet; ``facts`` go into the manifest.  A version that exists is never
    changed: publishing it again is an error."""
    if not version or version.startswith(("_", ".")) or "/" in version:
        raise ValueError(f"not a version name: {version!r}")
    root = root.rstrip("/")
    fs, final = _fs(spark, f"{root}/{version}")
    if fs.exists(final):
        raise FileExistsError(f"{root}/{version}")
    staging = f"{root}/{STAGING}{uuid.uuid4().hex}"
    for write in save:
        write(staging)
    for name, df in (tables or {}).items():
        df.write.parquet(f"{staging}/{name}")
    if not save and not tables:
        fs.mkdirs(_fs(spark, staging)[1])
    manifest = {"version": version, "facts": dict(facts or {}), "tables": sorted(tables or {}), "files": _files(spark, staging)}
    _write_text(spark, f"{staging}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
    # rename moves into a folder that exists: two publishers of one version must not nest
    if fs.exists(final) or not fs.rename(_fs(spark, staging)[1], final):
        fs.delete(_fs(spark, staging)[1], True)
        raise FileExistsError(f"{root}/{version}")
    return f"{root}/{version}"


def read_manifest(spark: SparkSession, root: str, version: str) -> dict:
    """The manifest, checked against the files: a missing or cut file is an error."""
    folder = f"{root.rstrip('/')}/{version}"
    fs, p = _fs(spark, f"{folder}/{MANIFEST}")
    if not fs.exists(p):
        raise FileNotFoundError(f"{folder}/{MANIFEST}")
    doc = json.loads(spark.read.text(f"{folder}/{MANIFEST}").first()[0])
    there = _files(spark, folder)
    wrong = sorted(f for f, size in doc["files"].items() if there.get(f) != size)
    if wrong:
        raise ValueError(f"{folder}: {len(wrong)} files differ from the manifest, first {wrong[0]}")
    return doc


def versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions by name; folders without manifest are none."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")) and fs.exists(_fs(spark, f"{root.rstrip('/')}/{n}/{MANIFEST}")[1]))


def sweep(spark: SparkSession, root: str) -> int:
    """Removes staging folders (of writers that are gone: the caller knows that
    none is at work); how many."""
    fs, p = _fs(spark, root)
    old = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith(STAGING)] if fs.exists(p) else []
    for path in old:
        fs.delete(path, True)
    return len(old)


# ---- metric tables and what scoring takes from them ------------------------------

def union_metrics(tables: Sequence[DataFrame], order: Sequence[str] = ("valid_rmse", "cv_rmse_mean")) -> DataFrame:
    """Metric tables with different columns as one (a column that a table
    lacks is NULL), with ``rank`` from 1 by ``order``, NULLs last, then model."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    by = [F.asc_nulls_last(c) for c in order if c in both.columns] + [F.col("model")]
    return both.withColumn("rank", F.row_number().over(Window.orderBy(*by)))  # a row per model


def chosen_metrics(metrics: DataFrame, preferred: str) -> DataFrame:
    """The row of the preferred model, or, if there is none, the first by
    rank; ``is_fallback`` tells which."""
    first = metrics.withColumn("is_fallback", F.coalesce(F.col("model") != preferred, F.lit(True)))
    return first.orderBy("is_fallback", "rank").limit(1)


def aligned_batch(batch: DataFrame, columns: Sequence[str], defaults: Mapping, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``batch`` with the training columns, and the names of those that it
    lacked and that now hold their default."""
    from hearth import constants as K

    lacking = [c for c in columns if c not in batch.columns and c not in keep]
    have = [F.lit(defaults.get(c, K.ABSENT)).alias(c) if c in lacking else F.col(f"`{c}`") for c in columns if c not in keep]
    return batch.select(*[F.col(f"`{c}`") for c in keep], *have), lacking


def defaulted_report(spark: SparkSession, lacking: Sequence[str], defaults: Mapping) -> DataFrame:
    """One row per defaulted column, its default as a number or as text."""
    rows = [(c, float(defaults[c]), None) if isinstance(defaults.get(c), (int, float)) else (c, None, defaults.get(c)) for c in lacking]
    return spark.createDataFrame(rows, "feature string, number double, text string")
