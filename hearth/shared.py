"""Tables in the shared folder: columnar and compressed, so a pass over a wide
table reads only the columns it needs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hearth.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder, removed when the
    driver's file system closes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hearth-{uuid.uuid4().hex}/{name}"
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SCRATCH: list[list[str]] = []


#: Rows for which a task of its own is worth starting.
TASK_ROWS = 1 << 16


def dealt_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, a table as read, dealt out by its keys over all cores if it has the
    rows for them: a file of one row group is otherwise read, joined and written
    again by a single task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    parts = min(cores, df.count() // TASK_ROWS)
    return df.repartition(parts, *keys) if parts > df.rdd.getNumPartitions() else df


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``saved`` writes inside are deleted at the end, but for those
    written with ``keep``; what is returned from inside must rest on these."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
        for path in _SCRATCH.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def saved(df: DataFrame, name: str = "table", keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there,
    and a lost executor costs no recomputation.  The frame is run only here, so
    its shuffle files go as soon as it is written.  See ``scratch`` for when the
    table itself goes."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    outer = _SCRATCH[:-1] if keep else _SCRATCH
    if outer:
        outer[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
