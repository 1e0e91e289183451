"""Shared-folder tables, bounded bitmaps and count tables, and components."""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator  # noqa: UP035  (what applyInArrow looks for)

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.shared import saved, scratch, shared_path  # noqa: F401  (operators take them from here)

#: Bits of a membership bitmap (1 MB) and cells of a count table (4 MB).
BITMAP_BITS = 1 << 23
COUNT_CELLS = 1 << 20
#: Bits of the largest bitmap (16 MB).
MAX_BITMAP_BITS = 1 << 27
_COUNT_PARTS = 64


def bit_of(col: str, bits: int = BITMAP_BITS) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(bits))


def bits_for(keys: int) -> int:
    """Bits of a bitmap of which ``keys`` keys set one in eight, 16 MB at most;
    beyond, it lets more rows pass and loses none."""
    return min(MAX_BITMAP_BITS, max(BITMAP_BITS, 1 << (8 * keys - 1).bit_length()))


def bitmap(keys: DataFrame, bit: Column, bits: int = BITMAP_BITS) -> bytes:
    """The set bits of ``keys``, ``bit`` being a number from 0 below ``bits``;
    built by Spark, ``bits / 8`` bytes reach the driver whatever the number of
    keys."""
    h = bit + 1
    parts = (
        keys.select(F.bitmap_bucket_number(h).alias("b"), F.bitmap_bit_position(h).alias("p"))
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    )
    out = bytearray(bits // 8)
    for r in parts:
        at = (r.b - 1) * 4096
        out[at : at + len(r.m)] = r.m
    return bytes(out)


def maybe_in(df: DataFrame, bits: bytes, col: str) -> tuple[DataFrame, DataFrame]:
    """``df`` split into rows whose key may be in the set of a bitmap made by
    ``bit_of``, and rows whose key surely is not.  The bitmap is a broadcast of bounded size."""
    shared = df.sparkSession.sparkContext.broadcast(np.frombuffer(bits, np.uint8))
    marked = df.withColumn("__bit", bit_of(col, 8 * len(bits)))

    def pick(wanted: bool) -> Callable:
        def run(batches):
            cells = shared.value
            for b in batches:
                p = b.column("__bit").to_numpy(zero_copy_only=False)
                hit = ((cells[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool)
                yield b.filter(pa.array(hit == wanted))

        return run

    return tuple(marked.mapInArrow(pick(x), marked.schema).drop("__bit") for x in (True, False))


def count_table(df: DataFrame, tokens: Callable, cells: int = COUNT_CELLS) -> np.ndarray:
    """How often the tokens of all rows fall into each of ``cells`` hash cells,
    an upper bound of each token's count.  ``tokens(batch)`` yields arrays of
    64-bit hashes.  Each task adds up its own cells; sums meet in Spark, and
    ``4 * cells`` bytes reach the driver at any input size."""
    width = cells // _COUNT_PARTS

    def run(batches):
        total, waiting, size = np.zeros(cells, np.int64), [], 0
        for batch in batches:
            for t in tokens(batch):
                waiting.append((t & np.uint64(cells - 1)).astype(np.int32))
                size += len(t)
                if size >= cells:  # a pass over all cells for as many tokens
                    total += np.bincount(np.concatenate(waiting), minlength=cells)
                    waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=cells)
        total = np.minimum(total, 0x7FFFFFFF).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_COUNT_PARTS), pa.int32()), pa.array([total[i * width : (i + 1) * width].tobytes() for i in range(_COUNT_PARTS)])],
            names=["part", "cells"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(width, np.int64), None
        for b in batches:
            for p, c in zip(b.column("part").to_pylist(), b.column("cells").to_pylist(), strict=True):
                part = p
                total += np.frombuffer(c, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.minimum(total, 0x7FFFFFFF).astype(np.int32).tobytes()])], names=["part", "cells"]
        )

    schema = "part int, cells binary"
    rows = df.mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros(cells, np.int32)
    for r in rows:
        out[r.part * width : (r.part + 1) * width] = np.frombuffer(r.cells, np.int32)
    return out


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table: (id, comp), comp the
    smallest id reachable, one row per id that has a link.

    Rounds of label exchange with pointer jumping: every id takes the smallest
    label among its neighbours' and its own, then its label's label.  A hub's
    rows meet in partial minima, never in one list.  Each round is written to
    the shared folder."""
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = saved(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = saved(edges.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("c")), "labels")
    for _ in range(max_rounds):
        near = edges.join(labels.select(F.col("x").alias("y"), F.col("c")), "y").groupBy("x").agg(F.min("c").alias("m"))
        step = labels.join(near, "x").select("x", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        jump = step.select(F.col("x").alias("c"), F.col("c").alias("cc"))
        new = saved(step.join(jump, "c", "left").select("x", "old", F.least("c", F.coalesce("cc", "c")).alias("c")), "labels")
        moved = new.where(F.col("c") != F.col("old")).limit(1).count()
        labels = new.drop("old")
        if not moved:
            return labels.select(F.col("x").alias("id"), F.col("c").alias("comp"))
    raise RuntimeError(f"components: labels still move after {max_rounds} rounds")


def quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]
