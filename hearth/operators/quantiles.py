"""Exact order statistics and modes, one way for every size.

Spark's ``percentile`` is exact but its final merge keeps every distinct value
of a group in a single task's memory.  ``exact_quantiles`` ranks instead:

1. ``groupBy(group, value).count()``, combined map-side; a hot value is one row
   a task;
2. the counts are range-partitioned by (group, value) and checkpointed with
   their partition numbers, so a group with a third of the rows is spread over
   many partitions, and each (group, partition) gets a running count of its own;
3. a small table of counts per (group, partition) gives each partition its
   offset, and the values at the wanted ranks are picked and interpolated the
   way ``percentile``/``quantile_cont`` interpolate.

No task holds more than one range partition, and nothing is approximate.

``column_quantiles`` serves the quantiles of whole columns of a stored table:
nothing is exchanged but counts of cells.  A pass cuts the range that holds a
wanted rank into cells, and the next pass looks at that rank's cell alone, until
the cell has one value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import ensure_checkpoint_dir


#: Cells into which a pass cuts each range.
CELLS = 1 << 9


def _prob_name(p: float) -> str:
    return f"q{p:g}".replace(".", "_")


def ranked_counts(df: DataFrame, value: str | Column, by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """One row per group of ``by`` and distinct non-null value: ``_v``, its count
    ``_c``, the count of values up to it ``_cum`` and of all values ``_n``."""
    keys = list(by)
    vcol = F.col(value) if isinstance(value, str) else value
    base = df.select(*keys, vcol.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # partition numbers are written down once: a second exchange would draw other range bounds
    ensure_checkpoint_dir(df.sparkSession)
    spread = counted.repartitionByRange(n, *keys, "_v").withColumn("_p", F.spark_partition_id()).checkpoint()
    sizes = spread.groupBy(*keys, "_p").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0))).withColumn(
        "_n", F.sum("_s").over(Window.partitionBy(*keys))).drop("_s")
    running = Window.partitionBy(*keys, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _join_null_safe(spread.withColumn("_run", F.sum("_c").over(running)), sizes, [*keys, "_p"])
    return ranked.withColumn("_cum", F.col("_off") + F.col("_run")).drop("_p", "_off", "_run")


def bin_edges(df: DataFrame, value: str, by: Sequence[str], bins: int) -> DataFrame:
    """Per group: the largest value of each of ``bins`` bins with equal counts
    (a value lies in one bin; fewer bins where values repeat): ``bin``, ``edge``."""
    ranked = ranked_counts(df, value, by)
    cell = F.floor((F.col("_cum") - 1) * bins / F.col("_n")).cast("int")
    return ranked.groupBy(*by, cell.alias("bin")).agg(F.max("_v").alias("edge"))


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Per group of ``by``: exact linear-interpolated quantiles of ``value``.

    Returns one row per group with a non-null value; columns ``by + names``.
    NULL values are ignored (like ``percentile``).  ``partitions``: range
    partitions of the ranking, by default the session's shuffle partitions.
    """
    probs = [float(p) for p in probs]
    if not probs or any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    names = list(names) if names is not None else [_prob_name(p) for p in probs]
    keys = list(by)
    ranked = ranked_counts(df, value, keys, partitions)
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        aggs += [F.min(F.when(F.col("_cum") > F.floor(pos), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("_cum") > F.ceil(pos), F.col("_v"))).alias(f"_hi{i}")]
    picked = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *aggs)
    if not keys:
        picked = picked.where(F.col("_n").isNotNull())
    part = lambda p: F.lit(p) * (F.col("_n") - 1) - F.floor(F.lit(p) * (F.col("_n") - 1))
    return picked.select(*keys, *[
        (F.col(f"_lo{i}") + part(p) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(nm)
        for i, (p, nm) in enumerate(zip(probs, names, strict=True))])


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group keys where NULL matches NULL (a NULL key is a group)."""
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_rk_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_rk_{k}" for k in keys])


def _sortable(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the numbers, NaN last, -0.0 as 0.0."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def _number(key: int) -> float:
    key = np.int64(key)
    return float((key ^ np.int64(0x7FFFFFFFFFFFFFFF) if key < 0 else key).view(np.float64))


def _cell_counts(df: DataFrame, ranges: list, folds: Sequence, fold: str | None) -> list:
    """Rows (r, cell, lo, hi, n): least and greatest key and the rows per fold
    of each cell that has rows; ``ranges``: (column, least key, greatest key),
    keys None for the whole column, which is one cell then."""
    columns = list(dict.fromkeys(c for c, *_ in ranges))
    groups = len(folds) + 1  # the last: rows without a fold
    known = np.array(folds, np.int64)
    plan = []
    for i, (c, lo, hi) in enumerate(ranges):
        plan.append((i, columns.index(c), lo, hi, 1 if lo is None else CELLS, 0 if lo is None else max(0, (hi - lo).bit_length() - CELLS.bit_length() + 1)))

    def run(batches):
        total = {i: (np.zeros(groups * m, np.int64), np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)) for i, *_, m, _ in plan}
        for b in batches:
            if not b.num_rows:
                continue
            f = b.column("f")
            group = np.searchsorted(known, f.fill_null(0).to_numpy()) if len(known) else np.zeros(b.num_rows, np.int64)
            group = np.where(f.is_valid().to_numpy(zero_copy_only=False), group, len(known)) if f.null_count else group
            keys: dict = {}
            for i, j, lo, hi, m, shift in plan:
                if j not in keys:
                    x = b.column(f"x{j}")
                    some = np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False)) if x.null_count else slice(None)
                    keys[j] = _sortable(x.to_numpy(zero_copy_only=False)[some]), group[some]
                key, g = keys[j]
                if lo is not None:
                    at = np.flatnonzero((key >= lo) & (key <= hi))
                    key, g = key[at], g[at]
                    cell = ((key.view(np.uint64) - np.int64(lo).view(np.uint64)) >> np.uint64(shift)).astype(np.intp)
                else:
                    cell = np.zeros(len(key), np.intp)
                n, least, most = total[i]
                n += np.bincount(g * m + cell, minlength=len(n))
                if lo is None and len(key):
                    least[0], most[0] = min(least[0], key.min()), max(most[0], key.max())
                else:
                    np.minimum.at(least, cell, key)
                    np.maximum.at(most, cell, key)
        for i, (n, least, most) in total.items():
            n = n.reshape(groups, -1)
            at = np.flatnonzero(n.sum(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(least[at]), pa.array(most[at]),
                                              *[pa.array(n[g][at]) for g in range(groups)]], names=names)

    names = ["r", "cell", "lo", "hi", *[f"n{g}" for g in range(groups)]]
    schema = ", ".join(["r int", "cell int", "lo long", "hi long", *[f"n{g} long" for g in range(groups)]])
    group = F.col(fold).cast("long") if fold else F.lit(None).cast("long")
    cells = df.select(group.alias("f"), *[F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(columns)]).mapInArrow(run, schema)
    found = cells.groupBy("r", "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(f"n{g}").alias(f"n{g}") for g in range(groups)])
    return [(r["r"], r["cell"], r["lo"], r["hi"], np.array([r[f"n{g}"] for g in range(groups)], np.int64)) for r in found.collect()]  # ranges x CELLS


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], fold: str | None = None, folds: Sequence = (),
                     apart: Sequence[str] | None = None) -> dict:
    """{None: {column: [exact linear-interpolated quantiles]}} over all rows, and
    with ``folds`` also {f: ...} over the rows of the other folds, there for the
    columns in ``apart`` (default: all).  Columns without a value are left out.
    ``df`` is read several times, so it should be a stored table."""
    folds = sorted(folds)
    held = {None: np.ones(len(folds) + 1, np.int64)}
    for i, f in enumerate(folds):
        held[f] = np.array([j < len(folds) and j != i for j in range(len(folds) + 1)], np.int64)
    out: dict = {s: {} for s in held}
    picked: dict = {}
    ranges: dict = {(c, None, None): np.zeros(len(folds) + 1, np.int64) for c in dict.fromkeys(columns)}  # rows below, per fold
    wanted: dict = {k: None for k in ranges}  # of each range: (set, rank); None: not known before the first pass
    size: dict = {}
    while ranges:
        order = list(ranges)
        cells: dict = {i: [] for i in range(len(order))}
        for r, cell, lo, hi, n in _cell_counts(df, order, folds, fold):
            cells[r].append((cell, lo, hi, n))
        further: dict = {}
        goals: dict = {}
        for r, key in enumerate(order):
            c, below = key[0], ranges[key]
            todo = wanted[key]
            if todo is None:
                n = sum((x[3] for x in cells[r]), np.zeros(len(folds) + 1, np.int64))
                todo = []
                for s in held:
                    if s is None or apart is None or c in apart:
                        size[s, c] = int(n @ held[s])
                        if size[s, c]:
                            todo += {(s, int(f(p * (size[s, c] - 1)))) for p in probs for f in (np.floor, np.ceil)}
            mine = sorted(cells[r], key=lambda x: x[0])
            before = np.cumsum([below, *[x[3] for x in mine]], axis=0)
            up_to = {s: before[1:] @ held[s] for s in {s for s, _ in todo}}
            for s, rank in todo:
                i = int(np.searchsorted(up_to[s], rank, side="right"))
                _, lo, hi, _ = mine[i]
                if lo == hi:
                    picked[s, c, rank] = _number(lo)
                else:
                    further[c, lo, hi] = before[i]
                    goals.setdefault((c, lo, hi), []).append((s, rank))
        ranges, wanted = further, goals
    for (s, c), n in size.items():
        if n:
            at = [p * (n - 1) for p in probs]
            ends = [(picked[s, c, int(np.floor(x))], picked[s, c, int(np.ceil(x))], x - float(np.floor(x))) for x in at]
            out[s][c] = [lo + part * (hi - lo) for lo, hi, part in ends]
    return out


def exact_median(df: DataFrame, value: str | Column, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by=by, names=[name])


def mode_of(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    name: str = "mode",
    count_name: str | None = None,
) -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    ``groupBy(g, v).count()`` is combined map-side, then ``min_by`` keeps one
    candidate per group per partition, so a hot group never sits in one task.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    aggs = [F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value))).alias(name)]
    if count_name:
        aggs.append(F.max("_c").alias(count_name))
    return counts.groupBy(*by).agg(*aggs)
