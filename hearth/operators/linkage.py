"""Record linkage and row-set validation.

* exact step: null-safe equality on every shared column and the tiebreak;
  rows that are equal on all of them are paired 1:1 in id order;
* wildcard step: a blank (NULL) cell on the right matches anything; a right row
  is linked to the one left row of its block that matches and is nearest by the
  tiebreak, found by a sorted merge per pattern of blanks, and only 1:1;
* validation: one-sided rows, overlap and cell-by-cell equality as
  semi/anti joins and ``exceptAll``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import ensure_checkpoint_dir

#: Slices that a group's rows are numbered in; no effect on the numbers.
SLICES = 64


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def ranked(df: DataFrame, group: Sequence[str], row_id: str, name: str) -> DataFrame:
    """0-based rank of each row in its group (NULLs are a value) by ``row_id``,
    a number.

    A group is numbered in slices of the id range, and a running count over the
    (group, slice) counts gives each slice its offset: a group with a third of
    all rows is spread over ``SLICES`` window partitions, and as slices follow
    the id order the rank is the same for any number of them."""
    bounds = df.agg(F.min(row_id).alias("lo"), F.max(row_id).alias("hi")).first()
    lo, width = bounds["lo"] or 0, max(1, ((bounds["hi"] or 0) - (bounds["lo"] or 0)) // SLICES + 1)
    keys = [*group, "_slice"]
    d = df.withColumn("_slice", F.floor((F.col(row_id) - F.lit(lo)) / F.lit(width)))
    d = d.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(row_id)) - 1)
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = d.join(offsets, reduce(lambda a, b: a & b, [_same(d[k], offsets[f"_o_{k}"]) for k in keys]))
    return out.withColumn(name, F.col("_off") + F.col("_local")).select(*df.columns, name)


def exact_link(left: DataFrame, right: DataFrame, left_id: str, right_id: str, columns: Sequence[str],
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Steps 1 and 3: ``(right_id, left_id)`` for rows equal on every column and
    tiebreak (NULL equals NULL).  Rows that are equal on all of these are
    interchangeable and paired 1:1 in id order; twins told apart by the
    tiebreak are linked by it, whichever of them has a partner."""
    match = [*columns, *tiebreak]
    lr = ranked(left.select(left_id, *match), match, left_id, "_rank")
    rr = ranked(right.select(right_id, *match), match, right_id, "_rank")
    lr = lr.select(left_id, *[F.col(c).alias(f"_l_{c}") for c in [*match, "_rank"]])
    return rr.join(lr, reduce(lambda a, b: a & b, [_same(rr[c], lr[f"_l_{c}"]) for c in [*match, "_rank"]])).select(right_id, left_id)


def _nearest(left: DataFrame, right: DataFrame, on: Sequence[str], v: str) -> DataFrame:
    """``right`` (one row per ``_p``) with ``_n`` and ``_id``: how many left rows
    of the same ``on`` are nearest in ``v``, and the smallest id.  ``left`` has
    one row per ``on`` and ``v`` with its count ``_n`` and smallest id ``_id``.

    A sorted merge: along the values of a group, every right row takes the last
    left value up to it and the first one from it on.  A group is cut into slices
    of the value range; what lies beyond a slice comes from the slices' own
    extremes, so a group with a third of the rows is spread over the slices.  A
    left row without value is nearest only where no other is there."""
    bounds = left.agg(F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi")).first()
    lo, width = bounds["lo"] or 0.0, max((bounds["hi"] or 0.0) - (bounds["lo"] or 0.0), 1e-300) / SLICES
    cut = F.least(F.greatest(F.floor((F.col(v).cast("double") - lo) / width), F.lit(-1)), F.lit(SLICES)).cast("int")
    cell = F.struct(F.col(v).alias("v"), F.col("_n").alias("n"), F.col("_id").alias("id"))
    kind = left.select(cell.alias("c")).schema["c"].dataType
    known = left.where(F.col(v).isNotNull()).select(*on, v, cut.alias("_s"), cell.alias("_l"), F.lit(None).cast("string").alias("_p"))
    asked = right.where(F.col(v).isNotNull()).select(*on, v, cut.alias("_s"), F.lit(None).cast(kind).alias("_l"), "_p")
    both = known.unionByName(asked)
    group = [*on, "_s"]
    up = Window.partitionBy(*group).orderBy(F.col(v), F.col("_p").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*group).orderBy(F.col(v).desc(), F.col("_p").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("_a", F.last("_l", ignorenulls=True).over(up)).withColumn("_b", F.last("_l", ignorenulls=True).over(down))
    at = F.when(F.col("_l").isNotNull(), F.col(v))
    ends = both.groupBy(*group).agg(F.max_by("_l", at).alias("_top"), F.min_by("_l", at).alias("_low"))
    line = Window.partitionBy(*on).orderBy("_s")  # at most SLICES + 2 rows
    ends = ends.select(*group, F.last("_top", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.first("_low", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    lost = left.where(F.col(v).isNull()).groupBy(*on).agg(F.sum("_n").alias("_n0"), F.min("_id").alias("_id0"))
    found = near.where(F.col("_p").isNotNull()).join(ends, group).join(lost, list(on), "left")
    a, b = F.coalesce("_a", "_before"), F.coalesce("_b", "_after")
    found = found.select("_p", v, a.alias("_a"), b.alias("_b"), "_n0", "_id0")
    da, db = F.col(v) - F.col("_a.v"), F.col("_b.v") - F.col(v)
    pick = F.when(F.col("_a").isNull() & F.col("_b").isNull(), F.struct(F.col("_n0").alias("n"), F.col("_id0").alias("id"))) \
        .when(F.col("_b").isNull() | (da < db) | (F.col("_a.v") == F.col("_b.v")), F.struct(F.col("_a.n").alias("n"), F.col("_a.id").alias("id"))) \
        .when(F.col("_a").isNull() | (db < da), F.struct(F.col("_b.n").alias("n"), F.col("_b.id").alias("id"))) \
        .otherwise(F.struct((F.col("_a.n") + F.col("_b.n")).alias("n"), F.col("_a.id").alias("id")))
    dated = found.select("_p", pick.alias("_x")).select("_p", F.col("_x.n").alias("_n"), F.col("_x.id").alias("_id"))
    # a right row without value is as far from all left rows of its group
    whole = left.groupBy(*on).agg(F.sum("_n").alias("_n"), F.min("_id").alias("_id"))
    undated = right.where(F.col(v).isNull()).select(*on, "_p").join(whole, list(on)).select("_p", "_n", "_id")
    return dated.unionByName(undated)


def wildcard_link(left: DataFrame, right: DataFrame, left_id: str, right_id: str, block: Sequence[str],
                  wild: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Step 2: right rows whose non-blank cells match a left row, and only one
    nearest to them by the tiebreak (or only one, without tiebreak).

    ``block`` columns are never blank; ``wild`` columns may be blank on the
    right; ``tiebreak`` is at most one number.  For each pattern of blanks that
    occurs, left rows are counted per non-blank cells and value, and distinct
    right profiles are merged with them in the order of the value: no profile
    is listed with the others of its block."""
    if len(tiebreak) > 1:
        raise ValueError("one tiebreak column at most")
    ensure_checkpoint_dir(left.sparkSession)
    keys = [*block, *wild, *tiebreak]
    text = F.concat_ws("|", *[F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")) for c in keys])
    blanks = reduce(lambda x, y: x + y, [F.when(F.col(c).isNull(), 2**i).otherwise(0) for i, c in enumerate(keys)], F.lit(0))
    profiles = right.select(*keys).distinct().where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in block], F.lit(True)))
    profiles = profiles.withColumn("_p", F.concat(blanks.cast("string"), F.lit("|"), text)).withColumn(
        "_blank", reduce(lambda x, y: x + y, [F.when(F.col(c).isNull(), 2**i).otherwise(0) for i, c in enumerate(wild)], F.lit(0))).checkpoint()
    equal = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(left_id).alias("_id")).checkpoint()
    found = []
    for pattern in sorted(r[0] for r in profiles.select("_blank").distinct().collect()):  # at most 2 ** len(wild)
        on = [*block, *[c for i, c in enumerate(wild) if not pattern >> i & 1]]
        l = equal.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in on], F.lit(True)))
        l = l.groupBy(*on, *tiebreak).agg(F.sum("_n").alias("_n"), F.min("_id").alias("_id"))
        r = profiles.where(F.col("_blank") == pattern).select(*on, *tiebreak, "_p")
        found.append(_nearest(l, r, on, tiebreak[0]) if tiebreak else r.join(l, on).select("_p", "_n", "_id"))
    if not found:
        return right.select(right_id, F.lit(None).cast(left.schema[left_id].dataType).alias(left_id)).limit(0)
    best = reduce(DataFrame.unionByName, found).where("_n = 1").join(profiles, "_p")
    best = best.select(F.col("_id").alias(left_id), *[F.col(c).alias(f"_r_{c}") for c in keys])
    return right.join(best, reduce(lambda x, y: x & y, [_same(right[c], best[f"_r_{c}"]) for c in keys])).select(right_id, left_id)


def link_records(left: DataFrame, right: DataFrame, left_id: str, right_id: str, columns: Sequence[str],
                 block: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """All steps: ``(right_id, left_id, step)`` with step 'exact' or 'wildcard'."""
    ensure_checkpoint_dir(left.sparkSession)
    exact = exact_link(left, right, left_id, right_id, columns, tiebreak).checkpoint()  # read three times below
    r_rest = right.join(exact.select(right_id), right_id, "left_anti")
    l_rest = left.join(exact.select(left_id), left_id, "left_anti")
    wild = [c for c in columns if c not in block]
    w = wildcard_link(l_rest, r_rest, left_id, right_id, block, wild, tiebreak)
    w = w.groupBy(left_id).agg(F.count(F.lit(1)).alias("_n"), F.min(right_id).alias(right_id)).where("_n = 1").select(right_id, left_id)
    return exact.withColumn("step", F.lit("exact")).unionByName(w.withColumn("step", F.lit("wildcard")))


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows present on one side only: ``(n_left_only, n_right_only)``."""
    j = left.select(F.col(key).alias("_l")).join(right.select(F.col(key).alias("_r")), F.col("_l") == F.col("_r"), "full_outer")
    return j.agg(F.count_if(F.col("_r").isNull()).cast("long").alias("n_left_only"),
                 F.count_if(F.col("_l").isNull()).cast("long").alias("n_right_only"))


def split_checks(whole: DataFrame, part_a: DataFrame, part_b: DataFrame, key: str) -> DataFrame:
    """Sizes, key overlap between the parts, and whether the parts
    re-assemble the whole row-for-row (``exceptAll`` both ways)."""
    overlap = part_a.select(key).join(part_b.select(key), key, "left_semi")
    glued = part_a.unionByName(part_b)
    missing = whole.exceptAll(glued)
    extra = glued.exceptAll(whole)

    counted = [(name, d) for name, d in
               [("n_a", part_a), ("n_b", part_b), ("n_overlap", overlap), ("n_missing", missing), ("n_extra", extra)]]
    long = reduce(lambda a, b: a.unionByName(b), [
        d.agg(F.count(F.lit(1)).alias("v")).select(F.lit(name).alias("k"), "v") for name, d in counted])
    return long.groupBy().agg(*[F.max(F.when(F.col("k") == name, F.col("v"))).alias(name) for name, _ in counted])


def enrichment_validation(original: DataFrame, enriched: DataFrame, key: str, added: Sequence[str],
                          other: DataFrame | None = None) -> DataFrame:
    """V5: ``(check, value)`` rows - original columns unchanged cell by cell
    (``exceptAll`` both ways on the original projection), 1:1 key mapping,
    optional overlap with another split, NULLs left in each added column."""
    cols = original.columns
    proj = enriched.select(*cols)
    checks = [
        ("original_rows_missing", original.exceptAll(proj).agg(F.count(F.lit(1)).alias("v"))),
        ("original_rows_changed", proj.exceptAll(original).agg(F.count(F.lit(1)).alias("v"))),
        ("duplicate_keys", enriched.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("v"))),
    ]
    if other is not None:
        checks.append(("overlap_with_other", enriched.select(key).join(other.select(key), key, "left_semi")
                       .agg(F.count(F.lit(1)).alias("v"))))
    nulls = enriched.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(added)])
    parts = [d.select(F.lit(name).alias("check"), F.col("v").cast("long").alias("value")) for name, d in checks]
    parts += [nulls.select(F.lit(f"nulls_in_{c}").alias("check"), F.col(f"_n{i}").cast("long").alias("value"))
              for i, c in enumerate(added)]
    return reduce(lambda a, b: a.unionByName(b), parts)
