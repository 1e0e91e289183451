"""Phrase collocation mining over truncated suffix trees.

Every word occurrence starts a suffix: itself and up to two words that follow it
in its piece.  The tree of all these suffixes, three words deep, holds the count
of every phrase as the total of the leaves below its node.  It is never built
whole.  Its prefixes are partitioned by weight:

* One pass counts words.  Words are packed into groups of at most ``budget``
  suffixes: the heaviest, a bounded list, first-fit by weight, all others by
  hash.
* A word with more suffixes than a group may have is extended: a second pass
  counts its two-word prefixes, which are packed the same way; one that is still
  too heavy is extended to three words, that is to single leaves.
* A third pass cuts the suffixes.  A task sorts and counts those of some million
  words and sends each group one packed row (own dictionary, codes, counts).
* A group's task sorts its leaves, finds the nodes where neighbours part, and
  reads the nodes' totals.  Groups are independent; a hot word is many groups.

A word is known by a 64-bit hash of its language and letters.  Should two words
ever share one, the job stops with an error instead of mixing their counts.

Phrases below ``min_count`` need nothing rarer than themselves, so words below
it cut a suffix short (a bitmap of fixed size, which may let some pass).

Null texts are empty; a null group (language) counts as ``und``.  Documents need
no key; repeated rows count as often as they occur.  Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Iterator  # noqa: UP035  (what applyInArrow looks for)

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm import textkernel as tk
from hearth.llm.tables import BITMAP_BITS, bitmap, saved

#: Suffixes that a group may hold (about 150 MB while its leaves are sorted).
BUDGET = 1 << 21
#: Prefixes of each depth that are packed by name; 12 bytes each in a broadcast.
LISTED = 1 << 20
#: Words counted together in a task; local word numbers must fit 21 bits.
FLUSH_WORDS = 3 << 19
SLICE_WORDS = 1 << 18
#: Distinct words that a task holds as text before it passes on their counts.
FLUSH_DISTINCT = 1 << 18
#: Parts in which a group's best rows are found before its best overall.
SALTS = 64
NO_GROUP = "und"

_BETWEEN = b".,;:!?\x0a\x0b\x0c\x0d"
IS_BREAK = np.zeros(256, bool)
IS_BREAK[list(_BETWEEN)] = True
IS_PART = ~IS_BREAK
IS_PART[[0x20, 0x09]] = False
_EXTENDED = -1


def _hash_of(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tk.mix(tk.mix(a, 21) + b, 22)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Per run of words of a (text, group) batch: their hashes, how many words
    follow each in its piece (0 to 2), how many are to be counted (the others
    only follow), and a function that gives (group, word) of one of them."""
    groups = [g if g is not None else NO_GROUP for g in batch.column(1).to_pylist()]
    salt = {g: _hash_of(g) for g in set(groups)}
    salts = np.array([salt[g] for g in groups], np.uint64)
    for first, last, data, offs in tk.pieces(batch.column(0)):
        starts, ends, h = tk.words(data, offs, IS_PART)
        n = len(starts)
        if not n:
            continue
        doc = np.searchsorted(offs[1:], starts, side="right")
        h = np.maximum(tk.mix(h ^ salts[first:last][doc], 20), np.uint64(1))  # 0 stands for no word
        breaks = np.searchsorted(np.flatnonzero(IS_BREAK[data]), starts)
        follows = np.zeros(n + 1, np.int8)
        follows[: n - 1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
        after = follows[:-1] + (follows[:-1] & follows[1:])
        for a in range(0, n, SLICE_WORDS):
            b = min(n, a + SLICE_WORDS)

            def spelled(i, a=a, first=first, doc=doc, data=data, starts=starts, ends=ends):
                return groups[first + int(doc[a + i])], data[starts[a + i] : ends[a + i]].tobytes().lower().decode()

            yield h[a : b + 2], after[a : b + 2], b - a, spelled


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, lang, word, c), counted until a task holds many different words."""
    total: dict[int, list] = {}

    def flush():
        rows = [(h, g, w, c) for h, (g, w, c) in total.items()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["h", "lang", "word", "c"])

    for batch in batches:
        for h, _, own, spelled in _slices(batch):
            u, at, c = np.unique(h[:own], return_index=True, return_counts=True)
            for key, i, k in zip(u.view(np.int64).tolist(), at.tolist(), c.tolist(), strict=True):
                if (row := total.get(key)) is not None:
                    row[2] += k
                else:
                    total[key] = [*spelled(i), k]
            if len(total) >= FLUSH_DISTINCT:
                yield flush()
    yield flush()


def _suffixes(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[tuple]:
    """Distinct suffixes of two or three words of some million words at a time:
    (word hashes, number of the 1st, 2nd, 3rd word, count); number -1: none.
    Words outside the bitmap end a suffix."""
    held: list[tuple] = []
    size = 0

    def flush():
        h = np.concatenate([x[0] for x in held])
        after = np.concatenate([x[1] for x in held])
        u, i = np.unique(h, return_inverse=True)
        bit = (u & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
        known = ((frequent[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)[i]
        known = np.concatenate([known, [False, False]])
        i = np.concatenate([i, [-1, -1]])
        n = len(h)
        two = (after >= 1) & known[:n] & known[1 : n + 1]
        three = two & (after == 2) & known[2:]
        second = i[1 : n + 1]
        third = np.where(three, i[2:], -1)
        key = (i[:n][two] << 42) | ((second[two] + 1) << 21) | (third[two] + 1)
        key, c = np.unique(key, return_counts=True)
        return u, key >> 42, ((key >> 21) & 0x1FFFFF) - 1, (key & 0x1FFFFF) - 1, c

    for batch in batches:
        for h, after, own, _ in _slices(batch):
            after = after.copy()
            after[own:] = 0
            held.append((h, after))
            size += own
            if size >= FLUSH_WORDS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


class Packing:
    """Which group a prefix belongs to: named prefixes by a sorted list, all
    others by hash over groups of their own.  ``_EXTENDED`` marks prefixes that
    are heavier than a group."""

    def __init__(self, named: list[tuple[int, int]], rest: int, budget: int, base: int):
        bins: list[int] = []
        place = {}
        too_heavy = 0
        for h, weight in sorted(named, key=lambda x: (-x[1], x[0])):
            if weight > budget:
                place[h] = _EXTENDED
                too_heavy += weight
                continue
            if not bins or bins[-1] + weight > budget:  # next fit, heaviest first: bins at least half full
                bins.append(0)
            bins[-1] += weight
            place[h] = base + len(bins) - 1
        keys = np.array(sorted(place, key=lambda h: h % (1 << 64)), np.int64).view(np.uint64)
        self.keys = keys
        self.groups = np.array([place[h] for h in keys.view(np.int64).tolist()], np.int64)
        self.base = base + len(bins)
        self.spread = max(1, -(-2 * rest // budget))
        self.end = self.base + self.spread
        self.leaf_spread = max(1, -(-2 * too_heavy // budget))

    def of(self, h: np.ndarray) -> np.ndarray:
        hashed = self.base + (tk.mix(h, 23) % np.uint64(self.spread)).astype(np.int64)
        if not len(self.keys):
            return hashed
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.groups[at], hashed)

    def extended(self) -> np.ndarray:
        return self.keys[self.groups == _EXTENDED]


def _narrow(x: np.ndarray) -> bytes:
    """Non-negative numbers as bytes: the width, then the smallest type that holds them."""
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, {1: np.uint8, 2: np.uint16, 4: np.uint32}[x[0]], offset=1)


def _cut(frequent, words, pairs):
    """Packed leaves per group: dictionary of word hashes, codes of first words,
    second words and third words (one column each), counts."""

    def run(batches):
        bits, one, two = frequent.value, words.value, pairs.value
        for u, i1, i2, i3, c in _suffixes(batches, bits):
            grp = one.of(u)[i1]
            wide = np.flatnonzero(grp == _EXTENDED)
            if len(wide):
                p = pair_hash(u[i1[wide]], u[i2[wide]])
                g = two.of(p)
                leaf = g == _EXTENDED
                third = np.where(i3[wide] >= 0, u[i3[wide]], np.uint64(0))
                g[leaf] = two.end + (tk.mix(p[leaf] + third[leaf], 24) % np.uint64(two.leaf_spread)).astype(np.int64)
                grp[wide] = g
            order = np.argsort(grp, kind="stable")
            edges = np.flatnonzero(np.diff(grp[order])) + 1
            rows = []
            for part in np.split(order, edges):
                if not len(part):
                    continue
                ids = np.concatenate([i1[part], i2[part], i3[part]])
                d, codes = np.unique(ids, return_inverse=True)
                words_of = np.where(d >= 0, u[np.maximum(d, 0)], np.uint64(0))
                rows.append((int(grp[part[0]]), words_of.tobytes(), _narrow(codes), _narrow(c[part])))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), *[pa.array(x, pa.binary()) for x in cols[1:]]], names=["grp", "words", "codes", "counts"]
                )

    return run


def _nodes(min_count: int, leaf_groups_from: int) -> Callable:
    """A group's subtree: leaves in order, nodes where neighbours part, totals.
    In groups of three-word prefixes a two-word node is not whole; its count is
    known from the pass over pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, grp = [], 0
        for b in batches:
            for r in b.to_pylist():
                grp = r["grp"]
                d, codes = np.frombuffer(r["words"], np.uint64), _wide(r["codes"]).reshape(3, -1)
                held.append((*(d[x] for x in codes), _wide(r["counts"]).astype(np.int64)))
        h1, h2, h3, c = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((h3, h2, h1))
        h1, h2, h3, c = h1[order], h2[order], h3[order], c[order]
        part2 = np.ones(len(c), bool)
        part2[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        part3 = part2.copy()
        part3[1:] |= h3[1:] != h3[:-1]
        out = []
        for depth, parts in ((2, part2), (3, part3)):
            at = np.flatnonzero(parts)
            total = np.add.reduceat(c, at)
            keep = total >= min_count
            if depth == 3:
                keep &= h3[at] != 0
            elif grp >= leaf_groups_from:
                keep[:] = False
            at, total = at[keep], total[keep]
            third = h3[at] if depth == 3 else np.zeros(len(at), np.uint64)
            out.append((h1[at], h2[at], third, total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*out, strict=True)], names=["h1", "h2", "h3", "f"]
        )

    return run


def _pair_counts(frequent, extended):
    """(h1, h2, c) of the two-word prefixes of the words that are too heavy."""

    def run(batches):
        bits, heavy = frequent.value, extended.value
        for u, i1, i2, _, c in _suffixes(batches, bits):
            pick = np.isin(u, heavy)[i1]
            key, inv = np.unique((i1[pick] << 21) | i2[pick], return_inverse=True)
            total = np.bincount(inv, weights=c[pick], minlength=len(key)).astype(np.int64)
            h1, h2 = u[key >> 21], u[key & 0x1FFFFF]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(total)], names=["h1", "h2", "c"]
            )

    return run


def count_phrases(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = 10, budget: int = BUDGET, listed: int = LISTED
) -> tuple[DataFrame, DataFrame]:
    """``words`` (h, lang, word, f) of all words, and ``phrases`` (h1, h2, h3, f)
    of the phrases of 2 and 3 words that occur ``min_count`` times or more; h3 is
    0 for two words."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    slim = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{group_col}`").cast("string").alias("lang"))
    counted = slim.mapInArrow(_count_words, "h long, lang string, word string, c long")
    words = saved(counted.groupBy("h", "lang", "word").agg(F.sum("c").alias("f")), "words")
    if words.groupBy("h").count().where("count > 1").limit(1).count():
        raise RuntimeError("two words share a 64-bit hash; change the seeds of hearth.llm.collocations")
    often = words.where(F.col("f") >= min_count)
    frequent = sc.broadcast(np.frombuffer(bitmap(often, F.expr(f"h & {BITMAP_BITS - 1}")), np.uint8))

    def packed(counts: DataFrame, base: int) -> Packing:
        total = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
        floor = max(budget // 16, -(-total // listed))  # at most ``listed`` prefixes weigh so much
        heavy = [(r.h, r.f) for r in counts.where(F.col("f") >= floor).select("h", "f").collect()]
        return Packing(heavy, total - sum(w for _, w in heavy), max(budget, floor), base)

    one = packed(often, 0)
    pairs = None
    two = Packing([], 0, budget, one.end)
    if len(one.extended()):
        counted = slim.mapInArrow(_pair_counts(frequent, sc.broadcast(one.extended())), "h1 long, h2 long, c long")
        pairs = saved(counted.groupBy("h1", "h2").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count), "pairs")
        named = saved(pairs.mapInArrow(_name_pairs, "h1 long, h2 long, h long, f long"), "named")
        two = packed(named, one.end)
        whole = named.join(F.broadcast(_column(spark, two.extended())), "h")  # at most ``listed``
        if whole.count() != len(two.extended()):
            raise RuntimeError("two pairs of words share a 64-bit hash; change the seeds of hearth.llm.collocations")
    cut = slim.mapInArrow(_cut(frequent, sc.broadcast(one), sc.broadcast(two)), "grp long, words binary, codes binary, counts binary")
    schema = "h1 long, h2 long, h3 long, f long"
    phrases = cut.groupBy("grp").applyInArrow(_nodes(min_count, two.end), schema)
    if pairs is not None:
        phrases = phrases.unionByName(whole.select("h1", "h2", F.lit(0).cast("long").alias("h3"), "f"))
    return words, saved(phrases, "phrases")


def _column(spark: SparkSession, h: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(x,) for x in h.view(np.int64).tolist()], "h long")


def _name_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h1, h2 = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2"))
        cols = [b.column("h1"), b.column("h2"), pa.array(pair_hash(h1, h2).view(np.int64)), b.column("f")]
        yield pa.RecordBatch.from_arrays(cols, names=["h1", "h2", "h", "f"])


def _ratio(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    d = lambda c: f"CAST({c} AS DECIMAL(19,0))"
    return F.expr(f"(1000000BD * {d(a)} * {d(a)}) div ({d(left)} * {d(right)})")


def _best(df: DataFrame, keys: list[str], order: list[Column], limit: int, number: Callable[[], Column], name: str = "rank") -> DataFrame:
    """Rows whose ``number`` in their group is within ``limit``: first among the
    rows of each part of a group, so no task sees a whole group, then overall."""
    salted = df.withColumn("__part", F.pmod(F.xxhash64("h1", "h2", "h3"), F.lit(SALTS)))
    some = salted.withColumn("__n", number().over(Window.partitionBy(*keys, "__part").orderBy(*order))).where(F.col("__n") <= limit)
    ranked = some.drop("__part", "__n").withColumn(name, number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(name) <= limit)


def mine(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = 10, covered_percent: int = 50,
    limit: int = 2000, budget: int = BUDGET, listed: int = LISTED,
) -> DataFrame:
    """Each group's best ``limit`` phrases of 2 and 3 words: lang, rank, phrase, a
    (its count), l and r (counts of the two parts of the cut that scores least),
    n (words of the group), score.  A two-word phrase goes if a three-word one
    that contains it has ``covered_percent`` of its count or more."""
    words, phrases = count_phrases(docs, text_col, group_col, min_count, budget, listed)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= min_count)
    two = phrases.where("h3 = 0").select("h1", "h2", F.col("f").alias("a"))
    three = phrases.where("h3 <> 0").withColumnRenamed("f", "a")
    over = three.select("h1", "h2", "a").unionByName(three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    over = over.groupBy("h1", "h2").agg(F.max("a").alias("m"))
    open_two = two.join(over, ["h1", "h2"], "left").where(F.coalesce(100 * F.col("m") < covered_percent * F.col("a"), F.lit(True)))

    def word(i: int) -> DataFrame:
        return often.select(F.col("h").alias(f"h{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))

    def pair(i: int, j: int) -> DataFrame:
        return two.select(F.col("h1").alias(f"h{i}"), F.col("h2").alias(f"h{j}"), F.col("a").alias(f"f{i}{j}"))

    cols = ["lang", "h1", "h2", "h3", "a", "l", "r", "score"]
    scored2 = open_two.join(word(1), "h1").join(word(2), "h2").select(
        "lang", "h1", "h2", F.lit(0).cast("long").alias("h3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _ratio("a", "f1", "f2").alias("score")
    )
    cuts = three.join(word(1), "h1").join(pair(2, 3), ["h2", "h3"]).join(pair(1, 2), ["h1", "h2"]).join(word(3), "h3")
    cuts = cuts.withColumn("s1", _ratio("a", "f1", "f23")).withColumn("s2", _ratio("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    scored3 = cuts.select(
        "lang", "h1", "h2", "h3", "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    by = [F.col("score").desc(), F.col("a").desc()]
    top = saved(_best(scored2.unionByName(scored3).select(cols), ["lang"], by, limit, F.rank).drop("rank"), "top")
    for i in (1, 2, 3):
        top = top.join(often.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}")), f"h{i}", "left")
    named = top.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    final = _best(named, ["lang"], [*by, F.col("phrase")], limit, F.row_number).join(totals, "lang")
    return final.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
