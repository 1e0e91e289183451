"""Exact set-similarity join (Jaccard >= 4/5) of the 5-word shingle sets of
text units: whole documents, or their lines.

A set is known by a 64-bit hash of its tokens, so copies are one member.
Tokens are ordered rare first, by a count table of fixed size that covers all
rows and by hash among equals; two sets that meet the threshold share a token
of their prefixes.  The join never lists the pairs of a bucket:

1. each bucket (token) proposes its members against one of them: that with
   the fewest rarer tokens, the likeliest to be what the others are copies of;
   very frequent tokens are salted, and their salts meet in a second level;
2. proposals that pass the length, positional and bit-mark filters and share
   prefix tokens under every further global order asked for are verified on the
   whole sets, which are read again from the texts for the members of such pairs
   only (a bitmap of fixed size selects them);
3. the caller narrows what is left, and ``rest`` lists the remaining pairs of
   a bucket that pass the same filters.

Members' sets, not documents, meet in pairs, and only hashes are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import textkernel as tk
from hearth.llm.tables import BITMAP_BITS, bitmap, count_table, saved

#: A token in more than this many sets, and than four times the mean cell, is salted.
HOT_TOKEN = 4096
ADDRESS = "__key"
_SPREAD = 2654435761


def addressed(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """``docs`` plus ``__key``, a hash of id and text that names a row: rows
    that repeat both are one document, rows that share an id are not."""
    return docs.withColumn(ADDRESS, F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text_col}`")))


def id_type(docs: DataFrame, key: str) -> str:
    """Whole-number ids are carried as long, all others as what they are."""
    kind = docs.schema[key].dataType
    return "long" if isinstance(kind, T.IntegralType) else kind.simpleString()


def unit_starts(data: np.ndarray, offs: np.ndarray, by_line: bool) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the units of a piece of texts, and their texts."""
    starts, row = offs[:-1], np.arange(len(offs) - 1)
    if by_line:
        cut = np.flatnonzero(data == 10)
        of = np.searchsorted(offs, cut, side="right") - 1
        starts, row = np.concatenate([starts, cut + 1]), np.concatenate([row, of])
        order = np.lexsort((starts, row))
        starts, row = starts[order], row[order]
    return starts, row


def unit_chunks(texts: pa.Array, by_line: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, unit number in its row, word bounds, word hashes) of the units of
    a text column, in pieces of bounded size."""
    for lo, _, data, offs in tk.pieces(texts):
        starts, row = unit_starts(data, offs, by_line)
        row = row + lo
        number = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        at, _, hashes = tk.words(data, offs[1:-1])
        woff = np.concatenate([np.searchsorted(at, starts, side="left"), [len(at)]])
        for u in range(0, len(row), 1 << 15):  # see distinct_sets
            v = min(len(row), u + (1 << 15))
            yield row[u:v], number[u:v], woff[u : v + 1] - woff[u], hashes[woff[u] : woff[v]]


def bit_marks(tokens: np.ndarray, off: np.ndarray, width: int) -> np.ndarray:
    """Per unit ``width`` 64-bit words with a bit for each token, named by the
    token's first bits.  A bit that x has and y has not stands for at least one
    token of x that y lacks.  Tokens are sorted in each unit, so are the bits."""
    n_units, bits = len(off) - 1, 6 + width.bit_length() - 1
    unit = np.repeat(np.arange(n_units), np.diff(off))
    cell = (unit << bits) | (tokens >> np.uint64(64 - bits)).astype(np.int64)
    cell = cell[np.r_[True, cell[1:] != cell[:-1]]] if len(cell) else cell
    out = np.zeros(n_units * width, np.uint64)
    word = cell >> 6
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else word
    if len(first):
        out[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (cell & 63).astype(np.uint64), first)
    return out.view(np.int64).reshape(n_units, width)


def named_units(texts: pa.Array, address: np.ndarray, bits: np.ndarray, by_line: bool) -> Iterator[pa.Array]:
    """The texts of the units whose (address, number) bit is set."""
    hit = lambda row, number: ((lambda at: (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)(
        (address[row] ^ (number * _SPREAD)) & (BITMAP_BITS - 1))).astype(bool)
    if not by_line:
        yield texts.filter(pa.array(hit(np.arange(len(texts)), 0)))
        return
    for lo, hi, data, offs in tk.pieces(texts):
        starts, row = unit_starts(data, offs, True)
        number = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        ends = np.r_[starts[1:], len(data)]
        raw = data.tobytes()
        yield pa.array([raw[starts[i] : ends[i]] for i in np.flatnonzero(hit(row + lo, number)).tolist()], pa.binary())


def prefix_size(n: np.ndarray) -> np.ndarray:
    """Tokens of which two sets with Jaccard >= 4/5 share at least one."""
    return np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)


def _shingle_arrays(batch, by_line):
    for _, _, woff, hashes in unit_chunks(batch.column(0), by_line):
        yield tk.shingles(hashes, woff)[0]


@dataclass
class SetJoin:
    docs: DataFrame  # addressed
    key: str
    text_col: str
    by_line: bool
    orders: int = 0  # further global orders under which a pair must share prefix tokens

    def __post_init__(self):
        self.prefixes = [f"p{i}" for i in range(self.orders)]
        self.width = 4 if self.by_line else 8  # 64-bit words of a set's bit marks; a power of two
        self.marks = [f"w{i}" for i in range(self.width)]
        self.text = self.docs.select(F.col(f"`{self.text_col}`").alias("t"))
        self.sets = self._sets()
        self.live = self._live()
        self.known = self._known()

    def _sets(self) -> DataFrame:
        """One row per unit (lines without words are left out): row address,
        id, unit number, set size and id, the prefix's ``light`` tokens, in
        order, and its ``hot`` ones (token and salt), which come after them as
        they are frequent.  A task lists the prefix of each distinct set once."""
        by_line = self.by_line
        counts = count_table(self.text, lambda b: _shingle_arrays(b, by_line))
        limit = max(HOT_TOKEN, int(4 * counts.mean()))
        shared = self.docs.sparkSession.sparkContext.broadcast(counts)
        kind = id_type(self.docs, self.key)
        rows = self.docs.select(F.col(f"`{self.key}`").cast(kind).alias("id"), ADDRESS, F.col(f"`{self.text_col}`").alias("t"))
        hot = pa.struct([("k", pa.int64()), ("s", pa.int32())])
        width, orders = self.width, self.orders
        names = ["id", ADDRESS, "unit", "n", "set", *self.marks, *self.prefixes, "light", "hot"]

        def run(batches):
            cell_counts, seen = shared.value, set()
            mask = np.uint64(len(cell_counts) - 1)
            for batch in batches:
                for row, number, woff, hashes in unit_chunks(batch.column(2), by_line):
                    tokens, unit, _ = tk.shingles(hashes, woff)
                    t, u, off = tk.distinct_sets(tokens, unit, len(row))
                    n, ids = np.diff(off), tk.fingerprint(t, off)
                    cell = cell_counts[(t & mask).astype(np.int64)]
                    rank = np.minimum(255, 4 * np.log2(cell + 1.0)).astype(np.uint64)
                    order = np.argsort((u.astype(np.uint64) << np.uint64(48)) | (rank << np.uint64(40)) | (t >> np.uint64(24)))
                    pos = np.arange(len(t)) - off[u]  # units are grouped: sorting keeps each in its place
                    fresh = np.ones(len(row), bool)
                    for i, s in enumerate(ids.tolist()):
                        if s in seen:
                            fresh[i] = False
                        else:
                            seen.add(s)
                    marks = bit_marks(t, off, width).T.copy()
                    further = [pa.array(further_prefixes(t, off, o, fresh), pa.binary()) for o in range(orders)]
                    take = (pos < prefix_size(n)[u]) & fresh[u]
                    pick, pos, owner = order[take], pos[take], u[take]
                    is_hot = cell[pick] > limit
                    token, lists = pa.array(t[pick].view(np.int64)), []
                    salt = (ids[owner].view(np.uint64) % (cell[pick] // limit + 1).astype(np.uint64)).astype(np.int32)
                    pairs = pa.StructArray.from_arrays([token, pa.array(salt)], fields=list(hot))
                    for values, part in ((token, ~is_hot), (pairs, is_hot)):
                        ends = np.cumsum(np.bincount(owner[part], minlength=len(row)))
                        lists.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values.filter(pa.array(part))))
                    where = pa.array(row)
                    out = pa.RecordBatch.from_arrays(
                        [batch.column(0).take(where), batch.column(1).take(where), pa.array(number), pa.array(n), pa.array(ids), *map(pa.array, marks), *further, *lists], names=names
                    )
                    yield out.filter(pa.array(n > 0)) if by_line else out

        marked = "".join(f"{m} long, " for m in self.marks) + "".join(f"{p} binary, " for p in self.prefixes)
        schema = f"id {kind}, {ADDRESS} long, unit long, n long, set long, {marked}light array<long>, hot array<struct<k:long,s:int>>"
        return saved(rows.mapInArrow(run, schema), "sets")

    def _live(self) -> DataFrame:
        """Postings (bucket k, set, np, rep, rep_np) of buckets with several
        sets; ``np`` packs the set's size and the token's position."""
        packed = lambda pos: F.shiftleft(F.col("n"), 32).bitwiseOR(F.col("pos").cast("long") + pos).alias("np")
        light = self.sets.where(F.size("light") > 0).select("set", "n", F.posexplode("light").alias("pos", "k")).select("k", "set", packed(F.lit(0)))
        place = F.col("np").bitwiseAND(F.lit((1 << 32) - 1))
        w = Window.partitionBy("k").orderBy(place, "set")
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        light = light.select(
            "k", "set", "np", F.first("set").over(so_far).alias("rep"), F.first("np").over(so_far).alias("rep_np"),
            F.lag("set").over(w).alias("before"),
            F.last("set").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("end"),
        ).where("rep != end")
        # of copies that several tasks list, one stays
        light = light.where(F.col("before").isNull() | (F.col("before") != F.col("set"))).select("k", "set", "np", "rep", "rep_np")
        hot = self.sets.where(F.size("hot") > 0).select("set", "n", F.size("light").alias("after"), F.posexplode("hot").alias("pos", "p"))
        hot = hot.select("p.k", "set", packed(F.col("after")), "p.s")
        least = F.min(F.struct(place.alias("place"), "set", "np"))
        salted = saved(hot.groupBy("k", "s").agg(least.alias("r")).select("k", "s", "r"), "salted")
        top = salted.groupBy("k").agg(F.min("r").alias("t"))
        self.hot_reps = salted.join(top, "k").select("k", F.col("r.set").alias("set"), F.col("r.np").alias("np"), F.col("t.set").alias("rep"), F.col("t.np").alias("rep_np"))
        salted = salted.select("k", "s", F.col("r.set").alias("rep"), F.col("r.np").alias("rep_np"))
        hot = hot.join(salted, ["k", "s"]).select("k", "set", "np", "rep", "rep_np")
        return saved(light.unionByName(hot), "live")

    def _known(self) -> DataFrame:
        """One row per live set: its size, bit marks, and a unit that has it.
        A bitmap picks its candidates among all units, so only these are
        grouped."""
        cells = np.frombuffer(bitmap(self.live, F.pmod(F.col("set"), F.lit(BITMAP_BITS))), np.uint8)
        shared = self.docs.sparkSession.sparkContext.broadcast(cells)

        def pick(batches):
            bits = shared.value
            for b in batches:
                at = b.column(0).to_numpy(zero_copy_only=False) & (BITMAP_BITS - 1)
                yield b.filter(pa.array(((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)))

        fresh = self.sets.where(F.size("light") + F.size("hot") > 0).select("set", "n", *self.marks, *self.prefixes, ADDRESS, "unit")
        rows = fresh.mapInArrow(pick, fresh.schema)
        one = [F.max(c).alias(c) for c in ("n", *self.marks, *self.prefixes)]  # equal in all rows of a set
        return saved(rows.groupBy("set").agg(*one, F.min(F.struct(ADDRESS, "unit")).alias("u")), "known")

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """The whole sets, as packed sorted tokens, of set ids.  One unit that
        has each set is named by a bitmap, and the texts are read again (a few
        other units slip through and meet no pair)."""
        named = self.known.join(ids, "set", "left_semi")
        bit = F.pmod(F.col(f"u.{ADDRESS}").bitwiseXOR(F.col("u.unit") * _SPREAD), F.lit(BITMAP_BITS))
        cells = np.frombuffer(bitmap(named, bit), np.uint8)
        shared = self.docs.sparkSession.sparkContext.broadcast(cells)
        by_line = self.by_line

        def run(batches):
            bits = shared.value
            for batch in batches:
                address = batch.column(0).to_numpy(zero_copy_only=False)
                for picked in named_units(batch.column(1), address, bits, by_line):
                    for _, _, woff, hashes in unit_chunks(picked, False):
                        tokens, unit, _ = tk.shingles(hashes, woff)
                        t, _, off = tk.distinct_sets(tokens, unit, len(woff) - 1)
                        packed = [np.sort(t[a:b]).tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(tk.fingerprint(t, off)), pa.array(packed, pa.binary())], names=["set", "tokens"])

        rows = self.docs.select(ADDRESS, F.col(f"`{self.text_col}`").alias("t"))
        return saved(rows.mapInArrow(run, "set long, tokens binary"), "members")

    def proposals(self) -> DataFrame:
        """Star pairs (a, b) of all buckets that pass the filters."""
        stars = self.live.select("set", "np", "rep", "rep_np").unionByName(self.hot_reps.select("set", "np", "rep", "rep_np"))
        pairs = _ordered(stars.where(passes("np", "rep_np")).select(F.col("rep").alias("a"), F.col("set").alias("b")))
        side = lambda key, to: self.known.select(F.col("set").alias(key), *[F.col(c).alias(f"{to}_{c}") for c in ("n", *self.marks)])
        both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
        names = lambda to: [F.col(f"{to}_{m}") for m in self.marks]
        return both.where(may_agree(F.col("x_n"), F.col("y_n"), names("x"), names("y"))).select("a", "b")

    def rest(self, marked: DataFrame, condition: Column) -> DataFrame:
        """Remaining pairs: ``marked`` is ``live`` with the caller's columns;
        ``condition`` on the aliases x and y says which pairs are open.  All
        filters are part of the join, so only pairs that pass come out of it."""
        marked = saved(marked.join(self.known.select("set", *self.marks), "set"), "open")
        names = lambda to: [F.col(f"{to}.{m}") for m in self.marks]
        size = lambda c: F.shiftright(F.col(c), 32)
        close = may_agree(size("x.np"), size("y.np"), names("x"), names("y"))
        both = marked.alias("x").join(marked.alias("y"), (F.col("x.k") == F.col("y.k")) & condition & passes("x.np", "y.np") & close)
        return _ordered(both.select(F.col("x.set").alias("a"), F.col("y.set").alias("b")))

    def sharing(self, pairs: DataFrame) -> DataFrame:
        """The pairs that share a prefix token under every further order, told
        by the prefixes in ``known``: no whole set is read for the others."""
        side = lambda key, to: self.known.select(F.col("set").alias(key), *[F.col(p).alias(f"{to}{p}") for p in self.prefixes])
        both = pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", *[f"{to}{p}" for to in "xy" for p in self.prefixes])
        orders = self.orders

        def run(batches):
            for batch in batches:
                cols = [[np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column(2 + i)] for i in range(2 * orders)]
                good = [all(_common(cols[o][i], cols[orders + o][i]) for o in range(orders)) for i in range(batch.num_rows)]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return both.mapInArrow(run, "a long, b long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs with Jaccard >= 4/5, on whole sets.  Pairs that share no
        prefix token under one of the further orders are left out before."""
        pairs = saved(self.sharing(pairs) if self.orders else pairs, "pairs")
        m = self._sets_of(pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct())
        both = (
            pairs.join(m.select(F.col("set").alias("b"), F.col("tokens").alias("tb")), "b")
            .join(m.select(F.col("set").alias("a"), F.col("tokens").alias("ta")), "a").select("a", "b", "ta", "tb")
        )

        def run(batches):
            hub = None
            for batch in batches:
                good = []
                for a, x, y in zip(batch.column("a").to_pylist(), batch.column("ta"), batch.column("tb"), strict=True):
                    if hub is None or hub[0] != a:
                        hub = (a, np.frombuffer(x.as_buffer(), np.uint64))
                    good.append(similar(hub[1], np.frombuffer(y.as_buffer(), np.uint64)))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return saved(both.mapInArrow(run, "a long, b long").distinct(), "links")


def may_agree(nx: Column, ny: Column, x: list[Column], y: list[Column]) -> Column:
    """Bit-mark filter: what one set surely lacks of the other bounds the
    overlap, which must reach 4/9 of both sizes."""
    lacks = lambda a, b: reduce(lambda s, t: s + t, [F.bit_count(p.bitwiseAND(F.bitwise_not(q))) for p, q in zip(a, b, strict=True)])
    return (9 * F.least(nx - lacks(x, y), ny - lacks(y, x))) >= (4 * (nx + ny))


def passes(x: str, y: str) -> Column:
    """Length and positional filter on two packed (size, position) columns of a
    shared token: sizes within 4/5, and if it is the first shared token of a
    pair, enough tokens left for 4/9 of both sizes."""
    size = lambda c: F.shiftright(F.col(c), 32)
    left = lambda c: size(c) - F.col(c).bitwiseAND(F.lit((1 << 32) - 1))
    nx, ny = size(x), size(y)
    return ((5 * F.least(nx, ny)) >= (4 * F.greatest(nx, ny))) & (9 * F.least(left(x), left(y)) >= 4 * (nx + ny))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def further_prefixes(tokens: np.ndarray, off: np.ndarray, order: int, wanted: np.ndarray) -> list[bytes]:
    """Per unit its prefix under another global order, its smallest hashes,
    sorted, 32 bits each; empty where not ``wanted``.  Cutting the hashes to 32
    bits keeps their order, so it loses no shared token."""
    sizes = prefix_size(np.diff(off))
    h, out = tk.mix(tokens, 100 + order), []
    for a, b, p, w in zip(off[:-1].tolist(), off[1:].tolist(), sizes.tolist(), wanted.tolist(), strict=True):
        out.append(np.unique((np.partition(h[a:b], p - 1)[:p] >> np.uint64(32)).astype(np.uint32)).tobytes() if p and w else b"")
    return out


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Jaccard >= 4/5 of two sorted token arrays, after the length filter."""
    if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    both = _common(x, y)
    return 100 * both >= 80 * (len(x) + len(y) - both)
