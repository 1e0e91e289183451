"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are normalised to lower-case words between single spaces.  The test
strings are the 13-word windows of the benchmark items (a shorter item is one
window).  Strings are grouped by length class; each class has a block shift
table over the first ``m`` bytes of its strings (``m``: its shortest): the hash
of the ``BLOCK`` bytes that end at the scan position tells how far the scan may
jump, positions of shift 0 look up the suffix-hash bucket of that block, and
direct byte comparison confirms an occurrence.  Scans run in lockstep lanes
over one numpy buffer.

The benchmark is split by hash into blocks of bounded size, each broadcast and
scanned in turn over all documents; hits accumulate per row, so no shuffle of
documents happens and memory does not grow with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
#: Bytes of benchmark text broadcast at once.
BENCH_BLOCK_BYTES = 16 << 20
LANES_PER_SCAN = 4096
SCAN_BYTES = 4 << 20
_FOLD = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def normal_words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of ASCII letters and digits and
    of any character from U+0080 on."""
    return text.encode().translate(_FOLD).split() if text else []


class _Shift:
    """Tables of one length class."""

    def __init__(self, strings: list[bytes], first: int):
        self.m = min(map(len, strings))
        self.block = min(8, max(2, self.m - 1))
        self.bits = 16 if len(strings) < 2000 else 20
        top = self.m - self.block + 1
        self.shift = np.full(1 << self.bits, top, np.int32)
        heads = np.frombuffer(b"".join(s[: self.m] for s in strings), np.uint8).reshape(len(strings), self.m)
        for j in range(top):  # blocks that end at m - 1 have shift 0
            np.minimum.at(self.shift, self._hash(heads[:, j : j + self.block]), top - 1 - j)
        self.bucket: dict[int, list[tuple[bytes, int]]] = {}
        for i, (s, h) in enumerate(zip(strings, self._hash(heads[:, top - 1 :]).tolist(), strict=True)):
            self.bucket.setdefault(h, []).append((s, first + i))

    def _hash(self, rows: np.ndarray) -> np.ndarray:
        key = np.zeros(rows.shape[0], np.uint64)
        for j in range(rows.shape[1]):
            key = (key << np.uint64(8)) | rows[:, j].astype(np.uint64)
        return ((key * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64)

    def occurrences(self, data: np.ndarray, raw: bytes) -> list[tuple[int, int]]:
        """(start, string number) of all occurrences in the buffer."""
        n, m, block = len(data), self.m, self.block
        if n < m:
            return []
        span = max(4 * m, -(-n // LANES_PER_SCAN))
        at = np.arange(m - 1, n, span)
        end = np.minimum(at + span, n)
        back = np.arange(block - 1, -1, -1)
        found = []
        while len(at):
            h = self._hash(data[at[:, None] - back[None, :]])
            step = self.shift[h]
            zero = np.flatnonzero(step == 0)
            for i in zero.tolist():
                start = int(at[i]) - m + 1
                for s, number in self.bucket.get(int(h[i]), ()):
                    if raw.startswith(s, start):
                        found.append((start, number))
            at = at + np.maximum(step, 1)
            live = at < end
            if not live.all():
                at, end = at[live], end[live]
        return found


class WindowIndex:
    """All windows of a block of benchmark items and their search tables.
    ``items``: (item id as string, text); equal windows share one string."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            w = normal_words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(b" " + b" ".join(w[i : i + window]) + b" ", set()).add(item)
        strings = sorted(owners, key=len)
        self.owners = [sorted(owners[s]) for s in strings]
        self.n_words = [s.count(b" ") - 1 for s in strings]
        self.classes, lo = [], 0
        while lo < len(strings):  # a class spans a factor of two of lengths
            hi = lo
            while hi < len(strings) and len(strings[hi]) <= 2 * len(strings[lo]):
                hi += 1
            self.classes.append(_Shift(strings[lo:hi], lo))
            lo = hi

    def hits(self, texts: list[bytes]) -> list[tuple[int, int, int, list[str]]]:
        """(text number, first word, words, owners) of each occurrence in
        normalised texts (words between single spaces, spaces at both ends)."""
        raw = b"\x00".join(texts)
        data = np.frombuffer(raw, np.uint8)
        found = [x for c in self.classes for x in c.occurrences(data, raw)]
        if not found:
            return []
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        out = []
        for at, number in sorted(found):
            doc = int(np.searchsorted(starts, at, side="right")) - 1
            out.append((doc, raw.count(b" ", int(starts[doc]), at), self.n_words[number], self.owners[number]))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of about ``block_bytes``.  Only one block's texts
    are on the driver at a time when the caller iterates."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).alias("t"))
    size = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = int(size // block_bytes) + 1
    for b in range(n):
        yield [(r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).collect()]


def _word_count_and_text(text: str | None) -> tuple[int, bytes]:
    w = normal_words(text)
    return len(w), b" " + b" ".join(w) + b" " if w else b""


def find_windows(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BENCH_BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """``docs`` plus ``n_words`` and ``hits`` (array of first word, words,
    item ids) for every occurrence of a benchmark window in the whole text.

    Null and empty texts have no words; items without words have no window; an
    item without id counts as item "null"; equal windows of several items name
    them all; repeated document rows are judged each by itself.  Existing
    columns named ``n_words`` or ``hits`` (after ``prefix``) are replaced."""
    hit = T.ArrayType(T.StructType([
        T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]))
    count_col, hits_col = f"{prefix}n_words", f"{prefix}hits"
    fields = [f for f in docs.schema.fields if f.name not in (count_col, hits_col)]
    keep = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(count_col, T.LongType()), T.StructField(hits_col, hit)])
    out = docs.select(*[F.col(f"`{c}`") for c in keep])
    for number, items in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        out = out.mapInArrow(_scan(shared, window, text_col, keep, schema, number == 0), schema)
    return out


def _scan(shared, window, text_col, keep, schema, first):
    def run(batches):
        index = WindowIndex(shared.value, window)
        hit_type = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("items", pa.list_(pa.string()))]))
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            counts, hits = [], [[] for _ in texts] if first else [x or [] for x in batch.column(schema.names[-1]).to_pylist()]
            group, base, size = [], 0, 0
            for i, text in enumerate(texts):
                n, raw = _word_count_and_text(text)
                counts.append(n)
                group.append(raw)
                size += len(raw)
                if size >= SCAN_BYTES or i == len(texts) - 1:
                    for d, at, n_words, owners in index.hits(group):
                        hits[base + d].append({"first": at, "words": n_words, "items": owners})
                    base, group, size = i + 1, [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(counts, pa.int64()), pa.array(hits, hit_type)], names=schema.names
            )

    return run


def covered(spans: list[tuple[int, int]]) -> int:
    """Words inside any (first, words) span."""
    total = end = 0
    for a, n in sorted(spans):
        total += max(0, a + n - max(a, end))
        end = max(end, a + n)
    return total


def contamination(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``find_windows``: key, n_words, n_hit, n_items, items_sha256,
    contaminated (n_hit > 0 and 20 * n_hit >= n_words)."""
    slim = found.select(key, "n_words", "hits")
    schema = T.StructType([
        slim.schema[key], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
    ])

    def run(batches):
        none = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n_hit, n_items, digest = [], [], []
            for hits in batch.column("hits").to_pylist():
                items = sorted({i for h in hits for i in h["items"]}) if hits else []
                n_hit.append(covered([(h["first"], h["words"]) for h in hits]) if hits else 0)
                n_items.append(len(items))
                digest.append(hashlib.sha256(",".join(items).encode()).hexdigest() if items else none)
            n_words = batch.column("n_words")
            bad = [h > 0 and 20 * h >= w for h, w in zip(n_hit, n_words.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_words, pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(bad, pa.bool_())],
                names=schema.names,
            )

    return slim.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated rows, same columns; one pass, no shuffle."""
    found = find_windows(docs, benchmark, prefix="__", **options)
    spans = F.array_sort(F.expr("transform(__hits, h -> struct(h.first as a, h.first + h.words as b))"))
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda s, h: F.struct(
            (s.n + F.greatest(F.lit(0), h.b - F.greatest(h.a, s.e))).alias("n"), F.greatest(s.e, h.b).alias("e")
        ),
        lambda s: s.n,
    )
    bad = (F.size("__hits") > 0) & (20 * n_hit >= F.col("__n_words"))
    return found.where(~bad).select(*[F.col(f"`{c}`") for c in docs.columns])
