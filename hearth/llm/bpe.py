"""Byte-level BPE encoding and decoding.

Merging keeps, per piece of text, a segment tree over its byte positions; each
node holds the leftmost minimum rank of the pairs that start below it.  The
root names the next merge; a merge changes the pair ranks of two live
neighbours and clears one position, three point updates of logarithmic cost.
Pieces of equal size class are merged in lockstep as rows of one numpy array,
so a task pays array operations, not Python work per byte; a few pieces alone,
such as very long ones, are merged one by one, where an update ends at the first
node that it leaves as it was.  A bounded memo
keeps the ids of pieces already merged; it changes cost only.

Nulls and empty texts have no tokens.  Rows are independent, so copies, ties
and extra columns pass through unchanged.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Memoised pieces per Python worker (about 60 MB); then the memo starts anew.
MEMO_PIECES = 300_000
MEMO_MAX_CHARS = 64
#: Cells (rows x width) merged at once.
LOCKSTEP_CELLS = 1 << 19
#: Fewer rows than these are merged one by one.
LOCKSTEP_ROWS = 16
_NONE = np.int64(1 << 40)


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one ``base64(token) rank`` a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BytePairCodec:
    """Encodes pieces by ranks and decodes ids; holds the pair table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                if left is not None and (right := ranks.get(token[cut:])) is not None:
                    pairs.append((left << 32 | right, rank))
        pairs.sort()
        self.pair_key = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        self.pair_rank = np.array([r for _, r in pairs] + [0], np.int64)
        self.rank_of_pair = dict(pairs)
        self.memo: dict[str, bytes] = {"": b""}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of adjacent ids, or ``_NONE``; an id below 0 has no pair."""
        key = (left << 32) | right
        at = np.searchsorted(self.pair_key, key)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), self.pair_rank[at], _NONE)

    def _merge_rows(self, ids: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """Merge each row of ``ids`` (rows x width, width a power of two).
        Node keys are ``rank * width + position``: their minimum is the
        leftmost minimum rank."""
        n, width = ids.shape
        col = np.arange(width)
        nxt = np.broadcast_to(col + 1, ids.shape).copy()
        prv = np.broadcast_to(col - 1, ids.shape).copy()
        tree = np.empty((n, 2 * width), np.int64)
        follows = np.full(ids.shape, -1, np.int64)
        follows[:, :-1] = ids[:, 1:]
        follows[col[None, :] + 1 >= length[:, None]] = -1
        tree[:, width:] = self.rank_of(ids, follows) * width + col
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        none = _NONE * width
        live = np.flatnonzero(tree[:, 1] < none)

        def update(rows, pos, rank):
            node = pos + width
            tree[rows, node] = rank * width + pos
            node = node >> 1
            while width > 1 and node[0] >= 1:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node = node >> 1

        while len(live):
            best = tree[live, 1]
            p = best & (width - 1)
            q = nxt[live, p]
            ids[live, p] = best // width
            ids[live, q] = -1
            after = nxt[live, q]
            nxt[live, p] = after
            has = after < length[live]
            prv[live[has], after[has]] = p[has]
            update(live, q, np.full(len(live), _NONE))
            update(live, p, self.rank_of(ids[live, p], np.where(has, ids[live, np.minimum(after, width - 1)], -1)))
            o = prv[live, p]
            back = o >= 0
            if back.any():
                rows = live[back]
                update(rows, o[back], self.rank_of(ids[rows, o[back]], ids[rows, p[back]]))
            live = live[tree[live, 1] < none]
        return [row[:m][row[:m] >= 0] for row, m in zip(ids, length, strict=True)]

    def _merge_one(self, piece: bytes) -> np.ndarray:
        """Merge a single piece; the same tree, updated in place."""
        n, bits = len(piece), max(1, (len(piece) - 1).bit_length())
        width, none, rank_of = 1 << bits, 1 << 62, self.rank_of_pair.get
        start = self.byte_id[np.frombuffer(piece, np.uint8)]
        nodes = np.full(2 * width, none, np.int64)
        rank = self.rank_of(start[:-1], start[1:])
        nodes[width : width + n - 1] = np.where(rank == _NONE, none, (rank << bits) + np.arange(n - 1))
        level = width
        while level > 1:
            nodes[level // 2 : level] = np.minimum(nodes[level : 2 * level : 2], nodes[level + 1 : 2 * level : 2])
            level //= 2
        tree, ids = array("q", nodes.tobytes()), array("q", start.tobytes())
        nxt, prv = array("q", range(1, n + 1)), array("q", range(-1, n - 1))

        def update(pos: int, rank: int | None) -> None:
            node = width + pos
            tree[node] = none if rank is None else (rank << bits) + pos
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        while tree[1] < none:
            p, merged = tree[1] & (width - 1), tree[1] >> bits
            q = nxt[p]
            after, before = nxt[q], prv[p]
            ids[p], ids[q], nxt[p] = merged, -1, after
            update(q, None)
            if after < n:
                prv[after] = p
                update(p, rank_of(merged << 32 | ids[after]))
            else:
                update(p, None)
            if before >= 0:
                update(before, rank_of(ids[before] << 32 | merged))
        out = np.frombuffer(ids, np.int64)
        return out[out >= 0]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, packed as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif piece:
                classes.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in classes.items():
            step = max(1, LOCKSTEP_CELLS // width)
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                if len(part) < LOCKSTEP_ROWS:
                    for i in part:
                        out[i] = self._merge_one(pieces[i]).astype("<u4").tobytes()
                    continue
                raw = np.zeros((len(part), width), np.uint8)
                length = np.array([len(pieces[i]) for i in part])
                for r, i in enumerate(part):
                    raw[r, : length[r]] = np.frombuffer(pieces[i], np.uint8)
                ids = self.byte_id[raw]
                ids[np.arange(width)[None, :] >= length[:, None]] = -1
                for i, got in zip(part, self._merge_rows(ids, length), strict=True):
                    out[i] = got.astype("<u4").tobytes()
        return out

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts; every match of the pattern separately."""
        split = [self.split(t) if t else [] for t in texts]
        memo = self.memo
        if len(memo) > MEMO_PIECES:
            memo.clear()
        todo = list({p for pieces in split for p in pieces if p not in memo})
        fresh = dict(zip(todo, self.merge([p.encode() for p in todo]), strict=True))
        memo.update((p, ids) for p, ids in fresh.items() if len(p) <= MEMO_MAX_CHARS)
        extra = {p: ids for p, ids in fresh.items() if len(p) > MEMO_MAX_CHARS}
        if extra:
            return [b"".join([memo.get(p) or extra[p] for p in pieces]) for pieces in split]
        return [b"".join(map(memo.__getitem__, pieces)) for pieces in split]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_CODECS: dict[tuple, BytePairCodec] = {}


def _codec(ranks: dict[bytes, int], pattern: str) -> BytePairCodec:
    key = (id(ranks), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BytePairCodec(ranks, pattern)
    return _CODECS[key]


def _text_groups(texts: list[str | None], limit: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t or "")
        size += len(group[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _added(df: DataFrame, fields: list[T.StructField], drop: tuple[str, ...] = ()) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names and f.name not in drop] + fields)


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` plus ``out_col``: the packed ids (binary, little-endian uint32) of
    the whole text; an existing column of that name is replaced.  The rank
    table (under 1 MB in the public vocabularies) is read once on the driver
    and broadcast."""
    ranks = read_ranks(rank_path)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    schema = _added(df, [T.StructField(out_col, T.BinaryType())])
    keep = schema.names[:-1]

    def run(batches):
        codec = _codec(shared.value, pattern)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            packed = [ids for group in _text_groups(texts) for ids in codec.encode_texts(group)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(packed, pa.binary())], names=[*keep, out_col]
            )

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` plus ``out_col``: the bytes of the packed ids (null ids: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = _added(df, [T.StructField(out_col, T.BinaryType())])
    keep = schema.names[:-1]

    def run(batches):
        tokens = {i: t for t, i in shared.value.items()}
        for batch in batches:
            out = [
                b"".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist())) if x else b""
                for x in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(out, pa.binary())], names=[*keep, out_col]
            )

    return df.mapInArrow(run, schema)


def round_trip_digest(
    df: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text_col: str = "text", ids_col: str | None = None
) -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the packed ids and of the bytes
    decoded from them, and the packed ids if ``ids_col`` names a column for
    them.  Encoding and decoding share one pass."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    slim = df.select(key, text_col)
    schema = T.StructType([
        slim.schema[key], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
        *([T.StructField(ids_col, T.BinaryType())] if ids_col else []),
    ])

    def run(batches):
        codec = _codec(shared.value, pattern)
        for batch in batches:
            at = 0
            for group in _text_groups(batch.column(1).to_pylist()):
                coded = codec.encode_texts(group)
                cols = [
                    batch.column(0).slice(at, len(group)),
                    pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in coded], pa.string()),
                ]
                at += len(group)
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(coded, pa.binary())] if ids_col else []), names=schema.names)

    return slim.mapInArrow(run, schema)
