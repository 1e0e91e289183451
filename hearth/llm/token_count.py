"""Token counts of whole texts under a byte-level BPE vocabulary.

A piece of text starts as a doubly linked list of its bytes with a heap of
``(rank, position)`` for the adjacent pairs that merge.  The smallest entry is
popped: if its pair still stands there, the right symbol leaves the list and the
two new neighbouring pairs enter the heap; else the entry is stale.  The count is
the number of initial symbols less the number of merges; identifiers are never
put out.  A piece of n bytes costs O(n log n), however long it is.

Texts are cut at single spaces between two characters that are not white space.
No match of the pattern runs over such a cut, so a cut part is counted once and
remembered (bounded memos, which change cost only).

Null and empty texts have no tokens.  Rows are independent: copies, ties, null
keys and extra columns change nothing; columns of the output's names are
replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Remembered parts and pieces per Python worker (about 100 MB each); a full
#: memo starts anew.  Longer strings are counted each time.
MEMO_ENTRIES = 600_000
MEMO_MAX_CHARS = 64
#: Bytes up to which a piece's links are kept in lists.
SHORT_PIECE = 1 << 12
_POS_BITS = 40
_POS_MASK = (1 << _POS_BITS) - 1


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: the
    printable Latin-1 characters for themselves, the other bytes, in order, the
    characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """What counting needs of a tokenizer file: ids of the 256 bytes, merged
    pairs in order of rank, and the strings of added tokens.  A file with steps
    that this operator does not have is refused."""
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    model, pre = doc["model"], doc.get("pre_tokenizer") or {}
    added = doc.get("added_tokens", [])
    unlike = [
        what
        for what, wrong in [
            ("model", model.get("type", "BPE") != "BPE" or model.get("ignore_merges") or model.get("dropout")),
            ("word affixes", model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")),
            ("normalizer", doc.get("normalizer")),
            ("pre-tokenizer", pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)),
            ("added tokens", any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)),
        ]
        if wrong
    ]
    if unlike:
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary: {', '.join(unlike)}")
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {
        "bytes": [vocab[c] for c in byte_alphabet()],
        "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs],
        "added": sorted((a["content"] for a in added), key=len, reverse=True),
    }


def _compact(values) -> array:
    return array("i", values)


class TokenCounter:
    """Counts the tokens of texts; see the module's heading."""

    def __init__(self, vocabulary: dict, pattern: str):
        self.byte_ids = vocabulary["bytes"]
        self.rank: dict[int, int] = {}
        for r, (left, right, _) in enumerate(vocabulary["merges"]):
            self.rank.setdefault(left << 32 | right, r)
        self.merged = [m for _, _, m in vocabulary["merges"]]
        added = vocabulary["added"]
        self.added = added
        self.split_added = regex.compile("|".join(map(regex.escape, added))).split if added else None
        self.find = regex.compile(pattern).findall
        self.space = regex.compile(r"\s").match
        self.pieces: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def count_piece(self, piece: bytes) -> int:
        """Symbols that are left of a piece when no pair merges any more."""
        n = len(piece)
        rank, merged = self.rank, self.merged
        # lists are faster, arrays take 12 bytes a symbol; the heap holds one integer per mergeable pair
        row = list if n <= SHORT_PIECE else _compact
        ids = row(map(self.byte_ids.__getitem__, piece))
        nxt, prv = row(range(1, n + 1)), row(range(-1, n - 1))
        heap = []
        for at in range(n - 1):
            r = rank.get(ids[at] << 32 | ids[at + 1])
            if r is not None:
                heap.append(r << _POS_BITS | at)
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            at, r = top & _POS_MASK, top >> _POS_BITS
            right = nxt[at]
            if ids[at] < 0 or right >= n or rank.get(ids[at] << 32 | ids[right]) != r:
                continue  # one of the two symbols has been merged since
            merges += 1
            ids[at], ids[right] = merged[r], -1
            after = nxt[at] = nxt[right]
            if after < n:
                prv[after] = at
                new = rank.get(ids[at] << 32 | ids[after])
                if new is not None:
                    heappush(heap, new << _POS_BITS | at)
            before = prv[at]
            if before >= 0:
                new = rank.get(ids[before] << 32 | ids[at])
                if new is not None:
                    heappush(heap, new << _POS_BITS | before)
        return n - merges

    def _count_part(self, part: str) -> int:
        """Tokens of a part of a text, cut where no match runs over."""
        memo, total = self.pieces, 0
        for piece in self.find(part):
            k = memo.get(piece)
            if k is None:
                k = self.count_piece(piece.encode())
                if len(piece) <= MEMO_MAX_CHARS:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    memo[piece] = k
            total += k
        return total

    def _parts(self, chunks: list[str]) -> list[str]:
        """Chunks between spaces, glued again where white space meets white space."""
        out, whole = [chunks[0]], bool(chunks[0]) and not self.space(chunks[0][-1])
        for c in chunks[1:]:
            if whole and c and not self.space(c[0]):
                out.append(c)
            else:
                out[-1] += " " + c
            whole = bool(c) and not self.space(c[-1])
        return out

    def _count_plain(self, text: str) -> int:
        chunks = text.split(" ")
        memo = self.parts
        first = chunks.pop(0)
        if first and not self.space(first[-1]):
            try:
                return sum(map(memo.__getitem__, chunks)) + self._count_part(first)
            except KeyError:
                fresh = set(chunks).difference(memo)
            if not any(not c or self.space(c[0]) or self.space(c[-1]) for c in fresh):
                return self._sum_parts(chunks, fresh) + self._count_part(first)
        parts = self._parts([first, *chunks])
        first = parts.pop(0)
        return self._sum_parts(parts, {p for p in parts if p not in memo}) + self._count_part(first)

    def _sum_parts(self, parts: list[str], fresh: set[str]) -> int:
        """Tokens of parts that each follow a space; ``fresh`` are those that
        the memo lacks."""
        memo = self.parts
        counts = {p: self._count_part(" " + p) for p in fresh}
        total = sum([counts[p] if p in counts else memo[p] for p in parts])
        if len(memo) + len(counts) > MEMO_ENTRIES:
            memo.clear()
        if len(counts) <= MEMO_ENTRIES:
            memo.update((p, k) for p, k in counts.items() if len(p) <= MEMO_MAX_CHARS and not self.space(p[-1]))
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; the string of an added token is one token."""
        if not text:
            return 0
        if any(a in text for a in self.added):
            between = self.split_added(text)
            return len(between) - 1 + sum(self._count_plain(t) for t in between if t)
        return self._count_plain(text)


_COUNTERS: dict[tuple, TokenCounter] = {}


def _counter(vocabulary: dict, pattern: str) -> TokenCounter:
    key = (id(vocabulary), pattern)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(vocabulary, pattern)
    return _COUNTERS[key]


def with_token_counts(
    df: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", bytes_col: str = "n_bytes", tokens_col: str = "n_tokens"
) -> DataFrame:
    """``df`` with the UTF-8 length and the token count of ``text_col``.  The
    vocabulary (under 5 MB) is read once on the driver and broadcast; nothing is
    shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    keep = [f for f in df.schema.fields if f.name not in (bytes_col, tokens_col)]
    schema = T.StructType([*keep, T.StructField(bytes_col, T.LongType()), T.StructField(tokens_col, T.LongType())])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]):
        counter = _counter(shared.value, pattern)
        for batch in batches:
            texts = batch.column(text_col)
            sizes, counts = [], []
            for scalar in texts:  # one text at a time as a Python string
                text = scalar.as_py() or ""
                sizes.append(len(text.encode()))
                counts.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=schema.names
            )

    return df.mapInArrow(run, schema)
