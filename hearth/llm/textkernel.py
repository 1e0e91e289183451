"""Vectorised text kernels on Arrow string columns.

Texts of a batch are handled as one byte buffer with unit bounds (documents or
lines), so tokenizing and hashing cost a few array passes per byte instead of
Python work per word.  Buffers are cut at whole documents into pieces of about
``CHUNK`` bytes; one longer text is hashed piece by piece, cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Bytes whose words are hashed at once: their 8-byte cells stay in a core's cache.
BLOCK = 1 << 17
SHINGLE = 5

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z count as a-z
_STEP = [np.uint64(x) for x in (_rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1))]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: runs of ASCII letters and digits and of anything from U+0080 on
IS_ALNUM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
#: white space that separates words: \x20 and \x09-\x0D
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different seeds give independent orders."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("up", ())) < n:
        size = max(n, CHUNK)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
    return _POW["up"][:n], _POW["down"][:n]


def pieces(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` for runs of whole texts of about
    ``limit`` bytes; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    buf = texts.buffers()
    offs = np.frombuffer(buf[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None and buf[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def _hash_words(data: np.ndarray, breaks: np.ndarray, word: np.ndarray):
    inside = np.frombuffer(data.tobytes().translate(word.tobytes()), bool)
    n = len(data)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    b = breaks[(breaks > 0) & (breaks < n)]
    before[b] = False
    after[b - 1] = False
    starts = np.flatnonzero(inside > before)
    ends = np.flatnonzero(inside > after) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    cells = np.take(_BYTE, data, mode="clip")
    np.multiply(cells, up, out=cells)
    np.cumsum(cells, out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts])


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the words that are longer, other
    than any word's hash, and which words these are."""
    longer = np.flatnonzero(ends - starts > size)
    out = np.zeros(len(longer), np.uint64)
    for j in range(size):
        out = (out + _BYTE[data[starts[longer] + j]]) * _STEP[j]  # the byte table folds case
    return mix(out, 50 + size), longer


def words(data: np.ndarray, breaks: np.ndarray, word: np.ndarray = IS_WORD):
    """Starts, ends and 64-bit hashes (A-Z as a-z) of the words of a buffer.
    No word runs over a position in ``breaks``.  Buffers are hashed in blocks
    cut after a separator, so memory stays near ``BLOCK`` or the longest word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    out, at = [], 0
    while at < n:
        end, look = min(n, at + BLOCK), 256
        while end < n and word[data[end - 1]]:
            gap = np.flatnonzero(~word[data[end : end + look]])
            end = end + int(gap[0]) + 1 if len(gap) else min(n, end + look)
            look = min(2 * look, CHUNK)
        inside = breaks[(breaks > at) & (breaks < end)]
        s, e, h = _hash_words(data[at:end], inside - at, word)
        out.append((s + at, e + at, h))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def shingles(hashes: np.ndarray, woff: np.ndarray, k: int = SHINGLE):
    """Hashes of the k-word shingles of units whose words are
    ``hashes[woff[i]:woff[i+1]]``; a unit of fewer words, but not none, has its
    whole sequence as one shingle.  Returns (shingle hash, unit, word index)."""
    n = np.diff(woff)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    total = int(counts.sum())
    unit = np.repeat(np.arange(len(n)), counts)
    first = np.cumsum(counts) - counts
    start = np.arange(total) + np.repeat(woff[:-1] - first, counts)
    every = np.full(len(hashes), k, np.uint64)  # a shingle at each word, whatever its unit
    for j in range(k):
        every[: max(0, len(hashes) - j)] += hashes[j:] * _STEP[j]
    out = every[start]
    short = np.flatnonzero((n > 0) & (n < k))
    at, size = woff[:-1][short], n[short]
    whole = size.astype(np.uint64)
    for j in range(k - 1):
        has = size > j
        whole[has] += hashes[at[has] + j] * _STEP[j]
    out[first[short]] = whole
    return mix(out), unit, start


def distinct_sets(tokens: np.ndarray, unit: np.ndarray, n_units: int):
    """Distinct tokens per unit, grouped by unit and sorted by hash.
    ``unit`` must be below 2**16 (see ``CHUNK``)."""
    key = (unit.astype(np.uint64) << np.uint64(48)) | (tokens >> np.uint64(16))
    order = np.argsort(key)
    t, u = tokens[order], unit[order]
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] != t[:-1]) | (u[1:] != u[:-1])
    t, u = t[keep], u[keep]
    off = np.zeros(n_units + 1, np.int64)
    np.cumsum(np.bincount(u, minlength=n_units), out=off[1:])
    return t, u, off


def fingerprint(tokens: np.ndarray, off: np.ndarray) -> np.ndarray:
    """An order-free 64-bit hash of each unit's token set (0 if empty)."""
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens, 11), out=total[1:])
    return (total[off[1:]] - total[off[:-1]]).view(np.int64)
