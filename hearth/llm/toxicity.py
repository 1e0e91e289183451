"""Toxicity scores with noisy-channel deobfuscation.

The channel: letters may be written as look-alike digits and signs, be spaced
out, be repeated, or be interrupted by signs.  A suspicious token becomes a
lattice of readings, and Viterbi decoding under a character trigram model of
the whole corpus picks the likeliest ones.  The score is that of the text plus
its restored tokens.

The classifier sums log-odds of words and word beginnings that occur more often
in toxic labelled documents; the sum's threshold is set on the same training
rows, and the score is the logistic function of the distance from it.  Only
labelled rows for which crc32(id as text) mod 5 is not 0 are learned from, at
most ``TRAIN_ROWS`` of them, picked by hash.  Character counts are taken over
all documents.

Null and empty texts score as texts without any such word; ids that are null
are not held out; without labels every score is below 0.5.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import textkernel as tk
from hearth.llm.pii import _FOLD, _INVISIBLE

#: Labelled rows to learn from, the bound of the training sample.
TRAIN_ROWS = 40_000
#: The toxic documents each feature must occur in, and the log-likelihood ratio
#: of its counts, so that chance finds stay out whatever the number of labels
#: (20 has a chance of 8 in a million).
MIN_TOXIC = 3
MIN_RATIO = 20.0
MIN_WEIGHT = 2.0
BEGINNINGS = (4, 5, 6)
#: Columns of a lattice that are decoded at once; longer ones in pieces that
#: overlap by half.
PIECE = 96
#: Likeliest readings of a token that are scored.
READINGS_KEPT = 3

# What a sign may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¢": "c", "#": "h",
}
_DROPPED = "*._-'~^`\"/\\,:;="
_SIGNS = re.escape("".join(READINGS) + _DROPPED)
_LETTER = r"[^\W\d_]"
#: a sign before a letter, or a look-alike beside letters anywhere; runs of one
#: letter; letters and look-alikes, maybe repeated, spaced out one by one
_LIKE = re.escape("".join(READINGS))
_ODD = re.compile(rf"[{_SIGNS}](?={_LETTER})|{_LETTER}.*[{_LIKE}]|({_LETTER})\1\1")
_UNIT = rf"(?:{_LETTER}|[{_LIKE}])"
_SPACED = re.compile(rf"(?<!\w)({_UNIT})\1*(?:[ .*_\-]{{1,2}}({_UNIT})\2*){{2,}}(?!\w)")
_ANY_LETTER = re.compile(_LETTER)
_TRIM = _DROPPED + "!?()[]{}<>"
_TRIM_LEFT = "".join(c for c in _TRIM if c not in READINGS)  # "!" and "(" may stand for a first letter

# character classes of the trigram model: a-z, word bound, others
_CLASSES = 28
_CLASS = np.full(256, 27, np.int64)
_CLASS[[ord(c) for c in " \t\n\r\x0b\x0c.,;:!?()[]{}\"'-"]] = 26
for _c in range(26):
    _CLASS[ord("a") + _c] = _CLASS[ord("A") + _c] = _c


def _class(c: str) -> int:
    return int(_CLASS[ord(c)]) if c.isascii() else 27


def char_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of character classes over all texts; 28**3 cells."""

    def run(batches):
        total = np.zeros(_CLASSES**3, np.int64)
        for batch in batches:
            for _, _, data, offs in tk.pieces(batch.column(0)):
                for at in range(0, len(data), tk.CHUNK):  # pieces overlap by two
                    c = _CLASS[data[at : at + tk.CHUNK + 2]]
                    if len(c) > 2:
                        total += np.bincount(c[:-2] * (_CLASSES * _CLASSES) + c[1:-1] * _CLASSES + c[2:], minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    rows = docs.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_CLASSES**3, np.int64)
    for r in rows:
        out[r.cell] = r.n
    return out


class CharModel:
    """Smoothed log-probabilities of a class after two classes."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(float)
        pairs = n.sum(axis=0)
        back = (pairs + 0.5) / (pairs + 0.5).sum(axis=1, keepdims=True)
        self.logp = np.log((n + 5 * back[None]) / (n + 5 * back[None]).sum(axis=2, keepdims=True))

    def decode(self, lattice: list[list[tuple[str, float]]], best: int = READINGS_KEPT) -> list[str]:
        """The likeliest paths, Viterbi with ``best`` survivors a state; a
        column lists (reading, cost) pairs."""
        state = {(26, 26): [(0.0, "")]}
        for column in [*lattice, [(" ", 0.0)]]:
            step: dict[tuple[int, int], list[tuple[float, str]]] = {}
            for (p, q), paths in state.items():
                for reading, cost in column:
                    a, b, s = p, q, -cost
                    for c in reading:
                        k = _class(c)
                        s += self.logp[a, b, k]
                        a, b = b, k
                    step.setdefault((a, b), []).extend((score + s, text + reading) for score, text in paths)
            state = {k: sorted(set(v), reverse=True)[:best] for k, v in step.items()}
        last = sorted((x for v in state.values() for x in v), reverse=True)
        return list(dict.fromkeys(text.strip() for _, text in last))[:best]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Readings of each run of a token's characters."""
    out, i = [], 0
    while i < len(token):
        c = token[i]
        j = i
        while j < len(token) and token[j] == c:
            j += 1
        if c in READINGS:
            one = [(r, 0.5) for r in READINGS[c]] + [(c, 6.0), ("", 14.0)]
            out += [[*one, *((r + r, 1.0) for r in READINGS[c])]] if j - i >= 3 else [one] * (j - i)
        elif c in _DROPPED or c.isspace():  # a word may end there, the likelier the wider the gap
            out.append([("", 0.0), (" ", 1.0)] if j - i == 1 else [("", 1.0), (" ", 0.0)])
        elif j - i >= 3:
            out.append([(c, 0.0), (c + c, 0.5)])
        else:
            out += [[(c, 0.0)]] * (j - i)
        i = j
    return out


def suspicious(text: str) -> list[str]:
    """Tokens of a text that may hide a word, lower-cased, without repeats."""
    low = text.lower()
    if not low.isascii():
        low = low.translate(_FOLD)
        for c in _INVISIBLE:
            if c in low:
                low = low.replace(c, "")
    found = [t for w in dict.fromkeys(low.split()) if (t := _token(w))]
    found += [m[0] for m in _SPACED.finditer(low) if _ANY_LETTER.search(m[0])]
    changed = low.split() if low != text.lower() else []
    return list(dict.fromkeys(found + changed))


_TOKENS: dict[str, str] = {}


def _token(word: str) -> str:
    """The word without punctuation around it if it may hide another, or ""."""
    if word not in _TOKENS:
        if len(_TOKENS) > 200_000:
            _TOKENS.clear()
        token = word.rstrip(_TRIM).lstrip(_TRIM_LEFT)
        _TOKENS[word] = token if len(token) >= 3 and _ODD.search(token) else ""
    return _TOKENS[word]


def readings(token: str, model: CharModel) -> list[str]:
    """The likeliest readings of a token, those of its pieces if it is long.
    Words that a piece's bound cuts are whole in the piece before or after."""
    columns = lattice(token)
    if len(columns) <= PIECE:
        return model.decode(columns)
    out = []
    for at in range(0, len(columns) - PIECE // 2, PIECE // 2):
        for reading in model.decode(columns[at : at + PIECE]):
            words = reading.split()
            if len(words) >= 3:
                words = words[at > 0 : len(words) - (at + PIECE < len(columns))]
            out.append(" ".join(words))
    return list(dict.fromkeys(out))


_SEEN: dict[str, list[str]] = {}


def restored(text: str, model: CharModel) -> list[str]:
    """The likeliest readings of a text's suspicious tokens."""
    if len(_SEEN) > 200_000:
        _SEEN.clear()
    out = []
    for token in suspicious(text):
        if token not in _SEEN:
            _SEEN[token] = readings(token, model)
        out += _SEEN[token]
    return out


def features(texts: pa.Array):
    """Per piece: (feature hashes, rows they occur in): words and beginnings."""
    for lo, _, data, offs in tk.pieces(texts):
        at, end, hashes = tk.words(data, offs[1:-1], tk.IS_ALNUM)
        row = np.searchsorted(offs, at, side="right") - 1 + lo
        parts, rows = [hashes], [row]
        for size in BEGINNINGS:
            h, which = tk.prefix_hashes(data, at, end, size)
            parts.append(h)
            rows.append(row[which])
        yield np.concatenate(parts), np.concatenate(rows)


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(sorted feature hashes, weights, threshold) of the classifier."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    rows = rows.groupBy(key).agg(F.max(label_col).alias("y"))
    sample = rows.orderBy(F.xxhash64(key)).limit(TRAIN_ROWS)  # the bound that lets it be broadcast
    known = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text_col}`").alias("t")).join(F.broadcast(sample), key).select("t", F.col("y").cast("long"))

    def count(batches):
        parts = []
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for h, r in features(batch.column(0)):
                pair = np.unique(np.rec.fromarrays([h, r]))
                parts.append((pair["f0"], y[pair["f1"]]))
        if parts:
            h, y = (np.concatenate(x) for x in zip(*parts, strict=True))
            ids, inverse = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.view(np.int64)), pa.array(np.bincount(inverse, y > 0, len(ids)).astype(np.int64)), pa.array(np.bincount(inverse, y == 0, len(ids)).astype(np.int64))],
                names=["f", "toxic", "clean"],
            )

    total = known.agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.sum(F.when(F.col("y") > 0, 0).otherwise(1))).first()
    n_toxic, n_clean = total[0] or 0, total[1] or 0
    counts = known.mapInArrow(count, "f long, toxic long, clean long").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    share = n_toxic / max(1, n_toxic + n_clean)
    t, c, n = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    ratio = 2 * (t * F.log(t / (n * F.lit(share))) + F.when(c > 0, c * F.log(c / (n * F.lit(1 - share)))).otherwise(0.0))
    top = (
        counts.where((t >= MIN_TOXIC) & (ratio >= MIN_RATIO)).withColumn("w", weight).where(F.col("w") >= MIN_WEIGHT).collect()
    )  # words of the sample's toxic rows, which bounds them
    ids = np.array([r.f for r in top], np.int64).view(np.uint64)
    order = np.argsort(ids)
    ids, weights = ids[order], np.array([r.w for r in top], float)[order]
    model = (ids, weights)

    def sums(batches):
        for batch in batches:
            s = evidence(batch.column(0), *model)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(s, 1)), batch.column(1)], names=["s", "y"])

    seen = known.mapInArrow(sums, "s double, y long").groupBy("s").agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("p"), F.count("*").alias("n"))
    return ids, weights, _threshold(seen.collect())


def _threshold(rows) -> float:
    """Between two sums, where training errors are fewest (of several places
    the widest gap); above all sums if nothing is toxic."""
    rows = sorted((r.s, r.p, r.n - r.p) for r in rows)
    below, above = 0, sum(c for _, _, c in rows)
    best = (above, 0.0, -1.0)  # everything toxic
    for i, (s, p, c) in enumerate(rows):
        below, above = below + p, above - c
        gap = (rows[i + 1][0] - s) if i + 1 < len(rows) else 4.0
        best = min(best, (below + above, -gap, s + gap / 2))
    return best[2] if rows and any(p for _, p, _ in rows) else 4.0


def evidence(texts: pa.Array, ids: np.ndarray, weights: np.ndarray, extra: list[list[str]] | None = None) -> np.ndarray:
    """Per text the summed weights of its distinct features."""
    out = np.zeros(len(texts))
    if not len(ids):
        return out
    found = []
    sources = [texts] if extra is None else [texts, pa.array([" ".join(x) for x in extra])]
    for source in sources:
        for h, r in features(source):
            at = np.searchsorted(ids, h)
            at[at == len(ids)] = 0
            hit = ids[at] == h
            found.append((r[hit].astype(np.int64) << 32) | at[hit])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    np.add.at(out, pairs >> 32, weights[pairs & 0xFFFFFFFF])
    return out


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: key, held_out, score, predicted, restored (readings of
    suspicious tokens)."""
    ids, weights, threshold = train(docs, labels, key, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast((ids, weights, threshold, char_counts(docs, text_col)))
    slim = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text_col}`").alias("t"), held_out(key).alias("held_out"))
    schema = T.StructType([
        slim.schema[key], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()), T.StructField("restored", T.ArrayType(T.StringType())),
    ])

    def run(batches):
        ids, weights, threshold, counts = shared.value
        model = CharModel(counts)
        _SEEN.clear()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1)
                extra = [restored(t, model) if t else [] for t in texts.to_pylist()]
                s = np.clip(evidence(texts, ids, weights, extra) - threshold, -30, 30)
                p = 1 / (1 + np.exp(-s))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(extra, pa.list_(pa.string()))],
                    names=schema.names,
                )

    return slim.mapInArrow(run, schema)
