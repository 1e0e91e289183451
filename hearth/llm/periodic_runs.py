"""Periodic runs of words: maximal stretches whose words repeat at a distance.

A run of period q is a stretch of at least ``max(min_length, 4 * q)`` words with
smallest period q that no neighbouring word extends.  Work is tiled by scale.
Octave k covers the periods from S = 2**k below 2 * S; its tile boundaries stand
S words apart, and a tile reaches S words to the left and 4 * S to the right of
its boundary c, so neighbouring tiles overlap.

* A tile is solved on its own by two Z-functions from its boundary: for every
  period of the octave, how far word i equals word i + q to the right of c (up
  to 2 * S) and to the left (up to S).  Both together are an interval of equal
  places, a fragment.
* A run has 3 * S equal places or more, so at least one of its boundaries has S
  of them to its right, and those that do cover all of it.  A comparison of the
  first words to the right of all boundaries, for all periods of the octave at
  once, therefore finds the tiles that need solving.
* Fragments are shuffled by document and period and stitched where they touch.
  A stretch found under several periods has the smallest of them.

Documents of up to ``PIECE_WORDS`` words are solved where they are read; a longer
one is cut into pieces, several octaves together or, for long periods, one
octave alone, which are dealt over the cluster.  Words are compared exactly, by
numbers given within the document.  No task holds more than a document.

Null and empty texts have no words and no runs.  Rows are known by key and text:
repeated rows share their runs, null and repeated keys are allowed, keys may
have any type with a text form.  Extra columns pass through; columns of the
output's names are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.tables import bit_of, bitmap, maybe_in, quoted, saved

#: Words of a piece that is solved in one go; longer documents are dealt out.
PIECE_WORDS = 1 << 16
#: Words of small documents that are compared together, and cells at a time.
BATCH_WORDS = 1 << 18
CELLS = 1 << 19
#: Rows whose results are held at a time.
SLICE_ROWS = 512
#: Words to the right of a boundary compared before a tile is solved.
FIRST_WORDS = 8
EXPONENT = 4

#: ``rewrite(key, n)``: the order of words in which a text of n words is read, or None.
Rewrite = Callable[[object, int], "np.ndarray | None"]

_FOUND = "__key binary, part int, period long, lo long, hi long, first long, core_lo long, core_hi long, n long, octave int, octaves int, ids binary"
_ARROW_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "period", "length")]))
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "period", "length")]))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of anything but \\x20 and \\x09-\\x0D."""
    return text.split() if text else []


def z_function(s: list) -> list[int]:
    """For each place the length of the longest common prefix with the whole."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _solve_tile(w: np.ndarray, start: int, end: int, c: int, step: int) -> list[tuple[int, int, int]]:
    """Fragments (period, lo, hi) of the tile at ``c`` for the periods from
    ``step`` below ``2 * step``; words of other texts lie before ``start`` and
    from ``end`` on."""
    a, e = max(start, c - step), min(end, c + 2 * step)
    ahead = z_function(w[c : min(end, c + 4 * step)].tolist())
    back = w[a:c][::-1].tolist()
    behind = z_function([*back, -1, *w[a:e][::-1].tolist()])
    out = []
    for q in range(step, min(2 * step, len(ahead))):
        right = min(ahead[q], 2 * step)
        if right >= step:
            out.append((q, c - behind[len(back) + 1 + e - c - q], c + right))
    return out


def _open_tiles(w: np.ndarray, bounds: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """Which boundaries have, for some period of the octave, equal words at the
    first places to their right; ``step`` such places must lie before the end."""
    found = []
    rows = max(1, CELLS // step)
    periods = np.arange(step, 2 * step)
    for lo in range(0, len(bounds), rows):
        c, e = bounds[lo : lo + rows], ends[lo : lo + rows]
        at = c[:, None] + periods[None, :]
        fits = at + step <= e[:, None]
        same = fits & (w[np.where(fits, at, 0)] == w[c][:, None])
        r, p = np.nonzero(same)
        for t in range(1, min(step, FIRST_WORDS)):
            keep = w[c[r] + t] == w[c[r] + periods[p] + t]
            r, p = r[keep], p[keep]
        found.append(np.unique(r) + lo)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _stitched(rows: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(unit, period, lo, hi) with touching intervals of a unit and period made one."""
    out: list[tuple[int, int, int, int]] = []
    for u, q, lo, hi in sorted(set(rows)):
        if out and out[-1][:2] == (u, q) and lo <= out[-1][3]:
            out[-1] = (u, q, out[-1][2], max(hi, out[-1][3]))
        else:
            out.append((u, q, lo, hi))
    return out


def _solve(w: np.ndarray, starts: np.ndarray, ends: np.ndarray, cores: list[tuple[int, int]] | None, octaves: range, origin: np.ndarray):
    """Stitched fragments of units that lie one after another in ``w``.  Tile
    boundaries are multiples of the step in the unit's document, whose word
    ``origin`` the unit starts with; ``cores`` limits them (document words)."""
    rows = []
    size = ends - starts + origin
    for k in octaves:
        step = 1 << k
        units = np.flatnonzero(size >= EXPONENT * step)
        if not len(units):
            break
        first = np.array([cores[u][0] for u in units]) if cores else np.zeros(len(units), np.int64)
        last = np.minimum(np.array([cores[u][1] for u in units]) if cores else size[units], size[units] - 2 * step + 1)
        j0 = -(-first // step)
        count = np.maximum(0, -(-last // step) - j0)
        unit = np.repeat(units, count)
        j = np.repeat(j0 - (np.cumsum(count) - count), count) + np.arange(len(unit))
        shift = starts[unit] - origin[unit]
        bounds = j * step + shift
        for i in _open_tiles(w, bounds, ends[unit], step).tolist():
            u, s = int(unit[i]), int(shift[i])
            rows += [(u, q, lo - s, hi - s) for q, lo, hi in _solve_tile(w, int(starts[u]), int(ends[u]), int(bounds[i]), step)]
    return _stitched(rows)


def _bands(n: int, piece: int) -> Iterator[tuple[int, int, int]]:
    """(first octave, number of octaves, words of a core) for a text of n words:
    the octaves with short tiles together, longer ones each alone."""
    together = max(1, (piece >> 3).bit_length())
    yield 0, together, piece
    k = together
    while EXPONENT << k <= n:
        yield k, 1, max(piece, 4 << k)
        k += 1


def _numbered(text: bytes | None, key, rewrite: Rewrite | None) -> np.ndarray:
    words = words_of(text)
    number = {x: i for i, x in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    order = rewrite(key, len(words)) if rewrite and words else None
    return ids if order is None else ids[order]


def _rows(found: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _FOUND.split(", ")]
    kinds = [pa.binary(), pa.int32(), *[pa.int64()] * 7, pa.int32(), pa.int32(), pa.binary()]
    cols = list(zip(*found, strict=True)) if found else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


def _long_enough(q: int, places: int, min_length: int) -> bool:
    return places + q >= max(min_length, EXPONENT * q)


def _scan(piece: int, min_length: int, rewrite: Rewrite | None):
    """Per batch of (key, text, row key): fragments of the documents that are
    one piece, and the pieces of longer ones (``part`` above 0, with ids)."""

    def run(batches):
        for batch in _sliced(batches):
            keys, texts, names = batch.column(0), batch.column(1), batch.column(2)
            group, size, out = [], 0, []

            def flush(group):
                if not group:
                    return []
                ids = [g[1] for g in group]
                ends = np.cumsum([len(x) for x in ids])
                starts = ends - [len(x) for x in ids]
                w = np.concatenate(ids)
                got = _solve(w, starts, ends, None, range(64), np.zeros(len(ids), np.int64))
                return [
                    (group[u][0], 0, q, lo, hi, None, None, None, None, None, None, None)
                    for u, q, lo, hi in got
                    if _long_enough(q, hi - lo, min_length)
                ]

            for key, text, name in zip(keys, texts, names, strict=True):
                ids = _numbered(text.as_py(), key.as_py(), rewrite)
                n = len(ids)
                if n < min_length:
                    continue
                if n <= piece:
                    group.append((name.as_py(), ids))
                    size += n
                    if size >= BATCH_WORDS:
                        out += flush(group)
                        group, size = [], 0
                    continue
                part = 0
                for k, octaves, core in _bands(n, piece):
                    reach = 1 << (k + octaves - 1)
                    for lo in range(0, n, core):
                        part += 1
                        a, b = max(0, lo - reach), min(n, lo + core + 4 * reach)
                        row = (name.as_py(), part, None, None, None, a, lo, min(n, lo + core), n, k, octaves, ids[a:b].tobytes())
                        yield _rows([row])
            yield _rows(out + flush(group))

    return run


def _solve_pieces(min_length: int):
    """Fragments of dealt pieces: those that are long enough or reach the edge
    of the piece's core, beyond which another piece may go on."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                w = np.frombuffer(r["ids"], np.int32)
                core = (r["core_lo"], r["core_hi"])
                octaves = range(r["octave"], r["octave"] + r["octaves"])
                got = _solve(w, np.array([0]), np.array([len(w)]), [core], octaves, np.array([r["first"]]))
                out += [
                    (r["__key"], r["part"], q, lo, hi, None, None, None, None, None, None, None)
                    for _, q, lo, hi in got
                    if lo < core[0] or hi >= core[1] or _long_enough(q, hi - lo, min_length)
                ]
            yield _rows(out)

    return run


def _row_key(key: str, text_col: str) -> Column:
    """Rows with equal key and text have the same runs."""
    k = F.col(f"`{key}`").cast("string")
    head = F.when(k.isNull(), F.lit("-")).otherwise(F.concat(F.length(k).cast("string"), F.lit(":"), k))
    return F.unhex(F.md5(F.concat(head, F.lit("|"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def _keyed(df: DataFrame, key: str, text_col: str) -> DataFrame:
    return df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text_col}`").cast("binary").alias("text"), _row_key(key, text_col).alias("__key")
    )


def _runs(df: DataFrame, key: str, text_col: str, min_length: int, rewrite: Rewrite | None, piece: int) -> DataFrame:
    """(__key, start, length, period), one row per run and distinct row of ``df``."""
    found = saved(_keyed(df, key, text_col).mapInArrow(_scan(piece, min_length, rewrite), _FOUND), "tiles")
    pieces = found.where("part > 0").repartition("__key", "part").mapInArrow(_solve_pieces(min_length), _FOUND)
    cols = ["__key", "period", "lo", "hi"]
    fragments = found.where("part = 0").select(cols).unionByName(pieces.select(cols))
    # a document and period has at most a few fragments per piece of the document
    line = Window.partitionBy("__key", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = fragments.withColumn("opens", F.coalesce(F.col("lo") > reach, F.lit(True)).cast("int"))
    numbered = opens.withColumn("part", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("__key", "period", "part").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
    length = F.col("hi") - F.col("start") + F.col("period")
    long = whole.select("__key", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(min_length), EXPONENT * F.col("period"))
    )
    return long.groupBy("__key", "start", "length").agg(F.min("period").alias("period"))


def find_runs(
    df: DataFrame, key: str = "doc_id", text_col: str = "text", min_length: int = 6, rewrite: Rewrite | None = None, piece: int = PIECE_WORDS
) -> DataFrame:
    """One row per run: key, start (word number), length, period; for repeated
    rows of key and text once."""
    runs = _runs(df, key, text_col, min_length, rewrite, piece)
    keys = df.select(F.col(f"`{key}`"), _row_key(key, text_col).alias("__key")).distinct()
    return runs.join(keys, "__key").select(F.col(f"`{key}`"), "start", "length", "period")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(lo, SLICE_ROWS)


def _collapse(rewrite: Rewrite | None, key: str, text_col: str, names: list[str], listed, past=None):
    """The text without the words that a run repeats.  With ``past``, a bitmap,
    only rows that surely have no run."""

    def run(batches):
        for batch in _sliced(batches):
            if past is not None:
                p = batch.column("__bit").to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(((past.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1) == 0))
            found = batch.column("runs").to_pylist() if listed else [None] * batch.num_rows
            out, sizes = [], []
            for k, text, runs in zip(batch.column(key), batch.column(text_col), found, strict=True):
                words = words_of((text.as_py() or "").encode())
                sizes.append(len(words))
                order = rewrite(k.as_py(), len(words)) if rewrite and words else None
                if order is not None:
                    words = [words[i] for i in order.tolist()]
                if runs:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for r in runs:
                        edge[r["start"] + r["period"]] += 1
                        edge[r["start"] + r["length"]] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                out.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array([r or [] for r in found], _ARROW_RUNS), pa.array(sizes, pa.int64()), pa.array(out, pa.string())],
                names=[*names, "runs", "n_run_words", "collapsed"],
            )

    return run


def with_runs(
    df: DataFrame, key: str = "doc_id", text_col: str = "text", min_length: int = 6, rewrite: Rewrite | None = None, piece: int = PIECE_WORDS
) -> DataFrame:
    """``df`` plus ``runs`` (by start, then period), ``n_run_words`` (words of the
    text) and ``collapsed``: the words that no run repeats, joined by a space.  A
    word goes if some run contains it after that run's first period.

    A document's runs are one list; there are fewer than words.  Texts that
    surely have no run go past the join, told by a bitmap of fixed size."""
    runs = saved(_runs(df, key, text_col, min_length, rewrite, piece), "runs")
    listed = runs.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    names = [c for c in df.columns if c not in ("runs", "n_run_words", "collapsed")]
    added = [T.StructField("runs", RUNS), T.StructField("n_run_words", T.LongType()), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([*[df.schema[c] for c in names], *added])
    marked = df.select(*quoted(names), _row_key(key, text_col).alias("__key"))
    bits = bitmap(listed, bit_of("__key"))
    past = df.sparkSession.sparkContext.broadcast(np.frombuffer(bits, np.uint8))
    some, _ = maybe_in(marked, bits, "__key")
    some = some.join(listed, "__key", "left").mapInArrow(_collapse(rewrite, key, text_col, names, True), schema)
    none = marked.withColumn("__bit", bit_of("__key")).mapInArrow(_collapse(rewrite, key, text_col, names, False, past), schema)
    return some.unionByName(none)
