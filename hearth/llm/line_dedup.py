"""Line dedup: an exact set-similarity join of all lines of a corpus.

A line's tokens are its 5-word shingles; lines match when the Jaccard
similarity of their token sets is at least 0.8.  A line goes if any line before
it matches, before meaning by (document id, row address, line number).  Lines
without words are neither matched nor removed.

The join (``setjoin``) works on distinct sets.  The earliest match of each set
is then proposed to its other matches, which settles nearly all lines; only
sets that still have no earlier match are compared further.

Null and empty texts have no lines to remove; a null id comes after all others;
rows that repeat id and text are one document, and both keep or lose the same
lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.setjoin import ADDRESS, SetJoin, _ordered, addressed, id_type
from hearth.llm.tables import bit_of, bitmap, maybe_in, quoted, saved, scratch

_LAST = (1 << 63) - 1


def _place(kind: str):
    """Place of a line in the corpus that sorts by id (null last), then by row,
    then by line: one number, or a struct if ids are not whole numbers."""
    if kind != "long":
        return F.struct(F.col("id").isNull().alias("none"), "id", F.col(ADDRESS).alias("row"), "unit")
    whole = "decimal(38,0)"
    id_part = F.coalesce(F.col("id"), F.lit(_LAST)).cast("decimal(20,0)") * F.lit(10**18).cast("decimal(19,0)")
    row_part = F.pmod(F.col(ADDRESS), F.lit(10**8)) * F.lit(10**10) + F.col("unit")
    return (id_part.cast(whole) + row_part.cast(whole)).cast(whole)


def matched_lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(address, lines): the numbers, from 0, of the lines that an earlier line
    matches, for documents that have such lines."""
    join = SetJoin(docs, key, text_col, by_line=True)
    lines = join.sets.select(ADDRESS, "unit", "set", _place(id_type(docs, key)).alias("at"))
    every = saved(lines.groupBy("set").agg(F.min("at").alias("first"), F.count("*").alias("lines")), "first")
    first = saved(every.join(join.known.select("set"), "set", "left_semi").drop("lines"), "live_first")

    tried = saved(join.proposals(), "tried")
    found = join.verified(tried)
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = both.join(first.withColumnRenamed("set", "b"), "b").groupBy("a").agg(F.min(F.struct("first", F.col("b").alias("set"))).alias("e"))
    star = saved(_ordered(both.join(known, "a").select(F.col("e.set").alias("a"), "b")), "star")
    more = join.verified(star.join(tried, ["a", "b"], "left_anti"))
    found = found.unionByName(more)

    def best(links: DataFrame) -> DataFrame:
        """(set, best): place of the earliest line that matches a set."""
        both = links.select(F.col("a").alias("set"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("set"), F.col("a").alias("y")))
        return both.join(first.select(F.col("set").alias("y"), F.col("first").alias("best")), "y").groupBy("set").agg(F.min("best").alias("best"))

    near = join.live.select("k", "set", "np").join(first, "set").join(best(found), "set", "left")
    near = near.withColumn("open", F.col("best").isNull() | (F.col("best") >= F.col("first")))
    near = saved(near.select("k", "set", "np", "first", "open"), "near")
    busy = near.groupBy("k").agg(F.max("open").alias("any"), F.min("first").alias("lo"), F.max(F.when(F.col("open"), F.col("first"))).alias("hi"))
    near = near.join(busy.where("any and lo < hi").select("k"), "k", "left_semi")
    pairs = join.rest(near, F.col("x.open") & (F.col("y.first") < F.col("x.first")))
    last = join.verified(pairs.join(tried.unionByName(star), ["a", "b"], "left_anti"))
    found = found.unionByName(last)

    earlier = best(found).join(first, "set").where("best < first").select("set", "best")
    repeated = every.where("lines > 1").select("set", F.col("first").alias("best"))
    cut = saved(earlier.unionByName(repeated).groupBy("set").agg(F.min("best").alias("best")), "cut")
    # only lines of these sets are shuffled; a set with neither copies nor an earlier match is in no row of it
    maybe, _ = maybe_in(lines, bitmap(cut, bit_of("set")), "set")
    return (
        maybe.join(cut, "set").where(F.col("best") < F.col("at")).select(ADDRESS, "unit").distinct()
        .groupBy(ADDRESS).agg(F.array_sort(F.collect_list("unit")).alias("lines"))
    )


def mark_lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__lines``, the numbers of the removed lines (null if
    none).  Only documents that lose lines are shuffled."""
    docs = addressed(docs, key, text_col)
    with scratch(docs.sparkSession):
        gone = saved(matched_lines(docs.select(*dict.fromkeys([key, text_col, ADDRESS])), key, text_col), "gone", keep=True)
    maybe, never = maybe_in(docs, bitmap(gone, bit_of(ADDRESS)), ADDRESS)
    hit = maybe.join(gone.withColumnRenamed("lines", "__lines"), ADDRESS, "left")
    return hit.unionByName(never.withColumn("__lines", F.lit(None).cast("array<bigint>"))).drop(ADDRESS)


def kept_text(text_col: str = "text"):
    """The text without the lines in ``__lines``."""
    text = F.col(f"`{text_col}`")
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("__lines", i.cast("long")))
    return F.when(F.col("__lines").isNull(), text).otherwise(F.array_join(left, "\n"))


def drop_matched_lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the matched lines removed from ``text_col``; same rows and
    columns.  A text that loses all lines is empty.  A whole-number ``n_chars``,
    if there, follows the text."""
    marked = mark_lines(docs, key, text_col).withColumn("__text", kept_text(text_col))
    swap = {text_col: F.col("__text")}
    if "n_chars" in docs.columns and isinstance(docs.schema["n_chars"].dataType, T.IntegralType):
        swap["n_chars"] = F.when(F.col("__lines").isNull(), F.col("n_chars")).otherwise(F.length("__text")).cast(docs.schema["n_chars"].dataType)
    return marked.select(*[swap[c].alias(c) if c in swap else q for c, q in zip(docs.columns, quoted(docs.columns), strict=True)])
