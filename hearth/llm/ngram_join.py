"""N-gram Jaccard join of documents: 5-word shingle sets, Jaccard >= 0.8.

Candidates come from the prefixes under the rare-first order and must also
share prefix tokens under two further, independent global orders; the prefixes
are kept with each set, so the filters are intersected before a whole set is
read.  See ``setjoin`` for how buckets are kept linear.

Null, empty and word-less texts have no set and link with nothing; a text of
fewer than five words is one shingle.  Copies share a set.  Rows that repeat id
and text are one document.  A null id gets the smallest id of its group, null
if there is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.setjoin import ADDRESS, SetJoin, addressed
from hearth.llm.tables import bit_of, bitmap, components, maybe_in, quoted, saved, scratch

#: Global orders besides the rare-first one.
FURTHER_ORDERS = 2


def links(join: SetJoin) -> DataFrame:
    """Links between different sets, enough for every component: a bucket's
    members that are already connected are not compared again, all others are."""
    tried = saved(join.proposals(), "tried")
    first = join.verified(tried)
    comp = components(first).withColumnRenamed("id", "set")
    marked = join.live.select("k", "set", "np").join(comp, "set", "left").select("k", "set", "np", F.coalesce("comp", "set").alias("comp"))
    marked = saved(marked, "marked")
    mixed = marked.groupBy("k").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("k")
    open_rows = marked.join(mixed, "k", "left_semi")
    pairs = join.rest(open_rows, (F.col("x.set") < F.col("y.set")) & (F.col("x.comp") != F.col("y.comp")))
    more = join.verified(pairs.join(tried, ["a", "b"], "left_anti"))
    return first.unionByName(more)


def linked(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: key, its address, n_shingles and component_id."""
    with scratch(docs.sparkSession):
        return saved(_linked(docs, key, text_col), "linked", keep=True)


def _linked(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    join = SetJoin(addressed(docs.select(*dict.fromkeys([key, text_col])), key, text_col), key, text_col, by_line=False, orders=FURTHER_ORDERS)
    comp = components(links(join)).withColumnRenamed("id", "set")
    rows = join.sets.select("id", ADDRESS, F.col("n").alias("n_shingles"), "set")
    full = rows.where("n_shingles > 0")
    first = full.groupBy("set").agg(F.min("id").alias("first")).join(comp, "set", "left").withColumn("comp", F.coalesce("comp", "set"))
    first = saved(first, "first")
    smallest = first.groupBy("comp").agg(F.min("first").alias("component_id"))
    of_set = first.join(smallest, "comp").select("set", "component_id")
    out = full.join(of_set, "set").select("id", ADDRESS, "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("id", ADDRESS, "n_shingles", F.col("id").alias("component_id"))
    return out.unionByName(alone)


def keep_one_of_group(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose group has one with a smaller id
    (of equal ids: a smaller address); same columns."""
    rows = linked(docs, key, text_col).where("n_shingles > 0")
    best = rows.where("id <=> component_id").groupBy("component_id").agg(F.min(ADDRESS).alias("best"))
    gone = rows.join(best, rows["component_id"].eqNullSafe(best["component_id"]))
    gone = saved(gone.where(F.col(ADDRESS) != F.col("best")).select(ADDRESS).distinct(), "gone")
    maybe, never = maybe_in(addressed(docs, key, text_col), bitmap(gone, bit_of(ADDRESS)), ADDRESS)
    kept = maybe.join(gone, ADDRESS, "left_anti").select(*quoted(docs.columns))
    return kept.unionByName(never.select(*quoted(docs.columns)))
