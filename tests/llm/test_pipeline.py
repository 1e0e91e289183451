"""The pipeline against a plain version of its stages, and its contract."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from hearth.llm import bpe
from hearth.llm.queries import RANKS

import brute
from llm_data import SF, make_docs
from test_filters import brute_contamination


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_plain_versions(spark):
    """Each stage on its own input; the last on the whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judge = dict(corpus_pipeline.STAGES)
    good = judge["quality rules"](spark, docs, SF).cache()
    assert good.columns == columns and 0.7 * docs.count() < good.count() < docs.count()

    rows = sorted(rows_of(good))
    lined = judge["line dedup"](spark, good, SF).cache()
    gone = brute.removed_lines(rows)
    expect = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(gone.get(r, [])))) for r, (i, t) in enumerate(rows)]
    assert lined.columns == columns and sorted(rows_of(lined)) == expect

    single = judge["n-gram Jaccard join"](spark, lined, SF).cache()
    keep = {i for i, _, c in brute.joined(expect) if i == c}
    expect = [x for x in expect if x[0] in keep]
    assert single.columns == columns and sorted(rows_of(single)) == expect

    clean = judge["benchmark decontamination"](spark, single, SF).cache()
    bad = {i for i, x in brute_contamination(expect, items).items() if x[4]}
    expect = [x for x in expect if x[0] not in bad]
    assert clean.columns == columns and sorted(rows_of(clean)) == expect

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(RANKS)), special_tokens={})
    coded = {r.doc_id: r for r in judge["byte-level BPE"](spark, clean, SF).collect()}
    assert len(coded) == len(expect)
    for i, t in expect:
        ids = np.array(library.encode_ordinary(t), "<u4")
        assert coded[i].n_tokens == len(ids) and bytes(coded[i].ids) == ids.tobytes()
        assert coded[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_near_duplicates_are_taken_from_what_is_there(spark):
    """Copies that reach the join stage: one of the group stays."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = make_docs(spark, [(i, text, "en", "s", len(text)) for i in (5, 2, 9)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()] == [2]


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)}
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
