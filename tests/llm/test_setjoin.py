import random

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import line_dedup, ngram_join, setjoin, textkernel
from hearth.llm.queries import QUERIES

import brute
from llm_data import SF, docs_rows, make_docs  # noqa: F401

WORDS = [f"w{i}" for i in range(400)]


def near_copies(seed, n=120):
    """Texts with exact copies, copies with edits (near and past the threshold),
    shared lines, short texts and empty ones."""
    rnd = random.Random(seed)
    base = [[rnd.choice(WORDS) for _ in range(rnd.randint(1, 60))] for _ in range(12)]
    shared = " ".join(rnd.choice(WORDS) for _ in range(12))
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(WORDS)
        lines = [" ".join(w[j : j + 15]) for j in range(0, len(w), 15)]
        if rnd.random() < 0.4:
            lines.insert(0, shared)
        rows.append((i, "\n".join(lines).upper() if rnd.random() < 0.2 else "\n".join(lines)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\t\n"), (n + 3, "one two"), (n + 4, "One  TWO\n"), (n + 5, "x\n\nx\nx")]


def joined(spark, rows):
    out = ngram_join.linked(make_docs(spark, rows)).collect()
    return sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=str)


def dropped(spark, rows):
    out = line_dedup.mark_lines(make_docs(spark, rows)).collect()
    return {r.doc_id: list(r["__lines"]) for r in out if r["__lines"]}


@pytest.mark.parametrize("hot", [4096, 3])
def test_join_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(setjoin, "HOT_TOKEN", hot)
    rows = near_copies(hot)
    assert joined(spark, rows) == brute.joined(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    expect = {rows[r][0]: x for r, x in brute.removed_lines(rows).items()}
    assert dropped(spark, rows) == expect


def test_line_dedup_rewrites_text_and_keeps_rows(spark):
    line = "a line of more than five words"
    rows = [(1, f"{line}\nfirst own words here now ok", "x"), (2, f"{line.upper()}\nother words that stay in here", "y"), (3, line, None), (None, line, "z"), (4, None, "n")]
    out = line_dedup.drop_matched_lines(make_docs(spark, rows, "doc_id long, text string, n_chars string"))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: rows[0][1], 2: "other words that stay in here", 3: "", None: "", 4: None}
    assert out.columns == ["doc_id", "text", "n_chars"]


def test_keep_one_of_group(spark):
    a = "one two three four five six seven eight nine ten " * 3
    rows = [(3, a), (1, a), (2, a + "eleven"), (4, "quite other words stand here alone"), (5, None), (6, ""), (None, a)]
    out = ngram_join.keep_one_of_group(make_docs(spark, rows))
    assert sorted(r.doc_id for r in out.collect()) == [1, 4, 5, 6]


def test_ids_of_other_types(spark):
    """Text ids give the groups and lines that whole numbers in the same order give."""
    rows = near_copies(5, 60)
    named = [(f"d{i:04d}", t) for i, t in rows]
    docs = make_docs(spark, named, "doc_id string, text string")
    want = {(f"d{i:04d}", n, f"d{c:04d}") for i, n, c in joined(spark, rows)}
    assert {(r.id, r.n_shingles, r.component_id) for r in ngram_join.linked(docs).collect()} == want
    got = {r.doc_id: list(r["__lines"]) for r in line_dedup.mark_lines(docs).collect() if r["__lines"]}
    assert got == {f"d{i:04d}": x for i, x in dropped(spark, rows).items()}


def test_empty_tables(spark):
    none = make_docs(spark, [])
    assert ngram_join.linked(none).count() == 0
    assert line_dedup.drop_matched_lines(none).count() == 0
    assert ngram_join.keep_one_of_group(none).count() == 0


def test_repeated_ids_and_clashing_columns(spark):
    t = "one two three four five six seven"
    rows = [(1, t, 7, 8), (1, t, 7, 8), (1, "all other words in this text here", 7, 8)]
    docs = make_docs(spark, rows, "doc_id long, text string, `set` int, k int")
    assert sorted((r.n_shingles, r.component_id) for r in ngram_join.linked(docs).collect()) == [(3, 1), (3, 1), (3, 1)]
    assert line_dedup.drop_matched_lines(docs).count() == 3
    assert set(ngram_join.keep_one_of_group(docs).columns) == set(docs.columns)


def test_op6_equals_brute_force(spark, docs_rows):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_join"](spark, SF).collect())
    assert got == sorted(brute.joined(docs_rows))


def test_further_orders_filter_pairs_before_sets_are_read(spark, monkeypatch):
    """Of all star pairs of the buckets, those without a shared prefix token
    under a further order go before the sets are read; no link is among them."""
    rnd = random.Random(8)
    part = lambda n: [rnd.choice(WORDS) for _ in range(n)]
    long, short = [part(40) for _ in range(12)], [part(10) for _ in range(30)]  # short parts are the rarer ones
    rows = [(i, " ".join(sum(rnd.sample(long, 2), []) + short[i // 2])) for i in range(60)]
    rows += [(60 + i, t + (" more" if i % 2 else "")) for i, (_, t) in enumerate(rows[:20])]
    docs = make_docs(spark, rows)
    join = setjoin.SetJoin(setjoin.addressed(docs, "doc_id", "text"), "doc_id", "text", by_line=False, orders=2)
    stars = setjoin._ordered(join.live.select(join.live.rep.alias("a"), join.live.set.alias("b")))
    before = {(r.a, r.b) for r in stars.collect()}
    after = {(r.a, r.b) for r in join.sharing(stars).collect()}
    read = []
    whole = setjoin.SetJoin._sets_of
    monkeypatch.setattr(setjoin.SetJoin, "_sets_of", lambda self, ids: read.append({r.set for r in ids.collect()}) or whole(self, ids))
    links = {(r.a, r.b) for r in join.verified(stars).collect()}
    print("pairs", len(before), "with shared prefixes", len(after), "links", len(links))
    assert links and links <= after < before
    assert read == [{s for pair in after for s in pair}]


def test_prefixes_of_further_orders_share_a_token_at_the_threshold():
    rnd = np.random.default_rng(3)
    for n in (1, 4, 5, 9, 10, 46, 200):
        x = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        cut = len(x) // 9  # replace as many as keeps the Jaccard similarity at 0.8 or more
        y = np.unique(np.r_[x[cut:], rnd.integers(0, 1 << 63, cut, dtype=np.uint64)])
        for order in range(4):
            px, py = (np.frombuffer(setjoin.further_prefixes(v, np.array([0, len(v)]), order, np.array([True]))[0], np.uint32) for v in (x, y))
            assert setjoin.similar(x, y) and setjoin._common(px, py)
    assert setjoin.further_prefixes(x, np.array([0, 0, len(x)]), 0, np.array([True, False])) == [b"", b""]


def test_op3_equals_brute_force(spark, docs_rows):
    expect = {docs_rows[r][0]: x for r, x in brute.removed_lines(docs_rows).items()}
    got = {r.doc_id: [int(x) for x in r.removed_lines.split(",") if x] for r in QUERIES["op3_line_dedup"](spark, SF).collect()}
    assert {k: v for k, v in got.items() if v} == expect


def test_long_text_is_hashed_in_pieces(monkeypatch):
    text = ("word " * 30 + "Übung\n" + "x" * 700 + " ") * 40
    whole = textkernel.words(np.frombuffer(text.encode(), np.uint8), np.zeros(0, np.int64))
    monkeypatch.setattr(textkernel, "CHUNK", 500)
    cut = textkernel.words(np.frombuffer(text.encode(), np.uint8), np.zeros(0, np.int64))
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert len(whole[0]) == len(text.split())


def test_units_of_lines():
    texts = pa.array(["a b\n\nc", None, "", "\nd\n"])
    got = [(r, u, len(h)) for rows, units, woff, hashes in setjoin.unit_chunks(texts, True)
           for r, u, h in zip(rows, units, (hashes[a:b] for a, b in zip(woff[:-1], woff[1:], strict=True)), strict=True)]
    assert got == [(0, 0, 2), (0, 1, 0), (0, 2, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0), (3, 1, 1), (3, 2, 0)]
