import random
import re
from collections import Counter

import pytest

from hearth.llm import collocations

import brute
from llm_data import make_docs

SCHEMA = "lang string, text string, h1 string"


def plain(rows, min_count=10, limit=2000):
    """By the definition; ``rows`` are (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    out = {}
    for (lang, p), a in cand.items():
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        longer = [b for (g, q), b in cand.items() if g == lang and len(q) > len(p) and p in (q[:2], q[1:])] if len(p) == 2 else []
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i + 1, ph.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, ph, l, r) in enumerate(sorted(x)[:limit])
    )


def some_rows(seed, n):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "of", "cat", "sat", "Ünï", "日本", "a-b", "x\x0by"] + [f"w{i}" for i in range(12)]
    weights = [30, 5, 12] + [3] * (len(vocabulary) - 3)
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "; ", "!?", "\r\n"]
    rows = []
    for _ in range(n):
        words = rnd.choices(vocabulary, weights, k=rnd.randint(0, 120))
        rows.append((rnd.choice(["en", "en", "en", "de", None, "und"]), "".join(w + rnd.choice(gaps) for w in words), "x"))
    return rows


@pytest.mark.parametrize(("budget", "listed"), [(1 << 21, 1 << 20), (200, 1 << 20), (20, 1 << 20), (64, 8), (1, 1)])
def test_any_budget_gives_the_same_phrases(spark, budget, listed):
    rows = some_rows(1, 150) + [("en", None, None), (None, "", None), ("en", "of the " * 400, "x")]
    got = collocations.mine(make_docs(spark, rows, SCHEMA), budget=budget, listed=listed)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain([r[:2] for r in rows])


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_WORDS", 50)
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 120)
    monkeypatch.setattr(collocations, "FLUSH_DISTINCT", 5)
    rows = some_rows(2, 20) + [("en", " ".join(random.Random(3).choices(["a", "b", "c", "of", "the"], k=3000)), "x")]

    class Rows:  # the patched values hold in this process, where no worker runs
        def __init__(self, rows):
            import pyarrow as pa

            self.batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows]), pa.array([r[0] for r in rows])], names=["text", "lang"])

    want = Counter()
    for lang, text, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(brute.LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", x) for x in w)
    got = Counter()
    for b in collocations._count_words(iter([Rows(rows).batch])):
        for r in b.to_pylist():
            got[r["lang"], r["word"]] += r["c"]
    assert got == want


def test_ties_and_limit(spark):
    rows = [("en", ". ".join(f"a{i} b{i}" for i in range(9)), "")] * 10 + [("de", "p q. " * 10, "")]
    got = collocations.mine(make_docs(spark, rows, SCHEMA), limit=4).collect()
    assert sorted(map(tuple, got)) == plain([r[:2] for r in rows], limit=4)


def test_counts_past_64_bits(spark):
    a, left, right = 9 * 10**12, 95 * 10**11, 10**13 + 7
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(collocations._ratio("a", "l", "r").alias("s")).first().s == 10**6 * a * a // (left * right)


def test_empty_table(spark):
    assert collocations.mine(make_docs(spark, [], SCHEMA)).count() == 0
