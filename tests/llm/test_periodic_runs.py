import hashlib
import random
import re
from collections import defaultdict

import pytest

from hearth.llm import periodic_runs
from hearth.llm.queries import QUERIES, planted_repeats

from llm_data import SF, docs_rows, make_docs  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, min_length=6):
    """By the definition: equal places at every distance, the smallest period kept."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, q, length) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def read(doc_id, text):
    words = WORD.findall(text or "")
    order = planted_repeats(doc_id, len(words)) if words else None
    return words if order is None else [words[i] for i in order]


def expected(doc_id, words):
    runs = plain_runs(words)
    best = min(((-length, s, q) for s, q, length in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    return (doc_id, len(runs), *four, sha(lines), sha(collapsed(words, runs)))


def test_op11_equals_the_definition(spark, docs_rows):
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs_rows)
    short = [(i, t) for i, t in docs_rows if len(t or "") < 40_000]
    assert sum(got[i][1] > 0 for i, _ in short) > len(short) / 20
    for i, t in short:
        assert got[i] == expected(i, read(i, t))


def some_texts(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            unit = [rnd.choice("abcd") for _ in range(rnd.choice([1, 2, 3, 5, 8, 13, 21, 40]))]
            words += (unit * rnd.randint(1, 9))[: rnd.randint(1, 200)] if rnd.random() < 0.7 else unit
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("piece", [6, 32, 100, 1 << 16])
def test_any_cutting_finds_the_same_runs(spark, piece):
    texts = some_texts(3, 120) + ["x " * 700, "a b " * 300 + "c", " ".join("abcdefg"[i % 7] for i in range(900))]
    docs = make_docs(spark, list(enumerate(texts)))
    got = defaultdict(list)
    for r in periodic_runs.find_runs(docs, piece=piece).collect():
        got[r.doc_id].append((r.start, r.period, r.length))
    for i, t in enumerate(texts):
        assert sorted(got[i]) == plain_runs(t.split()), (piece, t)


def test_odd_rows(spark):
    run = "la " * 9
    rows = [
        (1, None, "x", 1), (2, "", None, 2), (3, " \t\n ", "", 3), (None, run, "", 4), (None, None, "", 5), (4, run, "", 6), (4, run, "", 7),
        (4, "other", "", 8), (5, "la la la la la", "", 9), (6, "La la " * 4, "", 10), (7, "é\x0bé\x0cé\ré é é", "", 11),
    ]
    docs = make_docs(spark, rows, "doc_id long, text string, collapsed string, runs int")
    out = periodic_runs.with_runs(docs)
    assert out.columns == ["doc_id", "text", "runs", "n_run_words", "collapsed"]
    got = sorted(((r.doc_id, r.text, r.n_run_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        w = WORD.findall(t or "")
        want.append((i, t, len(w), plain_runs(w), collapsed(w, plain_runs(w))))
    assert got == sorted(want, key=str)


def test_text_keys_and_empty_table(spark):
    docs = make_docs(spark, [("a", "x y " * 4), ("b", "x y")], "doc_id string, text string")
    assert [tuple(r) for r in periodic_runs.find_runs(docs).collect()] == [("a", 0, 8, 2)]
    assert periodic_runs.with_runs(make_docs(spark, [])).count() == 0


def test_z_function():
    rnd = random.Random(8)
    for _ in range(200):
        s = [rnd.choice("ab") for _ in range(rnd.randint(0, 30))]
        z = periodic_runs.z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k
