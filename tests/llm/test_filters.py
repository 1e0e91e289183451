import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from hearth.llm import bpe, decontam, pii, quality, toxicity, url_filter
from hearth.llm.queries import QUERIES, RANKS, URL_RULES

import brute
from llm_data import SF, docs_rows, make_docs  # noqa: F401

PATH = public_tokenizers.path(RANKS)
ODD = [None, "", "a" * 3000, " " * 500, "\n\t \r  x", "日本語テキスト" * 30, "👍🏽👨‍👩‍👧", "'s've it's", "1234567890" * 20, "ab" * 700]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


# --- byte-level BPE


def test_op1_equals_the_library(spark, docs_rows, library):
    got = {r.doc_id: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    for i, t in docs_rows:
        ids = library.encode_ordinary(t or "")
        r = got[i]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_odd_texts_and_round_trip(spark, library):
    rnd = random.Random(1)
    rows = [(i, t, b"x") for i, t in enumerate(ODD + ["".join(rnd.choice("ab é1!\n日😀'") for _ in range(rnd.randint(0, 300))) for _ in range(60)])]
    docs = make_docs(spark, rows, "doc_id long, text string, ids binary")
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns.count("ids") == 1
    got = {r.doc_id: r for r in bpe.decode(coded, PATH).collect()}
    for i, t, _ in rows:
        assert np.frombuffer(got[i].ids, "<u4").tolist() == library.encode_ordinary(t or "")
        assert bytes(got[i].decoded).decode() == (t or "")


def test_bpe_of_empty_table(spark):
    assert bpe.round_trip_digest(make_docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_merges_are_leftmost_minimum():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aaa": 258, b"aab": 259}
    codec = bpe.BytePairCodec(ranks, r"\w+|\W+")
    rnd = random.Random(2)
    for _ in range(300):
        word = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40)))
        parts = [bytes([c]) for c in word.encode()]
        while True:
            best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks), default=None)
            if best is None or word.encode() in ranks:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        expect = [ranks[word.encode()]] if word.encode() in ranks else [ranks[p] for p in parts]
        assert np.frombuffer(codec.merge([word.encode()])[0], "<u4").tolist() == expect


def test_pieces_merged_alone_equal_those_merged_in_lockstep(monkeypatch):
    codec = bpe.BytePairCodec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"aeinorst ") if rnd.random() < 0.9 else rnd.randrange(256) for _ in range(n)) for n in [*range(2, 40), 100, 1000, 5000]]
    pieces += [b"a" * n for n in (2, 3, 4, 5, 8, 9, 4000)]
    alone = [codec.merge([p])[0] for p in pieces]
    monkeypatch.setattr(bpe, "LOCKSTEP_ROWS", 0)
    assert alone == [codec.merge([p])[0] for p in pieces] == codec.merge(pieces)


def test_a_piece_of_a_megabyte():
    codec = bpe.BytePairCodec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    piece = bytes(random.Random(3).choices(b"abcdeinorst", k=1 << 20))
    packed = codec.merge([piece])[0]
    assert codec.decode(packed) == piece
    assert len(packed) < 4 * len(piece)


# --- decontamination

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, k):
    owners = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(brute.LOW))
        for j in range(max(1, len(w) - k + 1) if w else 0):
            owners.setdefault(tuple(w[j : j + k]), set()).add(i)
    sizes, out = {len(x) for x in owners}, []
    for d, t in enumerate(docs):
        w = ALNUM.findall((t or "").translate(brute.LOW))
        out += [(d, j, n, sorted(owners[tuple(w[j : j + n])])) for n in sizes for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in owners]
    return sorted(out)


def test_wu_manber_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(200):
        voc = ["a", "b", "é", "ab", "x1", "日本"][: rnd.randint(1, 6)]
        items = [(str(i), " ".join(rnd.choice(voc) for _ in range(rnd.randint(0, 8)))) for i in range(rnd.randint(0, 6))]
        docs = [". ".join(rnd.choice(voc).upper() for _ in range(rnd.randint(0, 60))) for _ in range(5)]
        index = decontam.WindowIndex(items, 3)
        assert sorted(index.hits([decontam._word_count_and_text(x)[1] for x in docs])) == brute_hits(docs, items, 3)


def brute_contamination(rows, items):
    hits = brute_hits([t for _, t in rows], items, 13)
    out = {}
    for d, (i, t) in enumerate(rows):
        own = [h for h in hits if h[0] == d]
        words = {j + k for _, j, n, _ in own for k in range(n)}
        ids = sorted({x for h in own for x in h[3]})
        n = len(ALNUM.findall((t or "").translate(brute.LOW)))
        out[i] = (n, len(words), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(words) and 20 * len(words) >= n)
    return out


def test_op2_equals_brute_force(spark, docs_rows):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op2_decontamination"](spark, SF).collect()}
    assert got == brute_contamination(docs_rows, items)
    assert any(x[4] for x in got.values())


def test_decontamination_in_blocks_and_edges(spark):
    items = [(1, "one two three"), (2, " ".join(f"w{i}" for i in range(30))), (3, ""), (None, "lone words"), (5, None), (6, "ONE two-three")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "x one two three y"), (2, "w1 " * 30), (3, None), (4, ""), (5, " ".join(f"W{i}," for i in range(5, 25))), (5, "lone words"), (None, "!!")]
    docs = make_docs(spark, [(*r, 1) for r in rows], "doc_id long, text string, hits int")
    whole = decontam.find_windows(docs, bench)
    split = decontam.find_windows(docs, bench, block_bytes=40)
    key = lambda df: sorted(map(str, decontam.contamination(df).collect()))
    assert key(whole) == key(split)
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "None"]
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


# --- URL filter


def brute_rule(url, rules):
    host, path = url_filter.host_and_path(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"), default=None)


def test_url_filter_equals_brute_force(spark):
    rnd = random.Random(4)
    part = lambda: rnd.choice(["a", "b", "net", "org", "example", "en", "x.y"])
    rules = URL_RULES + [url_filter.Rule(".".join(part() for _ in range(rnd.randint(1, 3))), rnd.choice(["", "/", "/en", "/en/a", "/é"]), rnd.choice(["allow", "block"])) for _ in range(40)]
    urls = [None, "", "net", "http://", "http://net", "HTTP://A.Example.NET/en/x?q#f", "http://net?x/", "a://b://net/", "http://x" + ".a" * 2000 + ".net/", "://net/#", "http://.net/"]
    urls += ["http://" + ".".join(part() for _ in range(rnd.randint(1, 4))) + rnd.choice(["", "/", "/en/a/b", "/é?x", "/en#t"]) for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for block in (1_000_000, 7):
        got = {r.page_id: r for r in url_filter.judge(pages, rules, rules_per_block=block).collect()}
        for i, u in enumerate(urls):
            best = brute_rule(u, rules)
            assert (got[i].rule, got[i].verdict) == ((best.text, best.verdict) if best else (None, "allow")), (u, block)
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}


# --- personal data

BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    ok = [
        lambda m: True, lambda m: all(int(x) <= 255 for x in m[0].split(".")),
        lambda m: 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m)), lambda m: 10 <= len(digits(m)) <= 15,
    ]
    return sorted((m.start(), k, m.end()) for k, p in enumerate(BASE) for m in p.finditer(t) if ok[k](m))


def test_base_spans_equal_brute_force(spark, docs_rows):
    rnd = random.Random(5)
    for _ in range(20000):
        t = "".join(rnd.choice("a1@.-+ 2é49") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t)
    got = {r.doc_id: r for r in QUERIES["op7_pii"](spark, SF).collect()}
    for i, t in docs_rows:
        line = pii._line(brute_spans(t or ""))
        assert got[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) <= set(got[i].spans.split(","))


@pytest.mark.parametrize(("text", "hidden", "kind"), [
    ("x john at example dot com y", "john at example dot com", "email"),
    ("x john [at] example (dot) com", "john [at] example (dot) com", "email"),
    ("jоhn@exаmple.com", "jоhn@exаmple.com", "email"),
    ("a.b at example.com.", "a.b at example.com", "email"),
    ("mail jane_doe AT mail DOT example DOT net", "jane_doe AT mail DOT example DOT net", "email"),
    ("call plus one five five five one two three four five six seven", "plus one five five five one two three four five six seven", "phone"),
    ("ip one nine two dot one six eight dot zero dot one", "one nine two dot one six eight dot zero dot one", "ip"),
    ("４１１１ １１１１ １１１１ １１１１", "４１１１ １１１１ １１１１ １１１１", "card"),
    ("+1 555 O12 3456 7l1", "+1 555 O12 3456 7l1", "phone"),
])
def test_disguised_data_maps_back_to_the_source(text, hidden, kind):
    spans = [(text[a:b], pii.KINDS[k]) for a, k, b in pii.added_spans(text, pii.base_spans(text))]
    assert (hidden, kind) in spans
    assert hidden not in pii.redact(text)


def test_plain_prose_has_no_added_spans(docs_rows):
    for t in ["look at example.com now", "one two three", "meet at the dot. At noon", *(t or "" for _, t in docs_rows)]:
        assert pii.added_spans(t, pii.base_spans(t)) == []


def test_pii_is_linear_and_null_safe(spark):
    import time

    for t in ["1" * 100000, "@" * 100000, "a" * 100000, "+1" * 50000, "1." * 50000, "[at" * 30000, "a@" * 50000]:
        t0 = time.process_time()
        pii.added_spans(t, pii.base_spans(t))
        assert time.process_time() - t0 < 3
    r = pii.find_spans(make_docs(spark, [(None, None), (1, "")])).collect()
    assert {(x.n_email, x.spans) for x in r} == {(0, "")}


# --- toxicity


def test_op8_held_out_accuracy(spark):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.98 * len(rows)
    recall = [r.predicted for r in rows if r.toxic]  # a few rows marked toxic have no word of the kind
    assert sum(recall) >= 0.9 * len(recall)


def test_disguised_words_score_like_plain_ones(spark):
    words = "the quick brown fox jumps over lazy dogs while nice people read idiot books and stupid papers".split()
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(200):
        w = [rnd.choice(words[:12]) for _ in range(30)]
        if i % 4 == 0:
            w[5] = rnd.choice(["idiot", "stupid"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    tests = ["you 1d10t there", "so s t u p i d today", "st*u*pid nice", "stuuuupid people", "nice people 2 read"]
    rows += [(1000 + i, t) for i, t in enumerate(tests)] + [(2000, None), (2001, ""), (None, "idiot")]
    labels += [(7777, 1), (None, 1), (3, None)]
    docs = make_docs(spark, [(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, lab).collect()}
    assert [got[1000 + i].predicted for i in range(5)] == [1, 1, 1, 1, 0]
    assert got[2000].predicted == got[2001].predicted == 0 and got[None].predicted == 1
    none = toxicity.score(docs, lab.limit(0))
    assert {r.predicted for r in none.collect()} == {0}
    assert toxicity.score(docs.limit(0), lab).count() == 0


def test_toxic_words_in_under_a_hundredth_of_toxic_documents(spark):
    rnd, plain = random.Random(3), [f"plain{chr(97 + i)}" for i in range(20)]
    bad = ["".join(rnd.choice("bcdfgjkz") + rnd.choice("aeiou") for _ in range(4)) for _ in range(150)]
    rows = [(i, " ".join(rnd.choices(plain, k=20) + ([bad[i // 10 % 150]] if i % 10 == 0 else []))) for i in range(12_000)]
    docs = make_docs(spark, rows)
    lab = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    kept = [r.predicted for r in toxicity.score(docs, lab).where("held_out").collect() if r.doc_id % 10 == 0]
    assert sum(kept) >= 0.7 * len(kept)  # about 0.15 have a word with under 5 training rows


def toxic_model():
    text = "you are a stupid idiot and the quick brown fox jumps over lazy dogs while nice people read books and papers " * 50
    c = toxicity._CLASS[np.frombuffer(text.encode(), np.uint8)]
    return toxicity.CharModel(np.bincount(c[:-2] * 784 + c[1:-1] * 28 + c[2:], minlength=28**3))


def read_words(text, model):
    return {w for x in toxicity.restored(text, model) for w in x.split()}


def test_words_in_spaced_out_runs_and_long_tokens_are_found():
    toxicity._SEEN.clear()
    model = toxic_model()
    for text in ("y o u s t u p i d", "a s t u p i d", "y o u  s t u p i d"):
        assert "stupid" in read_words(text, model)
    sentence = "the quick brown fox jumps over lazy dogs while nice people read books you stupid idiot and the quick brown fox jumps over lazy dogs"
    for gap in (" ", "  "):
        assert {"stupid", "idiot"} <= read_words(gap.join(" ".join(w) for w in sentence.split()), model)
    assert "stupid" in read_words("st" + "u" * 60 + "pid", model)
    assert "stupid" in read_words("-".join(sentence.split()), model)


def test_look_alikes_at_the_end_and_between_spaces_are_read():
    toxicity._SEEN.clear()
    model = toxic_model()
    for text, word in (("stupi6", None), ("idi07", "idiot"), ("boo|<$", None), ("book$", "books"), ("!diot", "idiot"), ("s 7 u p 1 d", "stupid"), ("i d 1 0 t", "idiot"), ("sss 7 uuu p 1 d", "stupid")):
        assert toxicity.suspicious(text)
        if word:
            assert word in read_words(text, model)
    assert toxicity.suspicious("nice people! (read) books, 1 2 3 4") in ([], ["(read"])


# --- quality rules


def brute_measures(t):
    t = t or ""
    w = brute.WORD.findall(t)
    lines = [x for x in t.split("\n") if brute.WORD.search(x)]
    where = {}
    for i in range(len(w) - 7):
        where.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


def fields(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_op9_measures_equal_brute_force(spark, docs_rows):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    for i, t in docs_rows:
        m = brute_measures(t)
        assert fields(got[i]) == m
        assert got[i].base_failed == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        assert not (got[i].kept and got[i].base_failed)
    quality_of = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [got[i].kept == bool(q) for i, q in quality_of.items() if i in got]
    good = [got[i].kept for i, q in quality_of.items() if i in got and q]
    assert sum(right) >= 0.9 * len(right) and sum(good) >= 0.97 * len(good)


def test_quality_odd_texts(spark):
    rnd = random.Random(7)
    texts = [None, "", " \x0b\x0c\r\t\n", "one", "a b\n\na b\n \na  b", "x " * 3000, "é#*$ " * 9, "#" * 5000, " nbsp words"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    docs = make_docs(spark, [(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(fields(got[i]) == brute_measures(t) for i, t in enumerate(texts))
    assert quality.judge(docs.limit(0)).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_em_equals_a_plain_version(spark):
    rnd = random.Random(8)
    rows = [tuple(rnd.choice([1, 1, 0, -1]) if rnd.random() < 0.9 else -1 for _ in range(3)) + (rnd.randint(1, 50),) for _ in range(20)]
    table = spark.createDataFrame(rows, "a int, b int, c int, n long")
    model = quality.fit(table, ["a", "b", "c"], rounds=3)
    prior, p, q = 0.8, [0.8] * 3, [0.8] * 3
    for _ in range(3):
        good = []
        for r in rows:
            x, y = prior, 1 - prior
            for i in range(3):
                x *= {1: p[i], -1: 1 - p[i], 0: 1}[r[i]]
                y *= {1: 1 - q[i], -1: q[i], 0: 1}[r[i]]
            good.append(x / (x + y))
        s = lambda i, v, w: sum(r[3] * g for r, g in zip(rows, w) if r[i] == v)
        bad = [1 - g for g in good]
        n = sum(r[3] for r in rows)
        prior = (sum(r[3] * g for r, g in zip(rows, good)) + 16) / (n + 20)
        p = [max(0.5, (s(i, 1, good) + 16) / (s(i, 1, good) + s(i, -1, good) + 20)) for i in range(3)]
        q = [max(0.5, (s(i, -1, bad) + 16) / (s(i, 1, bad) + s(i, -1, bad) + 20)) for i in range(3)]
    assert model.prior == pytest.approx(prior)
    assert [model.on_good[c][0] for c in "abc"] == pytest.approx(p)
    assert [model.on_bad[c][1] for c in "abc"] == pytest.approx(q)
