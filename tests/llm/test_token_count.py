import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hearth.llm import token_count
from hearth.llm.queries import COUNTS, QUERIES

from llm_data import SF, docs_rows, make_docs  # noqa: F401

PATH = public_tokenizers.path(COUNTS)
ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\n b", "x\t y", "a" * 3000, " " * 700, "\n\t \r  x", "日本語テキスト" * 30,
    "👍🏽👨‍👩‍👧", "'s've it's 'S", "1234567890" * 20, "ab" * 900, "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>",
    "<|endoftext|", "<|endof text|>", "\x1c a \x85 b c d", "aé́ ​ x", "a <|endoftext|>  b", "\x00\x01 z",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return token_count.TokenCounter(token_count.read_vocabulary(PATH), public_tokenizers.PATTERN)


def test_op12_equals_the_library(spark, docs_rows, library):
    got = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, SF).collect()}
    assert len(got) == len(docs_rows)
    for (i, t), n in zip(docs_rows, library([t for _, t in docs_rows]), strict=True):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 1024)


def test_odd_texts(spark, library):
    rnd = random.Random(4)
    signs = ["a", "b", "th", "ing", " ", "  ", "é", "1", "!", "'s", "\n", "日", "😀", "<|endoftext|>", "\t", " "]
    texts = ODD + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 120))) for _ in range(400)]
    rows = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = make_docs(spark, rows, "doc_id long, text string, n_bytes string, other int")
    out = token_count.with_token_counts(docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "other", "n_bytes", "n_tokens"]
    got = sorted(((r.text or "", r.text is None, r.n_bytes, r.n_tokens) for r in out.collect()))
    assert got == sorted((t or "", t is None, len((t or "").encode()), n) for t, n in zip(texts, library(texts), strict=True))


def test_count_is_that_of_plain_merging(counter):
    """Against merging by the definition: the smallest rank, leftmost, each time."""
    ranks = {}
    for r, (a, b, m) in enumerate(token_count.read_vocabulary(PATH)["merges"]):
        ranks[a, b] = (r, m)
    rnd = random.Random(5)
    for _ in range(300):
        piece = "".join(rnd.choice("aetns hé") for _ in range(rnd.randint(1, 40))).encode()
        ids = [counter.byte_ids[b] for b in piece]
        while best := min(((ranks[p][0], i, ranks[p][1]) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks), default=None):
            ids[best[1] : best[1] + 2] = [best[2]]
        assert counter.count_piece(piece) == len(ids)


def test_one_very_long_piece(counter, library):
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcdefghij") for _ in range(400_000)) + "a" * 100_000
    assert counter.count(text) == library([text])[0]


def test_memos_are_bounded_and_change_nothing(counter, library, monkeypatch):
    monkeypatch.setattr(token_count, "MEMO_ENTRIES", 3)
    own = token_count.TokenCounter(token_count.read_vocabulary(PATH), public_tokenizers.PATTERN)
    text = "the cat sat on the mat while an owl, unseen, saw the cat sit on it " * 3
    assert own.count(text) == own.count(text) == library([text])[0]
    assert len(own.parts) <= 20 and len(own.pieces) <= 3  # a text's new parts, then anew
    for _ in range(5):
        assert own.count("a few other words here") == library(["a few other words here"])[0]
    assert len(own.parts) <= 20


def test_empty_table_and_other_vocabularies(spark):
    assert token_count.with_token_counts(make_docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="plain byte-level"):
        token_count.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
