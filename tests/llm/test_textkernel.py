import time

import numpy as np

from hearth.llm import textkernel as tk
from hearth.llm.tables import count_table

from llm_data import make_docs


def plain_shingles(hashes, woff, k=5):
    """The shingles, each gathered word by word."""
    n = np.diff(woff)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    unit = np.repeat(np.arange(len(n)), counts)
    start = woff[:-1][unit] + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    wide = np.concatenate([hashes, np.zeros(k, np.uint64)])
    left = np.minimum(woff[1:][unit] - start, k)
    out = np.zeros(len(unit), np.uint64)
    for j in range(k):
        out += np.where(left > j, wide[start + j] * tk._STEP[j], np.uint64(0))
    return tk.mix(out + left.astype(np.uint64)), unit, start


def test_shingles_of_units_of_any_size():
    rng = np.random.default_rng(5)
    for trial in range(200):
        sizes = rng.integers(0, 4 if trial % 3 == 0 else 20, int(rng.integers(0, 30)))
        woff = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        hashes = rng.integers(0, 1 << 63, int(woff[-1]), dtype=np.uint64)
        for k in (5, 13):
            for a, b in zip(tk.shingles(hashes, woff, k), plain_shingles(hashes, woff, k), strict=True):
                assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_shingles_cost_less_than_a_gather_for_each_word():
    rng = np.random.default_rng(6)
    woff = np.arange(0, 600_001, 50)
    hashes = rng.integers(0, 1 << 63, 600_000, dtype=np.uint64)
    took = {}
    for f in (plain_shingles, tk.shingles):
        times = []
        for _ in range(5):
            start = time.perf_counter()
            f(hashes, woff)
            times.append(time.perf_counter() - start)
        took[f] = min(times)
    assert took[tk.shingles] < 0.75 * took[plain_shingles], list(took.values())


def test_words_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(7)
    data = rng.choice(np.frombuffer("abcdefghij XYZ\n\té".encode(), np.uint8), 20_000).astype(np.uint8)
    data[5000:9000] = ord("w")  # a word longer than a block
    breaks = np.unique(rng.integers(0, len(data), 40))
    whole = tk.words(data, breaks)
    for size in (1, 64, 1000):
        monkeypatch.setattr(tk, "BLOCK", size)
        for a, b in zip(whole, tk.words(data, breaks), strict=True):
            assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_count_table_adds_up_waiting_tokens(spark):
    rows = [(i, "x") for i in range(300)]
    tokens = lambda b: (np.array([v % 7, v % 64], np.uint64) for v in b.column(0).to_pylist())
    got = count_table(make_docs(spark, rows).repartition(3), tokens, 64)
    expect = np.bincount([x for i in range(300) for x in (i % 7, i % 64)], minlength=64)
    assert got.tolist() == expect.tolist()
    assert count_table(make_docs(spark, []), tokens, 64).tolist() == [0] * 64
