from hearth.operators.linkage import exact_link, link_records, split_checks, wildcard_link


def test_exact_twins_and_wildcard(spark):
    left = spark.createDataFrame([
        (1, "A", "x", 10), (2, "A", "x", 20),        # twins on (c, s), separated by price
        (3, "B", "y", 30), (4, "C", "z", 40), (5, "C", "w", 50),
    ], "a_id long, c string, s string, price long")
    right = spark.createDataFrame([
        (11, "A", "x", 20), (12, "A", "x", 10),
        (13, "B", None, 30),                          # blank cell, unique candidate
        (14, "C", None, 45),                          # blank cell, two candidates -> unresolved
    ], "b_id long, c string, s string, price long")
    links = {(r["b_id"], r["a_id"], r["step"]) for r in
             link_records(left, right, "a_id", "b_id", ["c", "s"], block=["c"], tiebreak=["price"]).collect()}
    assert (11, 2, "exact") in links and (12, 1, "exact") in links
    assert (13, 3, "wildcard") in links
    assert not any(b == 14 for b, _, _ in links)


def test_split_checks(spark):
    whole = spark.range(10).withColumnRenamed("id", "k")
    r = split_checks(whole, whole.where("k < 7"), whole.where("k >= 6"), "k").collect()[0]
    assert (r["n_a"], r["n_b"], r["n_overlap"], r["n_missing"], r["n_extra"]) == (7, 4, 1, 0, 1)


def test_twins_with_missing_partners_link_by_price(spark):
    """Four twins told apart by price; whichever right records exist, each goes
    to its own price, and a price without partner to none by the exact step."""
    left = spark.createDataFrame([(i, "A", "x", 10 * i) for i in (1, 2, 3, 4)], "a_id long, c string, s string, price long")
    for present in ([1], [4], [2, 4], [3, 1], [1, 2, 3, 4]):
        right = spark.createDataFrame([(100 + i, "A", "x", 10 * i) for i in present], "b_id long, c string, s string, price long")
        got = {(r.b_id, r.a_id) for r in exact_link(left, right, "a_id", "b_id", ["c", "s"], ["price"]).collect()}
        assert got == {(100 + i, i) for i in present}


def test_equal_twins_pair_in_id_order_for_any_slices(spark, monkeypatch):
    from hearth.operators import linkage

    left = spark.createDataFrame([(i, "A", 5) for i in (9, 2, 70, 4)], "a_id long, c string, price long")
    right = spark.createDataFrame([(i, "A", 5) for i in (300, 100, 200)], "b_id long, c string, price long")
    for slices in (1, 3, 64):
        monkeypatch.setattr(linkage, "SLICES", slices)
        got = {(r.b_id, r.a_id) for r in exact_link(left, right, "a_id", "b_id", ["c"], ["price"]).collect()}
        assert got == {(100, 2), (200, 4), (300, 9)}


def test_blank_cells_link_to_the_unique_nearest(spark):
    left = spark.createDataFrame([(1, "A", "x", 10), (2, "A", "y", 50), (3, "A", "z", 30)], "a_id long, c string, s string, price long")
    right = spark.createDataFrame([(11, "A", None, 48), (12, "A", None, 20), (13, "A", "q", 10)], "b_id long, c string, s string, price long")
    got = {(r.b_id, r.a_id) for r in wildcard_link(left, right, "a_id", "b_id", ["c"], ["s"], ["price"]).collect()}
    assert got == {(11, 2)}  # 20 lies between 10 and 30: no unique nearest


def _nearest_by_definition(left, right):
    """{b_id: a_id} of right rows with one matching left row at the least distance."""
    out = {}
    for b, c, s, t, price in right:
        if c is None:
            continue
        cand = [(abs(p - price) if None not in (p, price) else float("inf"), a) for a, lc, ls, lt, p in left
                if lc == c and (s is None or ls == s) and (t is None or lt == t)]
        near = [a for d, a in cand if d == min(cand)[0]]
        if len(near) == 1:
            out[b] = near[0]
    return out


def test_wildcard_link_equals_the_definition(spark, monkeypatch):
    import random

    from hearth.operators import linkage

    for seed, slices in ((1, 1), (2, 5), (3, 64)):
        monkeypatch.setattr(linkage, "SLICES", slices)
        rnd = random.Random(seed)
        pick = lambda x, p: None if rnd.random() < p else rnd.choice(x)
        left = [(i, pick("AAAB", 0.05), pick("xyz", 0.1), pick("uv", 0.1), pick(range(0, 60), 0.1)) for i in range(70)]
        right = [(1000 + i, pick("AAABC", 0.05), pick("xyz", 0.4), pick("uv", 0.4), pick(range(0, 60), 0.1)) for i in range(150)]
        l = spark.createDataFrame(left, "a_id long, c string, s string, t string, price long")
        r = spark.createDataFrame(right, "b_id long, c string, s string, t string, price long")
        got = {x.b_id: x.a_id for x in wildcard_link(l, r, "a_id", "b_id", ["c"], ["s", "t"], ["price"]).collect()}
        assert got == _nearest_by_definition(left, right)
