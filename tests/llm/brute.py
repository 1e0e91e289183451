"""Plain single-machine versions of the operators, for tests."""

import re
from collections import defaultdict

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def links(sets):
    """Pairs (i, j), i < j, of distinct sets with 100 * both >= 80 * either."""
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            where[t].append(i)
    both = defaultdict(int)
    for members in where.values():
        for a in range(len(members)):
            for b in range(a + 1, len(members)):
                both[members[a], members[b]] += 1
    return {(a, b) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)}


def components(n, pairs):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def joined(rows):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: min(map(str, s)))
    number = {s: i for i, s in enumerate(distinct)}
    comp = components(len(distinct), links(distinct))
    small = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            c = comp[number[s]]
            small[c] = min(small.get(c, doc), doc)
    return sorted(
        ((doc, len(s), small.get(comp[number[s]]) if s else doc) for (doc, _), s in zip(rows, sets, strict=True)), key=str
    )


def removed_lines(rows):
    """{row number: [line numbers]} that an earlier line matches; ids are unique."""
    lines = [(doc, i, shingle_set(x), r) for r, (doc, t) in enumerate(rows) for i, x in enumerate((t or "").split("\n"))]
    lines = sorted((x for x in lines if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    distinct, first = {}, []
    for doc, i, s, _ in lines:
        if s not in distinct:
            distinct[s] = len(distinct)
            first.append((doc is None, doc or 0, i))
    best = list(first)
    for a, b in links(list(distinct)):
        best[a], best[b] = min(best[a], first[b]), min(best[b], first[a])
    out = defaultdict(list)
    for doc, i, s, r in lines:
        if best[distinct[s]] < (doc is None, doc or 0, i):
            out[r].append(i)
    return dict(out)
