"""DuckDB twins of the queries that SQL can express, written from their
definitions: whole tables, no shared code with the operators."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _shingles(words: str) -> str:
    """5-word shingles of a word list; fewer words are one shingle."""
    return (
        f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) < 5 THEN [array_to_string({words}, ' ')] "
        f"ELSE [array_to_string({words}[i:i + 4], ' ') for i in range(1, len({words}) - 3)] END"
    )


DECONTAMINATION = f"""
WITH iw AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT x.r, x.n, x.i, win.item FROM grams x JOIN win ON x.n = win.n AND x.t = win.t),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS text, unnest(range(0, len(ls))) AS i FROM d),
w AS (SELECT doc_id, i, {_WORDS} AS w FROM l),
s AS (SELECT doc_id, i, list_sort(list_distinct({_shingles('w')})) AS s FROM w WHERE len(w) > 0),
c AS (SELECT row_number() OVER () AS c, s, min((doc_id, i)) AS first FROM s GROUP BY s),
t AS (SELECT c, len(s) AS n, unnest(s) AS t FROM c),
p AS (SELECT a.c AS a, b.c AS b, count(*) AS m, any_value(a.n) + any_value(b.n) AS n FROM t a JOIN t b ON a.t = b.t AND a.c <> b.c GROUP BY 1, 2),
best AS (SELECT c.c, c.s, least(c.first, min(o.first)) AS best
         FROM c LEFT JOIN (SELECT a, b FROM p WHERE 100 * m >= 80 * (n - m)) k ON k.a = c.c LEFT JOIN c o ON o.c = k.b GROUP BY c.c, c.s, c.first),
gone AS (SELECT s.doc_id, s.i FROM s JOIN best ON s.s = best.s WHERE best.best < (s.doc_id, s.i)),
g AS (SELECT doc_id, count(*) AS n, list_sort(list(i)) AS g FROM gone GROUP BY 1),
rest AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY i) AS kept FROM l WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM gone) GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(array_to_string(g, ','), '') AS removed_lines,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN rest ON d.doc_id = rest.doc_id
"""

_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v{g} >> {35 - 5 * k}) & 31 AS BIGINT) + 1, 1)" for g in range(4) for k in range(8)
)
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, sha1(h) AS d, strlen(h) AS n FROM p),
v AS (SELECT *, {', '.join(f"CAST('0x' || substr(d, {10 * g + 1}, 10) AS BIGINT) AS v{g}" for g in range(4))},
             min(page_id) OVER (PARTITION BY h) AS first FROM x)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM v
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct({_shingles('w')})) AS s FROM w),
c AS (SELECT row_number() OVER () AS c, s, min(doc_id) AS first FROM s WHERE len(s) > 0 GROUP BY s),
t AS (SELECT c, len(s) AS n, unnest(s) AS t FROM c),
p AS (SELECT a.c AS a, b.c AS b, count(*) AS m, any_value(a.n) + any_value(b.n) AS n FROM t a JOIN t b ON a.t = b.t AND a.c <> b.c GROUP BY 1, 2),
k AS (SELECT a, b FROM p WHERE 100 * m >= 80 * (n - m)),
reach(c, r) AS (SELECT c, c FROM c UNION SELECT reach.c, k.b FROM reach JOIN k ON reach.r = k.a),
comp AS (SELECT reach.c, min(o.first) AS component_id FROM reach JOIN c o ON o.c = reach.r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.s = c.s LEFT JOIN comp ON comp.c = c.c
"""

COLLOCATIONS = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
x AS (SELECT r, lang, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM w),
s AS (SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM x WINDOW p AS (PARTITION BY r ORDER BY i)),
f1 AS (SELECT lang, x, count(*) AS f FROM s GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM s WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM s WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY 1),
cut AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, a.f AS l, b.f AS r, 1 AS k
  FROM f2 JOIN f1 a ON a.lang = f2.lang AND a.x = f2.x JOIN f1 b ON b.lang = f2.lang AND b.x = f2.y
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.f >= 50 * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.f >= 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, a.f, b.f, 1
  FROM f3 JOIN f1 a ON a.lang = f3.lang AND a.x = f3.x JOIN f2 b ON b.lang = f3.lang AND b.x = f3.y AND b.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, a.f, b.f, 2
  FROM f3 JOIN f2 a ON a.lang = f3.lang AND a.x = f3.x AND a.y = f3.y JOIN f1 b ON b.lang = f3.lang AND b.x = f3.z),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cut),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM top JOIN total USING (lang) WHERE rank <= 2000
"""
