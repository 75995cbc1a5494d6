"""DuckDB SQL of the operators that SQL can express, over whole tables."""

from __future__ import annotations

_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _PLAIN + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(" + _PLAIN + r", '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_ALNUM} AS w FROM benchmark),
starts AS (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
tests AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS words FROM starts),
sizes AS (SELECT DISTINCT size FROM tests),
places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN sizes ON len(w) >= size),
hits AS (SELECT p.r, p.i, p.size, t.item FROM places p JOIN tests t
         ON t.size = p.size AND t.words = array_to_string(p.w[p.i:p.i + p.size - 1], ' ')),
spots AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(spots.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
       spots.n IS NOT NULL AS contaminated
FROM d LEFT JOIN spots ON spots.r = d.r LEFT JOIN items ON items.r = d.r
"""

# classes of equal sets stand for their documents; a doc_id names one row
NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END)) AS s FROM d),
classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS x FROM classes),
links AS (SELECT a.c AS a, b.c AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.c < b.c
          AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(c, to_c) AS (SELECT c, c FROM classes UNION SELECT reach.c, edges.b FROM reach JOIN edges ON edges.a = reach.to_c),
lowest AS (SELECT c, min(to_c) AS component FROM reach GROUP BY c)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(lowest.component, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(lowest.component, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN lowest ON lowest.c = classes.c
"""



def _clusters(k: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2") -> str:
    """Integer k-means, one pair of steps a round; rows in place of arrays."""
    steps = [
        f"""
v AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
      FROM embeddings WHERE len(embedding) = {dims}
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}),
parts AS MATERIALIZED (SELECT r, unnest(range({dims})) AS j, unnest(q) AS x FROM v),
c0 AS (SELECT c, unnest(range({dims})) AS j, unnest(q) AS x FROM
       (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS c, q FROM v) WHERE c < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (SELECT p.r, c.c, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{i} c ON p.j = c.j GROUP BY p.r, c.c),
a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{i} GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT a.c, p.j, sum(p.x) AS s, count(*) AS n FROM parts p JOIN a{i} a ON a.r = p.r GROUP BY a.c, p.j),
c{i + 1} AS MATERIALIZED (SELECT c.c, c.j, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x
      FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c AND m.j = c.j)""")
    return f"""WITH {",".join(steps)},
names AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY j)) AS name FROM c{rounds} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       names.name AS centroid_sha256
FROM v JOIN a{rounds} a ON a.r = v.r JOIN names ON names.c = a.c
"""


SQL: dict[str, str] = {"op12_centroid_clusters": _clusters(), "op6_decontamination": DECONTAMINATION, "op8_near_duplicates": NEAR_DUPLICATES}
