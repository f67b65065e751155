"""SQL twins of the registered queries that SQL can express.

Op 1 joins the windows of documents and items as strings; op 10 takes every
50-byte string of every document with the least document that holds it; op 13
scores every row with every anchor.
"""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    """The words of a text, A-Z in lower case, as a list."""
    lower = f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP1 = f"""
WITH docs AS (SELECT doc_id, {_words("text")} AS w FROM documents),
items AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
item_windows AS (
    SELECT DISTINCT n, item_id, array_to_string(w[i:i + n - 1], ' ') AS body
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM sized),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS body
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id
         FROM doc_windows JOIN item_windows USING (n, body)),
covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items,
           string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
    GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS body
    FROM (SELECT *, unnest(range(0, greatest(0, len(h) // 2 - 49))) AS i FROM docs)),
first AS (SELECT body, min(doc_id) AS least FROM places GROUP BY body),
gone AS (SELECT doc_id, i FROM places JOIN first USING (body) WHERE least < doc_id),
marked AS (
    SELECT *, CASE WHEN i <= max(i + 50) OVER (PARTITION BY doc_id ORDER BY i
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new
    FROM gone),
runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b
    FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
    GROUP BY doc_id, run),
edges AS (
    SELECT doc_id, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next, a,
           row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM runs),
removed AS (
    SELECT e.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
           max(CASE WHEN k = 1 THEN substr(h, 1, 2 * a) END)
           || string_agg(substr(h, 2 * b + 1,
                                2 * (coalesce(next, len(h) // 2) - b)), '' ORDER BY a) AS kept
    FROM edges e JOIN docs USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)
"""

OP13 = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM valid a JOIN valid r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id
                               ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
