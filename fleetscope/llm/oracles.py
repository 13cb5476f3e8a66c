"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

_GAPS = r"[\x20\x09-\x0D]+"

FILTER_AUDIT = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{_GAPS}'), lambda w: w <> '') AS words
  FROM documents
),
smallest AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(words) < 100 AS INT) AS a,
    CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT) AS b,
    CAST(100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 10 * length(t.text) AS INT) AS c,
    CAST(regexp_matches(t.text, '[#$%&*|]') AS INT) AS d,
    CAST(coalesce(t.doc_id > s.first_id, FALSE) AS INT) AS e
  FROM texts t JOIN smallest s ON t.text = s.text LEFT JOIN marks m ON t.doc_id = m.doc_id
),
cells AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failing GROUP BY ALL
),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE v.l NOT IN (w.l, x.l, y.l, z.l) AND w.l NOT IN (x.l, y.l, z.l)
    AND x.l NOT IN (y.l, z.l) AND y.l <> z.l
),
steps AS (
  SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS filter,
         substr(filter_order, 1, step - 1) AS done
  FROM orders, range(1, 6) AS r(step)
),
met AS (
  SELECT s.*, cells.*,
    CASE filter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
    if(contains(done, 'A'), a, 0) + if(contains(done, 'B'), b, 0) + if(contains(done, 'C'), c, 0)
      + if(contains(done, 'D'), d, 0) + if(contains(done, 'E'), e, 0) AS gone,
    a + b + c + d + e AS failed
  FROM steps s, cells
),
summed AS (
  SELECT part, filter_order, step, filter,
    CAST(sum(CASE WHEN fails = 0 AND gone = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN fails = 1 AND gone = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN fails = 1 AND gone > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = 1 AND failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN fails = 1 AND gone = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN fails = 1 AND gone = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, filter
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM summed
"""


def _centroid_clustering(dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> str:
    steps = [
        f"""vectors AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
)""",
        f"parts AS (SELECT place, d, whole[d] AS x FROM vectors, range(1, {dims + 1}) AS r(d))",
        f"""starts AS (
  SELECT place, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster
  FROM vectors ORDER BY sha256('1:' || vec_id) LIMIT {k}
)""",
        "centroids0 AS (SELECT cluster, d, x FROM starts JOIN parts USING (place))",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""away{turn} AS (
  SELECT p.place, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS distance
  FROM parts p JOIN centroids{turn} c ON p.d = c.d GROUP BY p.place, c.cluster
)""")
        steps.append(f"""nearest{turn} AS (
  SELECT place, cluster, distance FROM away{turn}
  QUALIFY row_number() OVER (PARTITION BY place ORDER BY distance, cluster) = 1
)""")
        if turn < rounds:
            steps.append(f"""centroids{turn + 1} AS (
  SELECT c.cluster, c.d, coalesce(CAST(floor(m.total / m.n) AS BIGINT), c.x) AS x
  FROM centroids{turn} c LEFT JOIN (
    SELECT cluster, d, sum(x) AS total, count(*) AS n
    FROM nearest{turn} JOIN parts USING (place) GROUP BY cluster, d
  ) m ON c.cluster = m.cluster AND c.d = m.d
)""")
    steps.append(f"""described AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
  FROM centroids{rounds} GROUP BY cluster
)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM nearest{rounds} JOIN described USING (cluster) JOIN vectors USING (place)
"""


CENTROID_CLUSTERING = _centroid_clustering()


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# shingles as text: words hold no blanks, so that equal texts are equal shingles
NGRAM_JACCARD_JOIN = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWERED}, '{_GAPS}'), lambda w: w <> '') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM split
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM split s JOIN smallest m ON s.doc_id = m.doc_id LEFT JOIN sizes z ON s.doc_id = z.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_GAPS}'), lambda w: w <> '') AS words
  FROM documents
),
placed AS (
  SELECT doc_id, place, words[place] AS word,
    CASE WHEN place + 49 <= len(words) THEN array_to_string(words[place : place + 49], ' ') END AS span
  FROM split, unnest(range(1, len(words) + 1)) AS r(place)
),
earliest AS (SELECT span, min(doc_id) AS first_id FROM placed WHERE span IS NOT NULL GROUP BY span),
judged AS (
  SELECT doc_id, place, word,
    max(coalesce(first_id < doc_id, FALSE)::INT) OVER (
      PARTITION BY doc_id ORDER BY place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM placed LEFT JOIN earliest USING (span)
),
left_over AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS kept
  FROM judged GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN left_over k ON s.doc_id = k.doc_id
"""
