"""SQL counterparts of the queries that SQL can express (DuckDB)."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"

CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
items AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM (SELECT item_id, {_ALNUM} AS ws FROM benchmark) WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM items)
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, lengths)
),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, w)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM docs WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM docs
  UNION
  SELECT e.y, r.root FROM reach r JOIN edges e ON e.x = r.id WHERE r.root < e.y
),
least_of AS (SELECT id AS doc_id, min(root) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_of LEFT JOIN sizes USING (doc_id)
"""

ARCHIVE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
sized AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), {_A_Z}) AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS dropped FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _sized(value: str) -> str:
    """A leaf's part: ``-`` for a null, else the bytes, a colon and the value."""
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _leaf(*values: str) -> str:
    return "sha256(" + " || ".join(_sized(v) for v in values) + ")"


MERKLE = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    {_leaf("doc_id", "source", "lang", "n_chars", f"translate(text, {_A_Z})")} AS lowered FROM documents
),
crc_bits AS (SELECT doc_id, encode(CAST(doc_id AS VARCHAR)) AS bytes FROM rows),
crc_steps AS (
  SELECT doc_id, bytes, 0 AS k, CAST(4294967295 AS UBIGINT) AS crc, 0 AS bit FROM crc_bits
  UNION ALL
  SELECT doc_id, bytes, CASE WHEN bit = 8 THEN k + 1 ELSE k END,
    CASE WHEN bit = 0 THEN xor(crc, CAST(ascii(decode(array_slice(bytes, k + 1, k + 1))) AS UBIGINT))
      WHEN crc % 2 = 1 THEN xor(crc // 2, CAST(3988292384 AS UBIGINT)) ELSE crc // 2 END,
    CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
  FROM crc_steps WHERE k < octet_length(bytes)
),
crcs AS (SELECT doc_id, xor(crc, CAST(4294967295 AS UBIGINT)) AS crc FROM crc_steps WHERE k = octet_length(bytes)),
leaves AS (
  SELECT doc_id, leaf, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS tampered,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx
  FROM rows JOIN crcs USING (doc_id)
),
lower_nodes AS (
  SELECT 0 AS level, tree, idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM leaves
  UNION ALL
  SELECT level + 1, tree, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(size) + 7) // 8
  FROM lower_nodes WHERE size > 1 GROUP BY level + 1, tree, idx // 8
),
subroots AS (SELECT tree, digest AS subroot, level AS height FROM lower_nodes WHERE size = 1),
upper_nodes AS (
  SELECT 0 AS level, tree AS idx, subroot AS digest, count(*) OVER () AS size FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(size) + 7) // 8
  FROM upper_nodes WHERE size > 1 GROUP BY level + 1, idx // 8
),
root AS (SELECT digest AS root FROM upper_nodes WHERE size = 1),
lower_entries AS (
  SELECT n.level, n.tree, n.idx, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx < n.idx), '') AS l,
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx > n.idx), '') AS r
  FROM lower_nodes n JOIN lower_nodes s ON s.level = n.level AND s.tree = n.tree AND s.idx // 8 = n.idx // 8
  WHERE n.size > 1 GROUP BY n.level, n.tree, n.idx
),
upper_entries AS (
  SELECT n.level, n.idx, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx < n.idx), '') AS l,
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx > n.idx), '') AS r
  FROM upper_nodes n JOIN upper_nodes s ON s.level = n.level AND s.idx // 8 = n.idx // 8
  WHERE n.size > 1 GROUP BY n.level, n.idx
),
walk AS (
  SELECT doc_id, tree, idx, 0 AS level, '' AS proof, tampered AS digest FROM leaves
  UNION ALL
  SELECT w.doc_id, w.tree, w.idx // 8, w.level + 1, w.proof || e.l || e.r, sha256(e.l || w.digest || e.r)
  FROM walk w JOIN lower_entries e ON e.level = w.level AND e.tree = w.tree AND e.idx = w.idx
),
climbed AS (
  SELECT w.doc_id, w.tree AS idx, 0 AS level, w.proof, w.digest FROM walk w JOIN subroots s ON s.tree = w.tree AND s.height = w.level
  UNION ALL
  SELECT c.doc_id, c.idx // 8, c.level + 1, c.proof || e.l || e.r, sha256(e.l || c.digest || e.r)
  FROM climbed c JOIN upper_entries e ON e.level = c.level AND e.idx = c.idx
),
ends AS (SELECT doc_id, proof, digest FROM climbed WHERE level = (SELECT max(level) FROM upper_nodes))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM leaves JOIN ends USING (doc_id) JOIN subroots USING (tree), root
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
