"""DuckDB SQL over whole tables for the operators that SQL can express."""

from __future__ import annotations

_REACH = """reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)"""

OP3 = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
sized AS (SELECT *, octet_length(body) AS n, max(page_id) OVER (PARTITION BY body) AS newest FROM payloads)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM sized"""

OP7 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
nodes AS (SELECT doc_id AS id FROM sets),
""" + _REACH + """
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id, c.component_id = doc_id AS kept
FROM sets JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = doc_id"""

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP9 = f"""
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
found AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN found ON id = vec_id"""

OP10 = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_USABLE}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20"""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _op12() -> str:
    """Rules, the beta prior by moments and the verdicts on sources, rule by rule."""
    rules = {"few": "n_words < 10", "again": "100 * n_repeat_words > 20 * n_words", "symbols": "10 * n_symbols > n_words",
             "lines": "100 * n_dup_lines > 30 * n_lines", "length": "word_chars < 3 * n_words OR word_chars > 10 * n_words"}
    flags = ", ".join(f"({rule}) AS {r}" for r, rule in rules.items())
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE {r}) AS DOUBLE) AS {r}" for r in rules)
    priors = ", ".join(f"sum({r}) / sum(n) AS mean_{r}, (sum({r} * {r} / n) - sum({r}) * sum({r}) / sum(n)) AS s_{r}" for r in rules)
    alike = ", ".join(f"CASE WHEN mean_{r} * (1 - mean_{r}) > 0 AND room > 0 THEN (s_{r} / (mean_{r} * (1 - mean_{r})) - (k - 1)) / room ELSE 0 END AS alike_{r}" for r in rules)
    rates = " OR ".join(f"CASE WHEN alike_{r} > 0 THEN ({r} + mean_{r} * greatest(0, 1 / alike_{r} - 1)) / (n + greatest(0, 1 / alike_{r} - 1)) ELSE mean_{r} END >= 0.5" for r in rules)
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, {_WORDS} AS w FROM texts),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM again) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM texts) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM split LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
held AS (SELECT *, {flags} FROM measured),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {counts} FROM held WHERE source IS NOT NULL GROUP BY source),
total AS (SELECT count(*) AS k, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room, {priors} FROM hosts),
fitted AS (SELECT *, {alike} FROM total),
rejected AS (SELECT source AS bad FROM hosts, fitted WHERE {rates})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR again AS base_failed,
       NOT (few OR again) AND bad IS NULL AS kept
FROM held LEFT JOIN rejected ON source = bad"""


OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                                        lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END)) AS b FROM runs),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295)) AS h FROM bytes, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
skipped AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM places),
shorter AS (SELECT DISTINCT word, n, a || b AS other FROM skipped),
near AS (
  SELECT x.word, y.word AS other, y.n FROM skipped x JOIN skipped y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.other
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.other),
counted AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
best AS (SELECT word, other, n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
forms AS (SELECT w.word, b.other AS form, b.n AS form_n FROM words w JOIN best b USING (word) WHERE b.n >= 2 * w.n),
chain AS (SELECT word, word AS root FROM words UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root)
SELECT w.word, form, c.root, w.n, coalesce(n_near, 0) AS n_near, form_n
FROM words w LEFT JOIN forms USING (word) LEFT JOIN counted USING (word)
JOIN (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms)) c USING (word)"""


OP13 = f"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10"""

SQL = {"op3_warc_reassembly": OP3, "op7_minhash_near_dedup": OP7, "op9_embedding_near_dedup": OP9, "op10_exact_top_k": OP10, "op11_permuterm": OP11, "op12_host_rules": _op12(), "op13_shared_lists": OP13}
