"""DuckDB SQL for the operators that SQL can express, over the same tables."""

# The blanks and letters of the contracts.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.first_doc < k.doc_id, false) AS dropped
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SUBSTRING_DEDUP = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS pos, words FROM texts WHERE len(words) >= 20),
keyed AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS key FROM windows),
repeated AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS k FROM keyed) WHERE k > 1),
covered AS (SELECT DISTINCT doc_id, pos + o AS pos FROM repeated, (SELECT unnest(range(0, 20)) AS o)),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts),
marked AS (
  SELECT p.doc_id, p.pos, p.word, c.pos IS NOT NULL AS removed
  FROM placed p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.pos = c.pos)
SELECT t.doc_id, len(t.words) AS n_words, coalesce(m.n_removed, 0) AS n_removed, sha256(coalesce(m.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT removed) AS kept
  FROM marked GROUP BY doc_id) m ON t.doc_id = m.doc_id
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

RANKED_SEARCH = f"""
WITH found AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS terms
  FROM documents),
counted AS (SELECT *, len(terms) AS n FROM found WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM counted),
counts AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM counted) GROUP BY doc, term),
asked AS (
  SELECT item, item_id, term, count(*) AS repeats FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY item, item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
scored AS (
  SELECT a.item, a.item_id, d.doc_id,
         sum(a.repeats * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 75 + (75 * d.n * t.docs) // t.length)))) AS score
  FROM asked a JOIN counts c ON a.term = c.term JOIN weights w ON w.term = c.term JOIN counted d ON d.doc = c.doc, total t
  WHERE d.doc_id IS NOT NULL GROUP BY a.item, a.item_id, c.doc, d.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM scored WHERE same)
  WHERE k <= 5),
negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""
