"""DuckDB text of the training-data queries that SQL can express."""

from __future__ import annotations

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split_lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_BLANKS}), {_A_TO_Z}) AS key
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), common AS (
  SELECT key, max(doc_id) AS keeper FROM split_lines
  WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, c.key IS NOT NULL AND l.doc_id <> c.keeper AS gone
  FROM split_lines l LEFT JOIN common c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: crc32 of an integer's decimal digits: eight bit steps for each byte.
_CRC32 = """xor(list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                        lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda crc, e: CASE WHEN xor(crc, e) % 2 = 1 THEN xor(xor(crc, e) // 2, 3988292384) ELSE xor(crc, e) // 2 END
         ), 4294967295)"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 32), md5(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), parts AS (
  SELECT c.conv_id, t.place, 0 AS own, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, t.place, 1, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth,
         md5(md5(role) || md5(text)) AS turn, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM parts
), path AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, depth, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)), words FROM rebuilt
), lengths AS (
  SELECT conv_id, max(depth) AS len FROM path GROUP BY conv_id
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
  FROM path JOIN lengths USING (conv_id) GROUP BY node, depth
), links AS (
  SELECT DISTINCT c.node, p.node AS parent FROM path c JOIN path p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1
), kids AS (
  SELECT parent AS node, count(*) AS n_children FROM links GROUP BY parent
), sized AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)
), under AS (
  SELECT p.node, sum((s.n_convs - 1) * s.words) AS saved_tokens, count(*) FILTER (s.n_children = 0) AS n_leaves
  FROM path p JOIN sized s ON s.conv_id = p.conv_id AND s.depth >= p.depth GROUP BY p.node
)
SELECT s.conv_id, s.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, s.n_convs::BIGINT AS n_convs,
       s.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN under u USING (node) LEFT JOIN links l USING (node) LEFT JOIN nodes up ON up.node = l.parent
"""

SOURCE_DIVERGENCE = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         translate(coalesce(text, ''), {_A_TO_Z}) AS text FROM documents
), words AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM grid x JOIN grid y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM grid WHERE n > 0 AND p > q
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM placed WHERE part = 'pair' OR rank <= 50
"""

#: component: the smallest id reachable by ``links`` (both directions), itself included.
_REACH = """reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), {_REACH}, roots AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN roots r ON r.a = vec_id LEFT JOIN counts c ON c.a = vec_id
WHERE vec_id IS NOT NULL
"""

MINHASH = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: md5(array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS shingle FROM sets
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y
      ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN sets sa ON sa.doc_id = p.a JOIN sets sb ON sb.doc_id = p.b
  WHERE 100 * p.n >= 75 * (len(sa.s) + len(sb.s) - p.n)
), {_REACH}, roots AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sets LEFT JOIN roots r ON r.a = doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op5_line_dedup": LINE_DEDUP,
    "op6_embedding_dedup": EMBEDDING_DEDUP,
    "op9_minhash": MINHASH,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
