"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), runs AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS run
  FROM words
), sets AS MATERIALIZED (SELECT DISTINCT doc_id, run FROM runs),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s
  FROM sets a JOIN sets b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE s >= 0.8 * (x.n + y.n - s) - 1e-9
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (
  WITH RECURSIVE r(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a
  ) SELECT a, min(b) AS least FROM r GROUP BY a
)
SELECT d.doc_id, least(d.doc_id, coalesce(reach.least, d.doc_id)) AS class_id,
  coalesce(counted.n, 0)::BIGINT AS n_links, coalesce(sizes.n, 0)::INTEGER AS n_runs
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
LEFT JOIN counted ON counted.a = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id
"""

OP6 = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), ranked AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS turn,
    count(*) OVER (PARTITION BY norm) AS group_size
  FROM rows WINDOW w AS (PARTITION BY norm ORDER BY size DESC, doc_id)
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, turn = 1 AS kept, sha256(norm) AS text_sha256
FROM ranked
"""

OP7 = r"""
WITH pieces AS (
  SELECT coalesce(page_id // 1000, -1) AS archive, page_id, coalesce(html, '') AS body,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) ||
    'WARC-Record-ID: <urn:record:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) ||
    'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\r\n]', '', 'g') || chr(13) || chr(10) ||
    'Content-Type: text/html' || chr(13) || chr(10) ||
    'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) AS head
  FROM pages
), records AS (
  SELECT archive, page_id, body, strlen(head || body) AS size, sha256(head || body) AS hash FROM pieces
)
SELECT archive::BIGINT AS archive, page_id,
  coalesce(sum(size + 4) OVER (PARTITION BY archive ORDER BY page_id, hash
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
  size::BIGINT AS size, hash,
  CASE WHEN page_id % 97 = 0 AND substr(body, 1, 1) NOT IN ('', '?') THEN 'changed' ELSE 'intact' END AS status
FROM records
"""

OP10 = r"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM rows
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), counts AS (
  SELECT s.doc_id, text, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered ON covered.doc_id = s.doc_id
), base AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    10 * n_symbols > 2 * n_words
    OR 3 * n_dup_lines > len(string_split(text, chr(10)))
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR regexp_matches(text, '(\p{Lu}{2,}[^\p{L}]+){8}')
    OR 4 * (length(text) - length(replace(text, '!', ''))) > n_words) AS kept
FROM base
"""


# crc32 of a text's bytes: eight steps for each byte, as the polynomial defines it.
CRC = r"""
xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
    range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda d, z: xor(d >> 1, 3988292384::BIGINT * (d & 1)))))
"""

OP11 = r"""
WITH runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
), keyed AS (SELECT *, id || ':' || run AS k FROM lowered
), hashed AS (SELECT *, {crc} AS h FROM keyed
), damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    n AS part
  FROM hashed
), words AS (
  SELECT word, sum(part)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(part) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS place
  FROM near
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), steps AS (
  WITH RECURSIVE s(word, reached, depth) AS (
    SELECT word, word, 0 FROM told
    UNION ALL SELECT s.word, t.form, depth + 1 FROM s JOIN told t ON t.word = s.reached WHERE t.form IS NOT NULL
  ) SELECT word, arg_max(reached, depth) AS root FROM s GROUP BY word
)
SELECT told.word, n, n_near, form, form_n::BIGINT AS form_n, root FROM told JOIN steps ON steps.word = told.word
""".replace("{crc}", CRC.format(text="k"))


OP12 = r"""
WITH given AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, strlen(r) || ':' || r || ':' || t AS x,
    len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || ':' || t)) AS place
  FROM given
), convs AS (SELECT DISTINCT c, c - c % 20 AS base, c::VARCHAR AS k FROM own
), family AS (SELECT c, base, {crc} % 4 AS h FROM convs
), turns AS (
  SELECT f.c, o.place, o.x, o.words FROM family f JOIN own o ON o.c = f.base WHERE o.place <= f.h
  UNION ALL SELECT f.c, o.place, o.x, o.words FROM family f JOIN own o ON o.c = f.c WHERE o.place > f.h
), rows AS (
  SELECT family.c, coalesce(list(x ORDER BY place) FILTER (x IS NOT NULL), []) AS s,
    coalesce(list(words ORDER BY place) FILTER (x IS NOT NULL), []) AS w
  FROM family LEFT JOIN turns ON turns.c = family.c GROUP BY family.c
), nodes AS (
  SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n, any_value(w[d]) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM rows) GROUP BY ALL
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.p = nodes.p
), sums AS (
  SELECT p[1:k] AS p, sum((n_children = 0)::INT) AS leaves, sum((n - 1) * coalesce(words, 0)) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_nodes) GROUP BY ALL
)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, a.ends_sha256
FROM full_nodes a JOIN sums ON sums.p = a.p LEFT JOIN nodes b ON a.d > 0 AND b.p = a.p[1:a.d - 1] AND b.d = a.d - 1
""".replace("{crc}", CRC.format(text="k"))


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": OP2, "op6_exact_dedup": OP6, "op7_warc_fixity": OP7,
            "op10_quality_rules": OP10, "op11_spelling_variants": OP11, "op12_prefix_trie": OP12}
