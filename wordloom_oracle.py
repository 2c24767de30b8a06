"""DuckDB SQL that each query is checked against.

Written on its own terms: joins and regular expressions where the Spark side uses
arrays and suffix tests.
"""

from __future__ import annotations

from wordloom.sources.lists import DEFAULT_STOPWORDS

STOP = "stop(word) AS (VALUES " + ", ".join(f"('{w}')" for w in DEFAULT_STOPWORDS) + ")"

TOK = """tok AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)"""

VOCAB = "vocab AS (SELECT DISTINCT word AS w FROM tok)"


def _counts(min_len: int = 1) -> str:
    return f"""counts AS (
  SELECT word, count(*) AS n FROM tok
  WHERE length(word) >= {min_len} AND word NOT IN (SELECT word FROM stop) GROUP BY word)"""


def _top(k: int = 50) -> str:
    return f"top AS (SELECT word, n FROM counts ORDER BY n DESC, word DESC LIMIT {k})"


LINES = """lines AS (
  SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, str_split(text, chr(10)) AS l FROM documents))"""

SENTENCES = LINES + """, clean AS (
  SELECT doc_id, line_no, replace(replace(replace(line, '&quot;', ' '), '&apos;', ' '), '&amp;', ' ') AS line
  FROM lines), bare AS (
  SELECT doc_id, line_no, regexp_replace(regexp_replace(line, 'http[^ ]+', '', 'g'), 'www\\.[^ ]+', '', 'g') AS line
  FROM clean), pieces AS (
  SELECT doc_id, line_no, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_no, unnest(s) AS line
  FROM (SELECT doc_id, line_no, string_split_regex(line, '[.!?]+') AS s FROM bare)), sentences AS (
  SELECT doc_id, line_no, sent_no, trim(line, chr(32) || chr(9)) AS line
  FROM pieces WHERE trim(line, chr(32) || chr(9)) <> '')"""


def _seq(min_len: int) -> str:
    return f"""seq AS (
  SELECT doc_id, line_no, sent_no, word,
         row_number() OVER (PARTITION BY doc_id, line_no, sent_no ORDER BY p) AS i
  FROM (SELECT doc_id, line_no, sent_no, generate_subscripts(a, 1) AS p, unnest(a) AS word
        FROM (SELECT doc_id, line_no, sent_no,
                     regexp_extract_all(lower(line), '[a-z]+') AS a FROM sentences))
  WHERE length(word) >= {min_len} AND word IN (SELECT word FROM top))"""


def _band(d: int, name: str = "band") -> str:
    return f"""{name} AS (
  SELECT a.doc_id, a.line_no, a.sent_no, a.i, b.i AS j, a.word AS w1, b.word AS w2
  FROM seq a JOIN seq b ON a.doc_id = b.doc_id AND a.line_no = b.line_no
   AND a.sent_no = b.sent_no AND a.i <> b.i AND abs(a.i - b.i) <= {d})"""


def _cooc(d: int, min_len: int, list_min_len: int = 1, k: int = 50) -> str:
    return ", ".join([STOP, TOK, _counts(list_min_len), _top(k), SENTENCES, _seq(min_len), _band(d),
                      "pairs AS (SELECT w1, w2, count(*) AS n FROM band GROUP BY w1, w2)"])


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


STRIPE = "'{' || string_agg(w2 || '=' || n, ', ' ORDER BY w2) || '}'"

# -- stems: one regular expression per rule, a CTE per step ---------------------

# The rules of the published algorithm, ``suffix>replacement`` in its order.
_STEP_2 = """ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e
    ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al
    iviti>ive biliti>ble logi>log"""
_STEP_3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
_STEP_4 = "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>"


def _step(rules: str) -> list[tuple[str, str]]:
    return [tuple(rule.split(">")) for rule in rules.split()]


_V, _C = "[aeiouy]", "[^aeiouy]"
_M0, _M1 = f"^{_C}*{_V}+{_C}", f"^{_C}*{_V}+{_C}+{_V}+{_C}"
_ONE = f"^{_C}*{_V}+{_C}+{_V}*$"
_O = f"{_C}{_V}[^aeiouywxY]$"


def _m(subject: str, pattern: str) -> str:
    return f"regexp_matches({subject}, '{pattern}')"


def _rules(rules, condition: str, extra=lambda suffix: "") -> str:
    whens = []
    for suffix, new in rules:
        ok = _m("s", f"{condition}.*{extra(suffix)}{suffix}$") if not extra(suffix) else (
            _m(f"s[:-{len(suffix) + 1}]", condition) + " AND " + _m("s", f"{extra(suffix)}{suffix}$"))
        whens.append(f"WHEN {_m('s', suffix + '$')} THEN CASE WHEN {ok} "
                     f"THEN regexp_replace(s, '{suffix}$', '{new}') ELSE s END")
    return "CASE " + " ".join(whens) + " ELSE s END"


def _stem_steps() -> list[str]:
    less = "s[:-2]"  # all but the last letter
    return [
        "regexp_replace(regexp_replace(s, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')",
        "CASE WHEN s LIKE '%sses' OR s LIKE '%ies' THEN s[:-3] WHEN s LIKE '%ss' THEN s "
        "WHEN s LIKE '%s' THEN s[:-2] ELSE s END",
        f"CASE WHEN s LIKE '%eed' THEN CASE WHEN {_m('s', _M0 + '.*eed$')} THEN s[:-2] ELSE s END "
        f"WHEN {_m('s', _V + '.*ed$')} THEN s[:-3] || '#' WHEN s LIKE '%ed' THEN s "
        f"WHEN {_m('s', _V + '.*ing$')} THEN s[:-4] || '#' ELSE s END",
        f"CASE WHEN s NOT LIKE '%#' THEN s WHEN {_m('s', '(at|bl|iz)#$')} THEN {less} || 'e' "
        f"WHEN length(s) > 2 AND lower(s[-2]) = lower(s[-3]) AND {_m('s[-2]', _C)} THEN "
        f"CASE WHEN s[-2] IN ('l', 's', 'z') THEN {less} ELSE s[:-3] END "
        f"WHEN {_m(less, _ONE)} AND {_m(less, _O)} THEN {less} || 'e' ELSE {less} END",
        f"regexp_replace(s, '^(.*{_V}.*)[yY]$', '\\1i')",
        _rules(_step(_STEP_2), _M0),
        _rules(_step(_STEP_3), _M0),
        _rules(_step(_STEP_4), _M1,
               lambda x: "[st]" if x == "ion" else ""),
        f"CASE WHEN s LIKE '%e' AND ({_m(less, _M1)} OR ({_m(less, _ONE)} AND NOT {_m(less, _O)})) "
        f"THEN {less} ELSE s END",
        f"CASE WHEN s LIKE '%ll' AND {_m('s', _M1)} THEN {less} ELSE s END",
        "lower(s)",
    ]


def stems(source: str = "vocab", name: str = "stems") -> str:
    """CTEs giving ``name(w, s)`` from ``source(w)``."""
    ctes, before = [], f"(SELECT w, w AS s FROM {source})"
    steps = _stem_steps()
    for number, step in enumerate(steps):
        cte = name if number == len(steps) - 1 else f"{name}_{number}"
        guarded = f"CASE WHEN length(w) <= 2 THEN s ELSE {step} END"
        ctes.append(f"{cte} AS MATERIALIZED (SELECT w, {guarded} AS s FROM {before})")
        before = cte
    return ", ".join(ctes)


STOP_STEMS = stems("(SELECT word AS w FROM stop)", "stop_stems") + """, stop2 AS (
  SELECT word FROM stop UNION SELECT s FROM stop_stems)"""

TERMS = ", ".join([STOP, TOK, VOCAB, stems(), STOP_STEMS]) + """, terms AS (
  SELECT DISTINCT doc_id, s AS term FROM tok JOIN stems ON word = w
  WHERE word NOT IN (SELECT word FROM stop2) AND s <> '' AND s NOT IN (SELECT word FROM stop2))"""

DF = TERMS + ", dfs AS (SELECT term, count(*) AS df FROM terms GROUP BY term)"


def _valid(c: str) -> str:
    return f"(length({c}) > 2 AND regexp_full_match({c}, '[a-z]+') AND NOT regexp_full_match({c}, '[ivx]+'))"


def _tf(k: int) -> str:
    return DF + f""", top_df AS (SELECT term, df FROM dfs ORDER BY df DESC, term LIMIT 100),
listed AS (SELECT term FROM dfs ORDER BY df DESC, term LIMIT {k}), tf AS (
  SELECT doc_id, s AS term, count(*) AS tf FROM tok JOIN stems ON word = w
  WHERE {_valid('word')} AND {_valid('s')} AND s IN (SELECT term FROM listed) GROUP BY doc_id, s)"""


TF_IDF = _tf(100) + """, scored AS (
  SELECT doc_id, term, tf, df, tf * ln((SELECT count(*) FROM documents)::DOUBLE / df + 1) AS score
  FROM tf JOIN top_df USING (term))"""

LONG = 1200
LONG_STOP = """base(word) AS (VALUES """ + ", ".join(f"('{w}')" for w in DEFAULT_STOPWORDS) + """),
stop AS (SELECT word FROM base UNION SELECT word FROM (
  SELECT word, count(*) AS n FROM tok WHERE word NOT IN (SELECT word FROM base)
  GROUP BY word ORDER BY n DESC, word DESC LIMIT 1200))"""

ENCODED = _tf(100) + """, encoded AS (
  SELECT d.doc_id, coalesce(e.stripe, '') AS stripe FROM documents d LEFT JOIN (
    SELECT doc_id, string_agg(term || ':' || tf, '|' ORDER BY term) AS stripe
    FROM tf GROUP BY doc_id) e USING (doc_id))"""

# Lines of a term<TAB>count file made from the part table, many of them malformed.
PART_LINES = """part_lines AS (
  SELECT p_partkey, CASE
    WHEN p_size < 10 THEN p_name || chr(9) || p_size
    WHEN p_size < 15 THEN p_name || chr(9) || p_size || chr(9)
    WHEN p_size < 20 THEN p_name || chr(9) || p_size || chr(9) || chr(9)
    WHEN p_size < 25 THEN ' ' || p_name || ' ' || chr(9) || ' ' || p_size || ' '
    WHEN p_size < 30 THEN p_name || chr(9) || p_brand
    WHEN p_size < 35 THEN p_name
    WHEN p_size < 40 THEN p_name || chr(9) || p_size || chr(9) || p_brand
    WHEN p_size < 45 THEN p_name || chr(9) || p_size || '99999999999'
    ELSE '' END AS line FROM part)"""


def oracle_sql() -> dict[str, str]:
    word_lists = _with(STOP, TOK)
    sql = {
        # sources
        "line_scan": _with(LINES) + "SELECT * FROM lines",
        "long_line_skip": _with(LINES) + "SELECT * FROM lines WHERE strlen(line) + 1 < 120",
        "doc_id_from_path": "SELECT page_id, regexp_replace(parse_filename(url), '\\.[^.]+$', '') AS doc_id FROM pages",
        "stopword_set": r"""SELECT DISTINCT lower(trim(w)) AS word FROM (
            SELECT unnest(string_split_regex(text, '[\t\n;,.]')) AS w FROM conversations)
            WHERE trim(w) <> ''""",
        "stopword_set_trim_only": r"""SELECT DISTINCT trim(w) AS word FROM (
            SELECT unnest(string_split_regex(text, '[\t\n;,.]')) AS w FROM conversations)
            WHERE trim(w) <> ''""",
        "top_word_list": _with(PART_LINES) + "SELECT DISTINCT split_part(line, chr(9), 1) AS word FROM part_lines",
        "df_tsv_parse": _with(PART_LINES) + """, f AS (
            SELECT p_partkey, str_split(rtrim(line, chr(9)), chr(9)) AS p FROM part_lines), g AS (
            SELECT p_partkey, trim(p[1]) AS term, TRY_CAST(trim(p[2]) AS INTEGER) AS df FROM f
            WHERE len(p) = 2)
            SELECT term, max_by(df, p_partkey)::BIGINT AS df FROM g WHERE df IS NOT NULL GROUP BY term""",
        "corpus_merge": """
            SELECT 'documents' AS origin, doc_id::VARCHAR AS doc_id, text FROM documents
            UNION ALL SELECT 'benchmark', item_id::VARCHAR, text FROM benchmark
            UNION ALL SELECT 'conversations', conv_id || '-' || turn, text FROM conversations""",
        # text functions
        "text_lower": "SELECT doc_id, lower(text) AS text FROM documents",
        "letters_only": "SELECT doc_id, regexp_replace(lower(text), '[^a-z ]', ' ', 'g') AS text FROM documents",
        "token_positions": """SELECT doc_id, (generate_subscripts(a, 1) - 1)::INTEGER AS pos, unnest(a) AS word
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS a FROM documents)""",
        "clean_entities": """SELECT page_id, replace(replace(replace(html, '&quot;', ' '),
            '&apos;', ' '), '&amp;', ' ') AS html FROM pages""",
        "strip_urls": r"""SELECT page_id, array_to_string(list_transform(str_split(html, chr(10)),
            lambda x: regexp_replace(regexp_replace(x, 'http[^ ]+', '', 'g'), 'www\.[^ ]+', '', 'g')),
            chr(10)) AS html FROM pages""",
        "sentence_split": _with(LINES) + """SELECT doc_id, line_no, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_no,
            unnest(s) AS line FROM (SELECT doc_id, line_no, string_split_regex(line, '[.!?]+') AS s FROM lines)""",
        "clean_lines": _with(LINES) + """SELECT doc_id, line_no, trim(line, chr(32) || chr(9)) AS line
            FROM lines WHERE trim(line, chr(32) || chr(9)) <> ''""",
        "sentence_corpus": _with(SENTENCES) + "SELECT * FROM sentences",
        "stem_vocab": _with(TOK, VOCAB, stems()) + "SELECT w AS word, s AS stem FROM stems",
        "pair_key": _with(_cooc(1, 1)) + "SELECT w1 || ',' || w2 AS pair, n FROM pairs",
        "tfidf_formula": _with(TOK) + """SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df,
            round(count(*) * ln((SELECT count(*) FROM documents)::DOUBLE / count(DISTINCT doc_id) + 1), 6) AS score
            FROM tok GROUP BY word""",
        "tf_idf_lines": _with(TF_IDF) + r"""SELECT doc_id || chr(9) || term || chr(9) ||
            printf('%.6f', score) AS line FROM scored""",
        # filters
        "min_len_filter": _with(TOK) + "SELECT doc_id, word FROM tok WHERE length(word) >= 3",
        "valid_token": _with(TOK, VOCAB, stems()) + f"""SELECT w AS word, s AS stem FROM stems
            WHERE {_valid('w')} AND {_valid('s')}""",
        # joins
        "stopword_anti_join": word_lists + """SELECT doc_id, word FROM tok
            WHERE word NOT IN (SELECT word FROM stop)""",
        "stem_anti_join": _with(STOP, TOK, VOCAB, stems(), STOP_STEMS) + """SELECT w AS word, s AS stem
            FROM stems WHERE w NOT IN (SELECT word FROM stop2) AND s <> ''
            AND s NOT IN (SELECT word FROM stop2)""",
        "top_word_semi_join": _with(STOP, TOK, _counts(), _top(), SENTENCES, _seq(1)) + """
            SELECT doc_id, line_no, sent_no, string_agg(word, ' ' ORDER BY i) AS words
            FROM seq GROUP BY doc_id, line_no, sent_no""",
        "df_lookup_join": _with(_tf(200)) + """SELECT doc_id, term, tf, coalesce(df, 1) AS df
            FROM tf LEFT JOIN top_df USING (term)""",
        "neighbour_band_join": _with(STOP, TOK, _counts(), _top(), SENTENCES, _seq(1).replace(
            "seq AS (", "seq AS MATERIALIZED (")) + """, ahead AS (
            SELECT word AS w1, lead(word, 1) OVER w AS a1, lead(word, 2) OVER w AS a2 FROM seq
            WINDOW w AS (PARTITION BY doc_id, line_no, sent_no ORDER BY i))
            SELECT w1, a1 AS w2, 1 AS gap FROM ahead WHERE a1 IS NOT NULL
            UNION ALL SELECT w1, a2, 2 FROM ahead WHERE a2 IS NOT NULL""",
        # word counts
        "word_count": _with(STOP, TOK, _counts()) + "SELECT * FROM counts",
        "word_count_min3": _with(STOP, TOK, _counts(3)) + "SELECT * FROM counts",
        "top_words": _with(STOP, TOK, _counts(3), _top()) + "SELECT * FROM top",
        "top_words_any_length": _with(STOP, TOK, _counts(), _top()) + "SELECT * FROM top",
        # co-occurrence
        "cooc_pairs_by_window": _with(_cooc(2, 1)) + "SELECT * FROM pairs",
        "pairs_preview": _with(_cooc(1, 1)) + "SELECT * FROM pairs ORDER BY w1, w2 LIMIT 20",
        "stripe_text": _with(_cooc(2, 1)) + f"SELECT w1 AS word, {STRIPE} AS stripe FROM pairs GROUP BY w1",
        "stripes_keep_empty": _with(_cooc(1, 2, 12, 300)) + f"""SELECT word, coalesce(stripe, '{{}}') AS stripe
            FROM (SELECT DISTINCT word FROM seq) LEFT JOIN (
              SELECT w1 AS word, {STRIPE} AS stripe FROM pairs GROUP BY w1) USING (word)""",
        "stripe_merge": _with(_cooc(1, 2), _band(2, "band2")) + f""", summed AS (
            SELECT w1, w2, count(*) AS n FROM (
              SELECT w1, w2 FROM band UNION ALL SELECT w1, w2 FROM band2) GROUP BY w1, w2)
            SELECT w1 AS word, {STRIPE} AS stripe FROM summed GROUP BY w1""",
        "cooc_sweep": _with(_cooc(4, 1)) + """SELECT d, w1, w2, count(*) AS n
            FROM band JOIN (SELECT unnest([1, 2, 3, 4]) AS d) ON abs(i - j) <= d GROUP BY d, w1, w2""",
        "cooc_equivalence": _with(_cooc(2, 2)) + """SELECT count(*) AS n_pairs,
            0::BIGINT AS only_pairs, 0::BIGINT AS only_stripes FROM pairs""",
        # document frequency
        "stopword_stem_union": _with(TOK, VOCAB, stems()) + "SELECT w AS word FROM stems UNION SELECT s FROM stems",
        "document_terms": _with(TERMS) + "SELECT * FROM terms",
        "document_frequency": _with(DF) + "SELECT * FROM dfs",
        "document_frequency_by_line": _with(DF) + "SELECT * FROM dfs",
        "top_terms": _with(DF) + "SELECT * FROM dfs ORDER BY df DESC, term LIMIT 100",
        "top_terms_desc_tie": _with(DF) + "SELECT * FROM dfs ORDER BY df DESC, term DESC LIMIT 100",
        # TF-IDF
        "term_frequency": _with(_tf(100)) + "SELECT * FROM tf",
        "tf_idf": _with(TF_IDF) + "SELECT doc_id, term, tf, df, round(score, 6) AS score FROM scored",
        "doc_stripes": _with(ENCODED) + r"""SELECT doc_id, '{' || replace(replace(stripe, ':', '='), '|', ', ') || '}'
            AS stripe FROM encoded""",
        "doc_stripe_encode": _with(ENCODED) + "SELECT * FROM encoded",
        "doc_stripe_decode": _with(ENCODED) + """SELECT doc_id, split_part(p, ':', 1) AS term,
            (2 * split_part(p, ':', 2)::BIGINT)::BIGINT AS tf
            FROM (SELECT doc_id, unnest(str_split(stripe, '|')) AS p FROM encoded) WHERE p <> ''""",
        "result_counts": _with(DF, _counts(), "voc AS (SELECT DISTINCT word FROM tok)") + """
            SELECT 'words' AS result, count(*) AS n_rows FROM counts
            UNION ALL SELECT 'vocabulary', count(*) FROM voc
            UNION ALL SELECT 'terms', count(*) FROM dfs""",
    }
    sql["cooc_pairs_long_list"] = _with(_cooc(2, 1, k=LONG)) + "SELECT * FROM pairs"
    sql["cooc_stripes_long_list"] = _with(_cooc(2, 2, k=LONG)) + f"""
        SELECT word, coalesce(stripe, '{{}}') AS stripe FROM (SELECT DISTINCT word FROM seq) LEFT JOIN (
          SELECT w1 AS word, {STRIPE} AS stripe FROM pairs GROUP BY w1) USING (word)"""
    sql["top_word_lines_long_list"] = sql["top_word_semi_join"].replace("LIMIT 50", f"LIMIT {LONG}")
    sql["document_frequency_long_list"] = _with(DF.replace(STOP + ", " + TOK, TOK + ", " + LONG_STOP)) + "SELECT * FROM dfs"
    sql["term_frequency_long_list"] = _with(_tf(LONG)) + "SELECT * FROM tf"
    sql["doc_stripes_long_list"] = _with(_tf(LONG)) + """SELECT d.doc_id, '{' || coalesce(stripe, '') || '}' AS stripe
        FROM documents d LEFT JOIN (SELECT doc_id, string_agg(term || '=' || tf, ', ' ORDER BY term) AS stripe
          FROM tf GROUP BY doc_id) e USING (doc_id)"""
    joined = """SELECT doc_id, len(a)::INTEGER AS n_tokens, array_to_string(a, ' ') AS tokens
        FROM (SELECT doc_id, {} AS a FROM documents)"""
    sql["tokenize_find"] = joined.format("regexp_extract_all(lower(text), '[a-z]+')")
    sql["tokenize_split"] = joined.format(
        "list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda t: t <> '')")
    sql["tokenize_ws"] = joined.format(
        "list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z ]', ' ', 'g'), ' +'), lambda t: t <> '')")
    for name in ("term_frequency", "tf_idf", "doc_stripes"):
        sql[f"{name}_by_line"] = sql[name]
    sql["cooc_pairs"] = sql["cooc_pairs_by_window"]
    sql["cooc_pairs_min2"] = sql["cooc_stripes"] = _with(_cooc(2, 2)) + "SELECT * FROM pairs"
    for name, k in (("cooc_pairs_whole_documents", 50), ("cooc_pairs_whole_documents_long_list", LONG)):
        sql[name] = _with(_cooc(2, 1, k=k).replace(SENTENCES, """sentences AS (
          SELECT doc_id, 0 AS line_no, 0 AS sent_no, replace(text, chr(10), ' ') AS line FROM documents)""")
        ) + "SELECT * FROM pairs"
    sql["document_frequency_by_dictionary"] = sql["document_frequency"]
    sql["term_frequency_by_dictionary"] = sql["term_frequency_long_list"]
    sql["stripes_of_written_halves"] = _with(_cooc(2, 2)) + (
        f"SELECT w1 AS word, {STRIPE} AS stripe FROM pairs GROUP BY w1")
    for d in (1, 2, 3, 4):
        sql[f"cooc_pairs_d{d}"] = _with(_cooc(d, 1)) + "SELECT * FROM pairs"
        sql[f"cooc_pairs_min2_d{d}"] = _with(_cooc(d, 2)) + "SELECT * FROM pairs"
        sql[f"cooc_stripes_d{d}"] = _with(_cooc(d, 2)) + (
            f"SELECT w1 AS word, {STRIPE} AS stripe FROM pairs GROUP BY w1")
    return sql
