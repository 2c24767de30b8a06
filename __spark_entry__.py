
from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import wordloom_oracle  # noqa: E402
from wordloom.functions import maps, text  # noqa: E402
from wordloom.operators import cooc, lines, terms, words  # noqa: E402
from wordloom.sources import lists  # noqa: E402
from wordloom.sources.tables import load_table  # noqa: E402
from wordloom.sources.text import file_stem  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


# -- shared inputs ---------------------------------------------------------------

def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "documents", "doc_id", "text")


def _n_docs(spark: SparkSession, sf: str) -> Column:
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    return terms.document_count(rows, row_per_doc=True)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.line_scan(_docs(spark, sf))


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    return lines.sentence_corpus(_docs(spark, sf))


LONG = 1_200  # more words than a list that travels with the tasks may have


def _long_top(spark: SparkSession, sf: str) -> DataFrame:
    # Worked out once: the operators look at a list more than once.
    return lists.local_copy(words.top_words(_counts(spark, sf), LONG), LONG)


def _stop(spark: SparkSession) -> DataFrame:
    return lists.default_stopwords(spark)


def _counts(spark: SparkSession, sf: str, min_len: int = 1) -> DataFrame:
    return words.word_count(_docs(spark, sf), _stop(spark), min_len=min_len)


def _top(spark: SparkSession, sf: str) -> DataFrame:
    return words.top_words(_counts(spark, sf), 50)


def _listed(spark: SparkSession, top: DataFrame) -> DataFrame:
    """A short list worked out once, for queries that use it more than once."""
    return lists.local_table(spark, word=[r.word for r in top.select("word").collect()])


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return terms.vocabulary(_docs(spark, sf))


def _df(spark: SparkSession, sf: str) -> DataFrame:
    return terms.document_frequency(_docs(spark, sf), _stop(spark), row_per_doc=True)


def _top_df(spark: SparkSession, sf: str, k: int = 100) -> DataFrame:
    return terms.top_terms(_df(spark, sf), k)


def _long_top_df(spark: SparkSession, sf: str) -> DataFrame:
    return lists.local_copy(_top_df(spark, sf, LONG), LONG)


def _part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``term<TAB>count`` lines out of the part table, many of them malformed."""
    part = load_table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size")
    name, size, brand, tab = F.col("p_name"), F.col("p_size"), F.col("p_brand"), F.lit("\t")
    pad = F.lit(" ")
    line = (
        F.when(size < 10, F.concat(name, tab, size))
        .when(size < 15, F.concat(name, tab, size, tab))
        .when(size < 20, F.concat(name, tab, size, tab, tab))
        .when(size < 25, F.concat(pad, name, pad, tab, pad, size, pad))
        .when(size < 30, F.concat(name, tab, brand))
        .when(size < 35, name)
        .when(size < 40, F.concat(name, tab, size, tab, brand))
        .when(size < 45, F.concat(name, tab, size, F.lit("99999999999")))
        .otherwise("")
    )
    return part.select("p_partkey", line.alias("line"))


def _list_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a word list, with blanks, padding and mixed case."""
    chats = load_table(spark, sf, "conversations", "text")
    return chats.select(F.explode(F.split("text", "[\t\n;,.]")).alias("line"))


# -- sources -----------------------------------------------------------------------

@_query
def line_scan(spark, sf):
    return _lines(spark, sf)


@_query
def long_line_skip(spark, sf):
    return lines.skip_long_lines(_lines(spark, sf), 120)


@_query
def doc_id_from_path(spark, sf):
    pages = load_table(spark, sf, "pages", "page_id", "url")
    return pages.select("page_id", file_stem(F.substring_index("url", "/", -1)).alias("doc_id"))


@_query
def stopword_set(spark, sf):
    return lists.stopword_set(_list_lines(spark, sf), "line")


@_query
def stopword_set_trim_only(spark, sf):
    return lists.stopword_set(_list_lines(spark, sf), "line", lowercase=False)


@_query
def top_word_list(spark, sf):
    return lists.top_word_set(_part_lines(spark, sf), "line")


@_query
def df_tsv_parse(spark, sf):
    return lists.parse_term_df(_part_lines(spark, sf), "line", F.col("p_partkey"))


@_query
def corpus_merge(spark, sf):
    chats = load_table(spark, sf, "conversations", "conv_id", "turn", "text")
    return lines.merge_corpora(
        documents=(_docs(spark, sf), F.col("doc_id"), "text"),
        benchmark=(load_table(spark, sf, "benchmark", "item_id", "text"), F.col("item_id"), "text"),
        conversations=(chats, F.concat_ws("-", "conv_id", "turn"), "text"),
    )


# -- text functions ------------------------------------------------------------------

@_query
def text_lower(spark, sf):
    return _docs(spark, sf).select("doc_id", text.lower(F.col("text")).alias("text"))


@_query
def letters_only(spark, sf):
    return _docs(spark, sf).select("doc_id", text.letters_only(F.col("text")).alias("text"))


def _tokenized(spark, sf, tokenizer):
    tokens = _docs(spark, sf).select("doc_id", tokenizer(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n_tokens"),
                         F.array_join("t", " ").alias("tokens"))


@_query
def tokenize_ws(spark, sf):
    return _tokenized(spark, sf, text.tokens_ws)


@_query
def tokenize_find(spark, sf):
    return _tokenized(spark, sf, text.tokens_find)


@_query
def tokenize_split(spark, sf):
    return _tokenized(spark, sf, text.tokens_split)


@_query
def token_positions(spark, sf):
    tokens = F.posexplode(text.tokens_find(F.col("text"))).alias("pos", "word")
    return _docs(spark, sf).select("doc_id", tokens)


def _pages(spark, sf):
    return load_table(spark, sf, "pages", "page_id", "html")


@_query
def clean_entities(spark, sf):
    return _pages(spark, sf).select("page_id", text.clean_entities(F.col("html")).alias("html"))


@_query
def strip_urls(spark, sf):
    return _pages(spark, sf).select("page_id", text.strip_urls(F.col("html")).alias("html"))


@_query
def sentence_split(spark, sf):
    pieces = F.posexplode(text.split_sentences(F.col("line"))).alias("sent_no", "line")
    return _lines(spark, sf).select("doc_id", "line_no", pieces)


@_query
def clean_lines(spark, sf):
    return lines.clean_lines(_lines(spark, sf))


@_query
def sentence_corpus(spark, sf):
    return _sentences(spark, sf)


@_query
def stem_vocab(spark, sf):
    return terms.stem_vocab(_vocabulary(spark, sf))


@_query
def pair_key(spark, sf):
    pairs = cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), 1)
    return pairs.select(text.pair_key(F.col("w1"), F.col("w2")).alias("pair"), "n")


@_query
def tfidf_formula(spark, sf):
    totals = terms.word_frequencies(_docs(spark, sf))
    score = text.tfidf_score(F.col("tf"), F.col("df"), _n_docs(spark, sf))
    return totals.select("word", "tf", "df", F.round(score, 6).alias("score"))


# -- filters ---------------------------------------------------------------------------

def _tokens(spark, sf, min_len=1):
    tokens = F.explode(text.raw_tokens(F.col("text"))).alias("word")
    return _docs(spark, sf).select("doc_id", tokens).where(F.length("word") >= min_len)


@_query
def min_len_filter(spark, sf):
    return _tokens(spark, sf, 3)


@_query
def valid_token(spark, sf):
    candidates = _vocabulary(spark, sf).where(text.valid_token(F.col("word")))
    return terms.stem_vocab(candidates).where(text.valid_token(F.col("stem")))


# -- joins -----------------------------------------------------------------------------

@_query
def stopword_anti_join(spark, sf):
    kept = words.without_stopwords(_tokens(spark, sf), _stop(spark))
    return kept.select("doc_id", "word")


@_query
def stem_anti_join(spark, sf):
    return terms.stemmed_without_stopwords(_vocabulary(spark, sf), _stop(spark))


@_query
def top_word_semi_join(spark, sf):
    kept = cooc.top_word_lines(_sentences(spark, sf), _top(spark, sf))
    return kept.select("doc_id", "line_no", "sent_no", F.array_join("seq", " ").alias("words"))


@_query
def df_lookup_join(spark, sf):
    # The list is worked out once, and its first hundred rows are the shorter list.
    many = lists.local_copy(_top_df(spark, sf, 200))
    counts = terms.term_frequency(_docs(spark, sf), many)
    found = terms.with_df(counts, terms.top_terms(many, 100))
    return found.select("doc_id", "term", "tf", "df")


@_query
def neighbour_band_join(spark, sf):
    near = cooc.following(_sentences(spark, sf), _top(spark, sf), 2)
    return near.where("w2 is not null")


def _whole(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as one long line."""
    return _docs(spark, sf).select(F.translate("text", "\n", " ").alias("line"))


@_query
def cooc_pairs_whole_documents(spark, sf):
    return cooc.cooc_pairs_in_chunks(_whole(spark, sf), _top(spark, sf), 2, size=10_000)


@_query
def cooc_pairs_whole_documents_long_list(spark, sf):
    return cooc.cooc_pairs_in_chunks(_whole(spark, sf), _long_top(spark, sf), 2, size=10_000)


# -- word counts -------------------------------------------------------------------------

@_query
def word_count(spark, sf):
    return _counts(spark, sf)


@_query
def word_count_min3(spark, sf):
    return _counts(spark, sf, 3)


@_query
def top_words(spark, sf):
    return words.top_words(_counts(spark, sf, 3), 50)


@_query
def top_words_any_length(spark, sf):
    return _top(spark, sf)


# -- co-occurrence -----------------------------------------------------------------------

def _register_distances() -> None:
    for d in (1, 2, 3, 4):
        def pairs(spark, sf, d=d):
            return cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), d)

        def pairs_min2(spark, sf, d=d):
            return cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), d, min_len=2)

        def stripes(spark, sf, d=d):
            found = cooc.cooc_stripes(_sentences(spark, sf), _top(spark, sf), d)
            return _as_text(found)

        _QUERIES[f"cooc_pairs_d{d}"] = pairs
        _QUERIES[f"cooc_pairs_min2_d{d}"] = pairs_min2
        _QUERIES[f"cooc_stripes_d{d}"] = stripes


def _as_text(stripes: DataFrame) -> DataFrame:
    return stripes.select("word", maps.stripe_text(F.col("stripe")).alias("stripe"))


_register_distances()


@_query
def cooc_pairs(spark, sf):
    return cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), 2)


@_query
def cooc_pairs_min2(spark, sf):
    return cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), 2, min_len=2)


@_query
def cooc_stripes(spark, sf):
    return cooc.pairs_from_stripes(cooc.cooc_stripes(_sentences(spark, sf), _top(spark, sf), 2))


@_query
def cooc_pairs_by_window(spark, sf):
    return cooc.cooc_pairs_by_window(_sentences(spark, sf), _top(spark, sf), 2)


@_query
def cooc_pairs_long_list(spark, sf):
    return cooc.cooc_pairs(_sentences(spark, sf), _long_top(spark, sf), 2)


@_query
def cooc_stripes_long_list(spark, sf):
    return _as_text(cooc.cooc_stripes(_sentences(spark, sf), _long_top(spark, sf), 2, keep_empty=True))


@_query
def top_word_lines_long_list(spark, sf):
    kept = cooc.top_word_lines(_sentences(spark, sf), _long_top(spark, sf))
    return kept.select("doc_id", "line_no", "sent_no", F.array_join("seq", " ").alias("words"))


@_query
def pairs_preview(spark, sf):
    pairs = cooc.cooc_pairs(_sentences(spark, sf), _top(spark, sf), 1)
    return pairs.orderBy("w1", "w2").limit(20)


@_query
def stripe_text(spark, sf):
    return _as_text(cooc.cooc_stripes(_sentences(spark, sf), _top(spark, sf), 2, min_len=1))


@_query
def stripes_keep_empty(spark, sf):
    long_words = words.top_words(_counts(spark, sf, 12), 300)
    return _as_text(cooc.cooc_stripes(_sentences(spark, sf), long_words, 1, keep_empty=True))


@_query
def stripe_merge(spark, sf):
    top = _listed(spark, _top(spark, sf))
    both = cooc.cooc_sweep(_sentences(spark, sf), top, 2, min_len=2)
    near, wide = (cooc.stripes_from_pairs(both.where(F.col("d") == d)) for d in (1, 2))
    return _as_text(cooc.merge_stripes(near.unionByName(wide)))


@_query
def stripes_of_written_halves(spark, sf):
    """Stripes of every other document, as written lines, and those of the rest added to them."""
    top = _listed(spark, _top(spark, sf))
    sentences = _sentences(spark, sf)
    halves = [_as_text(cooc.cooc_stripes(sentences.where(F.pmod("doc_id", F.lit(2)) == k), top, 2)) for k in (0, 1)]
    earlier, batch = (cooc.parse_stripes(h.select(F.concat_ws("\t", "word", "stripe").alias("value"))) for h in halves)
    return _as_text(cooc.add_to_stripes(earlier, batch))


@_query
def cooc_sweep(spark, sf):
    return cooc.cooc_sweep(_sentences(spark, sf), _top(spark, sf), 4)


@_query
def cooc_equivalence(spark, sf):
    top = _listed(spark, _top(spark, sf))
    pairs = cooc.cooc_pairs_by_window(_sentences(spark, sf), top, 2, min_len=2)
    return cooc.compare_layouts(pairs, cooc.cooc_stripes(_sentences(spark, sf), top, 2))


# -- document frequency --------------------------------------------------------------------

@_query
def stopword_stem_union(spark, sf):
    return lists.with_stems(_vocabulary(spark, sf))


@_query
def document_terms(spark, sf):
    return terms.document_terms(_docs(spark, sf), _stop(spark))


@_query
def document_frequency(spark, sf):
    return _df(spark, sf)


@_query
def document_frequency_long_list(spark, sf):
    # The 1,200 commonest words as further stopwords.
    stop = _stop(spark).unionByName(_long_top(spark, sf).select("word"))
    return terms.document_frequency(_docs(spark, sf), stop, row_per_doc=True)


@_query
def document_frequency_by_dictionary(spark, sf):
    docs = _docs(spark, sf)
    stems = terms.stem_dictionary(terms.vocabulary(docs))
    return terms.document_frequency(docs, _stop(spark), row_per_doc=True, stems=stems)


@_query
def document_frequency_by_line(spark, sf):
    return terms.document_frequency(_text_lines(spark, sf), _stop(spark))


@_query
def top_terms(spark, sf):
    return _top_df(spark, sf)


@_query
def top_terms_desc_tie(spark, sf):
    return terms.top_terms(_df(spark, sf), 100, tie="desc")


# -- TF-IDF ----------------------------------------------------------------------------------

def _tf(spark, sf):
    docs, top = _docs(spark, sf), _listed_df(spark, sf)
    return terms.term_frequency(docs, top, row_per_doc=True, stems=terms.listed_stems(docs, top))


def _listed_df(spark, sf):
    return lists.local_copy(_top_df(spark, sf))


def _tf_idf(spark, sf):
    docs, top = _docs(spark, sf), _listed_df(spark, sf)
    return terms.tf_idf(docs, top, _n_docs(spark, sf), row_per_doc=True, stems=terms.listed_stems(docs, top))


def _doc_stripes(spark, sf):
    return terms.doc_stripes_by_row(_docs(spark, sf), _top_df(spark, sf))


def _text_lines(spark, sf):
    return _lines(spark, sf).withColumnRenamed("line", "text")


@_query
def term_frequency(spark, sf):
    return _tf(spark, sf)


@_query
def term_frequency_long_list(spark, sf):
    return terms.term_frequency(_docs(spark, sf), _long_top_df(spark, sf), row_per_doc=True)


@_query
def doc_stripes_long_list(spark, sf):
    stripes = terms.doc_stripes_by_row(_docs(spark, sf), _long_top_df(spark, sf))
    return stripes.select("doc_id", maps.stripe_text(F.col("stripe")).alias("stripe"))


@_query
def term_frequency_by_dictionary(spark, sf):
    lines = _text_lines(spark, sf)
    stems = terms.stem_dictionary(terms.vocabulary(lines))
    return terms.term_frequency(lines, _long_top_df(spark, sf), stems=stems)


@_query
def term_frequency_by_line(spark, sf):
    return terms.term_frequency(_text_lines(spark, sf), _top_df(spark, sf))


@_query
def tf_idf(spark, sf):
    return _tf_idf(spark, sf).withColumn("score", F.round("score", 6))


@_query
def tf_idf_by_line(spark, sf):
    rows = _text_lines(spark, sf)
    scores = terms.tf_idf(rows, _top_df(spark, sf), terms.document_count(rows))
    return scores.withColumn("score", F.round("score", 6))


@_query
def tf_idf_lines(spark, sf):
    fields = F.concat_ws("\t", "doc_id", "term", text.six_decimals(F.col("score")))
    return _tf_idf(spark, sf).select(fields.alias("line"))


@_query
def doc_stripes(spark, sf):
    return _doc_stripes(spark, sf).select("doc_id", maps.stripe_text(F.col("stripe")).alias("stripe"))


@_query
def doc_stripes_by_line(spark, sf):
    rows = _text_lines(spark, sf)
    stripes = terms.doc_stripes(rows, terms.term_frequency(rows, _top_df(spark, sf)))
    return stripes.select("doc_id", maps.stripe_text(F.col("stripe")).alias("stripe"))


@_query
def doc_stripe_encode(spark, sf):
    return terms.encode_doc_stripes(_doc_stripes(spark, sf))


@_query
def doc_stripe_decode(spark, sf):
    encoded = terms.encode_doc_stripes(_doc_stripes(spark, sf))
    # Every stripe twice, with pieces in between that must be skipped.
    twice = F.concat_ws("|", "stripe", F.lit("broken"), F.lit("c:x"), "stripe")
    return terms.decode_doc_stripes(encoded.select("doc_id", twice.alias("stripe")))


@_query
def result_counts(spark, sf):
    results = {
        "words": _counts(spark, sf),
        "vocabulary": _vocabulary(spark, sf),
        "terms": _df(spark, sf),
    }
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("result"), "n_rows")
             for name, df in results.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- contract ----------------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    return top_words(spark, "/root/testdata/sf0.001")


def _training_data():
    """The modules with the training-data queries and their SQL, if they are installed."""
    if importlib.util.find_spec("wordloom.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    import corpus_pipeline
    from wordloom.llm import queries, sql

    return corpus_pipeline, queries, sql


def queries() -> dict[str, Query]:
    more = _training_data()
    if more is None:
        return dict(_QUERIES)
    pipeline, module, _ = more
    return {**_QUERIES, **module.queries(), "pipeline": pipeline.run}


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    own = wordloom_oracle.oracle_sql()
    if more is None:
        return own
    pipeline, _, module = more
    ours = {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}
    return {**own, **module.oracle_sql(), **ours}
