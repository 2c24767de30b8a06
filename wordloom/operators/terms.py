"""Document frequency, term frequency and TF-IDF over stemmed terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.maps import build_stripe, decoded_count, decoded_key, encode_stripe
from wordloom.functions.porter import stem_all
from wordloom.functions.text import once, raw_tokens, tfidf_score, valid_token
from wordloom.sources.lists import (
    local_copy,
    local_table,
    small_rows,
    small_words,
    with_stems,
    words_and_stems,
)
from wordloom.sources.sinks import finished


def vocabulary(texts: DataFrame, column: str = "text") -> DataFrame:
    """Distinct ``word`` rows; repeats are dropped inside each row first."""
    tokens = F.array_distinct(raw_tokens(F.col(column)))
    return texts.select(F.explode(tokens).alias("word")).where("word <> ''").distinct()


def stem_vocab(words: DataFrame) -> DataFrame:
    """``(word, stem)`` of distinct words."""
    return words.select("word", once(stem_all("array(word)")[0]).alias("stem"))


# A word is hot when it is in more than one row in so many; so fewer words than this are,
# which bounds what is broadcast.
HOT_WORDS = 20_000


def stem_dictionary(words: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(word, stem)`` of distinct ``words``; those in ``known(word, stem)`` are not stemmed again."""
    if known is None:
        return stem_vocab(words)
    fresh = words.select("word").join(known.select("word"), "word", "left_anti")
    old = known.join(words.select("word"), "word", "left_semi").select("word", "stem")
    return old.unionByName(stem_vocab(fresh))


def grown_dictionary(words: DataFrame, path: str) -> DataFrame:
    """The dictionary kept at ``path``, grown by the words that it does not have yet.

    Only these are stemmed. A first call makes the dictionary.
    """
    spark = words.sparkSession
    words = words.select("word").distinct()
    if finished(spark, path):
        words = words.join(spark.read.parquet(path).select("word"), "word", "left_anti")
    stem_vocab(words).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def word_rows(docs: DataFrame) -> DataFrame:
    """``(word, n)``: in how many rows of ``docs(text)`` each word stands."""
    tokens = F.array_distinct(raw_tokens(F.col("text")))
    return docs.select(F.explode(tokens).alias("word")).where("word <> ''").groupBy("word").agg(
        F.count("*").alias("n"))


def look_up(rows: DataFrame, stems: DataFrame) -> DataFrame:
    """Inner join of ``rows(word, …)`` with a dictionary, on ``word``.

    A dictionary with a column ``n``, the rows that hold a word, should be saved: its hot
    words are joined where their rows are, the others are shuffled. Without ``n`` the
    planner chooses the join, and may split what is too large for one task.
    """
    if "n" not in stems.columns:
        return rows.join(stems, "word")
    total = stems.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_WORDS > F.lit(total)
    hot = F.broadcast(stems.where(is_hot).drop("n"))
    rest = rows.join(hot.select("word"), "word", "left_anti").join(stems.where(~is_hot).drop("n"), "word")
    return rows.join(hot, "word").unionByName(rest)


def stemmed_without_stopwords(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """``(word, stem)`` where neither is a stopword or the stem of one."""
    stop = with_stems(stopwords)
    kept = stem_vocab(words.join(stop, "word", "left_anti")).where("stem <> ''")
    return kept.join(stop.withColumnRenamed("word", "stem"), "stem", "left_anti").select(
        "word", "stem")


def word_frequencies(docs: DataFrame) -> DataFrame:
    """``(word, tf, df)`` of plain words where every row is a whole document.

    One pass: in the sorted tokens of a row the first of each run counts for df. Both
    counts are summed per task before the one exchange.
    """
    rows = docs.select(once(F.sort_array(raw_tokens(F.col("text")))).alias("t"))
    marked = F.expr("transform(t, (w, i) -> struct(w AS word, if(i = 0 or t[i - 1] <> w, 1, 0) AS first))")
    words = rows.select(F.inline(marked)).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("tf"), F.sum("first").alias("df"))


# -- document frequency -------------------------------------------------------

def document_terms(docs: DataFrame, stopwords: DataFrame) -> DataFrame:
    """``(doc_id, term)``, each term once per input row.

    With a stop list of up to 1,000 words everything happens
    inside the row: distinct tokens, stop check, stemming, second stop check. A
    longer list is joined, before stemming on the token and afterwards on the term.
    """
    short = small_rows(stopwords.select(words_and_stems().alias("both")))
    tokens = raw_tokens(F.col("text"))
    if short is not None:
        chosen = sorted({word for row in short for word in row.both})
        rows = docs.select("doc_id", _distinct_unless(tokens, chosen).alias("words"))
        terms = _distinct_unless(stem_all("words"), chosen)
        return rows.select("doc_id", F.explode(terms).alias("term"))
    stop = with_stems(stopwords)
    # Ids first: next to the explode they would count its rows.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    rows = rows.select("row", "doc_id", F.explode(F.array_distinct(tokens)).alias("word"))
    kept = rows.where("word <> ''").join(stop, "word", "left_anti")
    terms = kept.select("row", "doc_id", once(stem_all("array(word)")[0]).alias("term"))
    # Two tokens of a row may share a stem.
    return terms.where("term <> ''").join(
        stop.withColumnRenamed("word", "term"), "term", "left_anti").distinct().select(
        "doc_id", "term")


def _distinct_unless(tokens: Column, dropped: list[str]) -> Column:
    return F.array_distinct(F.filter(tokens, lambda t: ~t.isin("", *dropped)))


def document_frequency(docs: DataFrame, stopwords: DataFrame, row_per_doc: bool = False,
                       stems: DataFrame | None = None) -> DataFrame:
    """``(term, df)``: in how many documents a term occurs.

    By default a document may be spread over many rows (lines), so its terms are
    made distinct by ``(doc_id, term)`` before they are counted. When every row is
    a whole document (``row_per_doc``), a row's own distinct terms are enough, and
    the only exchange left is that of partial counts per term. No list of
    documents is ever built for a term, however frequent it is.

    With a dictionary ``stems(word, stem)`` nothing is stemmed here: a row's different
    words look theirs up.
    """
    if stems is not None:
        return _frequency_by_dictionary(docs, stopwords, stems, row_per_doc)
    if row_per_doc and small_rows(stopwords) is None:
        return _frequency_by_words(docs, with_stems(stopwords))
    terms = document_terms(docs, stopwords)
    if not row_per_doc:
        terms = terms.distinct()
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def _frequency_by_words(docs: DataFrame, stop: DataFrame) -> DataFrame:
    """:func:`document_frequency` of rows that are whole documents, for a long stop list.

    A row gives each of its stems with its words that have it. Equal ones are counted before
    the list is joined, so only counts are shuffled: a term is in the rows that hold it with
    a word that is no stopword.
    """
    tokens = F.array_remove(F.array_distinct(raw_tokens(F.col("text"))), "")
    rows = docs.where("text is not null").select(once(tokens).alias("words"))
    rows = rows.select("words", once(stem_all("words")).alias("stems"))
    pairs = F.zip_with("stems", "words", lambda s, w: F.struct(s.alias("term"), w.alias("word")))
    rows = rows.select(once(F.sort_array(F.filter(pairs, lambda p: p["term"] != ""))).alias("found"))
    found = rows.select(F.inline(F.expr(_WORDS))).groupBy("term", "words").agg(F.count("*").alias("n"))
    found = found.join(stop.withColumnRenamed("word", "term"), "term", "left_anti")
    kept = found.select("term", "words", "n", F.explode("words").alias("word")).join(stop, "word", "left_anti")
    return kept.select("term", "words", "n").distinct().groupBy("term").agg(F.sum("n").alias("df"))


def _frequency_by_dictionary(docs: DataFrame, stopwords: DataFrame, stems: DataFrame,
                             row_per_doc: bool) -> DataFrame:
    stop = with_stems(stopwords)
    kept = stems.where("stem <> ''").join(stop, "word", "left_anti").join(
        stop.withColumnRenamed("word", "stem"), "stem", "left_anti")
    doc = F.monotonically_increasing_id() if row_per_doc else F.col("doc_id")
    rows = docs.select(doc.alias("doc"), "text").select(
        "doc", F.explode(F.array_distinct(raw_tokens(F.col("text")))).alias("word"))
    # Two words of a document may share a stem.
    terms = look_up(rows, kept).select("doc", F.col("stem").alias("term")).distinct()
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def top_terms(frequencies: DataFrame, k: int = 100, tie: str = "asc") -> DataFrame:
    """The ``k`` terms in most documents; ties in ``asc`` or ``desc`` term order."""
    if tie not in ("asc", "desc"):
        raise ValueError(f"tie is 'asc' or 'desc', not {tie!r}")
    by_term = F.asc("term") if tie == "asc" else F.desc("term")
    return frequencies.orderBy(F.desc("df"), by_term).limit(k)


# -- term frequency and TF-IDF ------------------------------------------------

def term_frequency(docs: DataFrame, terms: DataFrame, row_per_doc: bool = False,
                   stems: DataFrame | None = None) -> DataFrame:
    """``(doc_id, term, tf)`` of the listed terms.

    ``terms`` has a ``term`` column. With up to 1,000 of them a row's words are cut
    down to those that can become one before anything is stemmed, and only listed
    terms leave the row. When every row is a whole document (``row_per_doc``) they
    are also counted in it, and nothing is shuffled. For a longer list each different
    word of the corpus is stemmed once, into a dictionary.

    With a dictionary ``stems(word, stem)`` nothing is stemmed here: the words that have
    a listed stem are looked up, and their counts are shuffled once.
    """
    listed = terms.select("term").where(valid_token(F.col("term")))
    if stems is not None:
        return _counted_by_dictionary(docs, listed, stems, row_per_doc)
    chosen = small_words(listed)
    if chosen is not None and row_per_doc:
        return _counted_in_row(docs, chosen).select("doc_id", F.inline("counts"))
    if chosen is not None:
        found = F.explode(_listed_stems(chosen)).alias("term")
        return _per_document(_able_words(docs, chosen).select("doc_id", found))
    return _counted_by_dictionary(docs, listed, stem_dictionary(vocabulary(docs)), row_per_doc)


def _listed_words(listed: DataFrame, stems: DataFrame) -> DataFrame:
    """``(word, …, term)``: the part of a dictionary that gives a listed term.

    Up to ``HOT_WORDS`` words are worked out once and travel with the tasks. More of them,
    and a dictionary that is saved with its counts, stay as they are.
    """
    # As a filter on the word Spark would test every token of the text; this stays with the stem.
    term = once(F.when(valid_token(F.col("word")), F.col("stem"))).alias("term")
    more = [c for c in stems.columns if c not in ("word", "stem")]
    kept = stems.select("word", *more, term).join(listed.distinct(), "term", "left_semi").select("word", *more, "term")
    if more:
        return kept
    copy = local_copy(kept, HOT_WORDS)
    return copy if copy is kept else F.broadcast(copy)


def _counted_by_dictionary(docs: DataFrame, listed: DataFrame, stems: DataFrame, row_per_doc: bool) -> DataFrame:
    kept = _listed_words(listed, stems)
    row = [F.monotonically_increasing_id().alias("row")] if row_per_doc else []
    rows = docs.select(*row, "doc_id", "text")
    rows = rows.select(*(["row"] if row else []), "doc_id", F.explode(raw_tokens(F.col("text"))).alias("word"))
    keys = [*(["row"] if row else []), "doc_id", "term"]
    return look_up(rows, kept).groupBy(*keys).agg(F.count("*").alias("tf")).select("doc_id", "term", "tf")


def listed_stems(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(word, stem)``: a dictionary of the words of ``docs`` that become one of ``terms``."""
    stems = stem_dictionary(vocabulary(docs))
    return stems.join(terms.select(F.col("term").alias("stem")).distinct(), "stem", "left_semi")


def _able_words(docs: DataFrame, chosen: list[str]) -> DataFrame:
    able = F.filter(raw_tokens(F.col("text")), lambda w: _may_become(w, chosen) & valid_token(w))
    return docs.select("doc_id", able.alias("words"))


def _listed_stems(chosen: list[str]) -> Column:
    return F.filter(stem_all("words"), lambda t: t.isin(chosen))


def _counted_in_row(docs: DataFrame, chosen: list[str]) -> DataFrame:
    """``(doc_id, counts)``: per row an array of ``(term, tf)`` in term order."""
    return _stem_counts(_able_words(docs, chosen), lambda t: t.isin(chosen))


def _stem_counts(rows: DataFrame, wanted) -> DataFrame:
    """``rows(…, words)`` with ``counts`` of the ``wanted`` stems of its words.

    A row's words are sorted and counted by the lengths of their runs, so each
    different word is stemmed once; the counts of one stem are then summed the same
    way. A null text has an empty array.
    """
    keep = [c for c in rows.columns if c != "words"]
    words = F.coalesce(F.sort_array("words"), F.array().cast("array<string>"))
    rows = rows.select(*keep, once(words).alias("found"))
    rows = rows.select(*keep, once(F.expr(_RUNS)).alias("runs"))
    rows = rows.select(*keep, "runs", F.col("runs.term").alias("words"))
    rows = rows.select(*keep, "runs", once(stem_all("words")).alias("stems"))
    stems = F.zip_with("stems", "runs", lambda s, r: F.struct(s.alias("term"), r["tf"].alias("tf")))
    rows = rows.select(*keep, once(F.sort_array(F.filter(stems, lambda x: wanted(x["term"])))).alias("found"))
    return rows.select(*keep, once(F.expr(_SUMS)).alias("counts"))


# ``(term, tf)`` of the sorted array ``found``: each run starts where a place differs
# from the one before and ends where the next starts.
_RUNS = """
    flatten(transform(array(
        filter(sequence(0, size(found)), i -> i = 0 or i = size(found) or found[i] <> found[i - 1])), s ->
        transform(slice(s, 1, size(s) - 1), (a, k) ->
            struct(found[a] AS term, cast(s[k + 1] - a AS bigint) AS tf))))"""
# The same where ``found`` holds ``(term, tf)``: the sum over each run of a term.
_SUMS = """
    flatten(transform(array(
        filter(sequence(0, size(found)), i -> i = 0 or i = size(found) or found[i].term <> found[i - 1].term)), s ->
        transform(slice(s, 1, size(s) - 1), (a, k) -> struct(found[a].term AS term,
            aggregate(slice(found, a + 1, s[k + 1] - a), 0L, (n, x) -> n + x.tf) AS tf))))"""
# ``(term, words)`` of the sorted array ``found`` of ``(term, word)``: the words of each term.
_WORDS = """
    flatten(transform(array(
        filter(sequence(0, size(found)), i -> i = 0 or i = size(found) or found[i].term <> found[i - 1].term)), s ->
        transform(slice(s, 1, size(s) - 1), (a, k) -> struct(found[a].term AS term,
            slice(found, a + 1, s[k + 1] - a).word AS words))))"""


def _may_become(word: Column, terms: list[str]) -> Column:
    """Whether a word's first letters allow it to stem to one of the terms.

    A stem is its word cut at the end with at most one last letter replaced or
    added, so a word must start with the term less one letter. Up to four letters
    of that start are looked up.
    """
    starts: dict[int, set[str]] = {}
    for term in terms:
        start = term[:-1][:4]
        starts.setdefault(len(start), set()).add(start)
    able = F.lit(False)
    for length, found in sorted(starts.items(), reverse=True):
        able = able | F.substring(word, 1, length).isin(*sorted(found))
    return able


def _per_document(terms: DataFrame) -> DataFrame:
    return terms.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def with_df(counts: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Add ``df`` to rows with a ``term``; 1 where the term is not listed."""
    looked_up = counts.join(frequencies.select("term", "df"), "term", "left")
    return looked_up.withColumn("df", F.coalesce("df", F.lit(1).cast("bigint")))


def document_count(docs: DataFrame, row_per_doc: bool = False) -> Column:
    """The number of documents, as a scalar subquery over the ids alone."""
    count = F.count(F.lit(1)) if row_per_doc else F.count_distinct("doc_id")
    return docs.agg(count.alias("n_docs")).scalar()


def tf_idf(docs: DataFrame, frequencies: DataFrame, n_docs: int | Column | None = None,
           row_per_doc: bool = False, stems: DataFrame | None = None) -> DataFrame:
    """``(doc_id, term, tf, df, score)`` of the terms listed in ``frequencies``.

    ``n_docs`` is the N of the formula; by default the number of documents. A
    document without a listed term has no row. With a short list and every row a
    whole document (``row_per_doc``) nothing is shuffled.
    """
    listed = frequencies.select("term", "df")
    rows = small_rows(listed)
    if rows is not None:
        # Worked out once here, instead of once per use below.
        listed = local_table(docs.sparkSession, term=[r.term for r in rows],
                             df=[r.df for r in rows]) if rows else listed.limit(0)
    n = document_count(docs, row_per_doc) if n_docs is None else n_docs
    n = n if isinstance(n, Column) else F.lit(n)
    return score(with_df(term_frequency(docs, listed, row_per_doc, stems), listed), n)


def score(counts: DataFrame, n_docs: Column) -> DataFrame:
    return counts.select("doc_id", "term", "tf", "df",
                         tfidf_score(F.col("tf"), F.col("df"), n_docs).alias("score"))


# -- document stripes ---------------------------------------------------------

def doc_stripes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(doc_id, stripe)``: term -> tf for every document, ``{}`` without terms."""
    every = docs.select("doc_id", F.lit(None).cast("string").alias("term"),
                        F.lit(None).cast("bigint").alias("tf"))
    rows = counts.select("doc_id", "term", "tf").unionByName(every)
    stripe = build_stripe(F.col("term"), F.col("tf")).alias("stripe")
    return rows.groupBy("doc_id").agg(stripe)


def doc_stripes_by_row(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """As :func:`doc_stripes` of the listed terms, where a row is a whole document.

    One row per input row, also where ids repeat; ``{}`` for null texts. A short list
    needs no shuffle: each row's map is built in it.
    """
    listed = terms.select("term").where(valid_token(F.col("term")))
    chosen = small_words(listed)
    if chosen is not None:
        counts = _counted_in_row(docs, chosen)
        return counts.select("doc_id", F.map_from_entries("counts").alias("stripe"))
    kept = _listed_words(listed, stem_dictionary(vocabulary(docs)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       once(raw_tokens(F.col("text"))).alias("tokens"))
    rows = rows.select("row", "doc_id", F.explode_outer("tokens").alias("word"))
    # Words that give no listed term leave one null per row.
    counts = rows.join(kept, "word", "left").groupBy("row", "doc_id", "term").agg(F.count("*").alias("tf"))
    stripe = build_stripe(F.col("term"), F.col("tf")).alias("stripe")
    return counts.groupBy("row", "doc_id").agg(stripe).select("doc_id", "stripe")


def encode_doc_stripes(stripes: DataFrame) -> DataFrame:
    """``(doc_id, stripe)`` with the map written as ``term:count|term:count``."""
    return stripes.select("doc_id", encode_stripe(F.col("stripe")).alias("stripe"))


def decode_doc_stripes(encoded: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` from encoded stripes, repeats of a term summed.

    Pieces without a colon or with a count that is no integer are skipped.
    """
    pieces = encoded.select("doc_id", F.explode(F.split("stripe", "\\|")).alias("p"))
    parsed = pieces.select("doc_id", decoded_key(F.col("p")).alias("term"),
                           decoded_count(F.col("p")).cast("bigint").alias("tf"))
    return parsed.where("term is not null and tf is not null").groupBy(
        "doc_id", "term").agg(F.sum("tf").alias("tf"))
