"""The jobs a user runs: text folders and list files in, TSV folders out.

Jobs that take ``counters`` write ``counter<TAB>n`` lines there: the records of their
stages, gathered by observations while the job's one pass over the text runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.maps import stripe_text
from wordloom.functions.text import pair_key, six_decimals
from wordloom.operators import cooc, lines, terms, words
from wordloom.sources import lists, sinks
from wordloom.sources.text import list_files, read_documents, read_lines


LINES, SKIPPED, RESULTS = "input lines", "skipped lines", "result rows"


class _Stages(lines.Counters):
    """The counters of one job; without an output nothing is observed."""

    def __init__(self, output: str | None):
        super().__init__()
        self.output, self.skipped, self.limited = output, Observation(SKIPPED), False

    def __bool__(self) -> bool:
        return self.output is not None

    def read(self, spark: SparkSession, source: str, max_line: int | None) -> DataFrame:
        if not self:
            return read_lines(spark, source, max_line=max_line)
        self.limited = max_line is not None
        return self.rows(read_lines(spark, source, max_line=max_line, skipped=self.skipped), LINES)

    def write(self, spark: SparkSession, df: DataFrame, output: str, *order: str) -> None:
        """Sorted output; its rows are counted behind the sort, which reads its input twice."""
        ordered = df.orderBy(*order)
        sinks.write_tsv(self.rows(ordered, RESULTS) if self else ordered, output)
        if not self:
            return
        found = self.values()
        if self.limited:
            found[SKIPPED] = self.skipped.get["skipped"]
        table = lists.local_table(spark, counter=list(found), n=list(found.values()))
        sinks.write_tsv(table.coalesce(1), self.output)


def merge_corpus(spark: SparkSession, source: str, output: str, max_line: int | None = None) -> None:
    """One clean sentence per line."""
    texts = read_lines(spark, source, max_line=max_line).withColumnRenamed("line", "text")
    lines.sentence_corpus(texts).select("line").write.mode("overwrite").text(output)


def count_words(spark: SparkSession, source: str, output: str, stopwords: str, min_len: int = 1,
                as_written: bool = False, max_line: int | None = None, counters: str | None = None) -> None:
    """``word<TAB>n`` for every word that is no stopword."""
    stages = _Stages(counters)
    texts = stages.read(spark, source, max_line)
    stop = lists.read_stopwords(spark, stopwords, lowercase=not as_written)
    stages.write(spark, words.word_count(texts, stop, "line", min_len), output, "word")


def rank_words(spark: SparkSession, counts: str, output: str, k: int = 50) -> None:
    """The ``k`` most frequent words of a written word count, most frequent first."""
    table = spark.read.schema("word string, n bigint").option("sep", "\t").csv(counts)
    ranked = words.top_words(table, k)
    sinks.write_ranked_tsv(ranked, output, F.desc("n"), F.desc("word"))


def count_pairs(spark: SparkSession, source: str, output: str, top: str, distance: int, min_len: int = 1,
                max_line: int | None = None, counters: str | None = None) -> None:
    """``w1,w2<TAB>n``."""
    stages = _Stages(counters)
    pairs = cooc.cooc_pairs(stages.read(spark, source, max_line), lists.read_top_words(spark, top),
                            distance, min_len, stages or None)
    keyed = pairs.select(pair_key(F.col("w1"), F.col("w2")).alias("pair"), "n")
    stages.write(spark, keyed, output, "pair")


def count_stripes(spark: SparkSession, source: str, output: str, top: str, distance: int, min_len: int = 2,
                  keep_empty: bool = False, max_line: int | None = None, counters: str | None = None) -> None:
    """``word<TAB>{w=n, …}``."""
    stages = _Stages(counters)
    stripes = cooc.cooc_stripes(stages.read(spark, source, max_line), lists.read_top_words(spark, top),
                                distance, min_len, keep_empty, stages or None)
    shown = stripes.select("word", stripe_text(F.col("stripe")).alias("stripe"))
    stages.write(spark, shown, output, "word")


def add_counts(spark: SparkSession, earlier: str, batch: str, output: str) -> None:
    """Written ``key<TAB>n`` counts of an earlier run and of a new batch, summed by key."""
    table = spark.read.schema("key string, n bigint").option("sep", "\t").option("quote", "").csv([earlier, batch])
    sinks.write_sorted_tsv(table.where("n is not null").groupBy("key").agg(F.sum("n").alias("n")), output, "key")


def add_stripes(spark: SparkSession, earlier: str, batch: str, output: str) -> None:
    """Written stripes of an earlier run and of a new batch, summed cell by cell."""
    both = [cooc.parse_stripes(spark.read.text(path)) for path in (earlier, batch)]
    merged = cooc.add_to_stripes(*both)
    sinks.write_sorted_tsv(merged.select("word", stripe_text(F.col("stripe")).alias("stripe")), output, "word")


def sweep_pairs(spark: SparkSession, source: str, output: str, top: str,
                max_distance: int = 4, min_len: int = 1) -> None:
    """``d<TAB>w1,w2<TAB>n`` for every distance up to the given one, in one pass."""
    swept = cooc.cooc_sweep(read_lines(spark, source), lists.read_top_words(spark, top),
                            max_distance, min_len)
    keyed = swept.select("d", pair_key(F.col("w1"), F.col("w2")).alias("pair"), "n")
    sinks.write_sorted_tsv(keyed, output, "d", "pair")


def _documents(spark: SparkSession, source: str, doc_id: str, whole_files: bool) -> DataFrame:
    if whole_files:
        return read_documents(spark, source, doc_id)
    return read_lines(spark, source, doc_id).withColumnRenamed("line", "text")


def count_documents(spark: SparkSession, source: str, output: str, top_output: str,
                    stopwords: str, k: int = 100, tie: str = "asc",
                    whole_files: bool = False) -> None:
    """``term<TAB>df`` of all terms, and the first ``k`` of them.

    Files are read by lines, so one of any size is split among tasks.
    ``whole_files`` reads each as one row, which saves an exchange where all files
    are small. The ranking reads the written frequencies, not the text again.
    """
    write_frequencies(spark, source, output, stopwords, whole_files)
    rank_terms(spark, output, top_output, k, tie)


def write_frequencies(spark: SparkSession, source: str, output: str, stopwords: str, whole_files: bool = False) -> None:
    """``term<TAB>df`` of all terms."""
    docs = _documents(spark, source, "path", whole_files)
    stop = lists.read_stopwords(spark, stopwords)
    sinks.write_sorted_tsv(terms.document_frequency(docs, stop, whole_files), output, "term")


def rank_terms(spark: SparkSession, frequencies: str, output: str, k: int = 100, tie: str = "asc") -> None:
    """The first ``k`` terms of written frequencies."""
    table = spark.read.schema("term string, df bigint").option("sep", "\t").csv(frequencies)
    by_term = F.asc("term") if tie == "asc" else F.desc("term")
    sinks.write_ranked_tsv(terms.top_terms(table, k, tie), output, F.desc("df"), by_term)


def score_documents(spark: SparkSession, source: str, output: str, df_list: str,
                    n_docs: int | None = None, whole_files: bool = False) -> None:
    """``id<TAB>term<TAB>score`` for the terms of a ``term<TAB>df`` list.

    Not sorted: that would shuffle a result that grows with the documents. With
    ``whole_files`` nothing is shuffled; file names must then be distinct, where
    otherwise files of one name count as one document. Without ``n_docs`` the documents
    are counted in the listing of the files, so that empty ones count as well.
    """
    docs = _documents(spark, source, "stem", whole_files)
    if n_docs is None:
        n_docs = terms.document_count(list_files(spark, source, "stem"), whole_files)
    scores = terms.tf_idf(docs, lists.read_term_df(spark, df_list), n_docs, whole_files)
    shown = scores.select("doc_id", "term", six_decimals(F.col("score")).alias("score"))
    sinks.write_tsv(shown, output)


def _state(spark: SparkSession, source: str, stopwords: str, *how) -> str:
    """A name for the files below ``source`` and ``stopwords`` as they are now, and for ``how``."""
    files = list_files(spark, source).unionByName(list_files(spark, stopwords))
    file = F.xxhash64("path", "length", "modified")
    found = files.agg(F.count("*").alias("n"), F.bit_xor(file).alias("x"), F.sum(F.pmod(file, F.lit(1 << 31))).alias("s"))
    told = found.select(F.sha2(F.concat_ws(":", "n", "x", "s", *[F.lit(str(h)) for h in how]), 256)).first()[0]
    return told[:16]


def score_corpus(spark: SparkSession, source: str, work: str, stopwords: str, k: int = 100, tie: str = "asc",
                 n_docs: int | None = None, whole_files: bool = False, fresh: bool = False) -> list[tuple[str, str, bool]]:
    """Document frequency and then TF-IDF in one go; finished steps are not run again.

    Returns ``(step, path, ran)`` per step. Results lie in ``work``, in folders that are named after the state of
    the input files and the parameters that the step depends on. A step whose folder is
    complete is skipped unless ``fresh``: its writer leaves the mark of completion last,
    so a step that was cut off is run again.
    """
    first = _state(spark, source, stopwords, whole_files)
    ranked = _state(spark, source, stopwords, whole_files, k, tie)
    last = _state(spark, source, stopwords, whole_files, k, tie, n_docs)
    counts, top, scores = f"{work}/frequencies-{first}", f"{work}/top-{ranked}", f"{work}/scores-{last}"
    done = []

    def step(name: str, path: str, run) -> None:
        ran = fresh or not sinks.finished(spark, path)
        if ran:
            run()
        done.append((name, path, ran))

    step("document-frequency", counts, lambda: write_frequencies(spark, source, counts, stopwords, whole_files))
    step("rank-terms", top, lambda: rank_terms(spark, counts, top, k, tie))
    step("tf-idf", scores, lambda: score_documents(spark, source, scores, top, n_docs, whole_files))
    return done
