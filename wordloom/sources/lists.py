"""Side inputs: stopword lists, top-word lists, term/DF tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.porter import stem_all
from wordloom.functions.text import int_or_null

# The package's own default list (English function words).
DEFAULT_STOPWORDS = (
    "a about after all also an and any are as at be been but by can could did do "
    "each for from had has have he her his how i if in into is it its may more most "
    "no not of on one only or other our out over she so some such than that the "
    "their them then there these they this to up was we were what when which who "
    "will with would you your"
).split()

# A list up to this many rows may travel with the tasks (as a literal set or a
# hinted broadcast). Longer lists stay DataFrames and are joined.
SMALL_LIST = 1000


def local_table(spark: SparkSession, **columns: list) -> DataFrame:
    """A small table held in the plan itself.

    Built from Arrow it becomes a local relation, whose exact size the planner
    knows; rows parallelised from Python have no size, so Spark would shuffle the
    other side of a join instead of broadcasting this one.
    """
    return spark.createDataFrame(pa.table(columns))


def local_copy(df: DataFrame, limit: int = SMALL_LIST) -> DataFrame:
    """``df`` worked out once and held in the plan where it has at most ``limit`` rows, else as it is."""
    rows = small_rows(df, limit)
    if not rows:
        return df if rows is None else df.limit(0)
    return local_table(df.sparkSession, **{c: [r[c] for r in rows] for c in df.columns})


def default_stopwords(spark: SparkSession) -> DataFrame:
    return local_table(spark, word=list(DEFAULT_STOPWORDS))


def stopword_set(source: DataFrame, line: str = "value", lowercase: bool = True) -> DataFrame:
    """Distinct ``word`` rows of a list with one entry per line.

    Entries are trimmed and lower-cased (only trimmed with ``lowercase=False``);
    blank lines are skipped.
    """
    word = F.btrim(line, F.lit(" \t\r\n"))
    if lowercase:
        word = F.lower(word)
    return source.select(word.alias("word")).where("word <> ''").distinct()


def read_stopwords(spark: SparkSession, path: str, lowercase: bool = True) -> DataFrame:
    return stopword_set(spark.read.text(path), "value", lowercase)


def words_and_stems() -> Column:
    """Array of ``word`` and its stem."""
    return F.concat(F.array("word"), stem_all("array(word)"))


def with_stems(stopwords: DataFrame) -> DataFrame:
    """The words together with their stems, each once."""
    return stopwords.select(F.explode(words_and_stems()).alias("word")).distinct()


def top_word_set(source: DataFrame, line: str = "value") -> DataFrame:
    """Distinct ``word`` rows: the first tab-separated field of each line."""
    return source.select(F.split(line, "\t")[0].alias("word")).distinct()


def read_top_words(spark: SparkSession, path: str) -> DataFrame:
    return top_word_set(spark.read.text(path))


def parse_term_df(source: DataFrame, line: str = "value",
                  order: Column | None = None) -> DataFrame:
    """``(term, df)`` from ``term<TAB>df`` lines, one row per term.

    A line must have exactly two fields, empty ones at its end not counted, and a
    32-bit integer as the second; anything else is dropped. Of a term's lines the last by ``order`` wins, or the
    one with the largest count when there is no order.
    """
    fields = source.select(
        F.split(F.rtrim(F.col(line), F.lit("\t")), "\t").alias("p"),
        (F.lit(0) if order is None else order).alias("at"),
    )
    rows = fields.where(F.size("p") == 2).select(
        F.trim(F.col("p")[0]).alias("term"),
        int_or_null(F.trim(F.col("p")[1])).cast("bigint").alias("df"),
        "at",
    )
    last = F.max(F.struct("at", "df"))["df"]
    return rows.where("df is not null").groupBy("term").agg(last.alias("df"))


def read_term_df(spark: SparkSession, path: str) -> DataFrame:
    # Files in the order of their names; row ids rise with the position in a file.
    lines = spark.read.text(path).withColumn(
        "at", F.struct("_metadata.file_path", F.monotonically_increasing_id()))
    return parse_term_df(lines, "value", F.col("at"))


def small_rows(df: DataFrame, limit: int = SMALL_LIST) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``limit``, else ``None``.

    This is the size check in front of everything that travels with the tasks.
    It never brings more than ``limit + 1`` rows to the driver.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def small_words(df: DataFrame, limit: int = SMALL_LIST) -> list[str] | None:
    """The distinct values of a one-column list, under the same check."""
    rows = small_rows(df, limit)
    return None if rows is None else sorted({r[0] for r in rows})
