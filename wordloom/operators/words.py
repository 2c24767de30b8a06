"""Word counts and top words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import raw_tokens


def words(texts: DataFrame, column: str = "text", min_len: int = 1) -> DataFrame:
    """One ``word`` row per token of at least ``min_len`` letters."""
    exploded = texts.select(F.explode(raw_tokens(F.col(column))).alias("word"))
    return exploded.where(F.length("word") >= max(min_len, 1))


def without_stopwords(rows: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Rows whose ``word`` is not in the list.

    No hint: Spark broadcasts the list only if its estimated size allows, and
    then also moves the join below an aggregate on ``word``.
    """
    return rows.join(stopwords, "word", "left_anti")


def word_count(texts: DataFrame, stopwords: DataFrame, column: str = "text",
               min_len: int = 1) -> DataFrame:
    """``(word, n)``.

    Stopwords are taken off the counted vocabulary, so a list of any size joins
    one row per word. A short list ends up below the count, in the map tasks.
    """
    counts = words(texts, column, min_len).groupBy("word").agg(F.count("*").alias("n"))
    return without_stopwords(counts, stopwords)


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most frequent words; ties in descending word order."""
    return counts.orderBy(F.desc("n"), F.desc("word")).limit(k)
