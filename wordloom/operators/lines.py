"""From documents to lines and clean sentences. All narrow: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wordloom.functions.text import clean_entities, split_sentences, strip_urls, trim_blank


def line_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` from ``(doc_id, text)``."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def skip_long_lines(lines: DataFrame, max_bytes: int,
                    skipped: Observation | None = None) -> DataFrame:
    """Drop lines of ``max_bytes`` or more, the line end counted as one byte.

    ``skipped`` receives the number of dropped lines as ``skipped``.
    """
    fits = F.octet_length("line") + 1 < max_bytes
    if skipped is not None:
        lines = lines.observe(skipped, F.count_if(~fits).alias("skipped"))
    return lines.where(fits)


def clean_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Trim spaces and tabs, drop lines left empty."""
    return lines.withColumn(column, trim_blank(F.col(column))).where(F.col(column) != "")


def sentence_corpus(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, sent_no, line)``: one clean sentence per row.

    Entities, then URLs are removed, each line is cut at sentence ends, pieces are
    trimmed and blank ones dropped (their numbers stay unused).
    """
    cleaned = docs.select("doc_id", strip_urls(clean_entities(F.col("text"))).alias("text"))
    sentences = line_scan(cleaned).select(
        "doc_id", "line_no",
        F.posexplode(split_sentences(F.col("line"))).alias("sent_no", "line"),
    )
    return clean_lines(sentences)


def merge_corpora(**parts: tuple[DataFrame, Column, str]) -> DataFrame:
    """``(origin, doc_id, text)`` of several corpora.

    Each part is ``name=(frame, id column, text column name)``. Ids become
    strings, since corpora number their documents in their own ways.
    """
    frames = [
        df.select(F.lit(name).alias("origin"), key.cast("string").alias("doc_id"),
                  F.col(text).alias("text"))
        for name, (df, key, text) in parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


class Counters:
    """Record counters of the stages of a job, gathered while its one action runs."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def rows(self, df: DataFrame, name: str, count: Column | None = None) -> DataFrame:
        """``df`` as it is; its rows, or the aggregate ``count`` of them, are counter ``name``."""
        self._seen[name] = Observation(name)
        count = F.count(F.lit(1)) if count is None else count
        return df.observe(self._seen[name], F.coalesce(count, F.lit(0)).cast("bigint").alias("n"))

    def values(self) -> dict[str, int]:
        """The counters in the order of the stages; to be asked for after the action."""
        return {name: seen.get["n"] for name, seen in self._seen.items()}


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows of a stage while it runs: ``observation.get['rows']``."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
