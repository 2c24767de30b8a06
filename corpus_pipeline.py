"""The corpus pipeline: documents in, documents ready for training out.

Each stage takes ``(spark, docs, sf_dir)`` and is written and read again before the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import exact_dedup, jaccard_join, mixing, pieces, quality_model
from wordloom.llm.common import scratch_path
from wordloom.llm.queries import PIECES


def good_enough(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_model.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.keep_one(docs)


def one_of_similar_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return jaccard_join.keep_one(docs)


def mix_of_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; a text that would not decode to itself stops the job."""
    return pieces.encode(docs.select("doc_id", "lang", "source", "text"), PIECES, check=True).drop("text")


STAGES = [
    ("quality classifier", good_enough),
    ("exact dedup", one_of_equal_texts),
    ("n-gram Jaccard join", one_of_similar_texts),
    ("mixing sources to target weights", mix_of_sources),
    ("SentencePiece encoding and decoding", encoded),
]

# Language models and hashes of this library's own are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` table of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
