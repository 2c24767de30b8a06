"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    bpe_automaton,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    pieces,
    prefix_trie,
    quality_model,
    rule_cascade,
    secret_ledger,
    spelling_variants,
    url_templates,
    warc_fixity,
)

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
ARCHIVE_PAGES = 1_000
# Of the second replica every so-manyeth page has a damaged first byte.
DAMAGED = 97


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_model.judged(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_groups(_table(spark, sf, "documents")).drop("th")


def op3_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"))


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = language_id.held_out_split(_table(spark, sf, "documents"))
    model = language_id.fit(docs.where("not held_out").select("doc_id", "text", "lang"))
    found = language_id.identify(docs, model)
    return language_id.held_out_split(found).select("doc_id", "held_out", "lang_pred", "score")


def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    back = pieces.decode(pieces.encode(docs, PIECES), PIECES)
    return back.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf, "documents"))


def op7_warc_fixity(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    archive = F.coalesce(F.floor(F.col("page_id") / ARCHIVE_PAGES), F.lit(-1))
    body = F.when(F.col("page_id") % DAMAGED == 0, F.concat(F.lit("?"), F.substr("html", F.lit(2)))).otherwise(F.col("html"))
    left, right = (warc_fixity.catalogue(warc_fixity.to_records(rows, archive, "page_id", "url", "html"))
                   for rows in (pages, pages.withColumn("html", body)))
    return warc_fixity.audit(left, right).withColumnRenamed("record_id", "page_id")


def op8_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return url_templates.judge(_table(spark, sf, "pages"))


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = secret_ledger.scan(docs, secret_ledger.fresh_ledger(spark), path="doc_id")
    base = [r.kind for r in secret_ledger.BASE]
    line = lambda f: F.array_join(F.transform(f, lambda x: F.concat_ws(
        ":", x["kind"], x["start"], x["end"])), ",")
    of_base = F.filter("findings", lambda x: x["kind"].isin(base))

    def number(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("path").alias("doc_id"), *map(number, base),
                        F.sha2(line(of_base), 256).alias("base_sha256"), line(F.col("findings")).alias("spans"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rule_cascade.judged(_table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf, "documents"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_nodes(_table(spark, sf, "conversations"))


def op13_bpe_automaton(spark: SparkSession, sf: str) -> DataFrame:
    back = bpe_automaton.decode(bpe_automaton.encode(_table(spark, sf, "documents"), BYTE_BPE), BYTE_BPE)
    return back.select("doc_id", bpe_automaton.n_tokens().alias("n_tokens"),
                       F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_jaccard_join, op3_source_mixing, op4_language_id, op5_sentencepiece,
        op6_exact_dedup, op7_warc_fixity, op8_url_filters, op9_secret_scan, op10_quality_rules,
        op11_spelling_variants, op12_prefix_trie, op13_bpe_automaton)}
