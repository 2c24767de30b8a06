"""Exact duplicates by an extendible-hash index on shared files. [operator 6]

Texts are equal when the same bytes remain after their white space is deleted. The
index has one entry per different text. Its directory starts as one bucket; every
bucket with more than ``capacity`` entries is split at the next bit of the hash, and
the directory has doubled as often as the deepest bucket was split. A directory slot
is the run of leading hash bits at that depth; several slots share a shallow bucket.
Each owner task takes a range of buckets and chains the entries whose hashes agree.

Only built-in expressions: equal texts meet, and are compared byte by byte, in a
grouping on ``(hash, text)`` that folds the copies of a task before anything is
shuffled; these are the entries. Digests then stand for the texts. A row finds its bucket
through the directory, and in it the entry of its text, which gives the row that stays
and the size of the group. That no two different texts share a digest is checked against
the byte-wise entry, and the job stops if they do.

Cases: a null text counts as empty, so all null, empty and blank texts are equal. Of
rows alike in text, length and id one stays. Ids are of any type that has an order; a
null id comes after all others. An
empty table gives an empty result. Only the id and the text are read, so further
columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import join_keyed, one_of_alike, without, without_space
from wordloom.llm.common import saved_tidily as saved

CAPACITY = 50_000
CELL_BITS = 20


def normalised(text: Column) -> Column:
    return without_space(F.coalesce(text, F.lit("")))


def _hash(norm: Column, hash_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(norm)


def text_groups(docs: DataFrame, text: str = "text", hash_bits: int = 64) -> DataFrame:
    """``(h, sha, n)``: one row per different text, compared by its bytes."""
    norm = normalised(F.col(text)).alias("norm")
    rows = docs.select(norm).select(_hash(F.col("norm"), hash_bits).alias("h"), "norm")
    groups = rows.groupBy("h", "norm").agg(F.count("*").alias("n"))
    return groups.select("h", F.sha2("norm", 256).alias("sha"), "n")


def directory(entries: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """``(slot, depth, bucket, n_entries)``: the directory after all its doublings.

    Entries are counted once in cells of 20 leading hash bits. A node of the split
    tree is a bucket when it fits and its parent did not; a cell that does not fit
    stays a bucket, as one more doubling would not be told apart by its count.
    """
    bits = min(CELL_BITS, hash_bits)
    cells = entries.groupBy(_leading(F.col("h"), bits, hash_bits).alias("cell")).agg(
        F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")
    at = F.expr("shiftright(cell, %d - depth)" % bits).alias("prefix")
    nodes = cells.select("cell", "n", levels).select("depth", at, "n").groupBy(
        "depth", "prefix").agg(F.sum("n").alias("n"))
    split = nodes.where(F.col("n") > capacity).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    whole = nodes.where((F.col("n") <= capacity) | (F.col("depth") == bits)).withColumn(
        "parent", F.shiftright("prefix", 1))
    buckets = whole.where("depth = 0").drop("parent").unionByName(
        whole.join(split, ["depth", "parent"], "left_semi").drop("parent"))
    deepest = buckets.agg(F.max("depth").alias("top"))
    slots = F.sequence(F.expr("shiftleft(prefix, top - depth)"),
                       F.expr("shiftleft(prefix + 1, top - depth) - 1"))
    return buckets.crossJoin(F.broadcast(deepest)).select(
        F.explode(slots).alias("slot"), F.col("top"), "depth", F.col("prefix").alias("bucket"),
        F.col("n").alias("n_entries"))


def _leading(h: Column, bits: int, hash_bits: int) -> Column:
    return F.shiftrightunsigned(h, hash_bits - bits)


def _located(rows: DataFrame, slots: DataFrame, hash_bits: int) -> DataFrame:
    """``rows(h, …)`` with the ``bucket`` and ``depth`` that the directory has for their hash."""
    top = slots.agg(F.max("top")).first()[0] or 0
    slot = _leading(F.col("h"), top, hash_bits) if top else F.lit(0).cast("long")
    # At most 2 ** CELL_BITS slots.
    return rows.withColumn("slot", slot).join(F.broadcast(slots.select("slot", "depth", "bucket")), "slot").drop("slot")


def _index(docs: DataFrame, text: str, capacity: int, hash_bits: int) -> tuple[DataFrame, DataFrame]:
    entries = saved(text_groups(docs, text, hash_bits))
    slots = saved(directory(entries, capacity, hash_bits))
    owned = _located(entries, slots, hash_bits).repartitionByRange("depth", "bucket")
    chain = F.row_number().over(Window.partitionBy("depth", "bucket", "h").orderBy("sha"))
    return saved(owned.select("bucket", "depth", "h", chain.alias("chain"), "sha", "n")), slots


def build_index(docs: DataFrame, text: str = "text", capacity: int = CAPACITY,
                hash_bits: int = 64) -> DataFrame:
    """``(bucket, depth, h, chain, sha, n)``, saved in bucket order in the shared folder.

    ``chain`` counts the different texts under one hash, from 1.
    """
    return _index(docs, text, capacity, hash_bits)[0]


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    Of equal texts the row with the most code points in its original text stays,
    then the one with the smallest id.
    """
    rows = saved(docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("length"),
        normalised(F.col(text)).alias("norm"),
    ).select("doc_id", "length", F.monotonically_increasing_id().alias("row"),
             _hash(F.col("norm"), hash_bits).alias("h"), F.sha2("norm", 256).alias("sha")))
    index, slots = _index(docs, text, capacity, hash_bits)
    # Every row finds its bucket in the directory, and there the entry of its text.
    held = _located(rows, slots, hash_bits)
    best = F.min(F.struct(-F.col("length"), F.col("doc_id").isNull(), "doc_id", "row"))
    entry = ["depth", "bucket", "h", "sha"]
    owned = held.groupBy(*entry).agg(best.alias("best"), F.count("*").alias("group_size"))
    agreed = F.when(F.col("n") == F.col("group_size"), F.col("group_size")).otherwise(
        F.raise_error(F.lit("different texts share one digest")))
    chosen = saved(owned.join(index, entry).select(
        *entry, "chain", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"),
        agreed.alias("group_size")))
    return join_keyed(held, chosen, entry, "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = saved(exact_dedup(docs, doc_id, text).select("doc_id", F.col("text_sha256").alias("digest"), "kept"))
    alike = found.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    rows = without(docs, alike.where(~F.col("kept")), doc_id, lambda d: F.sha2(normalised(d[text]), 256))
    if not alike.where("kept and n > 1").isEmpty():
        rows = one_of_alike(rows, doc_id, F.desc(F.length(F.coalesce(F.col("doc")[text], F.lit("")))))
    return rows.select("doc.*")
