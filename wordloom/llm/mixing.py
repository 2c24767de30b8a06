"""Mixing sources to target weights by capped water-filling. [operator 3]

Every source asks for a share of ``share`` times all words, in proportion to its
weight. A source that would be read more than ``max_epochs`` times is clamped there,
and what it cannot take goes to the others by weight, again and again until no
source is above. Its documents are then taken a whole number of times, and a seeded
part of them once more.

The part is a prefix of the source's documents in the order of a keyed hash, found
by two rounds of sums over 4,096 hash ranges, so that no source is sorted in one
task. Of the documents behind the prefix, the one whose size is nearest to the words
still missing joins it, if that brings the source nearer to its target.

Cases: a null text has no words; a null source is a source of its own and comes
last; a source without words, or an empty table, gets nothing. Rows that repeat in
id and size are taken alike. Only id, text and source are read, so further columns
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import join_keyed, packed, words_of
from wordloom.llm.common import saved_tidily as saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
BIN_BITS = 12


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point, null last, without one big sort task.

    The rows are dealt out by ranges and numbered in each; only the number of rows
    per range, as many as there are partitions, is added up in one place.
    """
    ranges = saved(sources.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    sizes = ranges.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    return ranges.withColumn("place", place).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("place") + F.col("before")).drop("part", "place", "before")


def water_fill(sources: DataFrame, total: float) -> DataFrame:
    """``sources(weight, cap, …)`` with ``target``: shares of ``total`` by weight, none above its cap.

    Each round clamps the sources whose share reaches their cap and shares the rest
    out anew. Only sums come to the driver; a round clamps one source at least.
    """
    clamped = F.lit(False)
    while True:
        free = F.sum(F.when(~clamped, F.col("weight")))
        taken = F.sum(F.when(clamped, F.col("cap")))
        n = F.count_if(clamped)
        weight, full, n_full = sources.agg(free, taken, n).first()
        left = max(0.0, total - (full or 0.0))
        level = left / weight if weight else 0.0
        above = clamped | (F.col("weight") * level >= F.col("cap"))
        if sources.where(above).count() == n_full:
            return sources.withColumn(
                "target", F.when(clamped, F.col("cap")).otherwise(F.col("weight") * level))
        # The level only rises, so a clamped source stays clamped.
        clamped = F.lit(level) * F.col("weight") >= F.col("cap")


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last."""
    return F.when(source.isNull(), F.struct(F.lit(1).alias("last"), F.lit("").alias("name"))).otherwise(
        F.struct(F.lit(0).alias("last"), source.alias("name")))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(key, n_docs, source_size, target)`` per source of ``sizes(key, size)``."""
    sources = ranked(sizes.groupBy("key").agg(
        F.count("*").alias("n_docs"), F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    sources = saved(sources.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(max_epochs))))
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    return water_fill(sources, total)


def _prefix_ends(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """``(key, cut, missing)``: the hash up to which a source's rows are taken once more.

    The prefix is the longest whose words do not pass ``goal[want]``; ``missing`` are
    the words it lacks. Sums over 4,096 hash ranges find the range where it ends; rows
    are looked at one by one in that range alone, a 4,096th of the source.
    """
    cell = F.shiftright("u", 63 - BIN_BITS).alias("cell")
    bins = rows.groupBy("key", cell).agg(F.sum("size").alias("words"))
    edge = _last_below(bins.join(goal.select("key", "want"), "key"), "cell")
    edge = goal.select("key", "want").join(edge, "key", "left").select(
        "key", F.coalesce(F.col("last") + 1, F.lit(0)).alias("cell"),
        (F.col("want") - F.coalesce("upto", F.lit(0))).alias("want"))
    inside = rows.withColumn("cell", cell).join(edge, ["key", "cell"])
    alike = inside.groupBy("key", "u", "want").agg(F.sum("size").alias("words"))
    ends = _last_below(alike, "u").withColumnsRenamed({"last": "u", "upto": "inside"})
    start = F.shiftleft("cell", 63 - BIN_BITS) - 1
    return edge.join(ends, "key", "left").select(
        "key", F.coalesce("u", start).alias("cut"),
        (F.col("want") - F.coalesce("inside", F.lit(0))).alias("missing"))


def _last_below(sums: DataFrame, order: str) -> DataFrame:
    """``(key, last, upto)``: the last value of ``order`` whose running sum is within ``want``.

    Every value below an existing one that is too much is within it, so a range
    without rows does no harm.
    """
    run = F.sum("words").over(Window.partitionBy("key").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    return sums.withColumn("upto", run).where("upto <= want").groupBy("key").agg(
        F.max(order).alias("last"), F.max("upto").alias("upto"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = 1) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), _source_key(F.col(source)).alias("key"),
                       F.size(words_of(F.col(text))).cast("long").alias("size"))
    return copies(rows, weights, share, max_epochs, seed).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def copies(rows: DataFrame, weights=WEIGHTS, share: float = SHARE,
           max_epochs: float = MAX_EPOCHS, seed: int = 1) -> DataFrame:
    """``rows(doc_id, key, size)`` with ``source_size``, ``target`` and whole ``copies``."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 1)
    rows = saved(rows.withColumn("u", u))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = targets(rows, weights, share, max_epochs).select(
        "key", "n_docs", "source_size", "target", F.floor(epochs).alias("whole"))
    part = F.col("target") - F.col("whole") * F.col("source_size")
    goal = saved(goal.withColumn("want", F.round(part).cast("long")))
    # Where whole copies make up the target nobody is taken once more, wordless rows neither.
    cut = F.when(F.col("want") > 0, F.col("cut")).otherwise(F.lit(-1).cast("long"))
    ends = saved(goal.join(_prefix_ends(rows, goal), "key").withColumn("cut", cut))

    placed = saved(join_keyed(rows, ends.drop("want"), ["key"], "n_docs"))
    behind = placed.where((F.col("u") > F.col("cut")) & (F.col("size") < 2 * F.col("missing")))
    alike = behind.groupBy("key", "u", "missing").agg(F.sum("size").alias("words"))
    off = F.abs(F.col("words") - F.col("missing"))
    nearest = alike.where(off < F.col("missing")).groupBy("key").agg(
        F.min(F.struct(off.alias("off"), "u"))["u"].alias("pick"))
    picked = saved(ends.select("key", "n_docs").join(nearest, "key", "left"))
    once_more = (F.col("u") <= F.col("cut")) | F.coalesce(F.col("u") == F.col("pick"), F.lit(False))
    return join_keyed(placed.drop("n_docs"), picked, ["key"], "n_docs").withColumn(
        "copies", F.col("whole") + once_more.cast("long"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    def fields(c) -> list[Column]:
        return [c[doc_id].alias("doc_id"), _source_key(c[source]).alias("key"),
                F.size(words_of(c[text])).cast("long").alias("size")]

    rows = packed(docs).select("doc", F.struct(*fields(F.col("doc"))).alias("row"))
    chosen = copies(rows.select("row.*"), **how).select(
        F.struct("doc_id", "key", "size").alias("chosen"), F.col("copies").cast("int").alias("n")).distinct()
    taken = rows.join(chosen, F.col("row").eqNullSafe(F.col("chosen"))).where("n > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("n")))).select("doc.*")
