"""Helpers that several operators share: scratch tables, hot keys, white space."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The white space of the contracts, [\x20\x09-\x0D].
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"

# A key is hot when it holds more than one row in HOT_SHARE, so at most
# HOT_SHARE - 1 keys are: that is the size bound behind every broadcast of them.
HOT_SHARE = 256

# Spark's setting for shuffle files that go with the job they were written for.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing a local session gets a temporary folder; a cluster
    without it is refused, as its executors would not see each other's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wordloom-"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="wordloom-")) / "wordloom_package"
        sc.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _SHIPPED.add(sc.applicationId)


def give_back() -> None:
    """Return what a task has freed to the system: its Python worker lives on beside others."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` worked out once, its lineage cut by files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def saved_tidily(df: DataFrame) -> DataFrame:
    """``saved``, and the files that its shuffles left go at once.

    Otherwise they stay on the executors' disks until the driver happens to collect garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(TIDY, "false")
    conf.set(TIDY, "true")
    try:
        # The setting is read where a plan is made, so the plan is made anew.
        return saved(df.select("*"))
    finally:
        conf.set(TIDY, before)


def without(docs: DataFrame, dropped: DataFrame, doc_id: str, digest) -> DataFrame:
    """The rows of ``docs`` whose ``(id, digest)`` is not in ``dropped(doc_id, digest)``.

    ``dropped`` is written first, so the planner knows its size: a few rows are sent to
    the texts, many are joined.
    """
    path = scratch_path(docs.sparkSession, "dropped")
    dropped.select("doc_id", "digest").distinct().write.parquet(path)
    rows = packed(docs).withColumn("own", digest(F.col("doc")))
    same = F.col("doc")[doc_id].eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("digest"))
    return rows.join(docs.sparkSession.read.parquet(path), same, "left_anti")


def one_of_alike(rows: DataFrame, doc_id: str, first: Column) -> DataFrame:
    """Of rows that repeat in id and ``own`` digest one each, by ``first``; a shuffle of all texts."""
    turn = Window.partitionBy(F.col("doc")[doc_id], "own").orderBy(first)
    return rows.withColumn("turn", F.row_number().over(turn)).where("turn = 1")


def deleted(text: Column, characters: tuple[str, ...]) -> Column:
    """``text`` without the given characters, byte-wise and inside the JVM."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)


def without_space(text: Column) -> Column:
    return deleted(text, SPACES)


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; null and blank texts have none.

    Other white space becomes a blank first: a split at one plain character does
    not go through the pattern matcher.
    """
    plain = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACES[1:],
                   F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(plain, " "), "")


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``doc``, so that no further column can clash with it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, whatever the body does with it."""
    return F.transform(F.array(value), body)[0]


def join_keyed(rows: DataFrame, table: DataFrame, on: list[str], n: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key.

    ``table[n]`` is the number of rows that hold the key. Hot keys (over one row in
    256, so fewer than 256 of them) are joined by broadcast, where their rows stay;
    the rest is shuffled, none of it hot. Both inputs are read twice and should be
    saved. Keys must not be null.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * HOT_SHARE > F.lit(total)
    hot = F.broadcast(table.where(is_hot))
    here = rows.join(hot, on)
    rest = rows.join(F.broadcast(table.where(is_hot).select(*on)), on, "left_anti")
    return here.unionByName(rest.join(table.where(~is_hot), on))
