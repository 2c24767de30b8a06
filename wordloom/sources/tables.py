"""Parquet tables in, with a check that the scan can use the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A scan is dealt out anew only below this size, whatever the number of cores.
SPREAD_BYTES = 1 << 30
# Footers are read from at most so many files; a table of more is wide enough.
FOOTERS = 256


def load_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return spread(df, row_groups(df, -(-cores // 2))) if _scan_bytes(df) <= SPREAD_BYTES else df


def row_groups(df: DataFrame, enough: int) -> int:
    """How many row groups with rows the files of a scan have, told from their footers.

    Spark may cut a file into many splits, but a row group is read whole, by the split
    that holds its middle; so no more tasks than this get rows. Counting stops at
    ``enough``, and no more than ``FOOTERS`` files are looked at.
    """
    files = df.inputFiles()
    if len(files) > FOOTERS:
        return len(files)
    jvm, found = df.sparkSession._jvm, 0
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    parquet, hadoop = jvm.org.apache.parquet.hadoop, jvm.org.apache.hadoop.fs
    for name in files:
        path = hadoop.Path(jvm.java.net.URI(name))
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
        try:
            found += sum(group.getRowCount() > 0 for group in reader.getRowGroups())
        finally:
            reader.close()
        if found >= enough:
            break
    return found


def spread(df: DataFrame, groups: int | None = None) -> DataFrame:
    """Deal the rows of a small scan out over all cores.

    ``groups`` is the number of row groups that hold the rows, where it is known. The
    rows are moved only where fewer than half as many tasks as cores would get any,
    and the files are small; any larger scan is returned as it is, without a
    shuffle. Rows are dealt by their place in the scan: even, also where many rows are
    alike, repeatable, and without the sort that dealing in turn needs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.rdd.getNumPartitions()
    if min(tasks, tasks if groups is None else groups) * 2 >= cores or _scan_bytes(df) > SPREAD_BYTES:
        return df
    return df.repartition(cores, F.monotonically_increasing_id())


def _scan_bytes(df: DataFrame) -> int:
    """The planner's estimate for the scan, from the file listing."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
