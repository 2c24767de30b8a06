"""Results out. Every writer replaces what an earlier run left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tsv(df: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated part files: no header, no quoting, nulls as empty fields."""
    _tsv(df).write.mode("overwrite").text(path)


def write_sorted_tsv(df: DataFrame, path: str, *order: Column | str) -> None:
    """Sorted TSV part files: read in name order they are one sorted sequence."""
    _tsv(df.orderBy(*order)).write.mode("overwrite").text(path)


def write_single_tsv(df: DataFrame, path: str, *order: Column | str,
                     max_rows: int = 1_000_000) -> None:
    """One sorted TSV file, for results known to be small such as a top-k.

    The size is checked first; a result above ``max_rows`` is refused, as it belongs
    into sorted part files (:func:`write_sorted_tsv`).
    """
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows for a single file")
    _tsv(df.coalesce(1).sortWithinPartitions(*order)).write.mode("overwrite").text(path)


def write_ranked_tsv(df: DataFrame, path: str, *order: Column | str, max_rows: int = 1_000_000) -> None:
    """A ranking as one sorted file, or as sorted part files where it has over ``max_rows`` rows."""
    many = df.limit(max_rows + 1).count() > max_rows
    (write_sorted_tsv if many else write_single_tsv)(df, path, *order)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a writer has completed the folder ``path``: its mark is written last."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def hand_over(df: DataFrame, path: str) -> DataFrame:
    """Write a result once and read it back for the next job."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
