"""Text files in: line scans, whole documents, document ids from paths."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def file_stem(name: Column) -> Column:
    """File name without its last extension (``a.txt.xml -> a.txt``)."""
    return F.regexp_replace(name, "\\.[^.]+$", "")


def _decoded(name: Column) -> Column:
    """A file's own name: Spark gives it percent-encoded, with ``+`` as it is."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _doc_id(kind: str) -> Column:
    return _kind(_decoded(F.col("_metadata.file_path" if kind == "path" else "_metadata.file_name")), kind)


def _kind(name: Column, kind: str) -> Column:
    if kind not in ("path", "stem"):
        raise ValueError(f"doc id is 'path' or 'stem', not {kind!r}")
    return name if kind == "path" else file_stem(name)


def read_lines(spark: SparkSession, path: str, doc_id: str = "path", max_line: int | None = None,
               skipped: Observation | None = None) -> DataFrame:
    """``(doc_id, line)``: one row per line of every file below ``path``.

    Many small files are packed into splits of ``spark.sql.files.maxPartitionBytes``,
    large ones are cut at line ends. With ``max_line`` lines of so many bytes or more,
    their line ends counted, are left out; ``skipped`` receives how many, as ``skipped``.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if max_line is None:
        return reader.text(path).select(_doc_id(doc_id).alias("doc_id"), F.col("value").alias("line"))
    # Only a line feed ends a row here, so carriage returns are still there to be counted.
    rows = reader.text(path, lineSep="\n").select(_doc_id(doc_id).alias("doc_id"), ended_lines(F.col("value")).alias("l"))
    lines = rows.select("doc_id", F.inline("l"))
    fits = F.col("n_bytes") < max_line
    if skipped is not None:
        lines = lines.observe(skipped, F.count_if(~fits).alias("skipped"))
    return lines.where(fits).select("doc_id", "line")


def ended_lines(row: Column) -> Column:
    """``(line, n_bytes)`` of the lines in what stands before a line feed, line ends counted.

    A carriage return ends a line as well; one right before the line feed is part of its
    line's end. The last line of a file counts as ended by a line feed.
    """
    ends_in_two = row.endswith("\r")
    pieces = F.split(F.when(ends_in_two, F.substr(row, F.lit(1), F.length(row) - 1)).otherwise(row), "\r")
    last = F.when(ends_in_two, 2).otherwise(1)
    return F.transform(pieces, lambda piece, i: F.struct(
        piece.alias("line"),
        (F.octet_length(piece) + F.when(i == F.size(pieces) - 1, last).otherwise(1)).alias("n_bytes")))


def list_files(spark: SparkSession, path: str, doc_id: str = "path") -> DataFrame:
    """``(doc_id, path, length, modified)`` of every file below ``path``, empty ones too.

    Only the listing is used, which the driver keeps for any scan: no file is opened. A
    scan leaves empty files out, so their names come from the listing itself; their
    ``modified`` is null.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    found = reader.format("binaryFile").load(path)
    names = spark.createDataFrame(pa.table({"file": pa.array(found.inputFiles(), pa.string())}))
    # Local paths have one slash or three in front, in one listing or the other.
    same = lambda c: F.regexp_replace(_decoded(F.col(c)), "^file:/+", "file:/")
    sizes = found.select(same("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    files = names.select(same("file").alias("path"), "file").join(sizes, "path", "left")
    name = _decoded(F.col("file") if doc_id == "path" else F.substring_index("file", "/", -1))
    return files.select(_kind(name, doc_id).alias("doc_id"), "path",
                        F.coalesce("length", F.lit(0)).cast("bigint").alias("length"), "modified")


def read_documents(spark: SparkSession, path: str, doc_id: str = "path") -> DataFrame:
    """``(doc_id, text)``: one row per file, the file being the document."""
    # wholetext must be the keyword: as an option the method's default wins.
    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return texts.select(_doc_id(doc_id).alias("doc_id"), F.col("value").alias("text"))
