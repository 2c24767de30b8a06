"""WARC archives and a Merkle fixity audit of their replicas. [operator 7]

Every record of an archive is hashed. Records are put into ranges of bytes by their
offset; a range's hash covers the offsets and hashes of its records in order, and
``FANOUT`` ranges at a time are hashed into wider ones, up to one root per archive.
An audit compares the roots of two replicas and descends only below ranges that
differ, to the records that do.

Only built-in expressions, but for reading archive files. A range gathers the
records of ``RANGE_BYTES`` bytes, a wider one ``FANOUT`` hashes; offsets are running
sums within one archive, whose number of records the choice of ``archive`` bounds.

Cases: a null address or page counts as empty. Records with the same id in an archive
are told apart by their offset. A record that only one replica has is ``missing`` or
``extra``, one with other bytes ``changed``, one with the same bytes elsewhere
``moved``. An empty table has no archives. Only the named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import saved, ship

RANGE_BYTES = 1 << 18
FANOUT = 16
# What separates two records in a file.
END = "\r\n\r\n"
NODE = ["archive", "level", "place", "hash"]


def record_text(record_id: Column, url: Column, page: Column) -> Column:
    """A WARC resource record without the line ends behind it."""
    body = F.coalesce(page, F.lit(""))
    # Line ends in an address would end its header.
    address = F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", "")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), address,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit(END), body)


def to_records(pages: DataFrame, archive: Column, record_id: str, url: str, page: str) -> DataFrame:
    """``(archive, record_id, record)`` of a table of pages."""
    return pages.select(archive.alias("archive"), F.col(record_id).alias("record_id"),
                        record_text(F.col(record_id), F.col(url), F.col(page)).alias("record"))


def catalogue(records: DataFrame) -> DataFrame:
    """``(archive, record_id, start, size, hash)``: where each record lies, in order of id."""
    hashed = records.select("archive", "record_id", F.octet_length("record").cast("long").alias("size"),
                            F.sha2("record", 256).alias("hash"))
    before = Window.partitionBy("archive").orderBy("record_id", "hash").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("size") + len(END)).over(before), F.lit(0))
    return hashed.withColumn("start", start)


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """``(archive, level, place, hash)``: the nodes above a catalogue, saved.

    Level 1 are ranges of ``range_bytes``; the highest level has one node per archive.
    """
    line = F.concat_ws(":", "start", "size", "hash")
    nodes = records.groupBy("archive", F.floor(F.col("start") / range_bytes).alias("place")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", line.alias("line")))),
                                        lambda x: x["line"]), ","), 256).alias("hash"))
    level, nodes = 1, saved(nodes.withColumn("level", F.lit(1)).select(*NODE))
    levels = [nodes]
    while (nodes.agg(F.max("place")).first()[0] or 0) > 0:
        child = F.struct("place", F.concat_ws(":", "place", "hash").alias("line"))
        level += 1
        nodes = saved(nodes.groupBy("archive", F.floor(F.col("place") / fanout).alias("up")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda x: x["line"]), ","), 256).alias("hash"))
            .select("archive", F.lit(level).alias("level"), F.col("up").alias("place"), "hash"))
        levels.append(nodes)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def mismatches(left: DataFrame, right: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(archive, place)`` of the level-1 ranges that differ, found from the roots down."""
    top = max(x.agg(F.max("level")).first()[0] or 1 for x in (left, right))
    suspects = None
    for level in range(top, 0, -1):
        a, b = (x.where(F.col("level") == level).select("archive", "place", "hash") for x in (left, right))
        if suspects is not None:
            up = F.floor(F.col("place") / fanout)
            a, b = (x.withColumn("up", up).join(suspects, ["archive", "up"], "left_semi").drop("up") for x in (a, b))
        differ = a.alias("a").join(b.alias("b"), ["archive", "place"], "full").where(
            ~F.col("a.hash").eqNullSafe(F.col("b.hash")))
        suspects = saved(differ.select("archive", F.col("place").alias("up")))
    return suspects.withColumnRenamed("up", "place")


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES,
          fanout: int = FANOUT) -> DataFrame:
    """One row per record of either catalogue: its place in ``left`` (else ``right``) and ``status``."""
    left, right = saved(left), saved(right)
    ranges = mismatches(tree(left, range_bytes, fanout), tree(right, range_bytes, fanout), fanout)
    suspect = lambda x: x.withColumn("place", F.floor(F.col("start") / range_bytes)).join(
        ranges, ["archive", "place"], "left_semi").drop("place")
    intact = left.withColumn("place", F.floor(F.col("start") / range_bytes)).join(
        ranges, ["archive", "place"], "left_anti").select(
        "archive", "record_id", "start", "size", "hash", F.lit("intact").alias("status"))
    turn = F.row_number().over(Window.partitionBy("archive", "record_id").orderBy("start")).alias("turn")
    a, b = (suspect(x).select("*", turn).alias(n) for x, n in ((left, "a"), (right, "b")))
    same = F.col("a.hash") == F.col("b.hash")
    status = (F.when(F.col("b.hash").isNull(), "missing").when(F.col("a.hash").isNull(), "extra")
              .when(~same, "changed").when(F.col("a.start") != F.col("b.start"), "moved").otherwise("intact"))
    on = (F.col("a.archive") == F.col("b.archive")) & F.col("a.record_id").eqNullSafe(F.col("b.record_id")) & (
        F.col("a.turn") == F.col("b.turn"))
    pick = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
    looked_at = a.join(b, on, "full").select(*map(pick, ("archive", "record_id", "start", "size", "hash")),
                                             status.alias("status"))
    return intact.unionByName(looked_at)


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """One WARC file per archive below ``path``, its records in order of id."""
    rows = records.repartition("archive").sortWithinPartitions("archive", "record_id")
    rows.select("archive", F.col("record").alias("value")).write.partitionBy("archive").option(
        "lineSep", END).option("compression", compression).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(archive, record_id, start, size, hash, url, page)`` of WARC files, each read by one task."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)

    def parse(batches: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        for batch in batches:
            for name, data in zip(batch["archive"], batch["content"]):
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                at, rows = 0, []
                while at < len(data):
                    head = data.index(END.encode(), at)
                    fields = dict(x.split(": ", 1) for x in data[at:head].decode().split("\r\n")[1:])
                    end = head + len(END) + int(fields["Content-Length"])
                    rows.append((name, fields["WARC-Record-ID"][len("<urn:record:"):-1], at, end - at,
                                 hashlib.sha256(data[at:end]).hexdigest(), fields["WARC-Target-URI"],
                                 data[head + len(END):end].decode()))
                    at = end + len(END)
                    if len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    columns = ["archive", "record_id", "start", "size", "hash", "url", "page"]
    archive = F.regexp_extract("path", "archive=([^/]+)/", 1)
    return files.select(archive.alias("archive"), "content").mapInPandas(
        parse, "archive string, record_id string, start long, size long, hash string, url string, page string")
