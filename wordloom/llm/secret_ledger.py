"""Secret scans with an incremental blob ledger. [operator 9]

A version of a file is a path and a text; its blob is the SHA-256 of the text. The
ledger is a table in a shared folder with one row per blob and rule version that was
ever scanned, and what was found. A scan takes the blobs of the given versions, drops
those the ledger has under the present rule version, scans each other blob once, adds
them to the ledger, and joins the findings back to every path that holds the blob.

Rules are regular expressions, so the scan runs in Python over Arrow batches, one
text at a time. The rule version is a digest of the rules themselves.

Cases: a null text counts as empty. Paths that repeat are reported as often as they
occur; a null path is a path. An empty table leaves the ledger as it is. Only path
and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import join_keyed, saved, scratch_path, ship


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed values of the contract: the base kinds, in their order.
BASE = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
)
# What the method adds: kinds whose form alone tells them.
ADDED = (
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    SecretRule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/:@]{3,64})@", 1, 3),
)
RULES = BASE + ADDED

LEDGER = "blob string, rules string, findings array<struct<kind: string, start: int, end: int>>"


def rule_version(rules: Sequence[SecretRule]) -> str:
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def spans(text: str, rules: Sequence[tuple[str, re.Pattern, int, int]]) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then in the order of the rules."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    found.sort()
    return [(kind, start, end) for start, _, kind, end in found]


def compiled(rules: Sequence[SecretRule]) -> list[tuple[str, re.Pattern, int, int]]:
    """The rules ready to use. A bare run is looked for at its least length at once."""
    out = []
    for r in rules:
        run = re.fullmatch(r"(\[[^\]]+\])\+", r.pattern)
        out.append((r.kind, re.compile(f"{run[1]}{{{r.least},}}" if run else r.pattern, re.ASCII), r.group, r.least))
    return out


def scan_blobs(blobs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """``(blob, rules, findings)`` of ``blobs(blob, text)``."""
    ship(blobs.sparkSession)
    version = rule_version(rules)

    def scan(batches: Iterator) -> Iterator:
        import pandas as pd

        ready = compiled(rules)
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t, ready)] for t in batch["text"]]
            yield pd.DataFrame({"blob": batch["blob"], "rules": version, "findings": found})

    return blobs.select("blob", "text").mapInPandas(scan, LEDGER)


def ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, empty if nothing was ever scanned into it."""
    schema = T._parse_datatype_string(LEDGER)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan(versions: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES,
         path: str = "path", text: str = "text") -> DataFrame:
    """``(path, blob, findings)`` per row of ``versions``, the ledger brought up to date."""
    spark = versions.sparkSession
    rows = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    places = saved(rows.select("path", "blob"))
    blobs = saved(places.groupBy("blob").agg(F.count("*").alias("n")))
    known = ledger_table(spark, ledger).where(F.col("rules") == rule_version(rules)).select("blob")
    # Copies in a task fold into one row before the texts are shuffled.
    unseen = rows.groupBy("blob").agg(F.any_value("text").alias("text")).join(known, "blob", "left_anti")
    scan_blobs(unseen, rules).write.mode("append").parquet(ledger)
    # Of the ledger's whole history only the rows of this scan's blobs go on. A run that
    # was repeated may have added a blob twice, with the same findings.
    found = ledger_table(spark, ledger).where(F.col("rules") == rule_version(rules)).drop("rules")
    found = found.join(blobs, "blob").dropDuplicates(["blob"])
    return join_keyed(places, saved(found), ["blob"], "n").select("path", "blob", "findings")


def fresh_ledger(spark: SparkSession) -> str:
    return scratch_path(spark, "ledger")
