"""Session settings that suit the jobs; each can be overridden."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Text is CPU-bound here: small splits keep all cores busy, and many small
    # files are packed up to this size.
    "spark.sql.files.maxPartitionBytes": "64m",
}


# A reducer should get about this much, and a large input be read in splits of so much.
REDUCER_BYTES = 128 << 20
LARGE_INPUT, LARGE_SPLIT = 1 << 40, 256 << 20


def widths(input_bytes: int) -> dict[str, str]:
    """Shuffle and split widths for an input of so many bytes.

    Per-word counts shuffle about as much as they read where documents are spread over
    lines, so there is a reducer per 128 MB of input; AQE joins those that get little.
    From 1 TB on splits are larger, or the driver would keep millions of tasks.
    """
    reducers = max(200, -(-input_bytes // REDUCER_BYTES))
    out = {"spark.sql.shuffle.partitions": str(reducers)}
    if input_bytes >= LARGE_INPUT:
        out["spark.sql.files.maxPartitionBytes"] = str(LARGE_SPLIT)
    return out


def session(app: str, master: str | None = None, input_bytes: int | None = None,
            **settings: str) -> SparkSession:
    """A session with the settings above; the cluster's own otherwise.

    ``input_bytes``, the size of what the jobs will read, sets the widths.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else widths(input_bytes)
    for key, value in {**SETTINGS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
