import contextlib
import glob
import os
import time

import pytest

from samples import DOCS, prose
from wordloom.llm import common, exact_dedup, jaccard_join, mixing


def documents(spark):
    return spark.createDataFrame([(i, prose("en", 40, i % 150), "en", "abc"[i % 3]) for i in range(200)], DOCS)


def star(spark):
    return spark.range(1, 4_000).selectExpr("id as a", "0L as b")


@pytest.mark.parametrize("step", [
    lambda spark: jaccard_join.components(star(spark)),
    lambda spark: exact_dedup.build_index(documents(spark)),
    lambda spark: mixing.mix(documents(spark)),
], ids=["components", "build_index", "mix"])
def test_saved_steps_remove_their_shuffle_files(spark, step, monkeypatch):
    """Some may stay: of looks at saved steps, like a count, and of stages that end after their step, unused."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def left(most):
        before = {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
        step(spark)
        until = time.time() + 10
        while True:
            size = 0
            for d in folders:
                for f in set(glob.glob(f"{d}/**/shuffle_*.data", recursive=True)) - before:
                    with contextlib.suppress(OSError):  # a file may go meanwhile
                        size += os.path.getsize(f)
            if size <= most or time.time() > until:
                return size
            time.sleep(0.2)

    with monkeypatch.context() as m:
        m.setattr(common, "TIDY", "spark.sql.noSuchSetting")
        all_ = left(1 << 60)
    assert left(all_ // 3) <= all_ // 3
