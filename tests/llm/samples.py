"""Small tables with the awkward cases, and documents in two made-up languages."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string"
# Columns that operators use inside: they must not get in the way.
CLASHING = ["h", "norm", "row", "n", "key", "cid", "bands", "block", "u", "ids", "kept", "_id", "path", "host"]

AWKWARD = [
    (1, "one two three four five six seven", "en", "a"),
    (2, "one  two\nthree four five six seven ", "en", "b"),
    (2, "one  two\nthree four five six seven ", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\r\n\x0b\x0c", "en", "a"),
    (None, "one two three four five six seven", None, None),
    (6, "é😀 日本語 ▁mark", "xx", "a"),
    (7, "word " * 20_000, "en", "c"),
    (8, "x" * 50_000, "en", None),
    (9, "one two three four", "en", "b"),
]


def awkward(spark):
    """The rows above with clashing extra columns that hold nulls."""
    df = spark.createDataFrame(AWKWARD, DOCS)
    for name in CLASHING:
        df = df.withColumn(name, df["lang"])
    return df


def empty(spark):
    return awkward(spark).limit(0)


SYLLABLES = {"en": "the of an er in on re th ing ed ly st".split(), "fr": "le la ou que é è eau tion ment ai re en".split()}


def prose(lang: str, words: int, seed: int) -> str:
    rng = random.Random(f"{lang}{seed}")
    out = []
    for _ in range(words):
        out.append("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.choice((1, 1, 2, 3)))))
    return " ".join(out)


def corpus(n: int = 200, words: int = 80) -> list[tuple]:
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "fr"
        rows.append((i, prose(lang, words + i % 7, i), lang, f"s{i % 4}"))
    return rows
