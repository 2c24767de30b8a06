"""Spelling variants: words one edit apart, compared in dense tiles. [operator 11]

Two words are near when they differ by one inserted, deleted or replaced code point: then
their common prefix and their common suffix together reach the longer length less one.
One of the two has half of that at least. So words of the lengths ``b`` and ``b - 1`` meet
twice, with those that share the first ``b // 2`` code points and with those that share
the last; pairs that share both are counted in the first meeting only.

A meeting is compared as a whole: its words are rows of a matrix of code points, padded
to the same width, once from the left and once from the right. Column by column all pairs
of rows are compared, which gives prefix and suffix lengths of all pairs as two square
tiles. Small meetings are stacked to tiles of one size; one of more than ``BLOCK`` words
is cut into blocks, and each pair of blocks is a tile of its own, so no tile grows with
the data. A tile gives a row per word with near words in it: how many, and the best one.

A word's form is its near word with the most occurrences, if it has ``RATIO`` times the
word's own at least. The root follows forms to the last; each form is ``RATIO`` times as
frequent as the one before, so doubling the steps ends after a few rounds.

Cases: a null text has no words, a null id is an empty text in the hash. Repeated rows
count as often as they stand there. Words may be of any length. A tie for the form goes
to the smallest word in code-point order. An empty table, or one without frequent words,
gives an empty result. Only id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import join_keyed, saved, ship

# Fixed values of the contract: runs of letters, the share of damaged ones, the bounds.
RUNS = "[A-Za-zÀ-ÿ]+"
DAMAGE = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5

BLOCK = 1024
# Cells of the tiles that a task works on at once, and rows that a task should get.
CELLS = 2_000_000
TASK_ROWS = 20_000


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word)``: every run of six letters or more, lower-cased, a few of them damaged."""
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(RUNS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= MIN_LENGTH).select(
        "id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    damaged = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % DAMAGE == 0, damaged).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words with ``min_count`` occurrences at least."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def meetings(words: DataFrame) -> DataFrame:
    """``(b, side, part, word, n)``: the four meetings that each word goes to."""
    size = F.length("word")
    def meet(b, side):
        half = F.floor(b / 2).cast("int")
        part = F.left("word", half) if side == "p" else F.right("word", half)
        return F.struct(b.alias("b"), F.lit(side).alias("side"), part.alias("part"))

    return words.select(F.inline(F.array(*[meet(size + k, side) for k in (0, 1) for side in "ps"])), "word", "n")


def tiles(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(b, side, part, i, j, block, word, n)``: the rows of each tile.

    A tile compares the blocks ``i`` and ``j`` of a meeting, or one block with itself.
    """
    key = ["b", "side", "part"]
    rows = saved(meetings(words))
    sizes = rows.groupBy(*key).agg(F.count("*").alias("size"))
    large = saved(sizes.where(F.col("size") > block))
    some = saved(sizes.where((F.col("size") > 1) & (F.col("size") <= block)).select(*key, "size"))
    whole = join_keyed(rows, some, key, "size").select(
        *key, F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "word", "n")
    n_blocks = F.ceil(F.col("size") / block).cast("int")
    cut = join_keyed(rows, large, key, "size").withColumn(
        "block", F.pmod(F.xxhash64("word"), n_blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    return whole.unionByName(cut.select(
        *key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n"))


def near_in_tile(left, right, sizes, blocks, two_blocks: bool, width: int, side: str):
    """``(tile, x, y)`` of the near pairs ``x < y`` in a stack of tiles.

    ``left`` and ``right`` hold the code points ``[tile, row, column]`` from the left and
    from the right; rows without a word have size 0. All words share their first (side p)
    or last (side s) ``width // 2`` code points.
    """
    import numpy as np

    half = width // 2
    first, second, reach = (left, right, width - 1 - half) if side == "p" else (right, left, half)
    longer = np.maximum(sizes[:, :, None], sizes[:, None, :])
    both = np.minimum(sizes[:, :, None], sizes[:, None, :]) > 0
    pairs = both & (longer == width) & np.triu(np.ones(both.shape[1:], dtype=bool), 1)
    if two_blocks:
        pairs &= blocks[:, :, None] != blocks[:, None, :]

    def common(codes, start, stop):
        """How many columns from ``start`` on agree without a break."""
        alive, length = pairs.copy(), np.zeros(pairs.shape, dtype=np.int32)
        for c in range(start, stop):
            alive &= codes[:, :, None, c] == codes[:, None, :, c]
            if not alive.any():
                break
            length += alive
        return length

    a, b = common(first, half, width) + half, common(second, 0, reach)
    near = pairs & (a + b >= width - 1)
    if side == "s":
        near &= b < half
    return np.nonzero(near)


def _compare(frame):
    """``(word, n_near, best_n, best)`` from the whole tiles that ``frame`` holds, in order."""
    import numpy as np
    import pandas as pd

    key = ["b", "side", "part", "i", "j"]
    new = np.ones(len(frame), dtype=bool)
    new[1:] = (frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(frame)))
    words, n, block = frame["word"].to_numpy(), frame["n"].to_numpy(), frame["block"].to_numpy()
    head = frame.iloc[starts]
    # Tiles of one width, side and size class are stacked.
    room = 1 << np.ceil(np.log2(np.maximum(counts, 2))).astype(int)
    kinds = pd.DataFrame({"b": head["b"].to_numpy(), "side": head["side"].to_numpy(), "room": room,
                          "two": (head["i"] != head["j"]).to_numpy()})
    xs, ys = [], []
    for (b, side, s, two), at in kinds.groupby(["b", "side", "room", "two"]).indices.items():
        step = max(1, int(CELLS // max(s * s, s * b)))
        for k in range(0, len(at), step):
            part = at[k:k + step]
            place = np.arange(s)[None, :]
            there = place < counts[part][:, None]
            rows = np.where(there, starts[part][:, None] + place, 0)
            # All letters of a word are below U+0100.
            raw = [w.encode("latin-1") for w in words[rows.ravel()]]
            left = np.array(raw, dtype=f"S{b}").view(np.uint8).reshape(len(part), s, b)
            right = np.array([w[::-1] for w in raw], dtype=f"S{b}").view(np.uint8).reshape(len(part), s, b)
            sizes = np.where(there, np.array([len(w) for w in raw]).reshape(len(part), s), 0)
            t, x, y = near_in_tile(left, right, sizes, block[rows], bool(two), int(b), side)
            xs.append(rows[t, x])
            ys.append(rows[t, y])
    x = np.concatenate([*xs, *ys]) if xs else np.zeros(0, dtype=int)
    y = np.concatenate([*ys, *xs]) if xs else np.zeros(0, dtype=int)
    found = pd.DataFrame({"word": words[x], "best": words[y], "best_n": n[y]})
    found = found.sort_values(["word", "best_n", "best"], ascending=[True, False, True], kind="stable")
    count = found.groupby("word", sort=False)["best"].size()
    return found.drop_duplicates("word").assign(n_near=lambda f: f["word"].map(count))[
        ["word", "n_near", "best_n", "best"]]


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words of ``words(word, n)`` that have near ones."""
    ship(words.sparkSession)
    key = ["b", "side", "part", "i", "j"]
    rows = saved(tiles(words, block))
    width = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))
    dealt = rows.repartition(width, *key).sortWithinPartitions(*key)

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            # The last tile may go on in the next batch.
            last = (frame[key] == frame[key].iloc[-1]).all(axis=1).to_numpy()
            start = len(frame) - int(last[::-1].argmin()) if not last.all() else 0
            rest = frame.iloc[start:]
            if start:
                yield _compare(frame.iloc[:start])
        if rest is not None and len(rest):
            yield _compare(rest)

    found = dealt.mapInPandas(work, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last word that forms lead to."""
    steps = saved(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not steps.where("moved").isEmpty():
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = saved(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return steps.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT,
             ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every frequent word of ``docs``."""
    words = saved(vocabulary(occurrences(docs, doc_id, text), min_count))
    near = near_words(words, block)
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    told = saved(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    last = roots(told.where("form is not null"))
    return told.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
