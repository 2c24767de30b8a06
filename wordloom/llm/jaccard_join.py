"""N-gram Jaccard join by MinHash banding, and the groups it makes. [operator 2]

A text's set holds its runs of five words, by hash; a text of one to four words has
one run. Texts with the same set are one class from the start. A signature has a
minimum per hash function; ``rows`` of them make a band, and two classes are
candidates when a band agrees. Bands and rows are chosen so that a pair at the
threshold is found with probability ``target_recall``. Candidates are shuffled by
band hash and verified on their whole sets.

A bucket of up to ``SMALL`` classes gives its pairs, each told once, in the first
band that it agrees in. Larger buckets are many different texts that resemble each
other. Their pairs are never written down: classes in connected large buckets are one
crowd, which is cut into blocks of ``BLOCK`` classes, each packed into one row and first
compared with itself. A task then compares two blocks on whole sets, and gives two rows:
how many links the classes of each have, and which connected parts of both are linked. So
every pair is verified, in pieces of bounded size, and neither rows nor edges come per
pair of classes.

Cases: a text without words, or null, is in a class of its own and has no links.
Rows that repeat are each linked with the others of their class. A tie for the class
id goes to the smallest id, null ids last. An empty table gives an empty result. Only
id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import HOT_SHARE, give_back, join_keyed, one_of_alike, ship, without
from wordloom.llm.common import saved_tidily as saved

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
MAX_HASHES = 128
SMALL = 24
BLOCK = 256


def choose_bands(threshold: float, target_recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows per band, so the fewest false candidates, that reach the recall."""
    for rows in range(max_hashes, 0, -1):
        bands = max_hashes // rows
        for b in range(1, bands + 1):
            if 1 - (1 - threshold**rows) ** b >= target_recall:
                return b, rows
    raise ValueError("more hashes are needed for this recall")


class Shingler:
    """Sets of word runs and MinHash bands of many texts at once, as arrays."""

    def __init__(self, bands: int, rows: int, shingle: int = SHINGLE, seed: int = 2):
        import numpy as np

        rng = np.random.default_rng(seed)
        odd = lambda n: rng.integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands, self.rows, self.shingle = bands, rows, shingle
        self.factors, self.shifts = odd(bands * rows), odd(bands * rows)
        self.places, self.mixers = odd(shingle), odd(rows)
        self.letters = odd(64)
        self.space = np.zeros(256, dtype=bool)
        self.space[[32, *range(9, 14)]] = True

    @staticmethod
    def mixed(x):
        import numpy as np

        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def word_hashes(self, text: str):
        """A 64-bit hash per word, from its bytes; every 64 bytes of a word are mixed in turn."""
        import numpy as np

        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        is_word = ~self.space[data]
        edge = np.diff(is_word.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        sizes = ends - starts
        inside = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.append(np.append(0, starts), len(data))))
        value = (data.astype(np.uint64) + np.uint64(1)) * self.letters[inside & 63]
        far = inside >= 64
        if far.any():
            value[far] = self.mixed(value[far] + inside[far].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        value[~is_word] = 0
        return self.mixed(np.add.reduceat(value, starts) + sizes.astype(np.uint64))

    def set_of(self, text: str | None):
        """Sorted different run hashes of a text."""
        import numpy as np

        words = self.word_hashes(text) if text else ()
        if not len(words):
            return np.zeros(0, dtype=np.uint64)
        k = min(self.shingle, len(words))
        n = len(words) - k + 1
        runs = sum((words[i:i + n] * self.places[i] for i in range(1, k)), words[:n] * self.places[0])
        return np.unique(self.mixed(runs + np.uint64(k)))

    def band_hashes(self, runs):
        import numpy as np

        least = np.empty(len(self.factors), dtype=np.uint64)
        for i, (a, b) in enumerate(zip(self.factors, self.shifts)):
            least[i] = (runs * a + b).min()
        parts = self.mixed(least.reshape(self.bands, self.rows)) * self.mixers
        return self.mixed(parts.sum(axis=1, dtype=np.uint64)).view(np.int64)

    def digest(self, runs) -> bytes:
        import numpy as np

        a = self.mixed(runs).sum(dtype=np.uint64)
        b = self.mixed(runs * np.uint64(0xD1B54A32D192ED03) + np.uint64(len(runs))).sum(dtype=np.uint64)
        return np.array([a, b], dtype=np.uint64).tobytes()


def signatures(docs: DataFrame, shingler: Shingler, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, th, n, cid, bands)`` per row: text hash, set size, digest of the set, band hashes."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))

    def sign(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            n, cid, bands = [], [], []
            for t in batch["text"]:
                runs = shingler.set_of(t)
                n.append(len(runs))
                cid.append(shingler.digest(runs))
                bands.append(shingler.band_hashes(runs) if len(runs) else [])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "th": batch["th"], "n": n, "cid": cid, "bands": bands})
        give_back()

    return rows.mapInPandas(sign, f"doc_id {kind}, th long, n int, cid binary, bands array<long>")


def sets(docs: DataFrame, wanted: DataFrame, shingler: Shingler, text: str) -> DataFrame:
    """``(cid, runs)`` of ``wanted(cid, th)``; copies of a text fold before they are shuffled."""
    texts = docs.select(F.xxhash64(text).alias("th"), F.col(text).alias("text")).groupBy("th").agg(
        F.any_value("text").alias("text"))

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"cid": batch["cid"],
                                "runs": [shingler.set_of(t).view("int64") for t in batch["text"]]})
        give_back()

    return texts.join(wanted, "th").select("cid", "text").mapInPandas(work, "cid binary, runs array<long>")


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node that ``edges(a, b)`` connect a node with.

    Labels spread to neighbours until none changes; near copies reach each other in a
    few steps. A row ``(a, b, label)`` holds the label of ``b``; the least one at ``a`` is
    the new label of ``a``, and the row turned round tells it to ``b``: a step is one shuffle.
    Hubs, which have more than one row in ``HOT_SHARE``, are folded before it.
    """
    ends = lambda *pairs: F.inline(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs]))
    both = saved(edges.select(ends("ab", "ba", "aa", "bb")).distinct())
    degree = both.groupBy(F.col("a").alias("hub")).agg(F.count("*").alias("degree"))
    hubs = saved(degree.where(F.col("degree") * HOT_SHARE > F.lit(both.count())).select("hub").repartition(1))
    some_hubs = not hubs.isEmpty()

    def is_hub(node: str) -> Column:
        return F.col(f"hub_{node}").isNotNull().alias(f"{node}_hub")

    rows = both
    for node in "ab":
        rows = rows.join(F.broadcast(hubs.withColumnRenamed("hub", f"hub_{node}")),
                         F.col(node) == F.col(f"hub_{node}"), "left")
    rows = rows.select("a", "b", is_hub("a"), is_hub("b"), F.col("b").alias("label"))
    # A hub's rows are dealt out by their other end; its least label is sent to them.
    salt = F.when(F.col("a_hub"), F.pmod(F.xxhash64("b"), F.lit(HOT_SHARE))).otherwise(0)
    least = F.min("label").over(Window.partitionBy("a", "salt"))
    while True:
        told = rows.withColumn("salt", salt).withColumn("least", least)
        if some_hubs:
            of_hubs = rows.where("a_hub").groupBy("a").agg(F.min("label").alias("of_hub"))
            told = told.join(F.broadcast(of_hubs), "a", "left").withColumn("least", F.coalesce("of_hub", "least"))
        moved = (F.col("a") == F.col("b")) & (F.col("least") < F.col("label"))
        told = saved(told.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_hub").alias("a_hub"),
                                 F.col("a_hub").alias("b_hub"), F.col("least").alias("label"), moved.alias("moved")))
        rows = told.drop("moved")
        if told.where("moved").isEmpty():
            return rows.where("a = b").select(F.col("a").alias("node"), "label")


def _similar(shared: Column, a: Column, b: Column, threshold: float) -> Column:
    return shared >= threshold * (a + b - shared) - 1e-9


def similar_sets(left: list, right: list, threshold: float):
    """Which sets of ``left`` resemble which of ``right``, as a matrix; both hold sorted run hashes."""
    import numpy as np

    sizes = [np.array([len(r) for r in side], dtype=np.float64) for side in (left, right)]
    runs = [np.concatenate([np.zeros(0, dtype=np.int64), *side]) for side in (left, right)]
    # Only runs of both sides can be shared. They are multiplied in parts.
    both = np.intersect1d(*runs)
    place = []
    for side, n in zip(runs, sizes):
        column = np.searchsorted(both, side)
        keep = (column < len(both)) & (both[np.minimum(column, max(0, len(both) - 1))] == side if len(both) else False)
        owner = np.repeat(np.arange(len(n)), n.astype(np.int64))[keep]
        column = column[keep]
        order = np.argsort(column, kind="stable")
        place.append((column[order], owner[order]))
    shared = np.zeros((len(left), len(right)), dtype=np.float64)
    width = 8192
    for start in range(0, len(both), width):
        parts = []
        for (column, owner), n in zip(place, sizes):
            a, b = np.searchsorted(column, [start, start + width])
            part = np.zeros((len(n), width), dtype=np.float32)
            part[owner[a:b], column[a:b] - start] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    return shared >= threshold * (sizes[0][:, None] + sizes[1][None, :] - shared) - 1e-9


BLOCKS = ("crowd binary, block int, n_blocks int, cids array<binary>, n_docs array<long>, sizes array<int>, "
          "runs binary, part array<int>, links array<long>")


def packed_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """One row per block of ``members(crowd, block, n_blocks, cid, n_docs, runs)``, compared with itself.

    ``part`` gives for each class the first class of the block that links connect it with,
    ``links`` how many documents of the block it has links to.
    """
    def work(key, frame):
        import numpy as np
        import pandas as pd

        frame = frame.sort_values("cid", kind="stable")
        runs = [np.asarray(r, dtype=np.int64) for r in frame["runs"]]
        n_docs = frame["n_docs"].to_numpy(dtype=np.int64)
        similar = similar_sets(runs, runs, threshold)
        np.fill_diagonal(similar, False)
        part = np.arange(len(runs))
        while True:
            low = np.minimum(part, np.where(similar, part[None, :], len(runs)).min(axis=1, initial=len(runs)))
            if (low == part).all():
                break
            part = low
        return pd.DataFrame({
            "crowd": [key[0]], "block": [key[1]], "n_blocks": [frame["n_blocks"].iloc[0]], "cids": [list(frame["cid"])],
            "n_docs": [n_docs], "sizes": [np.array([len(r) for r in runs], dtype=np.int32)],
            "runs": [np.concatenate(runs).tobytes()], "part": [part.astype(np.int32)], "links": [similar @ n_docs]})

    return members.groupBy("crowd", "block").applyInPandas(work, BLOCKS)


def compare_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """``(crowd, block, links, a, b)``: the blocks of a crowd compared, each two once.

    Two rows per pair of blocks: the links that the classes of each have to the other,
    and, in the first, the connected parts of both as pairs ``a[i], b[i]``, each pair once.
    """
    def unpacked(row):
        import numpy as np

        return np.split(np.frombuffer(row["runs"], dtype=np.int64), np.cumsum(row["sizes"])[:-1])

    def work(key, frame):
        import numpy as np
        import pandas as pd

        x, y = (row for _, row in frame.sort_values("block").iterrows())
        similar = similar_sets(unpacked(x), unpacked(y), threshold)
        i, j = np.nonzero(similar)
        parts = np.unique(np.column_stack([np.asarray(x["part"])[i], np.asarray(y["part"])[j]]), axis=0)
        a, b = [x["cids"][k] for k in parts[:, 0]], [y["cids"][k] for k in parts[:, 1]]
        return pd.DataFrame({"crowd": [key[0]] * 2, "block": [x["block"], y["block"]],
                             "links": [similar @ np.asarray(y["n_docs"]), np.asarray(x["n_docs"]) @ similar],
                             "a": [a, []], "b": [b, []]})

    dealt = blocks.where("n_blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt = dealt.where("block <> other").withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    # A block may have no members; what is left alone then has nothing to be compared with.
    there = blocks.select("crowd", F.col("block").alias("other"))
    dealt = dealt.join(there, ["crowd", "other"], "left_semi")
    return dealt.groupBy("crowd", "i", "j").applyInPandas(
        work, "crowd binary, block int, links array<long>, a array<binary>, b array<binary>")


def crowd_links(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(cid, links)`` and edges ``(a, b)`` of the classes of all crowds."""
    blocks = saved(packed_blocks(members, threshold))
    found = saved(compare_blocks(blocks, threshold))
    inside = blocks.select(F.inline(F.arrays_zip("cids", F.transform("part", lambda k: F.col("cids")[k]).alias("first"))))
    edges = inside.toDF("a", "b").where("a <> b").unionByName(
        found.select(F.inline(F.arrays_zip("a", "b"))))

    def total(key, frame):
        import numpy as np
        import pandas as pd

        cids = next(c for c in frame["cids"] if c is not None)
        return pd.DataFrame({"cid": list(cids), "links": np.sum(np.stack(frame["links"].to_list()), axis=0)})

    none = F.lit(None).cast("array<binary>").alias("cids")
    counted = blocks.select("crowd", "block", "cids", "links").unionByName(
        found.select("crowd", "block", none, "links")).groupBy("crowd", "block").applyInPandas(total, "cid binary, links long")
    return counted, edges


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
                   small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, class_id, n_links, n_runs, th)``.

    ``class_id`` is the smallest id of the group that links connect; ``n_links`` counts
    the other rows whose similarity is ``threshold`` or more.
    """
    ship(docs.sparkSession)
    shingler = Shingler(*choose_bands(threshold, target_recall), shingle)
    rows = saved(signatures(docs, shingler, doc_id, text))
    some = rows.where("n > 0")
    classes = saved(some.groupBy("cid").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("least_id"), F.any_value("th").alias("th"),
        F.any_value("n").alias("n"), F.any_value("bands").alias("bands")))
    entries = classes.select("cid", F.posexplode("bands").alias("band", "bh"))
    buckets = saved(entries.groupBy("band", "bh").agg(F.count("*").alias("m")).where("m > 1"))
    shared = saved(join_keyed(entries, buckets, ["band", "bh"], "m"))

    # Crowds: the classes that large buckets connect.
    large = shared.where(F.col("m") > small)
    hubs = large.groupBy("band", "bh").agg(F.min("cid").alias("hub"), F.first("m").alias("m"))
    spokes = join_keyed(large.drop("m"), saved(hubs), ["band", "bh"], "m")
    crowd = components(spokes.select(F.col("cid").alias("a"), F.col("hub").alias("b"))).select(
        F.col("node").alias("cid"), F.col("label").alias("crowd"))
    crowd = saved(crowd)
    sizes = saved(crowd.groupBy("crowd").agg(F.count("*").alias("size")).withColumn(
        "n_blocks", F.ceil(F.col("size") / block).cast("int")))

    # Pairs of small buckets, each in the first band it agrees in.
    listed = shared.where(F.col("m") <= small).select("band", "bh", "cid").join(
        classes.select("cid", "n", "bands"), "cid").join(crowd, "cid", "left")
    a, b = listed.alias("a"), listed.alias("b")
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.bh") == F.col("b.bh"))
                   & (F.col("a.cid") < F.col("b.cid")))
    near = F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n") - 1e-9
    first = F.array_position(F.zip_with("a.bands", "b.bands", lambda x, y: x == y), True) == F.col("a.band") + 1
    apart = ~F.coalesce(F.col("a.crowd") == F.col("b.crowd"), F.lit(False))
    pairs = saved(pairs.where(near & first & apart).select(
        F.col("a.cid").alias("a"), F.col("b.cid").alias("b")))

    wanted = pairs.select(F.col("a").alias("cid")).unionByName(
        pairs.select(F.col("b").alias("cid"))).unionByName(crowd.select("cid")).distinct()
    full = saved(sets(docs, wanted.join(classes.select("cid", "th"), "cid"), shingler, text))
    left = full.select(F.col("cid").alias("a"), F.col("runs").alias("x"))
    right = full.select(F.col("cid").alias("b"), F.col("runs").alias("y"))
    checked = pairs.join(left, "a").join(right, "b").withColumn("s", F.size(F.array_intersect("x", "y")))
    links = saved(checked.where(_similar(F.col("s"), F.size("x"), F.size("y"), threshold)).select("a", "b"))

    # Crowds block against block.
    placed = join_keyed(crowd, sizes, ["crowd"], "size").withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("n_blocks")).cast("int"))
    members = placed.join(classes.select("cid", "n_docs"), "cid").join(full, "cid")
    found, edges = crowd_links(members.select("crowd", "block", "n_blocks", "cid", "n_docs", "runs"), threshold)

    weight = classes.select("cid", "n_docs")
    one_way = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = one_way.join(weight.withColumnsRenamed({"cid": "b"}), "b").select(
        F.col("a").alias("cid"), F.col("n_docs").alias("links")).unionByName(found.select("cid", "links"))
    n_links = counted.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(links.unionByName(edges))
    told = classes.select("cid", "n_docs", "least_id").join(n_links, "cid", "left").join(
        groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    told = saved(told)
    least = told.groupBy("label").agg(F.min("least_id").alias("class_id"), F.count("*").alias("in_group"))
    told = saved(join_keyed(told, saved(least), ["label"], "in_group").select(
        "cid", "n_docs", "class_id", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")))
    known = join_keyed(some.select("doc_id", "th", "n", "cid"), told, ["cid"], "n_docs").select(
        "doc_id", "class_id", "n_links", F.col("n").alias("n_runs"), "th")
    return known.unionByName(rows.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("n").alias("n_runs"), "th"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group: the one with the smallest id."""
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    found = saved(jaccard_groups(docs, doc_id, text, **how).select("doc_id", F.col("th").alias("digest"), stays))
    alike = found.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    rows = without(docs, alike.where(~F.col("kept")), doc_id, lambda d: F.xxhash64(d[text]))
    if not alike.where("kept and n > 1").isEmpty():
        rows = one_of_alike(rows, doc_id, F.lit(1))
    return rows.select("doc.*")
