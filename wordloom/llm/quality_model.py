"""Quality classifier: perplexity under an n-gram model of trusted text. [operator 1]

The model is an interpolated modified Kneser-Ney model of characters, order 5, one per
language. Trusted are the documents whose label says so; four fifths of them, by a hash
of the id, are counted, and the rest show what perplexity trusted text has that the
model has not seen. All trusted documents take part: a bitmap of their ids goes to the
texts, with a list of the other ids that the bitmap lets through, so that these texts are
not shuffled. Where that list is long, ids and texts that passed the bitmap are joined.

Counts, discounts, context sums and probabilities are tables, joined by n-gram. Texts
are scored in blocks of documents of one language, which hold far fewer different n-grams
than mixed ones. A block asks for the different n-grams it holds; the requests are sharded
by n-gram, joined with the model there, and the answers go back to the block. So neither
the model nor the n-grams of a corpus ever meet in one task, and a block is bounded by
``BLOCK_CHARS`` and its longest document. Rows go to their block in compressed packs, and
a task unpacks ``PART_CHARS`` of them at a time. A block holds rows of neighbouring
partitions, so that a partition's rows go to few blocks, in full packs, however many
blocks there are.

A document is rejected when its perplexity is more than ``TOLERANCE`` times the upper
fence of its language, ``q75 + fence * (q75 - q25)`` of the log perplexities of the
trusted texts kept apart, and what chance gives a text of its length. The quartiles
follow long texts of one kind; the tolerance leaves room for addresses, numbers and
names in clean ones.

Cases: a null language is a language of its own. A language with fewer than
``MIN_TRUSTED`` counted documents, or too few kept apart, is scored by a model of the
trusted texts of all languages; its fence comes from the kept apart ones of all such
languages together. Where these are too few as well there is no fence, and the documents
stay; with fewer than ``MIN_TRUSTED`` counted documents in all there is no perplexity
either. A null or empty text has no perplexity and is rejected. Rows that repeat are
scored alike. An empty table gives an empty result. Only id, text, language and the
label's columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wordloom.llm.common import give_back, ship
from wordloom.llm.common import saved_tidily as saved

ORDER = 5
# A language has a model of its own from so many counted documents on.
MIN_TRUSTED = 20
# The language of the model of all languages; no language of a corpus is called so.
POOL = "\x02"
# Bits of the bitmap of trusted ids, 64 MB at most; beyond that it only lets more texts through.
MAX_BITS = 1 << 29
# Other ids that the bitmap lets through: so many are sent to the texts, about 16 MB.
MAX_WRONG = 1_000_000
BLOCK_CHARS = 24_000_000
PART_CHARS = 1_000_000
ZSTD_LEVEL = 6
# Different n-grams that a task counts before it passes them on.
COUNTED_GRAMS = 300_000
FENCE = 3.0
# Log perplexity that chance adds to a text of n characters is about this over sqrt(n).
CHANCE = 4.0
TOLERANCE = 1.5
# Stands in front of a text; no text of a corpus begins with it.
START = "\x02"
FOLDS = 5


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), doc_id), F.lit(FOLDS))


def _grams(pieces: list[str], order: int) -> Counter:
    """How often each n-gram of ``order`` characters is in the pieces, which it does not cross."""
    import numpy as np
    import pandas as pd

    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    small, alphabet = pd.factorize(codes)
    bits = max(1, (len(alphabet) - 1).bit_length())
    if bits * order > 63:
        # Too many different characters for a number to hold a gram.
        return sum((Counter(map("".join, zip(*(p[i:] for i in range(order))))) for p in pieces), Counter())
    n = len(codes) - order + 1
    numbers = reduce(lambda x, j: x << bits | small[j:j + n], range(1, order), small[:n].astype(np.int64))
    inside = np.ones(n, dtype=bool)
    ends = np.cumsum([len(p) for p in pieces[:-1]], dtype=np.int64)
    for j in range(1, order):
        inside[ends - j] = False
    code, different = pd.factorize(numbers[inside])
    letters = [alphabet[different >> bits * j & (1 << bits) - 1] for j in reversed(range(order))]
    text = np.stack(letters, axis=1).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    return Counter(dict(zip((text[i:i + order] for i in range(0, len(text), order)), np.bincount(code).tolist())))


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, c)`` of ``rows(lang, text)``; each task counts its own texts first."""
    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        found: dict[str, Counter] = {}

        def told():
            for lang, c in found.items():
                # In order, as neighbours that begin alike are compressed better.
                grams = sorted(c)
                yield pd.DataFrame({"lang": lang, "gram": grams, "c": [c[g] for g in grams]})
            found.clear()

        def add(lang, pieces):
            if pieces:
                found.setdefault(lang, Counter()).update(_grams(pieces, order))
            if sum(map(len, found.values())) > COUNTED_GRAMS:
                yield from told()

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                pieces, size = [], 0
                for text in texts:
                    padded = START * (order - 1) + text
                    # A very long text is counted in parts.
                    for at in range(0, len(text), PART_CHARS):
                        pieces.append(padded[at:at + PART_CHARS + order - 1])
                        size += len(pieces[-1])
                        if size >= PART_CHARS:
                            yield from add(lang, pieces)
                            pieces, size = [], 0
                yield from add(lang, pieces)
        yield from told()
        give_back()

    return rows.select("lang", "text").mapInPandas(count, "lang string, gram string, c long").groupBy(
        "lang", "gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> DataFrame:
    """``(lang, d1, d2, d3)`` from the counts of counts; fixed values where these do not do."""
    n = [F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]
    table = counts.groupBy("lang").agg(*[x.alias(f"n{k}") for k, x in enumerate(n, 1)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def d(k: int, otherwise: float) -> Column:
        value = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
        fits = (value > 0) & (value < k)
        return F.when(fits, value).otherwise(otherwise).alias(f"d{k}")

    return table.select("lang", d(1, 0.5), d(2, 1.0), d(3, 1.5))


def model(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, k, gram, p, gamma)``: log probability of a gram's last character after
    the others, and log weight of the shorter context where the gram is the context.

    ``gram`` is empty in one row per language: what an unseen character gets.
    """
    by_order = {order: counts}
    for k in range(order - 1, 0, -1):
        # How many different characters stand in front of it.
        tail = F.substring("gram", 2, k)
        by_order[k] = saved(by_order[k + 1].groupBy("lang", tail.alias("gram")).agg(F.count("*").alias("c")))
    shorter = None
    tables = []
    for k in range(1, order + 1):
        some = by_order[k]
        # One row per language that has a model.
        rows = some.join(F.broadcast(_discounts(some)), "lang")
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        head = F.substring("gram", 1, k - 1)
        rows = rows.select("lang", "gram", head.alias("head"), F.substring("gram", 2, k - 1).alias("tail"), "c", cut.alias("cut"))
        sums = rows.groupBy("lang", "head").agg(
            F.sum("c").alias("total"), F.sum("cut").alias("cut_off"), F.count("*").alias("followers"))
        sums = saved(sums.withColumn("gamma", F.col("cut_off") / F.col("total")))
        if k == 1:
            # Unigrams share what is cut off among all characters and one unseen.
            shorter = sums.select("lang", F.lit("").alias("tail"), (1 / (F.col("followers") + 1)).alias("below"))
            tables.append(sums.select("lang", F.lit(0).alias("k"), F.lit("").alias("gram"),
                                      (F.col("gamma") / (F.col("followers") + 1)).alias("p"), F.lit(None).cast("double").alias("gamma")))
            joined = rows.join(F.broadcast(sums.select("lang", "total", "gamma")), "lang").join(
                F.broadcast(shorter.drop("tail")), "lang")
        else:
            joined = rows.join(sums.select("lang", "head", "total", "gamma"), ["lang", "head"]).join(
                shorter, ["lang", "tail"])
            tables[-1] = tables[-1].drop("gamma").join(
                sums.select("lang", F.col("head").alias("gram"), "gamma"), ["lang", "gram"], "left")
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("gamma") * F.col("below")
        done = saved(joined.select("lang", "gram", p.alias("p")))
        shorter = done.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below"))
        tables.append(done.withColumn("k", F.lit(k)).withColumn("gamma", F.lit(None).cast("double")))
        # Contexts made of nothing but starts are no grams of their own, but have a weight.
        if k > 1:
            starts = sums.where(F.col("head") == START * (k - 1)).select(
                "lang", F.lit(k - 1).alias("k"), F.col("head").alias("gram"), F.lit(None).cast("double").alias("p"), "gamma")
            tables.insert(0, starts)
    columns = ["lang", "k", "gram", F.log("p").alias("p"), F.log("gamma").alias("gamma")]
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


class Keys:
    """64-bit keys of n-grams, of whole texts at once."""

    def __init__(self, order: int = ORDER, seed: int = 3):
        import numpy as np

        self.order = order
        self.weights = np.random.default_rng(seed).integers(0, 1 << 63, size=order, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def mixed(x):
        import numpy as np

        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def of_lang(self, lang: str):
        import hashlib

        import numpy as np

        return np.frombuffer(hashlib.sha256(lang.encode()).digest()[:8], dtype=np.uint64)[0]

    def finish(self, sums, k: int, lang):
        import numpy as np

        return self.mixed(self.mixed(sums + np.uint64(k)) ^ lang).view(np.int64)

    def sums(self, codes, k: int, at):
        """Unmixed sums of the ``k`` characters that end at each place of ``at``."""
        import numpy as np

        return reduce(np.add, [(codes[at - j].astype(np.uint64) + np.uint64(1)) * self.weights[j] for j in range(k)],
                      np.zeros(len(at), dtype=np.uint64))

    def of_grams(self, grams: list[str], k: int, langs: list[str]):
        import numpy as np

        codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.arange(1, len(grams) + 1) * k - 1
        sums = self.sums(codes, k, ends) if k else np.zeros(len(grams), dtype=np.uint64)
        return self.finish(sums, k, np.array([self.of_lang(x) for x in langs], dtype=np.uint64))


def keyed(table: DataFrame, order: int = ORDER) -> DataFrame:
    """``(key, p, gamma)`` of a model."""
    keys = Keys(order)

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for k, part in batch.groupby("k"):
                yield pd.DataFrame({"key": keys.of_grams(part["gram"].tolist(), int(k), part["lang"].tolist()),
                                    "p": part["p"], "gamma": part["gamma"]})

    return table.select("lang", "k", "gram", "p", "gamma").mapInPandas(work, "key long, p float, gamma float")


class _Part:
    """Some texts of one language: their different grams, and where each occurs."""

    def __init__(self, keys: Keys, lang: str, texts: list[str]):
        import numpy as np
        import pandas as pd

        pad = keys.order - 1
        self.keys, self.lang = keys, keys.of_lang(lang)
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(START * pad + t for t in texts)
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        firsts = np.cumsum(self.sizes + pad) - self.sizes
        ends = np.arange(int(self.sizes.sum())) + np.repeat(firsts - (np.cumsum(self.sizes) - self.sizes), self.sizes)
        # Sums of all places, read in order, then of those where a gram ends.
        plus, n = self.codes.astype(np.uint64) + np.uint64(1), len(self.codes) - pad
        sums = reduce(np.add, [plus[pad - j:pad - j + n] * keys.weights[j] for j in range(keys.order)])
        self.code, different = pd.factorize(sums[ends - pad])
        first = np.empty(len(different), dtype=np.int64)
        first[self.code[::-1]] = ends[::-1]
        self.first = first

    def key(self, k: int, back: int = 0, some=slice(None)):
        """Key of the ``k`` characters that end ``back`` before the end of each different gram, or of some."""
        return self.keys.finish(self.keys.sums(self.codes, k, self.first[some] - back), k, self.lang)

    def requests(self):
        import numpy as np
        import pandas as pd

        order = self.keys.order
        return pd.unique(np.concatenate([self.key(0)[:1], *(self.key(k) for k in range(1, order + 1)),
                                         *(self.key(k, 1) for k in range(1, order))]))

    def log_probabilities(self, answers):
        """Sum over each text, NaN where its language has no model."""
        import numpy as np

        known, p, gamma = answers
        find = lambda key: np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        unseen = find(self.key(0)[:1])
        if not len(known) or not len(self.first) or known[unseen[0]] != self.key(0)[0]:
            return np.full(len(self.sizes), np.nan)
        total = np.zeros(len(self.first))
        open_ = np.arange(len(self.first))
        for k in range(self.keys.order, 0, -1):
            key = self.key(k, 0, open_)
            at = find(key)
            hit = (known[at] == key) & ~np.isnan(p[at])
            total[open_[hit]] += p[at[hit]]
            open_ = open_[~hit]
            if k > 1:
                key = self.key(k - 1, 1, open_)
                at = find(key)
                weighted = (known[at] == key) & ~np.isnan(gamma[at])
                total[open_[weighted]] += gamma[at[weighted]]
        total[open_] += p[unseen[0]]
        ends = np.concatenate([[0], np.cumsum(total[self.code])])
        last = np.cumsum(self.sizes)
        return ends[last] - ends[last - self.sizes]


def _packs(rows) -> Iterator:
    """Arrow rows of one block and language each, up to ``PART_CHARS`` bytes of text, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    rows = rows.sort_by([("block", "ascending"), ("lang", "ascending")])
    before = np.concatenate([[0], np.cumsum(pc.binary_length(rows["text"]).to_numpy().astype(np.int64))[:-1]])
    marks = (rows["block"].to_numpy(), pc.rank(rows["lang"], tiebreaker="dense").to_numpy(), before // PART_CHARS)
    cuts = np.flatnonzero(reduce(np.logical_or, [m[1:] != m[:-1] for m in marks])) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
        yield rows.slice(first, last - first)


def _parts(packs) -> Iterator[tuple]:
    """Rows of a block's packs with their texts, by language, ``PART_CHARS`` at a time; then the rest."""
    import pyarrow as pa
    import pyarrow.compute as pc

    waiting: dict[str, list] = {}
    size: Counter = Counter()
    for pack in packs:
        rows = pa.ipc.open_stream(pack.as_buffer()).read_all()
        lang = rows["lang"][0].as_py()
        waiting.setdefault(lang, []).append(rows)
        size[lang] += pc.sum(pc.utf8_length(rows["text"])).as_py()
        if size[lang] >= PART_CHARS:
            del size[lang]
            yield lang, pa.concat_tables(waiting.pop(lang))
    while waiting:
        lang, rows = waiting.popitem()
        yield lang, pa.concat_tables(rows)


def log_perplexity(docs: DataFrame, table: DataFrame, order: int = ORDER, with_text: bool = False) -> DataFrame:
    """``docs(lang, text, block, …)`` with ``n_chars`` and ``log_ppl``; texts not empty.

    Further columns are carried along, the text only if ``with_text``. The log
    perplexity is null where the language has no model. Rows are compressed before
    they are shuffled to their blocks; the two uses of the blocks share that exchange.
    """
    ship(docs.sparkSession)
    keys = Keys(order)
    carried = [c for c in docs.columns if c not in ("text", "block")]
    fields = {f.name: f for f in docs.schema.fields}

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", ZSTD_LEVEL))
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, packs = [], []
            for rows in _packs(pa.Table.from_batches([batch])):
                blocks.append(rows["block"][0].as_py())
                rows = rows.drop_columns("block")
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_table(rows)
                packs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(packs, pa.binary())], ["block", "pack"])
        give_back()

    blocks = docs.select(*carried, "block", "text").mapInArrow(pack, "block int, pack binary").repartition("block")

    def ask(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        asked: dict[int, list] = {}
        for batch in batches:
            of_block: dict[int, list] = {}
            for block, packed in zip(batch["block"].to_pylist(), batch["pack"]):
                of_block.setdefault(block, []).append(packed)
            for block, packs in of_block.items():
                some = asked.setdefault(block, [])
                for lang, rows in _parts(packs):
                    some.append(_Part(keys, lang, rows["text"].to_pylist()).requests())
                    if len(some) > 8:
                        some[:] = [np.unique(np.concatenate(some))]
        for block in list(asked):
            found = np.unique(np.concatenate(asked.pop(block)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, dtype=np.int32)), pa.array(found)], ["block", "key"])
        give_back()

    requests = blocks.mapInArrow(ask, "block int, key long")
    answers = requests.join(table, "key").select("block", "key", "p", "gamma")
    schema = T.StructType([*(fields[c] for c in carried), T.StructField("n_chars", T.LongType()),
                           T.StructField("log_ppl", T.DoubleType()), *([fields["text"]] if with_text else [])])

    def score(rows, found):
        import numpy as np
        import pyarrow as pa

        order_ = np.argsort(found["key"].to_numpy())
        known = tuple(found[c].to_numpy()[order_] for c in ("key", "p", "gamma"))
        done = []
        for lang, some in _parts(rows["pack"]):
            part = _Part(keys, lang, some["text"].to_pylist())
            log_ppl = -part.log_probabilities(known) / part.sizes
            some = some.append_column("n_chars", pa.array(part.sizes)).append_column(
                "log_ppl", pa.array(log_ppl, mask=np.isnan(log_ppl)))
            done.append(some.select(schema.names))
        del known, found
        give_back()
        return pa.concat_tables(done)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def _lang(lang: Column) -> Column:
    return F.coalesce(lang, F.lit(""))


def _perhaps(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id is in ``ids``, and a few others, by a bitmap of hashes."""
    bits = min(MAX_BITS, 1 << max(15, (16 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(bits))
    bucket, bit = F.shiftright(place, 15).alias("bucket"), F.pmod(place, F.lit(1 << 15))
    bitmaps = ids.groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias("bitmap"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    # MAX_BITS / 8 bytes at most.
    return texts.withColumn("bucket", bucket).join(F.broadcast(bitmaps), "bucket").where(is_set).select(texts.columns)


def _trusted_rows(rows: DataFrame, docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The ``rows`` of ``docs`` whose id is in ``trusted(doc_id)``, which is distinct; ids not null."""
    ids = docs.select("doc_id").where("doc_id is not null")
    wrong = saved(_perhaps(ids, trusted).distinct().join(trusted, "doc_id", "left_anti"))
    some = _perhaps(rows, trusted)
    if wrong.count() <= MAX_WRONG:
        return some.join(F.broadcast(wrong), "doc_id", "left_anti")
    # Not a semi-join: the planner would move it below the bitmap, and shuffle all texts.
    return some.join(trusted, "doc_id").select(rows.columns)


def _model_lang(rows: DataFrame, own: DataFrame) -> DataFrame:
    """``rows`` with the language of their model as ``lang``: their own, or that of all."""
    mine = own.select("lang", F.col("lang").alias("model_lang"))
    # One row per language with a model.
    return rows.join(F.broadcast(mine), "lang", "left").withColumn(
        "lang", F.coalesce("model_lang", F.lit(POOL))).drop("model_lang")


def fit(docs: DataFrame, labels: DataFrame, order: int = ORDER,
        fence: float = FENCE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The keyed model of ``docs(doc_id, lang, text)``, the languages ``(lang)`` with a model
    of their own, and ``(lang, fence)`` of log perplexity.

    ``labels(doc_id, quality)`` marks trusted documents with quality 1.
    """
    kind = docs.schema["doc_id"].dataType
    trusted = saved(labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").cast(kind).alias("doc_id")).distinct())
    some = _trusted_rows(docs.where("text <> '' and doc_id is not null"), docs, trusted)
    is_apart = _fold(F.col("doc_id")) == 0
    sizes = saved(some.groupBy("lang").agg(
        F.count_if(~is_apart).alias("n"), F.count_if(is_apart).alias("n_apart")))
    own = saved(sizes.where((F.col("n") >= MIN_TRUSTED) & (F.col("n_apart") * FOLDS >= MIN_TRUSTED)).select("lang"))
    strange = docs.where("text <> ''").select("lang").distinct().join(F.broadcast(own), "lang", "left_anti")
    pooled = (sizes.agg(F.sum("n")).first()[0] or 0) >= MIN_TRUSTED and not strange.isEmpty()
    every = count_grams(some.where(~is_apart), order)
    every = saved(every) if pooled else every
    counts = every.join(F.broadcast(own), "lang", "left_semi")
    if pooled:
        counts = counts.unionByName(every.groupBy(F.lit(POOL).alias("lang"), "gram").agg(F.sum("c").alias("c")))
    table = saved(keyed(model(saved(counts), order), order))
    apart = some.where(is_apart).select("doc_id", "lang", "text")
    scored = log_perplexity(_in_blocks(_model_lang(apart, own)), table, order).where("log_ppl is not null")
    quartile = F.percentile_approx("log_ppl", F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    fences = scored.groupBy("lang").agg(quartile.alias("q"), F.count("*").alias("n")).where(
        F.col("n") * FOLDS >= MIN_TRUSTED)
    found = fences.select("lang", (F.col("q")[1] + fence * (F.col("q")[1] - F.col("q")[0])).alias("fence"))
    return table, own, saved(found)


def _places(docs: DataFrame) -> DataFrame:
    """``(lang, place, chars, before)`` of ``docs(lang, text, place)``: characters of a
    language in a partition, and in the partitions before it."""
    sizes = docs.groupBy("lang", "place").agg(F.sum(F.length("text").cast("long")).alias("chars"))
    # One row per language and partition; a language's are few enough for one task.
    upto = F.sum("chars").over(Window.partitionBy("lang").orderBy("place"))
    return saved(sizes.withColumn("before", upto - F.col("chars")))


def _in_blocks(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, lang, text, …)`` with ``block``: of one language, about ``BLOCK_CHARS`` together.

    ``lang`` is that of a model. The texts of a language stand in a row, by partition and in
    it by a hash, and are cut into blocks of like length. Where rows are in another partition
    than when these were measured, the hash alone tells the block. Blocks whose numbers
    collide are one block of two languages.
    """
    rows = docs.withColumn("place", F.spark_partition_id())
    places = _places(rows)
    sizes = places.groupBy("lang").agg(F.sum("chars").alias("in_all"))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    at = F.coalesce(F.col("before") + share * F.col("chars"), share * F.col("in_all")) / F.col("in_all")
    number = F.floor(at * F.ceil(F.col("in_all") / BLOCK_CHARS))
    # One row per language and partition, and one per language.
    found = rows.join(F.broadcast(places), ["lang", "place"], "left").join(F.broadcast(sizes), "lang")
    return found.withColumn("block", F.hash("lang", number)).select(*docs.columns, "block")


def _judged(rows: DataFrame, labels: DataFrame, order: int, fence: float, chance: float,
            tolerance: float, with_text: bool) -> DataFrame:
    """``rows(doc_id, lang, text, …)`` with texts, scored, with ``limit`` and ``kept``."""
    ship(rows.sparkSession)
    table, own, fences = fit(rows, labels, order, fence)
    some = _model_lang(rows.where("text <> ''").withColumn("of_lang", F.col("lang")), own)
    scored = log_perplexity(_in_blocks(some), table, order, with_text)
    limit = F.col("fence") + chance / F.sqrt("n_chars") + F.log(F.lit(tolerance))
    # One row per language with a model.
    known = scored.join(F.broadcast(fences), "lang", "left").drop("lang").withColumnRenamed(
        "of_lang", "lang").withColumn("limit", limit)
    return known.withColumn("kept", F.coalesce(F.col("log_ppl") <= F.col("limit"), F.lit(True)))


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           order: int = ORDER, fence: float = FENCE,
           chance: float = CHANCE, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, lang, n_chars, perplexity, threshold, kept)``.

    ``labels(doc_id, quality)`` marks trusted documents with quality 1.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), _lang(F.col(lang)).alias("lang"), F.col(text).alias("text"))
    known = _judged(rows, labels, order, fence, chance, tolerance, False).select(
        "doc_id", "lang", "n_chars", F.exp("log_ppl").alias("perplexity"), F.exp("limit").alias("threshold"), "kept")
    none = F.lit(None).cast("double")
    empty = rows.where("text is null or text = ''").select(
        "doc_id", "lang", F.lit(0).cast("long").alias("n_chars"), none.alias("perplexity"),
        none.alias("threshold"), F.lit(False).alias("kept"))
    return known.unionByName(empty)


def kept(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
         order: int = ORDER, fence: float = FENCE,
         chance: float = CHANCE, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier keeps; no row is joined back."""
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c != text}
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _lang(F.col(f"`{lang}`")).alias("lang"),
                       F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(a) for c, a in own.items()])
    stays = _judged(rows, labels, order, fence, chance, tolerance, True).where("kept")
    return stays.select(*[F.col(own[c] if c in own else "text").alias(c) for c in docs.columns])
