"""Language identification, word first with backoff to shorter n-grams. [operator 4]

A known word scores by its log frequency in each language. An unseen word scores by
its character n-grams, from the longest order down: an n-gram that the model lacks
is replaced by the two one shorter, to single characters, and each order down costs
a constant. A document's language is the one with the largest sum over its words.

The model is fitted on a bounded sample of labelled rows: about ``TRAIN_ROWS`` of
them, picked by a hash of the id. Each language has an equal part of these, and at
least ``LEAST_ROWS`` rows, so that no language pushes out another, and all languages
take part. The model holds every word of the sample and every n-gram of these; the
sample's bound is what makes it small enough to be sent to every task, and the only
one. Every document is scored over its whole text. Words are counted in Spark.

Cases: a null id counts as an empty one, and is kept apart from learning. ``und`` with score 0 where the text is null or has no letter, and for every
text when there is nothing to learn from. Rows that repeat are scored alike. Ties go
to the first language in code point order. An empty table gives an empty result. Only
id, text and, for learning, language are read, so further columns cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import saved, ship

TRAIN_ROWS = 20_000
# Rows of a language that are learned from, however many languages there are.
LEAST_ROWS = 500
ORDER = 4
BACKOFF = math.log(0.4)
UNDETERMINED = "und"
# Runs of letters; digits and the underscore are word characters, but no letters.
LETTERS = re.compile(r"[^\W\d_]+")
CACHE = 2_000_000


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def count_words(rows: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of ``rows(lang, text)``, counted per task first."""
    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch["lang"], batch["text"]):
                found.update((lang, w) for w in LETTERS.findall(text.lower()))
            yield pd.DataFrame([(a, w, n) for (a, w), n in found.items()], columns=["lang", "word", "n"])

    ship(rows.sparkSession)
    schema = "lang string, word string, n long"
    return rows.select("lang", "text").mapInPandas(count, schema).groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


def count_grams(words: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, n)`` of the n-grams of orders 1 to ``order``, word ends marked by a blank."""
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))

    def of_order(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - (k - 1))
        grams = F.transform(starts, lambda i: F.substring(padded, i, F.lit(k)))
        return F.when(F.length(padded) >= k, grams).otherwise(F.array().cast("array<string>"))

    pieces = F.flatten(F.array(*map(of_order, range(1, order + 1))))
    return words.select("lang", "n", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


class Scorer:
    """The fitted tables of one model: a row of log frequencies per word and n-gram."""

    def __init__(self, langs: list[str], words: list[tuple], grams: list[tuple], order: int = ORDER):
        self.langs, self.order = langs, order
        self.words, self.word_rows = self._table(words, lambda word: 0)
        self.grams, self.gram_rows = self._table(grams, len)
        # Entries beyond the model that a task remembers, fewer where there are more languages.
        self.memory = CACHE // max(1, len(langs))

    def _table(self, rows: list[tuple], kind) -> tuple[dict, object]:
        """Smoothed log frequencies; n-grams are compared with those of their own order.

        Languages are smoothed as if all had as many counts as the largest, so that what
        is unseen is equally likely in each.
        """
        import numpy as np

        at = {lang: i for i, lang in enumerate(self.langs)}
        ids: dict = {}
        for _, gram, _ in rows:
            ids.setdefault(gram, len(ids))
        counts = np.zeros((len(ids), len(self.langs)))
        for lang, gram, n in rows:
            counts[ids[gram], at[lang]] += n
        kinds = np.array([kind(gram) for gram in ids], dtype=np.int64)
        for k in set(kinds.tolist()):
            some = counts[kinds == k]
            totals = some.sum(axis=0)
            some = some / np.maximum(totals, 1) * totals.max() + 0.5
            counts[kinds == k] = some / (totals.max() + 0.5 * len(some))
        return ids, np.log(counts)

    def start(self) -> _Memory:
        return _Memory(self)


class _Memory:
    """What a task remembers between texts: the model and what it worked out by backoff."""

    def __init__(self, model: Scorer):
        self.model = model
        self.words = _Rows(model.words, model.word_rows)
        self.grams = _Rows(model.grams, model.gram_rows)

    def gram(self, gram: str) -> int:
        """Row of an n-gram: its own, else the mean of its two parts one shorter, at a cost."""
        import numpy as np

        at = self.grams.ids.get(gram)
        if at is not None:
            return at
        if len(gram) == 1:
            return self.grams.add([gram], np.full((1, len(self.model.langs)), math.log(1e-7)))
        a, b = self.gram(gram[:-1]), self.gram(gram[1:])
        return self.grams.add([gram], BACKOFF + (self.grams.rows[a] + self.grams.rows[b])[None] / 2)

    def learn(self, words: list[str]) -> None:
        """Rows of unseen words: the mean over their n-grams."""
        import numpy as np

        known, flat, starts = self.grams.ids, [], []
        for word in words:
            padded = f" {word} "
            k = min(self.model.order, len(padded))
            starts.append(len(flat))
            for i in range(len(padded) - k + 1):
                at = known.get(padded[i:i + k])
                flat.append(self.gram(padded[i:i + k]) if at is None else at)
        sums = np.add.reduceat(self.grams.rows[flat], starts, axis=0)
        self.words.add(words, sums / np.diff([*starts, len(flat)])[:, None])

    def predict(self, texts) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text in texts:
            name, score = self.predict_one(text)
            names.append(name)
            scores.append(score)
            if self.words.n + self.grams.n > len(self.model.words) + len(self.model.grams) + self.model.memory:
                self.__init__(self.model)
        return names, scores

    def predict_one(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        words = LETTERS.findall(text.lower()) if text is not None else ()
        if not words or not self.model.langs or not any(map(str.isalpha, "".join(words))):
            return UNDETERMINED, 0.0
        ids = self.words.ids
        try:
            at = [ids[w] for w in words]
        except KeyError:
            self.learn([w for w in dict.fromkeys(words) if w not in ids])
            at = [ids[w] for w in words]
        total = self.words.rows[at].sum(axis=0)
        best = int(total.argmax())
        # Softmax with the root of the length as temperature: words are not independent.
        rest = np.exp((total - total[best]) / math.sqrt(len(words)))
        return self.model.langs[best], float(1.0 / rest.sum())


class _Rows:
    """Names and their rows in one matrix that grows by doubling."""

    def __init__(self, ids: dict, rows):
        self.ids, self.rows, self.n = dict(ids), rows, len(ids)

    def add(self, names: list[str], rows) -> int:
        import numpy as np

        first, self.n = self.n, self.n + len(names)
        if self.n > len(self.rows):
            grown = np.empty((2 * self.n + 1024, rows.shape[1]))
            grown[:first] = self.rows[:first]
            self.rows = grown
        self.rows[first:self.n] = rows
        for i, name in enumerate(names):
            self.ids[name] = first + i
        return first


def fit(rows: DataFrame, order: int = ORDER, train_rows: int = TRAIN_ROWS,
        max_words: int | None = None, max_grams: int | None = None) -> Scorer:
    """A model of ``rows(doc_id, text, lang)``, rows without language left out.

    A smaller model can be asked for by ``max_words`` and ``max_grams``, which every
    language then has an equal part of, by frequency.
    """
    rows = rows.where("lang is not null and text is not null")
    sizes = saved(rows.groupBy("lang").agg(F.count("*").alias("n_rows")))
    labelled, n_langs = sizes.agg(F.sum("n_rows"), F.count("*")).first()
    if not n_langs:
        return Scorer([], [], [], order)
    quota = labelled if labelled <= train_rows else max(LEAST_ROWS, -(-train_rows // n_langs))
    place = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 40))
    # One row per language.
    shares = F.broadcast(sizes.select("lang", (F.lit(float(quota)) / F.col("n_rows")).alias("share")))
    counts = saved(count_words(rows.join(shares, "lang").where(place < F.col("share") * (1 << 40))))
    names = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not names:
        return Scorer([], [], [], order)

    def rows_of(table: DataFrame, name: str, most: int | None) -> list[tuple]:
        if most is not None:
            turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), name))
            table = table.withColumn("turn", turn).where(F.col("turn") <= -(-most // len(names)))
        found = table.select("lang", name, "n").toArrow()
        return sorted(zip(*(found.column(c).to_pylist() for c in ("lang", name, "n"))))

    return Scorer(names, rows_of(counts, "word", max_words), rows_of(count_grams(counts, order), "gram", max_grams), order)


def identify(docs: DataFrame, model: Scorer, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row of ``docs``; nothing is shuffled."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def score(batches: Iterator) -> Iterator:
        import pandas as pd

        memory = shared.value.start()
        for batch in batches:
            names, scores = memory.predict(batch["text"])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names, "score": scores})

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        score, f"doc_id {kind}, lang_pred string, score double")


def held_out_split(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``: the fifth that learning never sees."""
    return docs.withColumn("held_out", fold_of(F.col(doc_id)) == 0)
