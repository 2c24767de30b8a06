import glob
import math
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from samples import DOCS, awkward, corpus, empty, prose
from wordloom.llm import quality_model as x


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney by dictionaries: ``logp(context, character)``."""
    counts = {order: Counter()}
    for t in texts:
        t = x.START * (order - 1) + t
        counts[order].update(t[i:i + order] for i in range(len(t) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, total, gamma = {}, {}, {}
    for k, c in counts.items():
        n = [sum(1 for v in c.values() if v == j) for j in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None

        def d(j, otherwise):
            if not n[j] or not n[1]:
                return otherwise
            v = j - (j + 1) * y * n[j + 1] / n[j]
            return v if 0 < v < j else otherwise

        cut[k] = (0, d(1, 0.5), d(2, 1.0), d(3, 1.5))
        total[k], off = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            off[g[:-1]] += cut[k][min(v, 3)]
        gamma[k] = {h: off[h] / total[k][h] for h in off}

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        head = gram[:-1]
        if head not in total[k]:
            return p(gram[1:])
        v = counts[k].get(gram, 0)
        return max(v - cut[k][min(v, 3)], 0) / total[k][head] + gamma[k][head] * p(gram[1:])

    return p


@pytest.mark.parametrize("order", [2, 5])
def test_perplexity_beside_plain_code(spark, order):
    train = [prose("en", 60, i) for i in range(12)]
    test = [prose("en", 30, 99), "ZZZ ### é", train[0], "a", "the\nof the"]
    p = plain_model(train, order)
    rows = spark.createDataFrame([("en", t) for t in train], "lang string, text string")
    table = x.keyed(x.model(x.saved(x.count_grams(rows, order)), order), order)
    docs = spark.createDataFrame([(i, "en", t, i % 2) for i, t in enumerate(test)] + [(9, "xx", "abc", 0)],
                                 "doc_id long, lang string, text string, block int")
    got = {r.doc_id: r.log_ppl for r in x.log_perplexity(docs, table, order).collect()}
    for i, t in enumerate(test):
        padded = x.START * (order - 1) + t
        want = -sum(math.log(p(padded[j:j + order])) for j in range(len(t))) / len(t)
        assert got[i] == pytest.approx(want, rel=1e-4)
    assert got[9] is None


@pytest.mark.parametrize("order", [1, 2, 5])
def test_grams_beside_plain_code(spark, monkeypatch, order):
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 6_000)))  # no number holds five of these
    texts = [prose("en", 60, i) for i in range(6)] + ["a", "é𐍈\n" * 40, wide, wide[::-1], "", "a"]
    want = Counter()
    for i, t in enumerate(texts):
        padded = x.START * (order - 1) + t
        want.update(("en" if i % 3 else "fr", padded[j:j + order]) for j in range(len(t)))
    rows = spark.createDataFrame([("en" if i % 3 else "fr", t) for i, t in enumerate(texts)], "lang string, text string")
    for chars in (1_000_000, 50):
        monkeypatch.setattr(x, "PART_CHARS", chars)
        assert {(r.lang, r.gram): r.c for r in x.count_grams(rows, order).collect()} == want
    padded = [x.START * (order - 1) + t for t in texts if t]
    plain = Counter(p[i:i + order] for p in padded for i in range(len(p) - order + 1))
    assert x._grams(padded, order) == x._grams(padded[:7], order) + x._grams(padded[7:], order) == plain


def test_probabilities_sum_to_one(spark):
    train = [prose("en", 40, i) for i in range(8)]
    rows = spark.createDataFrame([("en", t) for t in train], "lang string, text string")
    table = x.model(x.saved(x.count_grams(rows, 3)), 3).collect()
    seen = [math.exp(r.p) for r in table if r.k == 1 and r.p is not None]
    unseen = [math.exp(r.p) for r in table if r.k == 0]
    assert sum(seen) + unseen[0] == pytest.approx(1)


def labelled(spark, rows):
    return spark.createDataFrame([(r[0], 1) for r in rows if r[0] % 2 == 0], "doc_id long, quality int")


def test_junk_goes_and_clean_text_stays(spark):
    rows = corpus(300, 120)
    junk = [(1001 + 2 * i, prose("en", 100, 5000 + i).upper().replace(" ", "!! "), "en", "a") for i in range(10)]
    docs = spark.createDataFrame(rows + junk, DOCS)
    got = {r.doc_id: r for r in x.judged(docs, labelled(spark, rows)).collect()}
    assert len(got) == 310
    assert all(not got[r[0]].kept for r in junk) and all(got[r[0]].kept for r in rows)
    left = x.kept(docs, labelled(spark, rows))
    assert left.columns == docs.columns and left.count() == 300


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None)], "doc_id long, quality int")
    docs = awkward(spark)
    got = x.judged(docs, labels).collect()
    assert len(got) == docs.count()
    assert {r.doc_id for r in got if not r.kept} == {3, 4}  # null and empty
    assert all(r.perplexity is None for r in got)
    assert x.judged(empty(spark), labels).count() == 0
    assert x.kept(docs, labels).columns == docs.columns


def test_all_trusted_documents_count_and_small_languages_are_scored(spark):
    """A small language keeps its model beside a large one; languages below the least get the common one."""
    rows = corpus(300, 120)
    few = [(3000 + 2 * i, prose("fr", 120, 900 + i), f"l{i % 12}", "a") for i in range(60)]
    junk = [(5001, "#ß% " * 150, "l1", "a"), (5003, "#ß% " * 150, "none", "a"), (5005, "#ß% " * 150, "fr", "a")]
    docs = spark.createDataFrame(rows + few + junk, DOCS)
    labels = labelled(spark, rows + few)
    got = {r.doc_id: r for r in x.judged(docs, labels).collect()}
    assert len(got) == 363 and all(r.perplexity is not None and r.threshold is not None for r in got.values())
    assert not any(got[r[0]].kept for r in junk)
    assert sum(got[r[0]].kept for r in few) >= 58 and got[3000].lang == "l0"
    known = {r[0] for r in few}
    ids = labels.where("quality = 1").select("doc_id")
    passed = {r.doc_id for r in x._perhaps(docs, ids).collect()}
    assert known <= passed and {r[0] for r in rows if r[0] % 2 == 0} <= passed and len(passed) < 260


def test_four_characters_of_context(spark):
    """In the trusted texts the fourth character back tells the next one, the three before it do not."""
    train = [" ".join(("qabcx", "zabcy")[i * k % 3 % 2] for k in range(60)) for i in range(1, 9)]
    rows = spark.createDataFrame([("en", t) for t in train], "lang string, text string")
    table = x.keyed(x.model(x.saved(x.count_grams(rows))))
    docs = spark.createDataFrame([(0, "en", "qabcx zabcy " * 5, 0), (1, "en", "qabcy zabcx " * 5, 0)],
                                 "doc_id long, lang string, text string, block int")
    got = {r.doc_id: r.log_ppl for r in x.log_perplexity(docs, table).collect()}
    assert got[1] > 1.5 * got[0]


def test_trusted_texts_are_found_without_a_shuffle_of_texts(spark, monkeypatch):
    rows = corpus(300, 40) + [(None, "no id", "en", "a"), (4, "again", "fr", "b")]
    docs = spark.createDataFrame(rows, DOCS)
    ids = labelled(spark, corpus(300, 1)).select("doc_id")
    want = sorted(r[1] for r in rows if r[0] is not None and r[0] % 2 == 0)
    found = x._trusted_rows(docs.where("doc_id is not null"), docs, ids)
    assert sorted(r.text for r in found.collect()) == want and found.columns == docs.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(doc_id" not in plan
    monkeypatch.setattr(x, "MAX_WRONG", -1)
    found = x._trusted_rows(docs.where("doc_id is not null"), docs, ids)
    assert sorted(r.text for r in found.collect()) == want and found.columns == docs.columns


def test_blocks_are_of_one_language_and_keep_further_columns(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK_CHARS", 4_000)
    docs = spark.createDataFrame(corpus(90, 60), DOCS)
    blocks = x._in_blocks(docs).groupBy("block").agg(F.countDistinct("lang").alias("n")).collect()
    assert len(blocks) > 4 and all(r.n == 1 for r in blocks)
    monkeypatch.setattr(x, "PART_CHARS", 700)
    more = docs.selectExpr("*", "if(doc_id % 2 = 0, doc_id, null) as big", "timestamp_seconds(doc_id) as at",
                           "array(lang, null) as many")
    table = x.keyed(x.model(x.saved(x.count_grams(docs.where("lang = 'en'"), 3)), 3), 3)
    got = x.log_perplexity(x._in_blocks(more), table, 3, with_text=True)
    assert sorted(got.select(more.columns).collect()) == sorted(more.collect())
    assert all(r.n_chars == len(r.text) and (r.log_ppl is None) == (r.lang == "fr") for r in got.collect())


def test_a_partition_sends_its_rows_to_few_blocks(spark, monkeypatch):
    """Packs stay full however many blocks there are."""
    monkeypatch.setattr(x, "BLOCK_CHARS", 3_000)
    docs = spark.createDataFrame(corpus(300, 60), DOCS).repartition(6, "doc_id").localCheckpoint()
    found = x._in_blocks(docs)
    assert found.columns == [*docs.columns, "block"] and sorted(found.drop("block").collect()) == sorted(docs.collect())
    sizes = [r.n for r in found.groupBy("block").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 2 * 3_000
    met = found.select("block", "lang", F.spark_partition_id().alias("place")).distinct().count()
    assert met <= len(sizes) + 6 * docs.select("lang").distinct().count()


def test_rows_of_another_partition_than_measured_have_a_block(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK_CHARS", 3_000)
    docs = spark.createDataFrame(corpus(90, 60), DOCS).repartition(6, "doc_id").localCheckpoint()
    places = x._places
    monkeypatch.setattr(x, "_places", lambda rows: places(rows.withColumn("place", F.col("place") % 2 + 5)))
    found = x._in_blocks(docs)
    assert sorted(found.drop("block").collect()) == sorted(docs.collect())
    assert found.where("block is null").isEmpty() and found.select("block").distinct().count() > 4


def test_shuffle_files_go_with_their_step(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    rows = spark.createDataFrame([("en", prose("en", 60, i)) for i in range(12)], "lang string, text string")
    before = files()
    counts = x.saved(x.count_grams(rows))
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert len(files() - before) == 0 and counts.count() > 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
