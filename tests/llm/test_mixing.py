import re
from collections import Counter, defaultdict

import pytest

from samples import AWKWARD, awkward, corpus, empty, DOCS
from wordloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Water-filling as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, list(names)
    while free:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level >= epochs * sizes[s]]
        if not above:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: float(epochs * sizes[s]) for s in above}
        free = [s for s in free if s not in above]
    return target


def check(rows, got):
    sizes, counts = defaultdict(int), {}
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = fill(sizes)
    source = {r[0]: r[3] for r in rows}
    taken, largest = Counter(), Counter()
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken <= 2 * r.size and (r.size == 0) <= (r.taken == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    return want, taken, largest


def test_targets_and_words_taken(spark):
    rows = corpus(400)
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    want, taken, _ = check(rows, got)
    for s in want:
        assert taken[s] == pytest.approx(want[s], rel=0.01)
    again = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert sorted(got) == sorted(again)
    assert mixing.mix(spark.createDataFrame(rows, DOCS), seed=2).collect() != got


def test_hot_source(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "hot" if i % 2 else f"s{i % 30:02d}") for i in range(1200)]
    want, taken, largest = check(rows, mixing.mix(spark.createDataFrame(rows, DOCS)).collect())
    assert all(abs(taken[s] - want[s]) <= largest[s] + 1 for s in want)


def test_awkward_rows(spark):
    want, taken, largest = check(AWKWARD, mixing.mix(awkward(spark)).collect())
    assert set(want) == {"a", "b", "c", None}
    assert mixing.mix(empty(spark)).count() == 0


def test_water_filling_beside_plain_code(spark):
    sizes = {f"s{i:02d}": (i * 37) % 101 for i in range(12)}
    df = spark.createDataFrame([(k, float([5, 2, 1][i % 3]), 2.0 * v) for i, (k, v) in enumerate(sizes.items())],
                               "key string, weight double, cap double")
    got = {r.key: r.target for r in mixing.water_fill(df, 1.5 * sum(sizes.values())).collect()}
    assert got == pytest.approx(fill(sizes))


def test_repeated_rows_in_the_mix(spark):
    docs = spark.createDataFrame(corpus(120), DOCS)
    plan = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    rows = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert {k: v for k, v in plan.items() if v} == dict(rows)
    assert mixing.mixed(awkward(spark)).columns == awkward(spark).columns


def test_wordless_rows_stay_within_the_epochs(spark):
    """A source at its most epochs, one without words, and wordless rows in both."""
    rows = [(i, " " if i % 3 else "word " * 5, "en", "a") for i in range(60)]
    rows += [(100 + i, "word " * 2000, "en", "b") for i in range(5)] + [(200 + i, None, "en", "c") for i in range(9)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert max(r.copies for r in got) <= 2
    assert {r.copies for r in got if r.doc_id < 100} == {2}
    assert {r.copies for r in got if r.doc_id >= 200} == {0}
