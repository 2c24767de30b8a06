import random
from itertools import combinations

import pytest

from samples import AWKWARD, DOCS, awkward, empty, prose
from wordloom.llm import jaccard_join as x


def runs(text):
    w = (text or "").replace("\n", " ").replace("\t", " ").split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = [runs(r[1]) for r in rows]
    near = {i: set() for i in range(len(rows))}
    for i, j in combinations(range(len(rows)), 2):
        s = len(sets[i] & sets[j])
        if s and s >= threshold * (len(sets[i]) + len(sets[j]) - s) - 1e-9:
            near[i].add(j), near[j].add(i)
    out, seen = [], {}
    for i in range(len(rows)):
        if i not in seen:
            part, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()] - part:
                    part.add(j), todo.append(j)
            ids = [rows[j][0] for j in part if rows[j][0] is not None]
            seen |= {j: min(ids) if ids else None for j in part}
    return sorted((str(r[0]), str(seen[i]), len(near[i])) for i, r in enumerate(rows))


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def copies(n_groups=6, size=12):
    rows = []
    for g in range(n_groups):
        base = prose("en", 150, g)
        for i in range(size):
            rows.append((len(rows), edited(base, i % 4, i), "en", "a"))
        rows.append((len(rows), base, "en", "a"))
    return rows


def found(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in df.collect())


# A small limit of 1 makes every shared bucket a crowd; blocks of 5 cut the crowds.
@pytest.mark.parametrize("small,block", [(24, 256), (1, 5), (3, 4)])
def test_against_all_pairs(spark, small, block):
    rows = copies()
    got = x.jaccard_groups(spark.createDataFrame(rows, DOCS), small=small, block=block)
    assert found(got) == brute(rows)


def test_awkward_rows(spark):
    assert found(x.jaccard_groups(awkward(spark))) == brute(AWKWARD)
    assert x.jaccard_groups(empty(spark)).count() == 0
    kept = x.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    # Of the ids 1, 2, 2 and null with equal words one row stays.
    assert kept.where("text like 'one%two%seven%'").count() == 1


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.8, 0.99), (0.5, 0.95)):
        bands, rows = x.choose_bands(threshold, recall)
        assert bands * rows <= x.MAX_HASHES and 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        x.choose_bands(0.1, 0.9999, 8)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(20, 21)], "a long, b long")
    got = {r.node: r.label for r in x.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 13)}, 20: 20, 21: 20}


def test_words_are_told_apart_by_all_their_bytes():
    s = x.Shingler(18, 4)
    a, b = "x" * 200 + "a", "x" * 200 + "b"
    assert s.word_hashes(a)[0] != s.word_hashes(b)[0]
    swapped = "y" * 64 + "z" * 64, "z" * 64 + "y" * 64
    assert s.word_hashes(swapped[0])[0] != s.word_hashes(swapped[1])[0]
    assert len(s.word_hashes(" a  b\t\nc é ")) == 4 and not len(s.word_hashes(" \n"))


def test_rows_of_a_crowd_grow_with_its_size(spark):
    """Near copies of one text, in blocks of 20: edges and rows per block, not per pair of classes."""
    def rows_of(n):
        base = list(range(1000))
        sets = [(b"crowd", i % (n // 20), n // 20, f"{i:05d}".encode(), 1, sorted([*base[i % 50:], 10_000 + i])) for i in range(n)]
        members = spark.createDataFrame(sets, "crowd binary, block int, n_blocks int, cid binary, n_docs long, runs array<long>")
        counted, edges = x.crowd_links(members, 0.8)
        assert {r.links for r in counted.collect()} == {n - 1}
        return edges.count()

    for n in (100, 200, 400):
        blocks = n // 20
        assert rows_of(n) <= n + blocks * (blocks - 1) // 2


def test_components_of_a_hub_take_few_tasks(spark):
    """A hub with a chain behind it; further steps take no more tasks than the first."""
    def tasks_of(chain):
        ends = [(0, i) for i in range(1, 600)] + [(599 + i, 600 + i) for i in range(chain)] + [(5000, 5000)]
        edges = spark.createDataFrame(ends, "a long, b long")
        spark.sparkContext.setJobGroup(f"chain-{chain}", "")
        found = x.components(edges)
        spark.sparkContext.setJobGroup("", "")
        assert {r.node: r.label for r in found.collect()} == {**{i: 0 for i in range(600 + chain)}, 5000: 5000}
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(f"chain-{chain}") for s in tracker.getJobInfo(j).stageIds}
        return sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i is not None)

    short, long = tasks_of(2), tasks_of(8)
    assert long - short <= 6 * 8
