"""The prefix trie beside plain code, in one shard and in many."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wordloom.llm import prefix_trie as t

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))

    def tie(x):
        return x[:2], hashlib.sha256(f"{len(x[2].encode())}:{x[2]}:{x[3]}".encode()).digest()

    own = {c: [x[2:] for x in sorted(turns, key=tie)] for c, turns in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append((c, d == len(seq)))
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    out = []

    def sums(p):
        gain = (len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves = 0 if children[p] else 1
        for x in children[p]:
            a, b = sums(x)
            leaves, gain = leaves + a, gain + b
        ends = ",".join(str(c) for c, e in sorted(nodes[p]) if e)
        out.append((min(nodes[p])[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(nodes[p]), len(children[p]),
                    leaves, gain, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, gain

    if nodes:
        sums(())
    return sorted(out, key=str)


def ours(spark, rows, shard_turns=t.SHARD_TURNS):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r[c] for c in t.COLUMNS) for r in t.prefix_nodes(df, shard_turns).collect()), key=str)


def talks(seed, n=80, texts=3, longest=6):
    rng = random.Random(seed)
    return [(c, i, rng.choice(["user", "bot"]), rng.choice(["a b", "a", "c d e", " "][:texts]))
            for c in rng.sample(range(-60, 400), n) for i in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("seed,shard_turns", [(0, 250_000), (1, 60), (2, 20), (3, 7), (4, 1)])
def test_trie(spark, seed, shard_turns):
    rows = talks(seed)
    assert ours(spark, rows, shard_turns) == brute(rows)


def test_one_path_over_all_shards(spark):
    """Each conversation goes on from the one before: every border cuts the same path."""
    rows = [(20 * c, i, "user", f"turn {i}") for c in range(12) for i in range(c + 1)]
    assert ours(spark, rows, 8) == brute(rows)


def test_many_equal_and_one_long_conversation(spark):
    rows = [(c, i, "user", f"hello {i}") for c in range(300) for i in range(3)]
    rows += [(1000, i, "bot", f"t{i}") for i in range(700)]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, 200) == brute(rows)


def test_ids_in_parts(spark, monkeypatch):
    monkeypatch.setattr(t, "PART_BITS", 2)
    rows = [(20 * c, 0, "user", "same") for c in range(-7, 60)]
    assert ours(spark, rows, 3) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (2, 5, "", ""),
            (3, 1, "a", "b:c"), (3, 1, "a:b", "c"), (4, 2, "bot", "long " * 20_000), (4, 1, "bot", "é😀 x"), (21, 7, "u", "v")]
    assert ours(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "key", "depth", "words", "n", "shard", "at", "conv", "h", "base", "heads"):
        df = df.withColumn(name, df["role"])
    assert t.prefix_nodes(df).count() == len(brute(rows))


def test_empty_table(spark):
    assert t.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_find_close(seed):
    rng = random.Random(seed)
    opens, depth = [], 0
    for _ in range(rng.choice([10, 500, 5000])):
        up = depth == 0 or rng.random() < (0.5 if seed % 2 else 0.9 if len(opens) % 700 < 350 else 0.1)
        opens.append(up)
        depth += 1 if up else -1
    opens += [False] * depth
    stack, close = [], {}
    for i, up in enumerate(opens):
        if up:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree = t.Parentheses(np.array(opens))
    at = np.array(sorted(close))
    assert tree.find_close(at).tolist() == [close[i] for i in at]
    pairs = [i for i in range(len(opens) - 1) if opens[i] and not opens[i + 1]]
    assert tree.leaf_pairs().tolist() == np.searchsorted(pairs, np.arange(len(opens) + 1)).tolist()
