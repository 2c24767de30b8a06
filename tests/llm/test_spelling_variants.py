"""Spelling variants beside plain code."""

import random
import zlib
from collections import Counter

import pytest
from samples import awkward, empty

from wordloom.llm import spelling_variants as v


def edit_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if edit_is_one(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= ratio * n else None
        out[w] = (n, len(near), form, counts[form] if form else None)
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w] += (root,)
    return out


def told(spark, counts, **how):
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    near = {r.word: r for r in v.near_words(words, **how).collect()}
    return {w: (near[w].n_near, near[w].best) if w in near else (0, None) for w in counts}


def best_of(counts):
    out = {}
    for w in counts:
        near = [x for x in counts if edit_is_one(w, x)]
        out[w] = (len(near), min(near, key=lambda x: (-counts[x], x), default=None))
    return out


@pytest.mark.parametrize("letters,block", [("ab", 1024), ("ab", 7), ("abé", 20), ("ÿa", 3)])
def test_near_words(spark, letters, block):
    rng = random.Random(letters + str(block))
    counts = {"".join(rng.choices(letters, k=rng.choice([6, 6, 7, 7, 8, 9, 10]))): rng.randrange(5, 40) for _ in range(220)}
    assert told(spark, counts, block=block) == best_of(counts)


def test_long_words_and_one_hot_meeting(spark):
    counts = {"x" * 5000: 9, "x" * 4999: 8, "x" * 2500 + "y" + "x" * 2499: 7, "y" + "x" * 4999: 6}
    # All of these share their first letters, and are near to their neighbours only.
    counts |= {f"common{a}{b}": 5 for a in "abcdefgh" for b in "abcdefgh"}
    assert told(spark, counts, block=10) == best_of(counts)


def test_forms_and_roots(spark):
    texts = {"letters": 500, "leters": 60, "letrs": 1, "lettres": 100, "letterx": 100, "lxtterx": 20, "lxtteyx": 5,
             "Another": 30, "another": 30, "anothet": 12, "Étages": 6, "étages": 6}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(texts.items())]
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in v.variants(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = Counter()
    for i, text in rows:
        for w in text.split():
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{i}:{w}".encode())
            w = w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]
            want[w] += len(w) >= 6
    assert got == brute({w: n for w, n in want.items() if n >= 5})
    assert got["lxtteyx"][4] == "letters" or got["lxtterx"][2] == "letterx"


def test_damage(spark):
    rows = [(i, "Abcdefghé wörtlich") for i in range(800)] + [(None, "Abcdefghé")]
    words = Counter(r.word for r in v.occurrences(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = Counter()
    for i, text in rows:
        for w in text.split():
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            want[w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    assert words == want and len(words) > 4


def test_awkward_rows(spark):
    got = {r.word: r.n for r in v.variants(awkward(spark), min_count=1).collect()}
    assert got == {"x" * 50_000: 1}
    assert v.variants(awkward(spark)).count() == 0


def test_empty_table(spark):
    assert v.variants(empty(spark)).count() == 0
