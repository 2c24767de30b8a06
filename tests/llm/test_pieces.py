import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from samples import awkward, empty, prose
from wordloom.llm import pieces as x
from wordloom.llm.queries import PIECES

TEXTS = ["", "a", " ", "  x ", "é😀 \n\n\t tab", "x" * 300 + " y", "日本語のテキスト", "the the", "a\x00b", "a▁b ▁",
         "​﻿" * 20, prose("en", 300, 1), prose("fr", 300, 2), "".join(map(chr, range(32, 400)))]


@pytest.fixture(scope="module")
def vocabulary():
    return x.Vocabulary(PIECES)


def encoded(vocabulary, texts, dropout, seed=1, variants=None):
    flat, sizes = x.Encoder(vocabulary, dropout, seed).encode(texts, variants or [0] * len(texts))
    ends = np.cumsum(sizes)
    return [flat[e - s:e].tolist() for s, e in zip(sizes, ends)]


def decoded(vocabulary, ids):
    return x.decode_lists(vocabulary, pa.array(ids, type=pa.list_(pa.int32()))).to_pylist()


def test_without_dropout_it_is_the_library(vocabulary):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for t in TEXTS if x.MARK not in t]
    assert encoded(vocabulary, texts, 0) == [lib.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0, 0.1, 0.5, 0.9, 1])
def test_round_trip(vocabulary, dropout):
    assert decoded(vocabulary, encoded(vocabulary, TEXTS, dropout)) == TEXTS


def plain(vocabulary, chunk, key, dropout):
    """One chunk's agenda, the best allowed merge of all neighbours at a time."""
    parts = [(int(vocabulary.char_id[ord(c)]), i, i + 1) for i, c in enumerate(chunk)]
    while True:
        best = None
        for j in range(len(parts) - 1):
            (a, s, m), (b, _, e) = parts[j], parts[j + 1]
            joined = int(vocabulary.join(np.array([a]), np.array([b]))[0])
            if joined < 0 or dropout and x._skipped(key, *(np.array([v]) for v in (s, m, e)), dropout)[0]:
                continue
            rank = int(vocabulary.rank[joined])
            if best is None or rank < best[0]:
                best = rank, j, joined
        if best is None:
            return [p for p, _, _ in parts]
        _, j, joined = best
        parts[j:j + 2] = [(joined, parts[j][1], parts[j + 1][2])]


def test_skipped_merges_beside_plain_agenda(vocabulary, monkeypatch):
    keys = {}
    monkeypatch.setattr(x, "MARK_IN_TEXT", "\udc81")
    e = x.Encoder(vocabulary, 0.3, 5)
    words = [x.MARK + w for w in prose("en", 60, 3).split()] + [x.MARK + "abcdefgh" * 6]
    seen = x._skipped
    merge, merge_long = e._merge, e._merge_long

    def spy(ids, starts, lengths, key, width):
        keys.update({(int(s), int(n)): k for s, n, k in zip(starts, lengths, key)})
        return merge(ids, starts, lengths, key, width)

    def spy_long(ids, key):
        keys["long"] = key
        return merge_long(ids, key)

    monkeypatch.setattr(e, "_merge", spy)
    monkeypatch.setattr(e, "_merge_long", spy_long)
    sizes, flat = e.segment([(0, w) for w in words])
    assert x._skipped is seen
    at = start = 0
    for w, n in zip(words, sizes):
        key = keys.get((start, len(w)), keys.get("long"))
        assert flat[at:at + n].tolist() == plain(vocabulary, w, key, 0.3)
        at, start = at + n, start + len(w)


def test_seeds_and_variants_vary_and_repeat(vocabulary):
    texts = [prose("en", 200, 9)]
    one = encoded(vocabulary, texts, 0.3)
    assert one == encoded(vocabulary, texts, 0.3)
    assert one != encoded(vocabulary, texts, 0.3, seed=2) and one != encoded(vocabulary, texts, 0.3, variants=[1])
    assert len(one[0]) > len(encoded(vocabulary, texts, 0)[0])


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    texts = [prose("en", 50, i) for i in range(40)]
    whole = encoded(vocabulary, texts, 0.2)
    monkeypatch.setattr(x, "MEMORY", 10)
    e = x.Encoder(vocabulary, 0.2, 1)
    assert [e.encode([t], [0])[0].tolist() for t in texts] == whole


def test_frames(spark):
    docs = awkward(spark).withColumn("_variant", F.lit("mine"))
    out = x.decode(x.encode(docs, PIECES), PIECES, out="ids_text") if "ids" not in docs.columns else x.decode(
        x.encode(docs, PIECES, out="pieces"), PIECES, ids="pieces", out="back")
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.back == r.text for r in rows)
    assert all((r.pieces is None) == (r.text is None) for r in rows)
    assert out.columns == [*docs.columns, "pieces", "back"]
    assert x.encode(empty(spark), PIECES, out="pieces").count() == 0
    assert x.checked(x.encode(docs, PIECES, out="pieces"), PIECES, ids="pieces").count() == len(rows)
    wrong = x.encode(docs, PIECES, out="pieces").withColumn("text", F.lit("other"))
    with pytest.raises(Exception, match="do not decode"):
        x.checked(wrong, PIECES, ids="pieces").collect()


def test_bytes_that_are_no_text(vocabulary):
    ids = [[int(vocabulary.byte_ids[0xFF]), int(vocabulary.byte_ids[0x41])], None, [0]]
    assert decoded(vocabulary, ids) == ["�A", None, "�"]


def test_random_strings(vocabulary):
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([32, 10, 97, 101, 0x2581, 0x4E00, 0x1F600, 160])) for _ in range(rng.randrange(60))) for _ in range(300)]
    for dropout in (0, 0.4):
        assert decoded(vocabulary, encoded(vocabulary, texts, dropout)) == texts


def test_encoding_checks_itself(spark):
    """The check changes no ids, and texts of all kinds pass it."""
    docs = awkward(spark)
    plain = x.encode(docs, PIECES, out="made").select("doc_id", "made").collect()
    checked = x.encode(docs, PIECES, out="made", check=True).select("doc_id", "made").collect()
    assert sorted(map(str, plain)) == sorted(map(str, checked))


def test_remembered_agendas_are_those_of_each_occurrence(vocabulary, monkeypatch):
    texts = TEXTS + [prose("en", 300, i % 5) for i in range(30)]
    keys = [i * i - 7 for i in range(len(texts))]
    for dropout in (0.1, 0.4, 1):
        got = encoded(vocabulary, texts, dropout, variants=keys)
        with monkeypatch.context() as m:
            m.setattr(x.Encoder, "_apart", lambda self, codes, own: np.arange(len(codes)))
            assert encoded(vocabulary, texts, dropout, variants=keys) == got
        assert decoded(vocabulary, got) == texts


def test_segmentations_of_a_word_grow_with_documents(vocabulary):
    ways = [len(set(map(tuple, encoded(vocabulary, ["understandings"] * n, 0.3, variants=list(range(n)))))) for n in (4, 40, 400)]
    assert ways[0] > 1 and ways[1] > ways[0] and ways[2] > max(20, ways[1])
    ids = encoded(vocabulary, ["understandings " * 50], 0.3)[0]
    words, word = [], []
    for i in ids:
        if vocabulary.text[vocabulary.text_start[i]] == 32 and word:
            words.append(tuple(word))
            word = []
        word.append(i)
    assert len(set(words)) > 4


def test_the_share_of_skips_is_the_dropout():
    key = x._mixed(np.arange(200_000, dtype=np.uint64))
    at = [np.array([k]) for k in (0, 1, 2)]
    assert abs(x._skipped(key, *at, 0.1).mean() - 0.1) < 0.005


def test_copies_behind_each_other_are_cut_on_their_own(spark):
    docs = spark.createDataFrame([(1, prose("en", 200, 4)), (2, "x")], "doc_id long, text string")
    copies = docs.select("*", F.explode(F.expr("sequence(1, 5)")).alias("copy")).coalesce(1)
    rows = [r for r in x.encode(copies, PIECES).collect() if r.doc_id == 1]
    assert len({tuple(r.ids) for r in rows}) == 5
    again = [r for r in x.encode(copies, PIECES).collect() if r.doc_id == 1]
    assert rows == again


def test_only_candidates_that_are_taken_are_remembered(vocabulary):
    """A candidate that is met but never the best one may be skipped without an agenda of its own."""
    e = x.Encoder(vocabulary, 0.1, 1)
    e.encode([" ".join(f"{w}" for w in prose("en", 200, 5).split())], [3])
    for chunk, at in e.known.items():
        assert e.taken[at] == len(chunk) - e.size[at]
