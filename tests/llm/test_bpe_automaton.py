"""The automaton beside the full table of its gadgets, and beside the vocabulary's library."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from samples import awkward, empty

import __spark_entry__ as entry
from wordloom.llm import bpe_automaton as b

FILE = "/opt/tokenizers/byte_bpe_50k.json"
SF = "/root/testdata/sf0.001"


def ids_of(tokens):
    return np.frombuffer(tokens, dtype="<u4").tolist()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    return b.tokenizer(FILE)


def small(rng, n_merges):
    """Bytes as ids 0 to 255, and random merges of the letters a, b, c and what they make."""
    labels = {i: bytes([i]) for i in range(256)}
    letters, merges, made = [97, 98, 99], [], set()
    while len(merges) < n_merges:
        u, v = rng.choice(letters), rng.choice(letters)
        if labels[u] + labels[v] not in made:
            made.add(labels[u] + labels[v])
            labels[256 + len(merges)] = labels[u] + labels[v]
            letters.append(256 + len(merges))
            merges.append((u, v, letters[-1]))
    return labels, merges


def full_table(labels, merges):
    """Every gadget applied to every arc of the whole table, as the module's text tells it."""
    n = len(labels)
    arc = np.zeros((n, n), dtype=bool)
    arc[:256, :256] = True
    for u, v, w in merges:
        if arc[u, v]:
            arc[w] = arc[v]
            arc[u, v] = False
            arc[:, w] = arc[:, u]
    return arc


def by_merging(word, merges):
    """Plain BPE: merge after merge, over the whole word, from the left."""
    tokens = list(word)
    for u, v, w in merges:
        out = []
        for t in tokens:
            if t == v and out and out[-1] == u:
                out[-1] = w
            else:
                out.append(t)
        tokens = out
    return tokens


@pytest.mark.parametrize("seed", range(12))
def test_the_table_is_that_of_the_gadgets(seed):
    labels, merges = small(random.Random(seed), 25)
    automaton = b.Automaton(labels, merges)
    table = full_table(labels, merges)
    live = [t for t in labels if t not in automaton.dead]
    for x, y in itertools.product(live, live):
        assert automaton._arc(x, y) == table[x, y], (labels[x], labels[y])


@pytest.mark.parametrize("seed", range(12))
def test_paths_are_plain_merging(seed):
    rng = random.Random(seed)
    labels, merges = small(rng, 25)
    automaton = b.Automaton(labels, merges)
    for size in range(1, 7):
        for word in map(bytes, itertools.product(b"abc", repeat=size)):
            assert automaton.encode(word) == by_merging(word, merges)
    for _ in range(50):
        word = bytes(rng.choices(b"abc", k=200))
        assert automaton.encode(word) == by_merging(word, merges)


def test_broken_vocabularies_are_refused():
    labels = {i: bytes([i]) for i in range(256)}
    with pytest.raises(ValueError):
        b.Automaton({i: labels[i] for i in range(255)}, [])
    with pytest.raises(ValueError):
        b.Automaton(labels | {256: b"abc", 257: b"bc"}, [(97, 257, 256), (98, 99, 257)])
    with pytest.raises(ValueError):
        b.Automaton(labels | {256: b"ab"}, [(97, 98, 256), (97, 98, 256)])


def test_texts_as_the_library_has_them(own, library):
    rng = random.Random(3)
    texts = ["", " ", "a<|endoftext|>b <|endoftext|>  \n", "<|endoftext|>" * 3, "it's I'LL don't 'sx", "x" * 3000,
             " \t\r\n\x85\xa0\x0b\x1c\x1d a  b   ", "é😀 日本語 ▁mark\x00", "a࢏b 1\U00010940 ₏՘"]
    texts += ["".join(rng.choices("abcdefghtheinro \n'", k=rng.randrange(1, 80))) for _ in range(500)]
    texts += ["".join(rng.choices("aaaa  -=_.\n", k=rng.randrange(1, 200))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(60))
              for _ in range(300)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own.encode(text)) == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_bytes_that_are_no_character(own, library):
    for ids in ([own.automaton.whole[b"\xe9"]], [own.automaton.whole[b"\xf0"], own.automaton.whole[b"a"]]):
        assert own.decode(b.packed_ids(ids)) == library.decode(ids, skip_special_tokens=False)


def test_full_memories_change_nothing(own, monkeypatch):
    text = " ".join(f"word{i}longer{i % 7}" for i in range(400))
    want = b.Tokenizer(FILE).encode(text)
    monkeypatch.setattr(b, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(b, "TABLE_CELLS", 5)
    tight = b.Tokenizer(FILE)
    assert tight.encode(text) == want and len(tight.met) <= 3


def test_query(spark, library):
    rows = entry.queries()["op13_bpe_automaton"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        packed = np.array(ids, dtype="<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    rows = b.decode(b.encode(docs, FILE), FILE).collect()
    want = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), r.decoded) for r in rows) == want
    by_text = {r.decoded: ids_of(r.tokens) for r in rows}
    assert by_text[""] == [] and all(
        ids == library.encode(text, add_special_tokens=False).ids for text, ids in by_text.items())


def test_empty_table(spark):
    assert b.decode(b.encode(empty(spark), FILE), FILE).count() == 0
