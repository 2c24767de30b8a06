import hashlib
import re
from collections import defaultdict

import pytest

from samples import AWKWARD, awkward, empty
from wordloom.llm import exact_dedup as x


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[norm(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] if r[0] is not None else 0, i))
    out = []
    for i, r in enumerate(rows):
        g = groups[norm(r[1])]
        best = min(g)
        out.append((r[0], rows[best[3]][0], len(g), hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return out


# With two hash bits most texts share a hash, so chains are told apart by their bytes.
@pytest.mark.parametrize("bits,capacity", [(64, 50_000), (2, 1), (8, 2)])
def test_against_groups_by_text(spark, bits, capacity):
    got = x.exact_dedup(awkward(spark), capacity=capacity, hash_bits=bits).collect()
    assert sorted(map(str, [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got])) == sorted(map(str, expected(AWKWARD)))
    kept = [r for r in got if r.kept]
    assert len(kept) == len({norm(r[1]) for r in AWKWARD})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_full_directory_covers_every_slot_once(spark):
    entries = x.text_groups(spark.range(500).selectExpr("string(id) as text"))
    slots = x.directory(entries, capacity=20).collect()
    top = slots[0].top
    assert sorted(s.slot for s in slots) == list(range(1 << top))
    assert all(s.n_entries <= 20 for s in slots) and top >= 5
    index = x.build_index(spark.range(500).selectExpr("string(id) as text"), capacity=20)
    assert index.count() == 500 and index.where("chain > 1").isEmpty()


def test_chains_under_one_hash(spark):
    index = x.build_index(spark.range(50).selectExpr("string(id) as text"), capacity=4, hash_bits=3)
    assert index.count() == 50
    chains = index.groupBy("h").agg({"chain": "max", "*": "count"}).collect()
    assert all(r["max(chain)"] == r["count(1)"] for r in chains) and len(chains) <= 8


def test_empty_and_kept_rows(spark):
    assert x.exact_dedup(empty(spark)).count() == 0
    docs = awkward(spark)
    rows = x.keep_one(docs).collect()
    assert rows and set(rows[0].asDict()) == set(docs.columns)
    assert len(rows) == len({norm(r[1]) for r in AWKWARD})
    assert x.keep_one(empty(spark)).count() == 0


def test_hot_group(spark):
    docs = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', string(id)) as text")
    got = x.exact_dedup(docs)
    assert got.where("keep_id = 0 and group_size = 300").count() == 300
    assert got.where("kept").count() == 601


def test_ids_of_any_type(spark):
    docs = awkward(spark).withColumn("doc_id", x.F.col("doc_id").cast("string"))
    got = {(r.doc_id, r.keep_id, r.group_size) for r in x.exact_dedup(docs).collect()}
    assert ("2", "2", 4) in got and (None, "2", 4) in got and ("4", "5", 3) in got
    assert len(x.keep_one(docs).collect()) == len({norm(r[1]) for r in AWKWARD})


def test_the_result_comes_through_the_directory(spark, monkeypatch):
    """Without the entry for its slot a row has no bucket, and no keeper."""
    docs = spark.range(300).selectExpr("id as doc_id", "string(id % 200) as text")
    whole = x.directory

    def torn(entries, capacity, hash_bits):
        return whole(entries, capacity, hash_bits).where("slot > 0")

    assert x.exact_dedup(docs, capacity=20).count() == 300
    monkeypatch.setattr(x, "directory", torn)
    assert 0 < x.exact_dedup(docs, capacity=20).count() < 300
