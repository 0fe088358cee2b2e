from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm_words import words
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import smallest_reachable


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def fingerprint(text) -> int:
    ws = [lowered(w) for w in words(text)]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_and_components_equal_brute_force(docs_of, mixed_texts):
    rng = random.Random(1)
    long = mixed_texts[-1].split()
    near = []
    for _ in range(12):
        edited = list(long)
        edited[rng.randrange(len(edited))] = "changed"
        near.append(" ".join(edited))
    texts = mixed_texts + near
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(texts)).collect()}
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    want = components(prints)
    assert {i: r.component_id for i, r in got.items()} == want
    kept = simhash.keep_first(docs_of(texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_the_hash_is_the_one_of_the_engine(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


@pytest.mark.parametrize("block", [4, 2048])
def test_links_miss_no_pair(spark, block):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for bits in range(1, 6):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), bits)))
    values = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "f long").repartition(3)
    found = simhash.links(frame, 3, block).collect()
    assert all((a ^ b).__and__(2**64 - 1).bit_count() <= 3 for a, b in found)
    nodes = frame.select("f", F.col("f").alias("least"))
    edges = spark.createDataFrame(found, "a long, b long")
    got = {r.f: r.least for r in smallest_reachable(spark, nodes, edges).collect()}
    as_int = {v: v % 2**64 for v in values}
    assert got == components(as_int)


def test_long_chains_settle(spark):
    ids = np.random.default_rng(3).permutation(300).tolist()
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    nodes = spark.createDataFrame([(i, i) for i in range(301)], "f long, least long")
    got = {r.f: r.least for r in smallest_reachable(spark, nodes, edges).collect()}
    assert got == {i: 0 if i < 300 else 300 for i in range(301)}


def test_nulls_repeated_rows_and_extra_columns(docs_of):
    text = " ".join(map(str, range(50)))
    docs = docs_of([text, text, text, "other text here", None, ""], [None, 7, 7, 3, 9, 8])
    docs = docs.selectExpr("*", "1 AS f", "2 AS tile", "3 AS component_id", "4 AS least", "5 AS _rank")
    got = simhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 7), (7, 7), (7, 7), (3, 3), (9, 8), (8, 8)], key=str)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([None, 7, 3, 8], key=str)


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_first(docs_of([])).count() == 0


def test_unrelated_texts_of_one_doc_id_all_stay(docs_of):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    # 5 has two texts of its own, one of them twice, and a third that 2 has first; of 6 the first's text stays.
    rows = [(5, one), (5, two), (5, two), (2, three), (5, three), (6, two), (6, four), (6, one)]
    kept = simhash.keep_first(docs_of([t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, one), (5, two), (2, three), (6, four)])
