from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.llm.common import hex60

#: The law by exact sums, without samples, ranges or cells.
SHARDING = r"""
WITH sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
           ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS k,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15))::BIGINT AS k2
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER ()::BIGINT AS total,
           (sum(size) OVER o)::BIGINT - size AS start,
           row_number() OVER o - 1 AS number,
           sum(size) OVER (PARTITION BY k)::BIGINT AS group_size
    FROM sized WINDOW o AS (ORDER BY k, k2, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING)
), dealt AS (
    SELECT *, least(39, floor((CASE WHEN group_size * 40 <= 0.05 * total
            THEN 2 * min(start) OVER (PARTITION BY k) + group_size ELSE 2 * start + size END) * 40
            / (2 * total)))::INTEGER AS shard
    FROM placed
)
SELECT doc_id, size::BIGINT AS size, 'bytes' AS law, shard,
       number - min(number) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""


def law(docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return {r[0]: r[1:] for r in con.execute(SHARDING).fetchall()}


def dealt(docs, shards=40, *more):
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        *more,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        hex60(text).alias("key"),
        hex60(F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias("key2"),
    )
    return sharding.sharded(rows, shards)


def test_equal_to_the_exact_law(docs_of, mixed_texts):
    docs = docs_of([t for t in mixed_texts if t is not None] * 4)
    got = {r.doc_id: (r.size, "bytes", r.shard, r.slot, None) for r in dealt(docs).collect()}
    assert got == law(docs)


@pytest.mark.parametrize("cell_rows", [3, 20_000])
def test_hot_key_is_cut_and_bytes_are_near_equal(docs_of, monkeypatch, cell_rows):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    texts = ["same text again"] * 300 + [f"text number {i}" * (i % 7 + 1) for i in range(600)]
    rows = dealt(docs_of(texts), 10).collect()
    assert len(rows) == len(texts)
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and all(abs(s - mean) < 0.1 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_splitters_weigh_by_size(spark):
    frame = spark.range(1000).select(
        F.lit("x").alias("t"),
        F.when(F.col("id") < 10, 1000).otherwise(1).alias("size"),
        (F.col("id") * 10**15).alias("key"),
        hex60(F.col("id").cast("string")).alias("key2"),
    )
    cuts = sharding.splitters(frame, 10_990)
    assert cuts == sorted(set(cuts))
    assert set(range(0, 10**16, 10**15)) <= set(cuts)
    assert len(cuts) <= sharding.RANGES + 1


def test_nulls_repeated_rows_and_empty(docs_of):
    docs = docs_of([None, "", "a", "a", "a"], [None, 1, 2, 2, None])
    rows = dealt(docs).collect()
    assert sorted(r.size for r in rows) == [16, 16, 17, 17, 17]
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert dealt(docs_of([])).count() == 0


def test_columns_of_any_name_are_carried(docs_of, mixed_texts):
    names = ("row", "first", "low", "high", "parts", "part", "range", "number", "start", "cut", "own", "index", "copies", "order")
    docs = docs_of([t for t in mixed_texts if t is not None]).select(
        "*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names], F.lit(-1).alias("shard"), F.lit("x").alias("Slot")
    )
    found = dealt(docs, 40, *names, "shard", "Slot")
    assert found.columns == ["doc_id", *names, "size", "key", "key2", "shard", "slot"]
    want = law(docs.select("doc_id", "text"))
    for r in found.collect():
        assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
        assert (r.size, "bytes", r.shard, r.slot, None) == want[r.doc_id]


@pytest.mark.parametrize("cell_rows", [7, 20_000])
def test_a_large_group_of_short_copies_stays_whole(docs_of, monkeypatch, cell_rows):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    # More rows than a cell has, and a twentieth of a shard at most.
    texts = [""] * 400 + [f"text number {i} " * 100 for i in range(400)]
    docs = docs_of(texts)
    got = {r.doc_id: (r.size, "bytes", r.shard, r.slot, None) for r in dealt(docs, 2).collect()}
    assert len({got[i][2] for i in range(400)}) == 1
    assert sorted(got[i][3] for i in range(800) if got[i][2] == 0) == list(range(sum(g[2] == 0 for g in got.values())))


def test_repeated_rows_are_counted_in_parts(docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    docs = docs_of(["same"] * 300 + [f"other {i}" for i in range(300)], [None] * 300 + list(range(300)))
    rows = dealt(docs, 5).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 600 and all(sorted(s) == list(range(len(s))) for s in slots.values())
