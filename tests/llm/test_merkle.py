from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(digests: list[str], fan: int) -> tuple[str, list[list[str]]]:
    """The root and each leaf's siblings, level by level."""
    proofs, level, under = [[] for _ in digests], digests, [[i] for i in range(len(digests))]
    while len(level) > 1:
        runs = [range(i, min(i + fan, len(level))) for i in range(0, len(level), fan)]
        for run in runs:
            for i in run:
                for leaf in under[i]:
                    proofs[leaf] += [level[j] for j in run if j != i]
        under = [[leaf for i in run for leaf in under[i]] for run in runs]
        level = [h(*[level[i] for i in run]) for run in runs]
    return level[0], proofs


def brute(rows, fan: int = 3):
    """(subroot, root, proof) by (tree, position in its sorted leaves)."""
    first_null = lambda v: (v is not None, v)
    trees = {}
    for key, tree, leaf in rows:
        trees.setdefault(tree, []).append((first_null(key), leaf, key))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    grown = {t: climb([leaf for _, leaf, _ in sorted(trees[t], key=lambda r: r[:2])], fan) for t in names}
    root, over = climb([grown[t][0] for t in names], fan)
    out = []
    for t, above in zip(names, over):
        for (_, leaf, key), proof in zip(sorted(trees[t], key=lambda r: r[:2]), grown[t][1]):
            out.append((str(key), str(t), leaf, grown[t][0], root, "".join(proof + above)))
    return sorted(out)


def check(spark, rows, fan=3, parts=4):
    frame = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(parts)
    # names that the operator uses itself
    frame = frame.selectExpr("*", "1 AS tree", "2 AS place", "3 AS n", "4 AS digest", "5 AS row", "6 AS root", "7 AS key")
    found = merkle.manifest(frame, fan=fan)
    found = found.withColumn("folded", merkle.folded(spark, "row.leaf", fan))
    got = found.collect()
    assert all(r.folded == r.root for r in got)
    assert all((r.row.tree, r.row.place, r.row.root) == (1, 2, 6) for r in got)
    plain = [
        (str(r.row.doc_id), str(r.row.source), r.row.leaf, r.subroot, r.root, bytes(r.proof).hex()) for r in got
    ]
    assert sorted(plain) == brute(rows, fan)


SIZES = [("b", 1), ("a", 3), ("é", 4), ("Z", 9), (None, 10), ("z", 82), ("hot", 250)]


def leaves(sizes):
    return [(i * 7 % n, s, h(str(s), str(i))) for s, n in sizes for i in range(n)]


@pytest.mark.parametrize("places, rows", [(20_000, 500_000), (9, 40)])
def test_equals_the_plain_tree(spark, monkeypatch, places, rows):
    monkeypatch.setattr(merkle, "CELL_PLACES", places)
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    check(spark, leaves(SIZES))


def test_joins_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_NODES", 1)
    check(spark, leaves(SIZES[:5]), fan=2)


@pytest.mark.parametrize("sizes", [[("a", 1)], [("a", 28)], [("a", 1), ("b", 1)], [(str(i), 1) for i in range(11)]])
def test_few_trees_and_lone_leaves(spark, sizes):
    check(spark, leaves(sizes))


def test_null_and_repeated_keys_and_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 10)
    same = h("same")
    check(spark, [(None, "a", same)] * 20 + [(None, "a", h("x")), (3, "a", same), (3, "a", h("y")), (3, None, same)])


def test_a_changed_leaf_is_noticed(spark):
    frame = spark.createDataFrame(leaves(SIZES[:4]), "doc_id long, source string, leaf string")
    frame = frame.withColumn("given", F.when(F.col("doc_id") == 2, F.sha2("leaf", 256)).otherwise(F.col("leaf")))
    found = merkle.manifest(frame).withColumn("folded", merkle.folded(spark, "row.given"))
    for row in found.collect():
        assert (row.folded == row.root) == (row.row.doc_id != 2)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, leaf string")
    found = merkle.manifest(frame)
    assert found.withColumn("folded", merkle.folded(spark, "row.leaf")).count() == 0


def test_fields_are_told_apart(spark):
    frame = spark.createDataFrame([(1, "é\n", None), (None, "", "-")], "a long, b string, c string")
    got = [r[0] for r in frame.select(merkle.digest_of(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [h("1:1", "3:é\n", "-"), h("-", "0:", "1:-")]
