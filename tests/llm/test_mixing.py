from __future__ import annotations

import hashlib
import math

import pytest
from llm_words import words
from pyspark.sql import functions as F

from tidemark.llm import mixing


def shares(totals: dict, weights=(5, 2, 1), limit=3) -> dict:
    """The rule step by step: reshare the excess until none is above its limit."""
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    free, left = set(names), float(sum(totals.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        above = {s for s in free if unit * weight[s] > limit * totals[s]}
        if not above:
            return target | {s: unit * weight[s] for s in free}
        for s in above:
            target[s] = float(limit * totals[s])
            left -= target[s]
        free -= above
    return target


def brute(rows):
    size = [len(words(t)) for _, t, _ in rows]
    totals = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        totals[s] = totals.get(s, 0) + n
    target = shares(totals)
    taken = {}
    for s in totals:
        key = lambda i: (hashlib.md5(f"mix:{rows[i][0]}".encode()).hexdigest()[:15], rows[i][0])
        order = sorted((i for i in range(len(rows)) if rows[i][2] == s), key=key)
        left = min(3 * totals[s], math.floor(target[s] + 0.5))
        for _ in range(4):
            for i in order:
                part = min(left, size[i])
                taken[i] = taken.get(i, 0) + part
                left -= part
        assert left == 0
    return {rows[i][0]: (size[i], totals[s], target[s], taken[i]) for i, (_, _, s) in enumerate(rows)}


@pytest.fixture(params=[2, 20_000])
def cell_rows(request, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", request.param)


SOURCES = ["b", "a", "a", None, "c", "a", "a", "", "é", "a"]


def test_equal_to_the_plain_rule(docs_of, mixed_texts, cell_rows):
    sources = [SOURCES[i % len(SOURCES)] for i in range(len(mixed_texts))]
    docs = docs_of(mixed_texts, sources=sources)
    got = mixing.mixture(docs, mixing.word_count(F.col("text"))).collect()
    want = brute(list(zip(range(len(mixed_texts)), mixed_texts, sources, strict=True)))
    for r in got:
        assert tuple(r.mix) == pytest.approx(want[r.doc_id], abs=1e-9)


def test_the_mix_holds_what_was_taken(docs_of, mixed_texts, cell_rows):
    sources = [SOURCES[i % len(SOURCES)] for i in range(len(mixed_texts))]
    docs = docs_of(mixed_texts, sources=sources).selectExpr("*", "1 AS _mix", "2 AS size", "3 AS cell")
    want = brute(list(zip(range(len(mixed_texts)), mixed_texts, sources, strict=True)))
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert words(r.text) == words(mixed_texts[r.doc_id])[: len(words(r.text))]
    assert got == {i: w[3] for i, w in want.items() if w[3]}


def test_nulls_repeated_rows_and_empty(docs_of):
    docs = docs_of(["a b", "a b", None, "c"], [1, 1, None, None], [None, None, "x", "x"])
    rows = mixing.mixture(docs, mixing.word_count(F.col("text"))).select("doc_id", "mix.*").collect()
    assert sum(r.taken for r in rows) == 5
    assert all(r.taken <= 3 * r.size for r in rows)
    none = docs_of(["", None])
    assert [r.mix.taken for r in mixing.mixture(none, mixing.word_count(F.col("text"))).collect()] == [0, 0]
    assert mixing.mixed_texts(none).count() == 0
    assert mixing.mixed_texts(docs_of([])).count() == 0
