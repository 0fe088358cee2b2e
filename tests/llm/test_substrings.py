from __future__ import annotations

import hashlib
import random

import pytest
from llm_words import words

from tidemark.llm import blocks, substrings


def expected(rows):
    """rows: (doc_id, text); a null id is the largest."""
    key = lambda i: 2**63 - 1 if i is None else i
    least = {}
    for doc_id, text in rows:
        ws = words(text)
        for i in range(len(ws) - 12):
            w = tuple(ws[i : i + 13])
            least[w] = min(least.get(w, key(None)), key(doc_id))
    out = []
    for doc_id, text in rows:
        ws = words(text)
        gone = [False] * len(ws)
        for i in range(len(ws) - 12):
            if least[tuple(ws[i : i + 13])] < key(doc_id):
                gone[i : i + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((doc_id, len(ws), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    rows = substrings.without_repeats(docs).selectExpr("row.doc_id", "n_words", "n_removed", "kept", "kept_sha256")
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.fixture(scope="module")
def repetitive(mixed_texts):
    rng = random.Random(9)
    texts = list(mixed_texts)
    for _ in range(40):
        a, b = (words(rng.choice(mixed_texts)) for _ in range(2))
        i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        texts.append(" \n".join(a[i : i + rng.randint(5, 60)] + b[j : j + rng.randint(5, 60)]))
    return texts


@pytest.mark.parametrize("group_bytes,bucket_bytes", [(600, 900), (2**23, 2**23)])
def test_equal_to_brute_force(docs_of, repetitive, monkeypatch, group_bytes, bucket_bytes):
    monkeypatch.setattr(blocks, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(substrings, "_BUCKET_BYTES", bucket_bytes)
    ids = list(range(len(repetitive)))
    random.Random(2).shuffle(ids)
    got = found(docs_of(repetitive, ids))
    assert got == expected(list(zip(ids, repetitive)))
    assert sum(r[2] for r in got) > 500


def test_hot_minimisers_go_window_by_window(docs_of, monkeypatch):
    monkeypatch.setattr(substrings, "_BUCKET_BYTES", 2000)
    monkeypatch.setattr(blocks, "GROUP_BYTES", 3000)
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [" ".join(rng.choices("abcdefgh", k=9)) + " " + passage + " " + " ".join(rng.choices("xyz", k=9)) for _ in range(150)]
    docs = docs_of(texts)
    total = blocks.text_bytes(docs, "text")
    assert len(substrings._hot(docs, total, total * 3 // 2000, "text"))
    assert found(docs) == expected(list(enumerate(texts)))


def test_different_windows_of_one_hash_are_told_apart(monkeypatch):
    strings = [" ".join(f"{p}{i}" for i in range(14)).encode() for p in "ababa"]

    class Same(substrings.Rolling):
        def of(self, n):
            return super().of(n) * 0

    import numpy as np

    docs = np.array([5, 4, 3, 6, 9])
    want = substrings._window_masks(strings, docs).tolist()
    monkeypatch.setattr(substrings, "Rolling", Same)
    assert substrings._window_masks(strings, docs).tolist() == want == [3, 0, 0, 3, 3]


def test_nulls_repeated_rows_and_extra_columns(docs_of, mixed_texts):
    long = mixed_texts[-1]
    texts, ids = [long, long, long, None, "", long + " x"], [4, 4, None, 1, None, 2]
    docs = docs_of(texts, ids).selectExpr("*", "1 AS g", "2 AS row", "3 AS kept", "4 AS id")
    assert found(docs) == expected(list(zip(ids, texts)))
    out = substrings.cleaned(docs)
    assert out.columns == docs.columns
    assert all(r.n_chars in (None, len(r.text)) for r in out.collect())


def test_empty_table(docs_of):
    assert found(docs_of([])) == []


def test_groups_are_even_where_a_third_of_the_rows_are_equal(docs_of, monkeypatch):
    monkeypatch.setattr(blocks, "GROUP_BYTES", 20_000)
    rng = random.Random(5)
    same = " ".join(rng.choices("abcdefgh", k=300))
    texts = [" ".join(rng.choices("abcdefgh", k=300)) for _ in range(2000)] + [same] * 1000
    docs = docs_of(texts, [*range(2000), *[None] * 1000], parts=8)
    total = blocks.text_bytes(docs, "text")
    sizes = [r["count"] for r in blocks.grouped(docs, total).groupBy("g").count().collect()]
    # On average 33 rows each.
    assert sum(sizes) == 3000 and len(sizes) > 60 and max(sizes) < 150


def test_equal_rows_in_many_groups(docs_of, monkeypatch):
    monkeypatch.setattr(blocks, "GROUP_BYTES", 400)
    rng = random.Random(6)
    same = " ".join(rng.choices(["aa", "bb", "cc"], k=40))
    texts = [same] * 60 + [f"x {same} y"] * 3 + ["", None, "one"]
    ids = [7] * 30 + [None] * 30 + [3, 8, None, 1, None, None]
    docs = docs_of(texts, ids, parts=6)
    assert blocks.grouped(docs, blocks.text_bytes(docs, "text")).select("g").distinct().count() > 4
    assert found(docs) == expected(list(zip(ids, texts)))
