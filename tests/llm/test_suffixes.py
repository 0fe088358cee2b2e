from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import blocks, suffixes


def expected(rows):
    key = lambda i: 2**63 - 1 if i is None else i
    least = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for doc_id, b in raw:
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            place = (key(doc_id), p)
            least[w] = min(least.get(w, place), place)
    out = []
    for doc_id, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - 99):
            if least[b[p : p + 100]] < (key(doc_id), p):
                gone[p : p + 100] = [True] * 100
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    rows = suffixes.without_repeats(docs).selectExpr("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.fixture(scope="module")
def repetitive(mixed_texts):
    rng = random.Random(9)
    texts = [t if t is None else t[:2500] for t in mixed_texts]
    pool = [t for t in texts if t and len(t) > 20]
    for _ in range(60):
        a, b = rng.choice(pool), rng.choice(pool)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        texts.append(a[i : i + rng.randint(60, 300)] + b[j : j + rng.randint(60, 300)])
    texts += ["é" * 300, "\0" * 250, "\0" * 40 + "z" * 150, "ab" * 300, "abc" * 77, "x" * 99, "x" * 100, "x" * 101]
    return texts


@pytest.mark.parametrize("group_bytes,bucket_bytes,parts", [(600, 900, 4), (1500, 4000, 4096), (2**23, 2**23, 4096)])
def test_equal_to_brute_force(docs_of, repetitive, monkeypatch, group_bytes, bucket_bytes, parts):
    monkeypatch.setattr(blocks, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(suffixes, "_BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(suffixes, "_RANGES", parts)
    ids = list(range(len(repetitive)))
    random.Random(2).shuffle(ids)
    got = found(docs_of(repetitive, ids))
    assert got == expected(list(zip(ids, repetitive)))
    assert sum(r[2] for r in got) > 5000


def test_hot_leads_go_string_by_string(docs_of, monkeypatch):
    monkeypatch.setattr(suffixes, "_BUCKET_BYTES", 3000)
    monkeypatch.setattr(blocks, "GROUP_BYTES", 4000)
    rng = random.Random(3)
    passage = "a passage that many documents share, with a common line in it, over and over, said " * 2
    texts = ["".join(rng.choices("abcdefgh ", k=90)) + passage + "".join(rng.choices("xyz ", k=90)) for _ in range(120)]
    docs = docs_of(texts)
    plan = suffixes.planned(docs, blocks.text_bytes(docs, "text"), "text")
    assert len(plan.hot) and len(plan.splitters)
    assert found(docs) == expected(list(enumerate(texts)))


def test_multikey_sort_finds_exactly_the_ties():
    rng = random.Random(4)
    strings = [bytes(rng.choices(b"ab", k=20)) if rng.random() < 0.5 else b"a" * 19 + rng.choice([b"a", b"b"]) for _ in range(500)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    which, group = suffixes.tie_groups(data, np.arange(500) * 20, 20)
    seen = [strings[i] for i in which.tolist()]
    assert seen == sorted(seen)
    assert sorted(which.tolist()) == [i for i, s in enumerate(strings) if strings.count(s) > 1]
    assert len(set(zip(seen, group.tolist()))) == len(set(seen)) == len(set(group.tolist()))


def test_a_long_text_is_cut_into_segments(monkeypatch):
    monkeypatch.setattr(suffixes, "_SEGMENT_BITS", 8)
    data = np.frombuffer(random.Random(5).randbytes(3000), np.uint8)
    cut = suffixes._runs(data, np.array([0, 1000, 3000]))
    places = np.concatenate([np.repeat(cut[2], cut[1])])
    monkeypatch.setattr(suffixes, "_SEGMENT_BITS", 20)
    whole = suffixes._runs(data, np.array([0, 1000, 3000]))
    assert places.tolist() == np.repeat(whole[2], whole[1]).tolist()


def test_nulls_repeated_rows_and_extra_columns(docs_of, mixed_texts):
    long = mixed_texts[-1][:700]
    texts, ids = [long, long, long, None, "", long + " x"], [4, 4, None, 1, None, 2]
    docs = docs_of(texts, ids).selectExpr("*", "1 AS g", "2 AS row", "3 AS kept", "4 AS id")
    assert found(docs) == expected(list(zip(ids, texts)))


def test_empty_table(docs_of):
    assert found(docs_of([])) == []
