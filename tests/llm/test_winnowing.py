from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import winnowing
from tidemark.llm.winnowing import GRAM, WINDOW, Prints, likeness


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def grams(text: str, gram: int) -> list[int]:
    """The operator's own hash of each gram, taken one text at a time."""
    return [int(Prints.of([text[i : i + gram]], gram, 1).hashes[0]) for i in range(len(text) - gram + 1)]


def plain(text: str, gram: int, window: int) -> list[tuple[int, int]]:
    hashes = grams(text, gram)
    chosen = set()
    for i in range(max(1, len(hashes) - window + 1)) if hashes else ():
        part = hashes[i : i + window]
        chosen.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(hashes[i], i) for i in sorted(chosen)]


@pytest.mark.parametrize("gram,window", [(5, 4), (GRAM, WINDOW)])
def test_equal_to_plain_winnowing(mixed_texts, gram, window):
    texts = [t for t in mixed_texts if t is not None and len(t) < 1500]
    prints = Prints.of(texts, gram, window)
    for i, text in enumerate(texts):
        got = list(zip(prints.hashes[prints.at[i] : prints.at[i + 1]].tolist(), prints.places[prints.at[i] : prints.at[i + 1]].tolist()))
        if len(text) >= gram:
            assert got == plain(text, gram, window), text
        else:
            assert len(got) == (len(text) > 0)


def test_shared_passages_are_found_and_chance_is_not():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    for _ in range(200):
        passage = word(GRAM + WINDOW - 1)
        a, b = (Prints.of([word(rng.randrange(200)) + passage + word(rng.randrange(200))]) for _ in range(2))
        assert set(a.hashes.tolist()) & set(b.hashes.tolist())
    assert likeness(Prints.of([word(3000)]), Prints.of([word(3000)]))[0] < 0.01


def test_query_rows_equal_brute_force(docs_of, mixed_texts, monkeypatch):
    monkeypatch.setattr(winnowing, "_RANGE_BYTES", 2000)
    ids = [3 * i - 20 for i in range(len(mixed_texts))]
    random.Random(1).shuffle(ids)
    got = {r.doc_id: r for r in winnowing.compared_with_edits(docs_of(mixed_texts, ids)).collect()}
    order = sorted(zip(ids, mixed_texts), reverse=True)
    assert len(got) == len(order)
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        change, row = edited(text, following), got[doc_id]
        mine, other, next_one = (Prints.of([t]) for t in (text, change, following))
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(change.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (mine.strings()[0], other.strings()[0])
        assert row.near_edited == likeness(mine, other)[0]
        assert row.near_next == likeness(mine, next_one)[0]


def test_edits_are_nearer_than_the_next(docs_of, mixed_texts):
    texts = [t for t in mixed_texts[:25] if len(t) > 200]
    rows = winnowing.compared_with_edits(docs_of(texts)).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.3 > 0.1 > np.mean([r.near_next for r in rows])


@pytest.mark.parametrize("texts,ids", [(["only one text"], [4]), (["x", None, "x", "x", ""], [None, 1, 1, 1, None])])
def test_one_row_nulls_and_repeated_rows(docs_of, texts, ids):
    docs = docs_of(texts, ids).selectExpr("*", "1 AS tie", "2 AS home", "3 AS at", "4 AS extra")
    rows = winnowing.compared_with_edits(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_chars) for r in rows) == sorted(
        (i is None, i, len(t or "")) for i, t in zip(ids, texts)
    )
    assert [r.near_next for r in rows if len(texts) == 1] == [1.0] * (len(texts) == 1)


def test_operator_column_and_empty(docs_of):
    docs = docs_of(["abc" * 50, "", None]).selectExpr("*", "1 AS fingerprint")
    rows = {r.doc_id: r.fingerprint for r in winnowing.fingerprinted(docs).collect()}
    assert rows[1] == rows[2] == [] and [p.place for p in rows[0]] == sorted(p.place for p in rows[0])
    assert winnowing.compared_with_edits(docs_of([])).count() == 0
