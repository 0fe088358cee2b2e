from __future__ import annotations

import random

import numpy as np
import pytest
from llm_words import words

from tidemark.llm import minhash
from tidemark.llm.minhash import Banding


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, size) -> frozenset:
    ws = [lowered(w) for w in words(text)]
    return frozenset(tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))) if ws else frozenset()


def brute(rows, size=4, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    order = lambda i: (i is None, i)
    label = list(range(len(rows)))
    linked = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    least = {k: min((rows[i][0] for i in range(len(rows)) if label[i] == k), key=order) for k in set(label)}
    out = [(i, len(s), least[k]) for (i, _), s, k in zip(rows, sets, label)]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def check(docs_of, rows, banding=Banding(size=4)):
    docs = docs_of([t for _, t in rows], [i for i, _ in rows])
    docs = docs.selectExpr("*", "1 AS n", "2 AS row", "3 AS node", "4 AS t", "5 AS kept", "6 AS component_id")
    got = minhash.near_duplicates(docs, banding=banding).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, banding.size, banding.percent)


def near_copies(seed, count, length, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(count):
        changed = list(base)
        for _ in range(rng.randint(1, edits)):
            changed[rng.randrange(length)] = f"x{rng.randrange(1000)}"
        out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("block", [150, 65_536])
def test_equals_brute_force(docs_of, mixed_texts, monkeypatch, block):
    monkeypatch.setattr(minhash, "_BLOCK", block)
    monkeypatch.setattr(minhash, "_LOT", 4 * block)
    texts = mixed_texts + near_copies(1, 40, 120, 6) + near_copies(2, 20, 40, 2) + [t.upper() for t in mixed_texts[3:6]]
    # Texts that share half of a passage with many others share bands, and are no links.
    rng = random.Random(5)
    passage = near_copies(3, 0, 60, 0)[0]
    texts += [passage + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randint(10, 60))) for _ in range(40)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    check(docs_of, [(i, texts[i]) for i in order])


def test_chains_that_no_hub_reaches(docs_of):
    # Each text shares enough with the next one only, and the ends share little.
    base = [f"w{i}" for i in range(300)]
    check(docs_of, [(i, " ".join(base[4 * i : 4 * i + 80])) for i in range(40)])


def test_null_and_repeated_ids_and_rows(docs_of):
    text = " ".join(map(str, range(50)))
    rows = [(None, text), (7, text), (7, text), (3, "other text here"), (9, None), (8, ""), (None, None), (None, "lone")]
    rows += [(5, text + " tail"), (5, "unrelated words of one id"), (None, "lone"), (1, "other text HERE")]
    check(docs_of, rows)


def test_a_third_of_all_rows_are_copies_without_an_id(docs_of):
    rows = [(None, "one two three four five six")] * 60 + [(i, f"text number {i} is of its own") for i in range(120)]
    check(docs_of, rows)


def test_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0


def test_long_texts_are_whole(docs_of):
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    check(docs_of, [(1, base), (2, base + " tail of it"), (0, base[: len(base) // 2])])


def test_coordinates_are_minima_under_turned_permutations():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**64, n, np.uint64)) for n in (1, 5, 40_000, 3)]
    got = minhash._signatures(sets, 16)
    for s, row in zip(sets, got):
        place = (s >> np.uint64(32)).astype(np.uint32)
        for k in range(16):
            turned = place + np.uint32(k)
            assert row[k] == minhash._ordered(turned, np.empty_like(turned)).min()


def test_agreement_estimates_likeness():
    rng = np.random.default_rng(2)
    for likeness in (0.3, 0.6, 0.8, 0.95):
        both = int(likeness * 2000)
        items = rng.integers(0, 2**64, 4000 - 2 * both + both, np.uint64)
        alone = (len(items) - both) // 2
        sets = [np.unique(items[: both + alone]), np.unique(np.concatenate([items[:both], items[both + alone :]]))]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        signs = minhash._signatures(sets, 1024)
        assert (signs[0] == signs[1]).mean() == pytest.approx(true, abs=0.06)
