from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_words import words

from tidemark.llm import pitman_yor
from tidemark.llm.arrays import numbers, unpack
from tidemark.llm.pitman_yor import Contexts
from tidemark.llm.seating import Seating


def tokens(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words(text)] + [None]


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def base(rows):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        ts = tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        out.append((i, held_out(i), len(ts), sum(counts[t] > 0 for t in ts), n, round(score, 6)))
    return sorted(out, key=str)


def plain(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


@pytest.fixture(scope="module")
def chained():
    """Texts in which the next word depends on the last one."""
    rng = random.Random(12)
    names = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(300)]
    follow = {w: rng.choices(names, k=4) for w in set(names)}
    texts = []
    for _ in range(240):
        w = rng.choice(names[:20])
        out = [w]
        for _ in range(rng.randint(0, 150)):
            w = rng.choice(follow[w]) if rng.random() < 0.9 else rng.choice(names)
            out.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(" ".join(out))
    return texts + ["", None, "new words only here", " \n "]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(pitman_yor, "_WORD_BYTES", 20_000)
    monkeypatch.setattr(pitman_yor, "_CONTEXT_BYTES", 15_000)


def test_counts_and_base_are_exact_and_held_out_texts_gain(docs_of, chained, small):
    rows = pitman_yor.scored(docs_of(chained), least=8).collect()
    assert plain(rows) == base(list(enumerate(chained)))
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    own, flat = (sum(getattr(r, c) for r in rows if r.held_out) for c in ("score", "base_score"))
    n = sum(r.n_tokens for r in rows if r.held_out)
    # In a chain of four likely followers, far fewer words are worth considering than single counts say.
    assert 10 ** (-own / n) < 0.4 * 10 ** (-flat / n)
    again = pitman_yor.scored(docs_of(chained), least=8).collect()
    assert {r.doc_id: r.base_score for r in again} == {r.doc_id: r.base_score for r in rows}


def test_every_restaurant_gives_a_distribution(docs_of, chained, small, monkeypatch):
    model = pitman_yor.trained(docs_of(chained), least=8)
    seen, customers, tables, weights = Counter(), {}, Counter(), {}
    for row in model.tables.read(f"contexts-{pitman_yor.ROUNDS}", "state").collect():
        state = Contexts.of(row.block)
        moving = np.bincount(state.owners, minlength=len(state.n))
        for i, u in enumerate(state.u.tolist()):
            mine = state.owner == i
            seen[u] += int(state.n[mine].sum() + state.singles[i])
            tables[u] += float(moving[mine].sum() + state.singles[i])
            customers[u], weights[u] = int(state.customers[i]), float(state.weights[-1][i])
        assert (state.n > 1).all() and (moving >= 1).all() and (moving <= state.n).all()
        assert np.bincount(state.owners, state.sizes).astype(int).tolist() == state.n.tolist()
    assert len(seen) > 50 and dict(seen) == customers
    for u, c in customers.items():
        share = (c - model.discount * tables[u]) / (1 + c)
        assert share + weights[u] == pytest.approx(1)
    level = model.levels[pitman_yor.ROUNDS]
    own = [[numbers(x) for x in unpack(r.block, None, None)] for r in model.tables.read(f"parent-{pitman_yor.ROUNDS}", "own").collect()]
    known = np.concatenate([customers - level.parent_discount * tables for customers, tables in own])
    assert len(known) == model.train_words
    assert level.probability(known).sum() + level.probability(np.zeros(1))[0] == pytest.approx(1)
    # The parent's customers are the contexts' tables and the words behind rarer contexts.
    direct = sum(numbers(unpack(r.block, None, None)[1]).sum() for r in model.tables.read("pairs", "direct").collect())
    assert level.customers == sum(tables.values()) + direct


def test_gibbs_has_the_exact_distribution_of_tables():
    # Three customers of one dish: weights of 1, 2 and 3 tables from the seating rule.
    d, a = 0.5, 0.7
    strength = lambda t: a + 0.2 * t
    one = (1 - d) * (2 - d)
    two = 3 * (1 - d) * strength(1)
    three = strength(1) * strength(2)
    want = np.array([one, two, three]) / (one + two + three)
    rng = np.random.default_rng(1)
    seating = Seating(np.full(20_000, 3), d, strength, rng)
    seating.sweep(30)
    got = np.bincount(seating.tables, minlength=4)[1:] / 20_000
    assert np.abs(got - want).max() < 0.02


@pytest.mark.parametrize("customers", [40, 1000, 3000])
def test_tables_of_many_customers_as_by_seating_one_by_one(customers):
    # All ways to seat the customers one by one, by their numbers of tables.
    d, a, b = 0.8, 60.0, 0.05
    most = min(customers, 800)
    t = np.arange(most + 1)
    ways = np.where(t == 1, 0.0, -np.inf)
    for n in range(1, customers):
        stays = ways + np.log(np.maximum(n - d * t, 1e-300))
        opens = ways + np.log(a + b * t)
        ways = np.logaddexp(stays, np.append(-np.inf, opens[:-1]))
    want = np.exp(ways - ways.max())
    want /= want.sum()
    mean = (want * t).sum()
    deviation = math.sqrt((want * (t - mean) ** 2).sum())
    seating = Seating(np.full(4000, customers), d, lambda t: a + b * t, np.random.default_rng(3))
    seating.sweep(2)
    assert abs(seating.tables.mean() - mean) < 0.08 * deviation
    assert abs(seating.tables.std() / deviation - 1) < 0.06
    got = np.bincount(seating.tables, minlength=most + 1)[: most + 1] / 4000
    assert np.abs(np.cumsum(got) - np.cumsum(want)).max() < 0.035


def test_dishes_of_one_restaurant_have_the_tables_that_moving_one_by_one_leads_to():
    # Two dishes share a restaurant: numbers of tables weigh by those of both.
    d, p, n = 0.7, np.array([0.3, 0.1]), (6, 3)

    def ways(n):
        out = {1: 1.0}
        for m in range(1, n):
            out = {t: out.get(t, 0) * (m - d * t) + out.get(t - 1, 0) for t in range(1, m + 2)}
        return out

    want = np.zeros((7, 4))
    for s, x in ways(6).items():
        for t, y in ways(3).items():
            want[s, t] = x * y * p[0] ** s * p[1] ** t * math.prod(1 + d * i for i in range(s + t))
    want /= want.sum()
    many = 20_000
    owner, probability = np.repeat(np.arange(many), 2), np.tile(p, many)
    strength = lambda t: (1 + d * np.bincount(owner, t)[owner]) * probability
    seating = Seating(np.tile(n, many), d, strength, np.random.default_rng(4), step=d * probability)
    seating.sweep(12)
    got = np.zeros((7, 4))
    np.add.at(got, tuple(seating.tables.reshape(-1, 2).T), 1 / many)
    # Dishes that move at once do not see each other's move: a quarter of the pairs, each time.
    assert np.abs(got - want).max() < 0.02


def test_seating_keeps_all_customers():
    rng = np.random.default_rng(2)
    customers = np.concatenate([rng.integers(0, 5, 200), rng.integers(5, 5000, 50)])
    seating = Seating(customers, 0.8, lambda t: 0.5 * (1 + t), rng)
    for _ in range(4):
        seating.sweep(10)
        assert np.bincount(seating.owner, seating.sizes, minlength=250).astype(int).tolist() == customers.tolist()
        assert np.bincount(seating.owner, minlength=250).tolist() == seating.tables.tolist()
        assert (seating.sizes > 0).all() and (np.diff(seating.owner) >= 0).all()


def test_nulls_repeated_rows_extra_columns_and_no_training(docs_of):
    rows = [(None, "a b a b"), (1, "A b"), (1, "A b"), (2, None), (3, "")]
    docs = docs_of([t for _, t in rows], [i for i, _ in rows]).selectExpr("*", "1 AS kind", "2 AS id", "3 AS block")
    got = pitman_yor.scored(docs).collect()
    assert plain(got) == base(rows)
    held = next(i for i in range(100) if held_out(i))
    alone = pitman_yor.scored(docs_of(["x y"], [held])).collect()
    assert plain(alone) == base([(held, "x y")])
    assert alone[0].score == pytest.approx(0)
    assert pitman_yor.scored(docs_of([])).count() == 0


def test_by_default_every_training_word_has_a_restaurant_and_helps(docs_of, chained, small):
    model = pitman_yor.trained(docs_of(chained))
    blocks = model.tables.read(f"contexts-{pitman_yor.ROUNDS}", "state").collect()
    contexts = np.concatenate([c.u[c.customers > 0] for c in (Contexts.of(r.block) for r in blocks)])
    # All training words but the end, and the start.
    assert len(contexts) == len(set(contexts.tolist())) == model.train_words
    assert model.tables.read("pairs", "direct").count() == 0
    rows = pitman_yor.scores(model).collect()
    own, flat = (sum(getattr(r, c) for r in rows if r.held_out) for c in ("score", "base_score"))
    n = sum(r.n_tokens for r in rows if r.held_out)
    assert 10 ** (-own / n) < 0.4 * 10 ** (-flat / n)


def test_scores_equal_those_of_a_plain_model_with_the_same_tables(docs_of, chained, small):
    """Every token by itself: its pair and its context looked up in dictionaries, word numbers by their rule."""
    texts = [*chained, "words nobody trained on", "", chained[0] + " unheard"]
    model = pitman_yor.trained(docs_of(texts))
    samples, buckets = pitman_yor.ROUNDS - pitman_yor.BURN_IN, model.sizes.words
    counts = Counter()
    for i, text in enumerate(texts):
        for w in tokens(text):
            counts[w] += not held_out(i)
    digest = {w: 1 if w is None else xxhash.xxh64_intdigest(w.encode()) for w in counts}
    number = {}
    for b in range(buckets):
        mine = sorted((w for w in counts if digest[w] % buckets == b), key=lambda w: (-counts[w], digest[w]))
        number |= {w: place * buckets + b for place, w in enumerate(mine) if counts[w]}
    pair, context = {}, {}
    last = f"contexts-{pitman_yor.ROUNDS}"
    once = {r.key: r.block for r in model.tables.read("contexts-0", "once").collect()}
    for row in model.tables.read(last, "state").collect():
        state = Contexts.of(row.block)
        for i, u in enumerate(state.u.tolist()):
            context[u] = (int(state.customers[i]), [float(x[i]) for x in state.weights])
        for owner, w, n, tables in zip(state.owner, state.w, state.n, state.table_sum):
            pair[int(state.u[owner]), int(w)] = (int(n), int(tables) / samples)
        for owner, w in zip(*map(numbers, unpack(once[row.key], None, None))):
            pair[int(state.u[owner]), int(w)] = (1, 1.0)
    backed = []
    for turn, level in model.levels.items():
        own = {}
        for row in model.tables.read(f"parent-{turn}", "own").collect():
            for place, (n, tables) in enumerate(zip(*map(numbers, unpack(row.block, None, None)))):
                own[place * buckets + row.key] = int(n) - pitman_yor.PARENT_DISCOUNT * int(tables)
        tables, customers = model.tables.sums(f"parent-{turn}")
        base = (1 + pitman_yor.PARENT_DISCOUNT * tables) / (len(number) + 1)
        backed.append(lambda w, own=own, base=base, customers=customers: (own.get(w, 0.0) + base) / (1 + customers))
    want = {}
    for i, text in enumerate(texts):
        total, u = 0.0, -2
        for w in [number.get(x) for x in tokens(text)]:
            customers, weights = context.get(u, (0, [1.0] * samples))
            n, tables = pair.get((u, w), (0, 0.0))
            share = (n - model.discount * tables) / (1 + customers)
            total += math.log10(share + sum(x * p(w) for x, p in zip(weights, backed)) / samples)
            u = w
        want[i] = total
    got = {r.doc_id: r.score for r in pitman_yor.scores(model).collect()}
    assert got == pytest.approx(want, rel=1e-5)
    assert len(pair) > 500 and any(n > 1 for n, _ in pair.values())
