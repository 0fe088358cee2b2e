from __future__ import annotations

from collections import Counter

import pytest
from llm_words import words

from tidemark.llm.quality import RepetitionRules, keep_good, repetition

RULES = RepetitionRules()


def inside(ws: list[str], n: int) -> list[bool]:
    grams = [tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    count = Counter(grams)
    out = [False] * len(ws)
    for i, g in enumerate(grams):
        if count[g] > 1:
            out[i : i + n] = [True] * n
    return out


def expected(text):
    ws, text = words(text), text or ""
    chars = sum(map(len, ws))
    lines, dups, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if not words(line):
            continue
        if line in lines:
            dups, dup_chars = dups + 1, dup_chars + len(line)
        lines.add(line)
    repeat = sum(inside(ws, 3))
    out = {
        "n_words": len(ws),
        "word_chars": chars,
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dups,
        "n_repeat_words": repeat,
        "line_share": dup_chars / max(1, len(text)),
    }
    for n, _ in RULES.ngram_shares:
        out[f"share_{n}"] = sum(len(w) for w, i in zip(ws, inside(ws, n)) if i) / max(1, chars)
    out["base_failed"] = len(ws) < 50 or 100 * repeat > 50 * len(ws)
    out["kept"] = (
        not out["base_failed"]
        and out["line_share"] <= RULES.line_share
        and all(out[f"share_{n}"] <= most for n, most in RULES.ngram_shares)
    )
    return out


def test_measures_equal_the_plain_ones(docs_of, mixed_texts):
    rows = repetition(docs_of(mixed_texts)).collect()
    assert len(rows) == len(mixed_texts)
    for row in rows:
        want, got = expected(mixed_texts[row.doc_id]), row.quality.asDict()
        assert got == pytest.approx(want), row.doc_id
    assert {True, False} == {r.quality.kept for r in rows}


def test_a_clashing_column_is_replaced_and_others_stay(docs_of, mixed_texts):
    docs = docs_of(mixed_texts[:5]).selectExpr("*", "1 AS Quality", "2 AS kept", "3 AS _quality")
    out = repetition(docs)
    assert sorted(out.columns) == sorted([*docs.drop("quality").columns, "quality"])
    assert keep_good(docs).columns == docs.columns


def test_empty_table(docs_of):
    assert repetition(docs_of([])).count() == 0
    assert keep_good(docs_of([])).count() == 0
