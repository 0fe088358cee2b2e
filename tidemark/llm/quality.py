"""Quality rules: how much of a text lies inside repeated n-grams and repeated lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Rolling, covered, give_back, pieces, sums_between, texts, words_of
from tidemark.llm.common import bounded_batches, replaced

_SYMBOLS = b"#*$%&|<>"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SHARES = ("line_share",)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits. A text beyond any of them is rejected.

    ``ngram_shares`` gives for an n-gram length the largest share of word characters that may lie
    in n-grams found twice or more in the text; ``line_share`` the largest share of characters in
    lines that repeat an earlier one.
    """

    least_words: int = 50
    repeat_percent: int = 50
    ngram_shares: tuple[tuple[int, float], ...] = ((2, 0.8), (4, 0.5), (6, 0.4), (8, 0.35), (10, 0.3))
    line_share: float = 0.3


def _doubled(rolling: Rolling, n: int, text_of: np.ndarray) -> np.ndarray:
    """Which words lie in a run of n words that its text has at least twice."""
    many = len(text_of)
    starts = np.flatnonzero(text_of[: max(0, many - n + 1)] == text_of[n - 1 :])
    with np.errstate(over="ignore"):
        keys = rolling.of(n)[starts] + text_of[starts].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(ranked), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return covered(starts[order[twice]], n, many)


def _line_counts(text: str) -> tuple[int, int]:
    """Lines with a word that repeat an earlier line, and their characters."""
    lines = text.split("\n")
    if len(lines) == len(set(lines)):
        return 0, 0
    seen: set[str] = set()
    count = chars = 0
    for line in lines:
        if line in seen:
            count, chars = count + 1, chars + len(line)
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    return count, chars


def _measure(column: pa.Array, rules: RepetitionRules) -> dict[str, np.ndarray]:
    words = words_of(column)
    lengths = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
    text_of, at = words.text_of, words.at
    rolling = Rolling(words.hashes()[words.codes])
    strings = column.to_pylist()
    lines = np.array([_line_counts(s) for s in strings], np.int64).reshape(-1, 2)
    raw = [s.encode() for s in strings]
    out = {
        "n_words": np.diff(at),
        "word_chars": sums_between(lengths, at),
        "n_symbols": np.array([len(b) - len(b.translate(None, _SYMBOLS)) for b in raw], np.int64),
        "n_dup_lines": lines[:, 0],
        "n_repeat_words": sums_between(_doubled(rolling, 3, text_of), at),
        "line_share": lines[:, 1] / np.maximum(1, [len(s) for s in strings]),
    }
    for n, _ in rules.ngram_shares:
        inside = sums_between(lengths * _doubled(rolling, n, text_of), at)
        out[f"share_{n}"] = inside / np.maximum(1, out["word_chars"])
    failed = (out["n_words"] < rules.least_words) | (
        100 * out["n_repeat_words"] > rules.repeat_percent * out["n_words"]
    )
    fine = ~failed & (out["line_share"] <= rules.line_share)
    for n, most in rules.ngram_shares:
        fine &= out[f"share_{n}"] <= most
    return out | {"base_failed": failed, "kept": fine}


def result_type(rules: RepetitionRules) -> str:
    shares = [*_SHARES, *[f"share_{n}" for n, _ in rules.ngram_shares]]
    fields = [f"{c} long" for c in _COUNTS] + [f"{s} double" for s in shares]
    return f"struct<{','.join([*fields, 'base_failed boolean', 'kept boolean'])}>"


def repetition(
    docs: DataFrame, text: str = "text", into: str = "quality", rules: RepetitionRules = RepetitionRules()
) -> DataFrame:
    """``docs`` with a struct column ``into`` of counts, shares and the verdict ``kept``.

    Each row is judged on its own whole text, so nothing is shuffled, and a row, a repeated row or a
    hot source costs what its text is long. A null text is an empty one: no words, not kept. An
    input column called ``into`` is replaced, all others are passed through. Texts are measured a few
    megabytes at a time; a longer text is measured alone.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(result_type(rules))
    def measured(column: pa.Array) -> pa.Array:
        parts = [_measure(part, rules) for _, part in pieces(column, 3_000_000)]
        give_back()
        parts = parts or [_measure(texts(column), rules)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[name] for p in parts])) for name in parts[0]], list(parts[0])
        )

    return replaced(docs, into, measured(F.col(f"`{text}`")))


def keep_good(docs: DataFrame, text: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``docs`` whose text passes, with their columns."""
    names = docs.columns
    verdict = "_quality"
    while verdict in names:
        verdict += "_"
    judged = repetition(docs, text, verdict, rules)
    return judged.filter(F.col(f"{verdict}.kept")).select(*[F.col(f"`{n}`") for n in names])
