from __future__ import annotations

import random

import pytest

@pytest.fixture
def docs_of(spark):
    """Documents from texts; ids are positions unless given."""

    def build(texts, ids=None, sources=None, parts=3):
        ids = range(len(texts)) if ids is None else ids
        sources = ["a"] * len(texts) if sources is None else sources
        rows = [
            (i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)
        ]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return build


@pytest.fixture(scope="session")
def mixed_texts():
    """Copies, near copies, shared passages, odd spaces, long and empty texts, from a fixed seed."""
    rng = random.Random(7)
    vocabulary = ["the", "of", "Äpfel", "naïve", "x", "don't", "日本語", "🙂", "end.", "<|a|>", "A", "b,"]
    vocabulary += ["".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(150)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = make(60)
    texts = [make(rng.randint(1, 120)) for _ in range(25)]
    texts += [texts[3], texts[3], texts[5] + " tail", "head " + texts[5]]
    texts += [make(10) + " " + passage + " " + make(9), passage, make(30) + "\n" + passage, passage + passage]
    texts += ["", None, " \t\n\v\f\r ", "one", "a b", "  lead and trail \n", "a " * 40, "x" * 300, "ab" * 200]
    texts += ["line one\nline one\nline one\n" * 20, make(3000)]
    return texts
