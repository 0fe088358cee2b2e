from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_words import words
from test_bpe import PATH
from test_mixing import brute as mix
from test_quality_rules import expected as judged
from test_simhash import components, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline


def without_repeats(rows):
    least = {}
    for doc_id, text, _ in rows:
        ws = words(text)
        for i in range(len(ws) - 12):
            w = tuple(ws[i : i + 13])
            least[w] = min(least.get(w, doc_id), doc_id)
    out = []
    for doc_id, text, source in rows:
        ws = words(text)
        gone = [False] * len(ws)
        for i in range(len(ws) - 12):
            if least[tuple(ws[i : i + 13])] < doc_id:
                gone[i : i + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((doc_id, kept if any(gone) else text, source))
    return out


@pytest.fixture(scope="module")
def corpus(mixed_texts):
    rng = random.Random(21)
    texts = list(mixed_texts)
    long = [t for t in texts if t and len(words(t)) > 60]
    for _ in range(40):
        a, b = words(rng.choice(long)), words(rng.choice(long))
        texts.append(" ".join(a[: rng.randint(20, 80)] + b[rng.randint(0, 40) :]))
    return [(i, t, f"s{i % 4}" if i % 9 else None) for i, t in enumerate(texts)]


def test_stages_equal_brute_force(spark, corpus, tmp_path):
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in corpus]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want, results = corpus, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars in (None, len(r.text)) for r in docs.collect())
        results.append(docs)

    def rows_of(frame):
        return sorted(((r.doc_id, r.text, r.source) for r in frame.collect()), key=str)

    want = [r for r in want if judged(r[1])["kept"]]
    assert rows_of(results[0]) == sorted(want, key=str) and 20 < len(want) < len(corpus)
    label = components({i: fingerprint(t) for i, t, _ in want})
    want = [r for r in want if label[r[0]] == r[0]]
    assert rows_of(results[1]) == sorted(want, key=str)
    want = without_repeats(want)
    assert rows_of(results[2]) == sorted(want, key=str)
    taken = mix(want)
    expected = []
    for i, text, source in want:
        size, left = taken[i][0], taken[i][3]
        while left > 0:
            expected.append((i, text if left >= size else " ".join(words(text)[:left]), source))
            left -= size
    assert rows_of(results[3]) == sorted(expected, key=str)
    library = Tokenizer.from_file(PATH)
    digests = Counter()
    for i, text, _ in expected:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        digests[(i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert Counter(map(tuple, results[4].collect())) == digests
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == digests


def test_no_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
