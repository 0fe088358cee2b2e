from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import infill


def expected(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, texts):
    found = infill.transformed(docs).withColumn("back", infill.restored(F.col("fim.output"), F.col("fim.form")))
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row.fim) == expected(row.doc_id, row.text)
        assert row.back == (row.text or "")
    return rows


def test_equals_the_plain_reading(docs_of, mixed_texts):
    rng = random.Random(4)
    parts = ["a", "Zz", "@", "[", "`", "{", "é", "日", "🙂", "\n", "\0", "<P", ">", "<", "<S>", "<M>", " "]
    texts = mixed_texts + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(300)]
    rows = check(docs_of(texts), texts)
    assert {r.fim.form for r in rows} == {"plain", "psm", "spm"}


def test_texts_that_end_in_letters_do_not_run_on(docs_of):
    texts = [w * k for w in ("a", "ab ", "é", "aé") for k in (1, 7, 8, 9, 15, 16, 17)]
    check(docs_of(texts, parts=1), texts)


def test_long_texts_are_cut_whole(docs_of):
    texts = ["word " * 1_200_000, "日" * 900_000, "x" * 2_000_000]
    check(docs_of(texts, parts=1), texts)


def test_null_ids_repeated_rows_and_clashing_columns(docs_of):
    texts = ["one two three", "one two three", None, "", "lone", "lone"]
    docs = docs_of(texts, [None, None, 3, 4, 7, 7]).selectExpr("*", "1 AS FIM", "2 AS output", "3 AS n")
    found = infill.transformed(docs)
    assert sorted(found.columns) == sorted([*docs.drop("FIM").columns, "fim"])
    for row in found.collect():
        assert tuple(row.fim) == expected(row.doc_id, row.text)


def test_empty_table(docs_of):
    assert infill.transformed(docs_of([])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_marks_count_and_select(seed):
    rng = np.random.default_rng(seed)
    raw = rng.choice(np.frombuffer("aZ é日🙂.".encode(), np.uint8), 1000)
    at = np.array([0, 0, 13, 400, 400, 1000])
    ends, _ = infill.unit_marks(raw, at)
    flat = np.flatnonzero(ends.marks.view(np.uint8)[:1000])
    assert ends.place(np.arange(1, len(flat) + 1)).tolist() == flat.tolist()
    places = np.arange(1001)
    assert ends.ahead(places).tolist() == np.searchsorted(flat, places).tolist()
