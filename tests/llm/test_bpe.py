from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.lexicon import Lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tricky(mixed_texts):
    rng = random.Random(11)
    letters = "aàÀeéÉß ñ'sSİıΣσςﬁ①Ⅳ²3٣日́̈  ​🙂👍🏽\t\n-_!?<|>&\u0085\x1c\x00ǅ"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>'s", "<|EndOfText|>", "<|endoftext|"]
    texts += ["It's we'll I'd they've 'tis 'S x'RE", "x" * 500, "ab" * 400, "!" * 700, "9" * 50, "é" * 301]
    return texts + mixed_texts


@pytest.mark.parametrize("known", [0, 30, 200_000])
def test_equal_to_the_library(docs_of, tricky, known):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in bpe.digests(docs_of(tricky), PATH, known).collect()}
    assert len(got) == len(tricky)
    for i, text in enumerate(tricky):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256) == want, repr(text)
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest(), repr(text)


def test_both_ways_of_merging_agree():
    codec, rng = bpe.Codec(PATH), random.Random(3)
    runs = list({"".join(rng.choices("abetinsoth", k=rng.randint(1, 150))).encode() for _ in range(300)})
    table = codec.merge(runs)
    assert all(table[r].tolist() == codec.merge_long(r).tolist() for r in runs)


def test_lexicon_holds_exactly_its_words(tmp_path):
    rng = random.Random(4)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 8))).encode() for _ in range(400)} | {b""}
    entries = {w: [len(w), *w] for w in words}
    Lexicon.build(entries).save(str(tmp_path / "l"))
    lexicon = Lexicon.open(str(tmp_path / "l"))
    # Suffixes are shared: far fewer states than letters.
    assert len(lexicon.final) < sum(map(len, words)) / 4
    asked = [*words, *("".join(rng.choices("abcd", k=rng.randint(1, 9))).encode() for _ in range(300))]
    sizes = np.array([len(w) for w in asked])
    numbers = lexicon.numbers(np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(asked), np.uint8))
    for word, number in zip(asked, numbers.tolist(), strict=True):
        assert (number >= 0) == (word in entries)
        if number >= 0:
            assert lexicon.ids[lexicon.at[number] : lexicon.at[number + 1]].tolist() == entries[word]


def test_empty_lexicon_extra_columns_and_empty(docs_of):
    docs = docs_of(["a b", None, "", "a b"], [1, None, 1, 1]).selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS word")
    out = bpe.decoded(bpe.encoded(docs, PATH, words=0), PATH)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(r.decoded for r in out.collect()) == ["", "", "a</w> b</w>", "a</w> b</w>"]
    assert bpe.digests(docs_of([]), PATH).count() == 0
