"""BPE encoding and decoding with a lexicon of frequent words and exact merges of all others."""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.arrays import Places, give_back, pieces, slices, spread, sums_between, words_of
from tidemark.llm.common import bounded_batches, replaced
from tidemark.llm.lexicon import Lexicon

#: Frequent words that the lexicon holds; it is all that is collected or sent to executors.
LEXICON_WORDS = 100_000
#: Bytes of texts that a task looks at together.
_PIECE = 6 * 2**20
#: How often such a word has to occur in some megabytes of texts at least; this says which words are fast, not
#: what any word becomes.
_OFTEN = 3
#: Ids of several words in one array, and where each word's begin and how many they are.
Pool = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Longer runs of letters are merged one by one with a heap, as tables would grow with the square.
_TABLE_LENGTH = 200
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\v\f\ra-z0-9]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on in byte order."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(rest)) for b in range(256)]


class Codec:
    """A vocabulary file of byte-level BPE with word ends, white space as a border, and no byte prefix."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        # The place of a pair among the merges is its rank.
        self.keys, self.places = keys, Places.build(keys)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        names = dict.fromkeys(range(max([*vocab.values(), *self.special.values()]) + 1), "")
        names |= {i: t for t, i in (vocab | self.special).items()}
        strings = [names[i].encode() + b" " for i in sorted(names)]
        self.name_at = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        self.name_bytes = np.frombuffer(b"".join(strings), np.uint8)
        self._special_re = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def parts(self, word: str) -> list[bytes | int]:
        """A word's runs for the merges, as bytes, and the ids of special tokens in it."""
        if self._special_re and "<|" in word and (found := self._special_re.search(word)):
            rest = self.parts(word[found.end() :])
            return [*self.parts(word[: found.start()]), self.special[found[0]], *rest]
        if word.isascii():
            return [p.encode() for p in _ASCII_PARTS.findall(word.lower())]
        # Beyond ASCII, the vocabulary's own normal form and borders.
        plain = self.tokenizer.normalizer.normalize_str(word)
        runs = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(map(_LETTER_BYTES.__getitem__, run)) for run, _ in runs]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; a pair that never merges has the rank ``none``."""
        pairs = np.maximum(left, 0) << 32 | np.maximum(right, 0)
        found = self.places.of(pairs.ravel(), self.keys).reshape(pairs.shape)
        return np.where(found < 0, self.none, found), self.merged[found]

    def merge_table(self, runs: list[bytes]) -> list[np.ndarray]:
        """Ids of runs of similar length, each step merging in every run its lowest, then leftmost pair."""
        n, lengths = len(runs), np.array([len(r) for r in runs])
        width = int(lengths.max())
        table = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width)[None, :] < lengths[:, None]
        raw = np.frombuffer(b"".join(runs), np.uint8)
        table[:, :width][inside] = self.inner[raw]
        table[np.arange(n), lengths - 1] = self.last[raw[np.cumsum(lengths) - 1]]
        ranks, _ = self.look_up(table[:, :-1], table[:, 1:])
        ranks[table[:, 1:] < 0] = self.none
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        live = np.arange(n)
        while len(live):
            best = ranks.argmin(axis=1)
            rows = np.arange(len(live))
            done = ranks[rows, best] == self.none
            for i in np.flatnonzero(done).tolist():
                row = table[i]
                out[live[i]] = row[row >= 0]
            if done.any():
                live, table, ranks, best = live[~done], table[~done], ranks[~done], best[~done]
                rows = rows[: len(live)]
                if not len(live):
                    break
            _, joined = self.look_up(table[rows, best], table[rows, best + 1])
            column = np.arange(table.shape[1] - 1)[None, :]
            table[:, :-1] = np.where(column > best[:, None], table[:, 1:], table[:, :-1])
            table[:, -1] = -1
            table[rows, best] = joined
            shifted = np.concatenate([ranks[:, 1:], np.full((len(live), 1), self.none)], axis=1)
            ranks = np.where(column > best[:, None], shifted, ranks)
            for at in (best - 1, best):
                ok = at >= 0
                r, a = rows[ok], at[ok]
                right = table[r, a + 1]
                rank, _ = self.look_up(table[r, a], right)
                ranks[r, a] = np.where(right < 0, self.none, rank)
        return out

    def merge_long(self, run: bytes) -> np.ndarray:
        """Ids of one run, with a heap of its pairs by rank and place."""
        raw = np.frombuffer(run, np.uint8)
        ids = self.inner[raw].tolist()
        ids[-1] = int(self.last[raw[-1]])
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        table = self._pairs
        heap = [(*table[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in table]
        heapq.heapify(heap)
        while heap:
            _, result, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else len(ids)
            if j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = result, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m < len(ids) and (pair := (ids[k], ids[m])) in table:
                    heapq.heappush(heap, (*table[pair], k, *pair))
        return np.array([i for i in ids if i >= 0], np.int64)

    @property
    def _pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        if not hasattr(self, "_pair_dict"):
            rows = enumerate(zip(self.keys.tolist(), self.merged.tolist(), strict=True))
            self._pair_dict = {(k >> 32, k & 0xFFFFFFFF): (rank, m) for rank, (k, m) in rows}
        return self._pair_dict

    def merge(self, runs: list[bytes]) -> dict[bytes, np.ndarray]:
        """Ids of each distinct run."""
        out: dict[bytes, np.ndarray] = {}
        short = []
        for run in dict.fromkeys(runs):
            if len(run) > _TABLE_LENGTH:
                out[run] = self.merge_long(run)
            else:
                short.append(run)
        short.sort(key=len)
        start = 0
        while start < len(short):
            # Lengths in a table differ by a third at most, and it has a few hundred thousand cells.
            most = 4 + len(short[start]) * 4 // 3
            stop = min(len(short), start + max(1, 400_000 // most))
            while len(short[stop - 1]) > most:
                stop = start + max(1, (stop - start) // 2)
            part = short[start:stop]
            out.update(zip(part, self.merge_table(part), strict=True))
            start = stop
        return out

    def word_ids(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word by merges alone."""
        split = [self.parts(w) for w in words]
        merged = self.merge([p for parts in split for p in parts if isinstance(p, bytes)])
        one = lambda p: merged[p] if isinstance(p, bytes) else np.array([p], np.int64)
        return [
            one(parts[0]) if len(parts) == 1 else np.concatenate([np.zeros(0, np.int64), *map(one, parts)])
            for parts in split
        ]

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Words of ASCII and Latin-1 letters, split without the library: which, their runs, where each word's begin.

        Those letters are in normal form, change case one by one and count as letters; so a run is a
        maximal one of letters or of other signs, or one digit. Apostrophes and special tokens are
        left to the slow way.
        """
        data, at = _bytes_of(words)
        ahead = np.concatenate([[np.uint8(0)], data[:-1]]) if len(data) else data
        odd = (data >= 0xC0) & (data != 0xC3) | (data == ord("'")) | (ahead == ord("<")) & (data == ord("|"))
        odd |= (ahead == 0xC3) & ((data == 0x97) | (data == 0xB7))
        simple = np.flatnonzero(sums_between(odd, at) == 0)
        sizes = np.diff(at)[simple]
        place = spread(at[simple], sizes)
        data, ahead, begins = data[place], ahead[place], np.cumsum(sizes) - sizes
        data = data + 32 * ((data >= 65) & (data <= 90) | (ahead == 0xC3) & (data <= 0x9E)).astype(np.uint8)
        kind = ((data >= 97) & (data <= 122) | (data >= 0x80)).astype(np.int8) + 2 * ((data >= 48) & (data <= 57))
        opens = kind == 2
        opens[1:] |= kind[1:] != kind[:-1]
        opens[begins] = True
        edges = np.append(np.flatnonzero(opens), len(data))
        buffers = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)]
        runs = pa.Array.from_buffers(pa.binary(), len(edges) - 1, buffers)
        return simple, runs, np.searchsorted(edges, np.append(begins, len(data)))

    def _found(self, words: pa.Array, lexicon: Lexicon, rest: Callable[[pa.Array], Pool]) -> Pool:
        """Ids of distinct words: those of the lexicon, and of the others what ``rest`` makes of them."""
        data, at = _bytes_of(words)
        number = lexicon.numbers(at[:-1], np.diff(at), data)
        unseen = np.flatnonzero(number < 0)
        ids, starts, sizes = rest(words.take(pa.array(unseen)))
        all_starts, all_sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        seen = number >= 0
        all_starts[seen] = lexicon.at[number[seen]]
        all_sizes[seen] = lexicon.at[number[seen] + 1] - all_starts[seen]
        all_starts[unseen], all_sizes[unseen] = starts + len(lexicon.ids), sizes
        return np.concatenate([lexicon.ids, ids]), all_starts, all_sizes

    def _merged(self, runs: pa.Array) -> Pool:
        listed = runs.to_pylist()
        merged = self.merge(listed)
        return _pool([merged[r] for r in listed])

    def _split(self, words: pa.Array, lexicon: Lexicon) -> Pool:
        """Ids of words that are not in the lexicon; their runs may be."""
        simple, runs, at = self._plain(words)
        coded = runs.dictionary_encode()
        pool, starts, sizes = self._found(coded.dictionary, lexicon, self._merged)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        many = sizes[codes]
        ids = pool[spread(starts[codes], many)]
        other = np.setdiff1d(np.arange(len(words)), simple)
        slow, slow_starts, slow_sizes = _pool(self.word_ids(words.take(pa.array(other)).cast(pa.string()).to_pylist()))
        all_starts, all_sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        all_sizes[simple] = sums_between(many, at)
        all_starts[simple] = np.cumsum(all_sizes[simple]) - all_sizes[simple]
        all_starts[other], all_sizes[other] = slow_starts + len(ids), slow_sizes
        return np.concatenate([ids, slow]), all_starts, all_sizes

    def encode(self, column: pa.Array, lexicon: Lexicon) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All ids of the texts, one after another, and where each text's begin; some texts at a time."""
        words = words_of(column)
        distinct = words.distinct.cast(pa.binary())
        pool, starts, sizes = self._found(distinct, lexicon, lambda rest: self._split(rest, lexicon))
        pool = pool.astype("<u4")
        for first, last in slices(np.diff(words.at), 200_000):
            codes = words.codes[words.at[first] : words.at[last]]
            many = sizes[codes]
            at = np.concatenate([[0], np.cumsum(many)])[words.at[first : last + 1] - words.at[first]]
            yield pool[spread(starts[codes], many)], at

    def decode(self, ids: np.ndarray) -> bytes:
        """The names of the tokens, joined by a space: the vocabulary has no decoder of its own."""
        sizes = np.diff(self.name_at)[ids]
        return self.name_bytes[spread(self.name_at[ids], sizes)][:-1].tobytes()


def _pool(parts: list[np.ndarray]) -> Pool:
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.int64), *parts]), np.cumsum(sizes) - sizes, sizes


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buffers, n = words.buffers(), len(words)
    at = np.frombuffer(buffers[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


_LETTER_BYTES = {c: b for b, c in enumerate(_byte_letters())}


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def _lexicon(path: str) -> Lexicon:
    return Lexicon.open(path)


def _shipped(spark: SparkSession, path: str) -> str:
    """Hand a small file to all executors, also to those that join later; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def frequent_words(docs: DataFrame, text: str, most: int) -> list[str]:
    """The ``most`` words that occur most often, counted in every few megabytes that have them repeatedly.

    Ties go by the words. What they hold once or twice is not worth a place, and would be most of
    what is shuffled. So the ranking is approximate, and a word spread thinly over all pieces is not
    counted: it is merged in the tasks, to the same ids.
    """
    bounded_batches(docs.sparkSession, 4_000)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in pieces(batch.column(0), _PIECE):
                words = words_of(part)
                counts = np.bincount(words.codes, minlength=len(words.distinct))
                often = np.flatnonzero(counts >= _OFTEN)
                columns = [words.distinct.take(pa.array(often)), pa.array(counts[often], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n"])
                give_back()

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(counted, "word string, n long")
    totals = found.groupBy("word").agg(F.sum("n").alias("n"))
    top = totals.orderBy(F.desc("n"), "word").limit(most).select("word")
    return top.toArrow()["word"].to_pylist()


def compiled(spark: SparkSession, words: list[str], vocabulary: str) -> str:
    """Compile the words into a lexicon and hand it to the executors; its name there."""
    ids = _codec(vocabulary).word_ids(words)
    entries = {w.encode(): i.tolist() for w, i in zip(words, ids, strict=True)}
    handle, path = tempfile.mkstemp(prefix="lexicon-", suffix=".bin")
    os.close(handle)
    Lexicon.build(entries).save(path)
    del entries, ids
    give_back()
    return _shipped(spark, path)


def encoded(
    docs: DataFrame, vocabulary: str, text: str = "text", into: str = "ids", words: int = LEXICON_WORDS
) -> DataFrame:
    """``docs`` with the token ids of each whole text, as a binary column of little-endian 32-bit numbers.

    ``vocabulary`` is the path of a tokenizer file on the driver. The words that occur most often in
    these texts are compiled once; all others are merged in the tasks. A null text is empty and has no
    ids. An input column called ``into`` is replaced, others pass through.
    """
    spark = docs.sparkSession
    lexicon = compiled(spark, frequent_words(docs, text, words), vocabulary)
    spec = _shipped(spark, vocabulary)

    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        codec, known = _codec(SparkFiles.get(spec)), _lexicon(SparkFiles.get(lexicon))
        out: list[bytes] = []
        for _, part in pieces(column, _PIECE):
            for ids, at in codec.encode(part, known):
                raw = ids.tobytes()
                out += [raw[4 * a : 4 * b] for a, b in zip(at.tolist(), at[1:].tolist())]
            give_back()
        return pa.array(out, pa.binary())

    return replaced(docs, into, encode(F.col(f"`{text}`")))


def decoded(docs: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text that a column of ids, as ``encoded`` makes it, stands for; null ids are none."""
    spec = _shipped(docs.sparkSession, vocabulary)

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        codec = _codec(SparkFiles.get(spec))
        # A token name can end inside a character only where the vocabulary says so: names are whole.
        return pa.array([codec.decode(np.frombuffer(v or b"", "<u4")).decode() for v in column.to_pylist()], pa.string())

    return replaced(docs, into, decode(F.col(f"`{ids}`")))


def digests(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, one row per row of ``docs``."""
    narrow = docs.select("doc_id", "text")
    both = decoded(encoded(narrow, vocabulary, words=words).drop("text"), vocabulary)
    return both.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
