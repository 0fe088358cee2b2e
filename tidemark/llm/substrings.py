"""Substring dedup on words: windows travel as packed strings to the bucket of their minimiser."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm.arrays import (
    Rolling,
    covered,
    mixed,
    numbers,
    pack,
    pieces,
    planes,
    sliding_min,
    spread,
    sums_between,
    unpack,
    words_of,
)
from tidemark.llm.common import bounded_batches

#: Words of a window and of the runs among which its minimiser is the one of least hash.
WINDOW, ANCHOR = 13, 3
#: Bytes of strings in a bucket, on average, and by how much strings exceed the texts.
_BUCKET_BYTES, _GROWTH = 20 * 2**20, 3
#: Bytes of texts looked at for minimisers that alone would fill a quarter of a bucket.
_SAMPLE_BYTES = 64 * 2**20
_PLACE_BITS = 22
#: Strings are most of what is shuffled; a little more time to pack them is well spent.
_LEVEL = 3


@dataclass
class Piece:
    """Some whole documents of a group and their super-k-mers: runs of windows with one minimiser.

    Run r has ``windows[r]`` windows from word ``first[r]`` on, and travels as ``strings[r]``.
    """

    row: int
    at: np.ndarray
    offsets: np.ndarray
    joined: bytes
    first: np.ndarray
    windows: np.ndarray
    hashes: np.ndarray
    strings: list[bytes]
    #: In a group that is kept: each run's string and document.
    numbers: np.ndarray | None = None
    owner: np.ndarray | None = None


def _runs(values: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser hash of each super-k-mer."""
    rolled = Rolling(values).of(ANCHOR)
    found = []
    step = 1 << _PLACE_BITS
    for start in range(0, max(0, len(values) - WINDOW + 1), step):
        stop = min(start + step, len(values) - WINDOW + 1)
        part = rolled[start : stop + WINDOW - ANCHOR]
        low = np.uint64(2 * step - 1)
        # The least hash, and of equal ones the leftmost: a choice that a window's words alone determine.
        keys = sliding_min((part & ~low) | np.arange(len(part), dtype=np.uint64), WINDOW - ANCHOR + 1)
        valid = text_of[start:stop] == text_of[start + WINDOW - 1 : stop + WINDOW - 1]
        place = np.where(valid, (keys & low).astype(np.int64), -1)
        begins = np.flatnonzero(np.diff(place, prepend=-2))
        counts = np.diff(np.append(begins, len(place)))
        real = place[begins] >= 0
        begins, counts = begins[real], counts[real]
        found.append((begins + start, counts, mixed(keys[begins] >> np.uint64(_PLACE_BITS + 1))))
    empty = np.zeros(0, np.int64)
    columns = zip(*found, strict=True) if found else ([empty], [empty], [empty.astype(np.uint64)])
    first, counts, hashes = (np.concatenate(c) for c in columns)
    return first, counts, hashes


def _pieces(text: pa.Array, hot: np.ndarray) -> Iterator[Piece]:
    for row, part in pieces(text, 6 * 2**20):
        words = words_of(part)
        distinct = words.distinct.cast(pa.binary()).to_pylist()
        sizes = np.array([len(w) for w in distinct], np.int64)[words.codes]
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        joined = b" ".join([distinct[c] for c in words.codes.tolist()])
        first, windows, hashes = _runs(words.hashes()[words.codes], words.text_of)
        # A hot minimiser's windows go one by one, each by its own words.
        single = np.isin(hashes, hot)
        if single.any():
            apart = spread(first[single], windows[single])
            first = np.concatenate([first[~single], apart])
            windows = np.concatenate([windows[~single], np.ones(len(apart), np.int64)])
            own = Rolling(words.hashes()[words.codes]).of(WINDOW)
            hashes = np.concatenate([hashes[~single], own[apart]])
            order = np.argsort(first, kind="stable")
            first, windows, hashes = first[order], windows[order], hashes[order]
        ends = offsets[first + windows + WINDOW - 1] - 1
        strings = [joined[a:b] for a, b in zip(offsets[first].tolist(), ends.tolist(), strict=True)]
        yield Piece(row, words.at, offsets, joined, first, windows, hashes, strings)


class Asked:
    """The distinct strings of a group in the order of their first documents, dealt into buckets."""

    def __init__(self, ids: np.ndarray, text: pa.Array, buckets: int, hot: np.ndarray, keep: bool):
        self.index: dict[bytes, int] = {}
        self.pieces: list[Piece] = []
        docs, windows, hashes = [], [], []
        for piece in _pieces(text, hot):
            owner = np.searchsorted(piece.at, piece.first, side="right") - 1 + piece.row
            before = len(self.index)
            seen = [self.index.setdefault(s, len(self.index)) for s in piece.strings]
            # Documents come in the order of their ids, so a string's first one is its smallest.
            new, where = np.unique(np.array(seen, np.int64), return_index=True)
            where = where[new >= before]
            docs.append(ids[owner[where]])
            windows.append(piece.windows[where])
            hashes.append(piece.hashes[where])
            if keep:
                piece.strings, piece.numbers = [], np.array(seen, np.int64)
                piece.owner = owner
                self.pieces.append(piece)
        empty = np.zeros(0, np.int64)
        self.docs = np.concatenate([empty, *docs])
        self.windows = np.concatenate([empty, *windows])
        self.hashes = np.concatenate([empty.astype(np.uint64), *hashes])
        bucket = (self.hashes % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def members(self, bucket: int) -> np.ndarray:
        return self.order[self.bounds[bucket] : self.bounds[bucket + 1]]

    def blocks(self) -> blocks.Blocks:
        strings = list(self.index)
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            which = self.members(bucket)
            own = [strings[i] for i in which.tolist()]
            # Words hold no white space, so a line feed parts the strings.
            tags = (self.hashes[which] >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            yield bucket, pack(tags, planes(np.diff(self.docs[which], prepend=0)), b"\n".join(own), level=_LEVEL)


def _window_masks(strings: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Of each string a bit for each window that also occurs in a string of a smaller document.

    Windows are sorted by a hash and neighbours compared word by word. Should two different windows
    ever have one hash, all are sorted by their words instead.
    """
    words = words_of(pa.array(strings, pa.binary()).cast(pa.string()))
    counts = np.diff(words.at) - WINDOW + 1
    start = spread(words.at[:-1], counts)
    owner = np.repeat(np.arange(len(strings)), counts)
    codes = words.codes.astype(np.int32)
    views = np.lib.stride_tricks.sliding_window_view(codes, WINDOW) if len(codes) >= WINDOW else codes.reshape(0, WINDOW)
    keys = Rolling(words.hashes()[words.codes]).of(WINDOW)[start]
    order = np.argsort(keys, kind="stable")
    tied = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    equal = (views[start[order[tied]]] == views[start[order[tied + 1]]]).all(axis=1)
    same = np.zeros(max(0, len(order) - 1), bool)
    if equal.all():
        same[tied] = True
    else:
        order = np.lexsort(views[start].T)
        same = (views[start[order[1:]]] == views[start[order[:-1]]]).all(axis=1)
    out = np.zeros(len(strings), np.uint16)
    if not len(order):
        return out
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.repeat(np.minimum.reduceat(docs[owner[order]], begins), np.diff(np.append(begins, len(order))))
    repeated = order[least < docs[owner[order]]]
    place = start[repeated] - words.at[owner[repeated]]
    np.bitwise_or.at(out, owner[repeated], np.left_shift(1, place).astype(np.uint16))
    return out


def _answer(requests: list[bytes]) -> list[bytes | None]:
    index: dict[bytes, int] = {}
    parts = []
    for block in requests:
        tags, docs, raw = unpack(block, np.uint8, None, None)
        strings = raw.split(b"\n")
        number = np.array([index.setdefault(s, len(index)) for s in strings], np.int64)
        windows = np.array([s.count(b" ") for s in strings], np.int64) + 2 - WINDOW
        tag = np.zeros((len(strings), 4), np.uint8)
        tag[:, :3] = tags.reshape(-1, 3)
        parts.append((number, np.cumsum(numbers(docs)), windows, tag.view("<u4")[:, 0]))
    everything = np.concatenate([p[0] for p in parts])
    least = np.full(len(index), blocks.LAST_ID, np.int64)
    np.minimum.at(least, everything, np.concatenate([p[1] for p in parts]))
    # Only strings that share their minimiser with another string can share a window with it.
    tag_of = np.zeros(len(index), np.uint32)
    tag_of[everything] = np.concatenate([p[3] for p in parts])
    _, which, count = np.unique(tag_of, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count[which] > 1)
    all_strings = list(index)
    masks = np.zeros(len(index), np.uint16)
    # A minimiser's strings stay together; some thousand of them are compared at a time.
    shared = shared[np.argsort(which[shared], kind="stable")]
    group = which[shared]
    start = 0
    while start < len(shared):
        stop = int(np.searchsorted(group, group[min(len(shared) - 1, start + 50_000)], side="right"))
        some = shared[start:stop]
        masks[some] = _window_masks([all_strings[i] for i in some.tolist()], least[some])
        start = stop
    out: list[bytes | None] = []
    for number, docs, windows, _ in parts:
        full = (np.left_shift(1, windows) - 1).astype(np.uint16)
        mask = np.where(least[number] < docs, full, masks[number])
        hit = np.flatnonzero(mask)
        out.append(pack(hit.astype(np.int32), mask[hit]) if len(hit) else None)
    return out


def _kept(table: pa.Table, answers: dict[int, bytes], buckets: int, hot: np.ndarray) -> pa.Table:
    ids, text = blocks.columns_of(table)
    asked = Asked(ids, text, buckets, hot, keep=True)
    masks = np.zeros(len(asked.index), np.uint16)
    for bucket, block in answers.items():
        hit, mask = unpack(block, np.int32, np.uint16)
        masks[asked.members(bucket)[hit]] = mask
    n_words, n_removed, kept = [], [], []
    for piece in asked.pieces:
        full = (np.left_shift(1, piece.windows) - 1).astype(np.uint16)
        # A string of this group whose first document is a smaller one is repeated as a whole.
        own = np.where(asked.docs[piece.numbers] < ids[piece.owner], full, masks[piece.numbers])
        hit = np.flatnonzero(own)
        bits = (own[hit, None] >> np.arange(WINDOW, dtype=np.uint16)) & 1
        which, place = np.nonzero(bits)
        gone = covered(piece.first[hit[which]] + place, WINDOW, piece.at[-1])
        removed = sums_between(gone, piece.at)
        n_words += np.diff(piece.at).tolist()
        n_removed += removed.tolist()
        offsets = piece.offsets
        for i, (a, b) in enumerate(zip(piece.at.tolist(), piece.at[1:].tolist())):
            if not removed[i]:
                kept.append(piece.joined[offsets[a] : max(offsets[a], offsets[b] - 1)])
                continue
            stay = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=1, append=1))
            spans = zip((a + stay[::2]).tolist(), (a + stay[1::2]).tolist(), strict=True)
            kept.append(b" ".join([piece.joined[offsets[x] : offsets[y] - 1] for x, y in spans]))
    columns = [table["row"].combine_chunks(), table["text"].combine_chunks()]
    columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
    columns += [pa.array(kept, pa.binary()).cast(pa.string())]
    columns += [pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
    return pa.Table.from_arrays(columns, ["row", "text", "n_words", "n_removed", "kept", "kept_sha256"])


def _hot(docs: DataFrame, total: int, buckets: int, text: str) -> np.ndarray:
    """Minimisers that alone would have more than a quarter of a bucket, as far as a bounded sample shows.

    At most four times as many as there are buckets. They decide how windows travel, not what is found.
    """
    sample = docs.filter(blocks.sampled(total, _SAMPLE_BYTES)).select(F.col(f"`{text}`").alias("text"))

    def minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                words = words_of(part)
                _, _, hashes = _runs(words.hashes()[words.codes], words.text_of)
                value, n = np.unique(hashes, return_counts=True)
                columns = [pa.array(value.view(np.int64)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["h", "n"])

    counts = sample.mapInArrow(minimisers, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    all_of_them = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    limit = F.greatest(F.lit(64), F.col("total") / (4 * buckets))
    found = counts.filter("n >= 64").crossJoin(all_of_them).filter(F.col("n") > limit)
    return np.array([r.h for r in found.select("h").collect()], np.int64).view(np.uint64)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (row, text, n_words, n_removed, kept, kept_sha256) per row of ``docs``.

    Each word is removed that lies in a window of 13 words which also starts in a document with a
    smaller doc_id; windows are those of the input. ``kept`` joins the other words by one space,
    ``row`` holds the row's other columns, ``text`` what it was (a null becomes empty).

    A null doc_id is larger than any, and rows of one doc_id do not count as smaller than each other,
    so neither removes the other's words. Texts below 13 words lose nothing. Windows are compared
    by their words, never by a hash alone. A task holds a group of some megabytes or a bucket of such size.
    """
    bounded_batches(docs.sparkSession)
    total = blocks.text_bytes(docs, text)
    buckets = max(1, -(-total * _GROWTH // _BUCKET_BYTES))
    hot = _hot(docs, total, buckets, text)
    groups = blocks.grouped(docs, total, doc_id, text)
    requests = blocks.asked(groups, lambda t: Asked(*blocks.columns_of(t), buckets, hot, keep=False).blocks())
    answers = blocks.answered(requests, _answer)
    schema = blocks.result_schema(groups, "text string, n_words long, n_removed long, kept string, kept_sha256 string")
    return blocks.applied(groups, answers, lambda t, a: _kept(t, a, buckets, hot), schema)


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with the kept words as text where any was removed, and with ``length`` as its new length."""
    found = without_repeats(docs, doc_id, text)
    changed = F.col("n_removed") > 0
    columns = []
    for c in docs.columns:
        if c == text:
            column = F.when(changed, F.col("kept")).otherwise(F.col("text"))
        elif c == length:
            column = F.when(changed, F.length("kept").cast(docs.schema[c].dataType)).otherwise(F.col(f"row.`{c}`"))
        else:
            column = F.col(f"row.`{c}`")
        columns.append(column.alias(c))
    return found.select(*columns)
