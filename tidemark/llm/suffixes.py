"""Suffix-array dedup on bytes: sampled suffixes, range-partitioned and sorted, find repeated strings.

Every 100-byte string has one anchor, the place in it whose 16 leading bytes have the least hash, so
equal strings have equal anchors. Only the suffixes that start at anchors are sorted. Each carries the
bytes that its strings need on both sides of it, so all strings are still compared byte by byte. About
one place in 43 is an anchor; with one suffix per byte the shuffle alone would be a hundred times the
input.
"""

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
)
from tidemark.llm.common import bounded_batches

#: Bytes of a string that counts as a repeat, and of the lead by which suffixes are dealt out.
LENGTH, LEAD = 100, 16
#: Bytes of strings in a bucket, on average, and by how much strings exceed the texts.
_BUCKET_BYTES, _GROWTH = 20 * 2**20, 3.4
#: Bytes of texts looked at for splitters and for leads that alone would fill a quarter of a bucket.
_SAMPLE_BYTES = 64 * 2**20
#: Ranges between splitters (their number reaches the driver), and suffixes drawn for each.
_RANGES, _DRAWN = 4096, 32
_SEGMENT_BITS = 20
_SEED = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Plan:
    """How suffixes are dealt out: ascending splitters, buckets of a range, and hashes of hot leads."""

    splitters: np.ndarray
    parts: int
    hot: np.ndarray

    @property
    def buckets(self) -> int:
        return (len(self.splitters) + 1) * self.parts

    def bucket_of(self, leads: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.splitters, leads).astype(np.int64) * self.parts
        if self.parts > 1:
            words = leads.astype(f"S{LEAD}").view(">u8").reshape(-1, 2).astype(np.uint64)
            place += (mixed(words[:, 0] ^ mixed(words[:, 1])) % np.uint64(self.parts)).astype(np.int64)
        return place


def _leads(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    if not len(places):
        return np.zeros(0, f"S{LEAD}")
    return np.lib.stride_tricks.sliding_window_view(data, LEAD)[places].view(f"S{LEAD}")[:, 0]


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of strings with one anchor: its first place, number of strings, anchor and lead hash."""
    step, last = 1 << _SEGMENT_BITS, len(data) - LENGTH + 1
    begins = np.maximum(at[:-1], at[1:] - LENGTH + 1)
    crosses = covered(begins, at[1:] - begins, len(data))
    found = []
    for start in range(0, max(0, last), step):
        stop = min(start + step, last)
        hashes = Rolling(_SEED[data[start : stop + LENGTH - 1]]).of(LEAD)
        low = np.uint64(2 * step - 1)
        # Of equal leads in a string the leftmost is the anchor.
        keys = sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), LENGTH - LEAD + 1)
        anchor = np.where(crosses[start:stop], -1, (keys & low).astype(np.int64))
        first = np.flatnonzero(np.diff(anchor, prepend=-2))
        count = np.diff(np.append(first, len(anchor)))
        real = anchor[first] >= 0
        first, count = first[real], count[real]
        found.append((first + start, count, anchor[first] + start, hashes[anchor[first]]))
    empty = np.zeros(0, np.int64)
    columns = zip(*found, strict=True) if found else ([empty], [empty], [empty], [empty.astype(np.uint64)])
    return tuple(np.concatenate(c) for c in columns)


def _bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each text begins."""
    raw = text.cast(pa.binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Piece:
    row: int
    at: np.ndarray
    data: np.ndarray
    first: np.ndarray
    count: np.ndarray
    owner: np.ndarray
    numbers: np.ndarray


class Asked:
    """The distinct strings around a group's anchors, with the first place of each, dealt into buckets."""

    def __init__(self, ids: np.ndarray, text: pa.Array, plan: Plan):
        index: dict[bytes, int] = {}
        self.pieces: list[Piece] = []
        parts = []
        for row, part in pieces(text, 2_000_000):
            data, at = _bytes_of(part)
            first, count, anchor, hashes = _runs(data, at)
            # The strings of a hot lead go one by one, each by its own first bytes.
            single = np.isin(hashes, plan.hot)
            if single.any():
                apart = spread(first[single], count[single])
                first = np.concatenate([first[~single], apart])
                count = np.concatenate([count[~single], np.ones(len(apart), np.int64)])
                anchor = np.concatenate([anchor[~single], apart])
            raw = data.tobytes()
            ends = first + count + LENGTH - 1
            strings = [raw[a:b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            number = np.array([index.setdefault(s, len(index)) for s in strings], np.int64)
            owner = np.searchsorted(at, first, side="right") - 1
            bucket = plan.bucket_of(_leads(data, anchor))
            parts.append((number, ids[owner + row], first - at[owner], count, anchor - first, bucket))
            self.pieces.append(Piece(row, at, data, first, count, owner, number))
        empty = np.zeros(0, np.int64)
        number, docs, places, count, before, bucket = (
            np.concatenate([empty, *column]) for column in (zip(*parts, strict=True) if parts else [[]] * 6)
        )
        order = np.lexsort((places, docs, number))
        leading = order[np.flatnonzero(np.diff(number[order], prepend=-1))]
        self.strings = list(index)
        self.docs, self.places, self.count, self.before = docs[leading], places[leading], count[leading], before[leading]
        bucket = bucket[leading]
        self.order = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[self.order], np.arange(plan.buckets + 1))

    def members(self, bucket: int) -> np.ndarray:
        return self.order[self.bounds[bucket] : self.bounds[bucket + 1]]

    def blocks(self) -> blocks.Blocks:
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            which = self.members(bucket)
            yield bucket, pack(
                planes(np.diff(self.docs[which], prepend=0)),
                planes(self.places[which]),
                self.count[which].astype(np.uint8),
                self.before[which].astype(np.uint8),
                b"".join([self.strings[i] for i in which.tolist()]),
                level=3,
            )


def tie_groups(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey sort of data[start:start + width]: (which, group) of those equal to another one, in order.

    Eight bytes at a time are one character. Strings are sorted by a character within the groups that
    were equal so far, and those that are then alone need no further look.
    """
    which, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    if not len(starts):
        return which, group
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    for depth in [*range(0, width - 8, 8), width - 8]:
        chars = view[starts[which] + depth].view(">u8")[:, 0].astype(np.uint64)
        order = np.lexsort((chars, group))
        which, group, chars = which[order], group[order], chars[order]
        new = np.ones(len(which), bool)
        new[1:] = (group[1:] != group[:-1]) | (chars[1:] != chars[:-1])
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        which, group = which[tied], group[tied]
        if not len(which):
            break
    return which, group


def _related(data: np.ndarray, anchors: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Strings that can share 100 bytes with another one.

    Those bytes hold the anchor, so half of them follow it, or half of them and the lead end with it.
    """
    out = np.zeros(len(anchors), bool)
    half = LENGTH // 2
    for fits, start in ((after >= half, anchors), (before >= half - LEAD, anchors - (half - LEAD))):
        some = np.flatnonzero(fits)
        which, _ = tie_groups(data, start[some], half)
        out[some[which]] = True
    return out


def _answer(requests: list[bytes]) -> list[bytes | None]:
    index: dict[bytes, int] = {}
    parts = []
    for block in requests:
        docs, places, count, before, raw = unpack(block, None, None, np.uint8, np.uint8, None)
        ends = np.cumsum(count.astype(np.int64) + LENGTH - 1)
        starts = ends - count - LENGTH + 1
        strings = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        number = np.array([index.setdefault(s, len(index)) for s in strings], np.int64)
        ids = np.cumsum(numbers(docs))
        parts.append((number, ids, numbers(places), count.astype(np.int64), before.astype(np.int64)))
    number, docs, places, count, before = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((places, docs, number))
    leading = order[np.flatnonzero(np.diff(number[order], prepend=-1))]
    docs, places, count, before = docs[leading], places[leading], count[leading], before[leading]
    data = np.frombuffer(b"".join(index), np.uint8)
    starts = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    related = np.flatnonzero(_related(data, starts + before, before, count + LENGTH - 1 - before))
    # The first place of each string of 100 bytes is kept, all others are repeats.
    string = np.repeat(related, count[related])
    shift = spread(np.zeros(len(related), np.int64), count[related])
    which, group = tie_groups(data, starts[string] + shift, LENGTH)
    doc, place = docs[string[which]], places[string[which]] + shift[which]
    order = np.lexsort((place, doc, group))
    opens = np.flatnonzero(np.diff(group[order], prepend=-1))
    first = np.repeat(order[opens], np.diff(np.append(opens, len(order))))
    later = order[(doc[order] != doc[first]) | (place[order] != place[first])]
    repeated = np.zeros(len(string), bool)
    repeated[which[later]] = True
    # Runs of repeated strings, cut where those of one anchor end.
    opens = repeated & ((shift == 0) | ~np.concatenate([[False], repeated[:-1]])[: len(repeated)])
    run_at = np.flatnonzero(opens)
    run_length = np.bincount((np.cumsum(opens) - 1)[repeated], minlength=len(run_at))
    run_string, run_shift = string[run_at], shift[run_at]
    run_bounds = np.searchsorted(run_string, np.arange(len(index) + 1))
    out: list[bytes | None] = []
    for number, own_docs, own_places, own_count, _ in parts:
        is_first = (own_docs == docs[number]) & (own_places == places[number])
        whole = np.flatnonzero(~is_first)
        some = np.flatnonzero(is_first)
        many = run_bounds[number[some] + 1] - run_bounds[number[some]]
        runs = spread(run_bounds[number[some]], many)
        entry = np.concatenate([whole, np.repeat(some, many)])
        start = np.concatenate([np.zeros(len(whole), np.int64), run_shift[runs]])
        length = np.concatenate([own_count[whole], run_length[runs]])
        out.append(
            pack(entry.astype(np.int32), start.astype(np.uint8), length.astype(np.uint8)) if len(entry) else None
        )
    return out


def _kept(table: pa.Table, answers: dict[int, bytes], plan: Plan) -> pa.Table:
    ids, text = blocks.columns_of(table)
    asked = Asked(ids, text, plan)
    found = [(np.zeros(0, np.int64),) * 3]
    for bucket, block in answers.items():
        entry, start, length = unpack(block, np.int32, np.uint8, np.uint8)
        found.append((asked.members(bucket)[entry], start.astype(np.int64), length.astype(np.int64)))
    number, start, length = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(number, kind="stable")
    number, start, length = number[order], start[order], length[order]
    bounds = np.searchsorted(number, np.arange(len(asked.strings) + 1))
    sizes, removed_bytes, spans, kept = [], [], [], []
    for piece in asked.pieces:
        own_place = piece.first - piece.at[piece.owner]
        is_first = (ids[piece.owner + piece.row] == asked.docs[piece.numbers]) & (own_place == asked.places[piece.numbers])
        whole, some = np.flatnonzero(~is_first), np.flatnonzero(is_first)
        many = bounds[piece.numbers[some] + 1] - bounds[piece.numbers[some]]
        runs = spread(bounds[piece.numbers[some]], many)
        begin = np.concatenate([piece.first[whole], np.repeat(piece.first[some], many) + start[runs]])
        count = np.concatenate([piece.count[whole], length[runs]])
        gone = covered(begin, count + LENGTH - 1, len(piece.data))
        opens = gone & ~np.concatenate([[False], gone[:-1]]) if len(gone) else gone
        # A span ends with its document.
        starts = piece.at[:-1][piece.at[:-1] < len(gone)]
        opens[starts] = gone[starts]
        sizes += np.diff(piece.at).tolist()
        removed = sums_between(gone, piece.at)
        removed_bytes += removed.tolist()
        spans += sums_between(opens, piece.at).tolist()
        for i, (a, b) in enumerate(zip(piece.at.tolist(), piece.at[1:].tolist())):
            part = piece.data[a:b]
            kept.append((part[~gone[a:b]] if removed[i] else part).tobytes())
    columns = [table["row"].combine_chunks(), table["text"].combine_chunks()]
    columns += [pa.array(c, pa.int64()) for c in (sizes, removed_bytes, spans)]
    columns += [pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
    names = ["row", "text", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    return pa.Table.from_arrays(columns, names)


def planned(docs: DataFrame, total: int, text: str) -> Plan:
    """Splitters and hot leads from a bounded sample of documents. They do not change what is found."""
    buckets = max(1, -(-int(total * _GROWTH) // _BUCKET_BYTES))
    ranges = min(_RANGES, buckets)
    sample = docs.filter(blocks.sampled(total, _SAMPLE_BYTES)).select(F.col(f"`{text}`").alias("text"))
    every = max(1, int(min(total, _SAMPLE_BYTES)) // (43 * _DRAWN * ranges))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in pieces(batch.column(0), 2_000_000):
                data, at = _bytes_of(part)
                _, count, anchor, hashes = _runs(data, at)
                value, n = np.unique(hashes, return_counts=True)
                often = n >= 4
                some = _leads(data, anchor[::every]).tolist()
                columns = [
                    pa.array(value[often].view(np.int64).tolist() + [None] * len(some), pa.int64()),
                    pa.array(n[often].tolist() + [len(count)] * min(1, len(some)) + [0] * (len(some) - 1), pa.int64()),
                    pa.array([None] * int(often.sum()) + some, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["h", "n", "lead"])

    found = sample.mapInArrow(drawn, "h long, n long, lead binary").persist()
    try:
        leads = sorted(r.lead for r in found.filter("lead IS NOT NULL").select("lead").collect())
        runs = found.filter("lead IS NOT NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        counts = found.filter("h IS NOT NULL").groupBy("h").agg(F.sum("n").alias("n"))
        hot = [r.h for r in counts.filter(F.col("n") > max(64, runs / (4 * buckets))).collect()]
    finally:
        found.unpersist()
    cuts = sorted({leads[i * len(leads) // ranges] for i in range(1, ranges)}) if leads else []
    return Plan(np.array(cuts, f"S{LEAD}"), -(-buckets // (len(cuts) + 1)), np.array(hot, np.int64).view(np.uint64))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (row, text, n_bytes, n_removed, n_spans, kept, kept_sha256) per row of ``docs``.

    Each byte is removed that lies in a string of 100 bytes which also starts earlier: in a document
    with a smaller doc_id, or in the same one at an earlier byte. Strings are those of the input.
    ``kept`` holds the other bytes, which need not be whole characters; ``n_spans`` counts the maximal
    removed runs; ``row`` holds the row's other columns.

    A null text is empty, a null doc_id is larger than any, and rows that share a doc_id are compared
    by the place alone, so copies in them are both first. Texts below 100 bytes lose nothing. A
    task holds a group of some megabytes or a bucket of such size.
    """
    bounded_batches(docs.sparkSession)
    total = blocks.text_bytes(docs, text)
    plan = planned(docs, total, text)
    groups = blocks.grouped(docs, total, doc_id, text)
    requests = blocks.asked(groups, lambda t: Asked(*blocks.columns_of(t), plan).blocks())
    answers = blocks.answered(requests, _answer)
    schema = blocks.result_schema(
        groups, "text string, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
    return blocks.applied(groups, answers, lambda t, a: _kept(t, a, plan), schema)
