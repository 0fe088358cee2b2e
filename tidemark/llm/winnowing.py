"""Document fingerprints by winnowing: rolling k-gram hashes, the least of each window, with places."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Rolling, mixed, pieces, sliding_min, slices
from tidemark.llm.common import bounded_batches, count_below, only, replaced

#: Code points of a gram and grams of a window: any shared passage of GRAM + WINDOW - 1 code points
#: leaves the same hash in both fingerprints, and a shared passage below GRAM never does.
GRAM, WINDOW = 20, 41
_LOW = np.uint64(0xFFFFFFFF)
#: Ranges of documents that stand next to each other, and bytes of text that one is meant to have.
_RANGES, _RANGE_BYTES = 4096, 16 * 2**20


class Prints:
    """Fingerprints of several texts: of text i the hashes and places between at[i] and at[i + 1]."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, at: np.ndarray):
        self.hashes, self.places, self.at = hashes, places, at

    @classmethod
    def of(cls, texts: list[str], gram: int = GRAM, window: int = WINDOW) -> Prints:
        parts = [cls._part(texts[a:b], gram, window) for a, b in slices(np.array([len(t) for t in texts], np.int64), 500_000)]
        empty = np.zeros(0, np.int64)
        sizes = np.concatenate([empty, *[np.diff(p.at) for p in parts]])
        return cls(
            np.concatenate([empty.astype(np.uint32), *[p.hashes for p in parts]]),
            np.concatenate([empty, *[p.places for p in parts]]),
            np.concatenate([[0], np.cumsum(sizes)]),
        )

    @classmethod
    def _part(cls, texts: list[str], gram: int, window: int) -> Prints:
        lengths = np.array([len(t) for t in texts], np.int64)
        stops = np.cumsum(lengths)
        starts = stops - lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        hashes = Rolling(mixed(points.astype(np.uint64) + np.uint64(1))).of(gram)
        # Ties go to the rightmost place: it has the smallest complement.
        place = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes & ~_LOW) | (_LOW - place)
        text_of = np.repeat(np.arange(len(texts)), lengths)
        reach = window + gram - 1
        whole = np.flatnonzero(text_of[: max(0, len(points) - reach + 1)] == text_of[reach - 1 :])
        chosen = [sliding_min(keys, window)[whole] if len(whole) else keys[:0]]
        for i in np.flatnonzero((lengths >= gram) & (lengths < reach)).tolist():
            chosen.append(keys[starts[i] : stops[i] - gram + 1].min(keepdims=True))
        found = np.unique((_LOW - (np.concatenate(chosen) & _LOW)).astype(np.int64))
        values, owner = (hashes[found] >> np.uint64(32)).astype(np.uint32), text_of[found]
        local = found - starts[owner]
        # A text shorter than a gram is a gram of its own; an empty one has none.
        tiny = np.flatnonzero((lengths > 0) & (lengths < gram))
        if len(tiny):
            own = np.array([xxhash.xxh32_intdigest(texts[i].encode("utf-8", "surrogatepass")) for i in tiny], np.uint32)
            owner = np.concatenate([owner, tiny])
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            values = np.concatenate([values, own])[order]
            local = np.concatenate([local, np.zeros(len(tiny), np.int64)])[order]
        return cls(values, local, np.searchsorted(owner, np.arange(len(texts) + 1)))

    def strings(self) -> list[str]:
        """Of each text its hashes (8 hex digits), each followed by the step to its place (2 digits).

        The steps never exceed the window, which is what guarantees the matches.
        """
        steps = np.diff(self.places, prepend=0)
        first = self.at[:-1][np.diff(self.at) > 0]
        steps[first] = self.places[first]
        raw = np.empty((len(self.hashes), 5), np.uint8)
        raw[:, :4] = self.hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
        raw[:, 4] = steps
        return [raw[a:b].tobytes().hex() for a, b in zip(self.at.tolist(), self.at[1:].tolist())]

    def keyed(self) -> np.ndarray:
        """The distinct pairs of text and hash, as one number each."""
        owner = np.repeat(np.arange(len(self.at) - 1, dtype=np.uint64), np.diff(self.at))
        return np.unique(owner << np.uint64(32) | self.hashes)

    def rows(self, first: int, last: int) -> Prints:
        a, b = self.at[first], self.at[last]
        return Prints(self.hashes[a:b], self.places[a:b], self.at[first : last + 1] - a)


def likeness(x: Prints, y: Prints) -> np.ndarray:
    """Of each pair of fingerprints: common hashes by all hashes, each counted once; two empty ones are alike."""
    n = len(x.at) - 1
    a, b = x.keyed(), y.keyed()
    both = np.bincount((np.intersect1d(a, b, assume_unique=True) >> np.uint64(32)).astype(np.int64), minlength=n)
    sizes = [np.bincount((k >> np.uint64(32)).astype(np.int64), minlength=n) for k in (a, b)]
    union = sizes[0] + sizes[1] - both
    return np.where(union > 0, both / np.maximum(1, union), 1.0)


def fingerprinted(
    docs: DataFrame, text: str = "text", into: str = "fingerprint", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``docs`` with an array of (hash, place) for each whole text, by places.

    A text shorter than a gram has one hash, of itself; an empty or null one has none. Equal texts have
    equal fingerprints. An input column called ``into`` is replaced, others pass through.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("array<struct<hash:long,place:long>>")
    def prints(column: pa.Array) -> pa.Array:
        found = [Prints.of(part.to_pylist(), gram, window) for _, part in pieces(column)]
        sizes = np.concatenate([np.zeros(0, np.int64), *[np.diff(p.at) for p in found]])
        hashes = np.concatenate([np.zeros(0, np.uint32), *[p.hashes for p in found]]).astype(np.int64)
        places = np.concatenate([np.zeros(0, np.int64), *[p.places for p in found]])
        pairs = pa.StructArray.from_arrays([pa.array(hashes), pa.array(places)], ["hash", "place"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pairs)

    return replaced(docs, into, prints(F.col(f"`{text}`")))


def successive(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) in partitions in which each is followed by its next one.

    The order is by doc_id, descending, nulls last, and by a hash of the text among equal ids. Ranges of
    doc_id come from sampled quantiles; the first row of a range is also sent to the range before it,
    as ``extra``, and the very first to the last range. So a text crosses one shuffle.
    """
    rows = docs.withColumn("tie", F.xxhash64("text"))
    size, low = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    ranges = max(1, min(_RANGES, (size or 0) // _RANGE_BYTES))
    cuts: list[int] = []
    if low is not None and ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0]))
    # Larger ids first, so ranges count down; ids of null come last.
    code = F.coalesce(F.lit(len(cuts)) - count_below(F.col("doc_id"), cuts), F.lit(len(cuts) + 1))
    rows = rows.withColumn("home", code)
    place = F.struct(F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(0)).alias("o"), "tie")
    heads = sorted(rows.groupBy("home").agg(F.min(place).alias("head")).collect())
    before = {r.home: heads[i - 1].home for i, r in enumerate(heads)}
    # What is known of each range, by its number; there are few, and none of it grows with the rows.
    listed = {r.home: (r.head.o, r.head.tie, before[r.home]) for r in heads}
    known = [listed.get(i, (None, None, None)) for i in range(len(cuts) + 2)]
    kinds = {"head_o": "decimal(20,0)", "head_tie": "long", "ahead": "int"}
    rows = rows.withColumn("o", place["o"]).withColumns(
        {
            name: F.get(F.array(*[F.lit(k[i]).cast(kind) for k in known]), F.col("home"))
            for i, (name, kind) in enumerate(kinds.items())
        }
    )
    is_head = (F.col("o") == F.col("head_o")) & F.col("tie").eqNullSafe(F.col("head_tie"))
    at = lambda range_, extra: F.struct(F.col(range_).alias("at"), F.lit(extra).alias("extra"))
    sent = F.when(is_head, F.array(at("home", False), at("ahead", True))).otherwise(F.array(at("home", False)))
    rows = rows.select("doc_id", "text", "o", "tie", F.explode(sent).alias("sent"))
    rows = rows.select("sent.at", "sent.extra", "o", "tie", "doc_id", "text")
    return rows.repartition(2 * ranges, "at").sortWithinPartitions("at", "extra", "o", "tie")


def compared_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and what it has in common with others.

    The edited text has the last third of its code points (rounded down) replaced by the first as many
    of the next document, or all of it if that is shorter. A null text is empty. A table's only
    document is its own next one. Rows of one doc_id follow each other in the order of a hash of
    their texts. A task holds one batch of texts and the last document of the batch before.
    """
    bounded_batches(docs.sparkSession)
    narrow = only(docs, doc_id=doc_id, text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            held = table.slice(table.num_rows - 1)
            texts = table["text"].to_pylist()
            for first, last in slices(np.array([len(t) for t in texts[:-1]], np.int64), 2_000_000):
                emitted = np.flatnonzero(~table["extra"].slice(first, last - first).to_numpy())
                if not len(emitted):
                    continue
                own = texts[first : last + 1]
                edited = []
                for this, following in zip(own, own[1:]):
                    third = len(this) // 3
                    edited.append(this[: len(this) - third] + following[:third])
                prints, changed = Prints.of(own), Prints.of(edited)
                n = last - first
                mine = prints.rows(0, n)
                columns = [
                    table["doc_id"].slice(first, n).combine_chunks(),
                    pa.array([len(t) for t in own[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array(mine.strings()),
                    pa.array(changed.strings()),
                    pa.array(likeness(mine, changed)),
                    pa.array(likeness(mine, prints.rows(1, n + 1))),
                ]
                names = [f.split()[0] for f in schema.split(", ")]
                whole = pa.RecordBatch.from_arrays(columns, names)
                yield whole.take(pa.array(emitted))

    return successive(narrow).select("extra", "doc_id", "text").mapInArrow(compare, schema)
