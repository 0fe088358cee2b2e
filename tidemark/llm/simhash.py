"""SimHash near-dedup: tiles of fingerprints compared exactly, bit by bit.

Equal fingerprints are one from the start, so a group of copies of any size is a single row here.
The distinct ones are dealt into tiles by the bit counts of their four 16-bit quarters. The bit
counts of two fingerprints cannot differ, summed over the quarters, by more than the fingerprints
do, so a tile meets only the tiles within the radius; all other pairs of tiles are skipped, and no
link is missed. A tile pair is one exclusive-or and one bit count of numpy over blocks of bounded
size. It reports a spanning forest of its links, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import give_back, pieces, words_of
from tidemark.llm.common import bounded_batches, only, replaced, stored
from tidemark.llm.components import smallest_reachable

_QUARTERS = 4


def _lowered(words: list[bytes]) -> list[bytes]:
    # bytes.lower() changes A-Z only
    return [w.lower() for w in words]


def _fingerprints(column: pa.Array, size: int, seed: int) -> np.ndarray:
    """A bit is set where it is set in more than half of the hashes of the text's shingles."""
    words = words_of(column)
    distinct = _lowered(words.distinct.cast(pa.binary()).to_pylist())
    stream = [distinct[c] for c in words.codes.tolist()]
    at = words.at
    counts = np.diff(at)
    digest = xxhash.xxh64_intdigest
    # All runs of ``size`` words, over the borders of texts as well; those are left out below.
    runs = map(b" ".join, zip(*[stream[i:] for i in range(size)], strict=False))
    hashes = np.fromiter((digest(r, seed) for r in runs), np.uint64, max(0, len(stream) - size + 1))
    text_of = words.text_of
    inside = text_of[: len(hashes)] == text_of[size - 1 :]
    shingles, owner = hashes[inside], text_of[: len(hashes)][inside]
    out = np.zeros(len(counts), np.uint64)
    if len(shingles):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        many = np.diff(np.append(starts, len(shingles)))
        packed = np.packbits(2 * ones > many[:, None], axis=1, bitorder="little")
        out[owner[starts]] = np.ascontiguousarray(packed).view(np.uint64)[:, 0]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        out[i] = digest(b" ".join(stream[at[i] : at[i + 1]]), seed)
    return out


def fingerprinted(
    docs: DataFrame, text: str = "text", into: str = "fingerprint", size: int = 3, seed: int = 42
) -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each text as a long (its bits as they are).

    Shingles are runs of ``size`` words with A-Z lower-cased, joined by a space, repeats included. A
    text of fewer words is one shingle, a text without words (or a null) has fingerprint zero. An
    input column called ``into`` is replaced.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def hashed(column: pa.Array) -> pa.Array:
        parts = [_fingerprints(part, size, seed) for _, part in pieces(column, 2_000_000)]
        give_back()
        return pa.array(np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64))

    return replaced(docs, into, hashed(F.col(f"`{text}`")))


def _nearby(radius: int) -> list[tuple[int, ...]]:
    """Steps to the tiles within the radius, one of each pair of opposite ones, and to the own tile."""
    steps = product(range(-radius, radius + 1), repeat=_QUARTERS)
    return sorted(s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * _QUARTERS)


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks (or inside one), as pairs of fingerprints.

    The links of one row lead to a single hub, so a row adds at most as many edges as it merges trees.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    left, right = [], []
    rows = max(1, 2_000_000 // max(1, len(b)))
    for start in range(0, len(a), rows):
        differ = np.bitwise_count(a[start : start + rows, None] ^ b[None, :])
        near_a, near_b = np.nonzero(differ <= radius)
        for x, y in zip(a[start + near_a].tolist(), b[near_b].tolist(), strict=True):
            if x != y and (rx := root(x)) != (ry := root(y)):
                parent[ry] = rx
                left.append(x)
                right.append(y)
    return np.array(left, np.uint64).view(np.int64), np.array(right, np.uint64).view(np.int64)


def links(distinct: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """Links (a, b) that join all fingerprints within ``radius`` bits of each other, directly or by steps.

    ``distinct`` has one column ``f``. Blocks hold ``block`` fingerprints at most, so a tile however
    full is many small pairs of blocks that any task can take.
    """
    quarter = [f"CAST(bit_count((shiftrightunsigned(f, {16 * i}) & 65535L)) AS int)" for i in range(_QUARTERS)]
    tiled = distinct.select("f", F.array(*map(F.expr, quarter)).alias("tile"))
    # The rank in a tile would need the tile in one task; a hash deals it out as evenly.
    full = tiled.groupBy("tile").count().withColumn("parts", F.ceil(F.col("count") / (block // 2)))
    parted = tiled.join(full, "tile").withColumn(
        "part", F.pmod(F.xxhash64("f"), F.col("parts")).cast("int")
    )
    blocks = parted.groupBy("tile", "part").agg(F.collect_list("f").alias("values"))
    blocks = stored(blocks, "simhash-tiles")
    steps = F.array(*[F.array(*map(F.lit, s)) for s in _nearby(radius)])
    visiting = blocks.select(
        F.col("tile").alias("home"),
        F.col("part").alias("home_part"),
        F.col("values").alias("visitors"),
        F.explode(steps).alias("step"),
    ).select("*", F.zip_with("home", "step", lambda x, y: x + y).alias("tile"))
    met = visiting.join(blocks, "tile").filter(
        (F.col("home") != F.col("tile")) | (F.col("home_part") <= F.col("part"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                blocks = [v.values.to_numpy().view(np.uint64) for v in (x, y)]
                found.append(_forest(*blocks, radius))
            ends = [np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    return met.select("visitors", "values").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    seed: int = 42,
    radius: int = 3,
) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links of ``radius`` bits or
    fewer. A null doc_id counts as larger than any; if all of a component are null, so is its id.
    Rows of one doc_id are kept as they are and linked through their own texts. No rows give no rows.
    """
    return _linked(only(docs, doc_id=doc_id, text=text), size, seed, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id")
    )


def _linked(texts: DataFrame, size: int, seed: int, radius: int) -> DataFrame:
    """``texts`` (doc_id, text and others) without the text, with its fingerprint ``f``, and ``least`` and ``hub`` of its component."""
    prints = stored(fingerprinted(texts, "text", "f", size, seed).drop("text"), "simhash")
    distinct = prints.groupBy("f").agg(F.min("doc_id").alias("least"))
    edges = links(distinct.select("f"), radius)
    return prints.join(smallest_reachable(texts.sparkSession, distinct, edges), "f", "left")


def keep_first(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    seed: int = 42,
    radius: int = 3,
) -> DataFrame:
    """Of each component the row with the smallest doc_id, with its columns.

    Of a component's rows that share that doc_id one stays, chosen by a hash of the text; rows of
    one doc_id in several components do not count against each other. Rows without a doc_id cannot
    be told from each other and all stay.
    """
    key, names = F.col(f"`{doc_id}`"), [F.col(f"`{c}`") for c in docs.columns]
    mark, rank = "_mark", "_rank"
    while mark in docs.columns or rank in docs.columns:
        mark, rank = mark + "_", rank + "_"
    of_text = F.xxhash64(f"`{text}`")
    found = _linked(only(docs, doc_id=doc_id, text=text, mark=of_text), size, seed, radius)
    # By doc_id as well: a component can hold a third of all rows, and its smallest id is known already.
    first = found.filter("doc_id = least").groupBy("doc_id", "hub").agg(F.min("mark").alias("mark"))
    stay = first.select(F.col("doc_id").alias(doc_id), F.col("mark").alias(mark))
    same = Window.partitionBy(key, mark).orderBy(mark)
    kept = docs.filter(key.isNotNull()).withColumn(mark, of_text).join(stay, [doc_id, mark], "left_semi")
    kept = kept.withColumn(rank, F.row_number().over(same)).filter(F.col(rank) == 1).select(*names)
    return kept.unionByName(docs.filter(key.isNull()))
