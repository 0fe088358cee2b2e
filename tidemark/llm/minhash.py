"""MinHash near-dedup: circulant signatures, bands, and links confirmed on whole shingle sets.

Two permutations make all coordinates of a signature: the first puts a shingle on a circle of 2**32
places, the second orders the circle, turned by one place per coordinate. Equal sets are one node from
the start. Nodes that share a band are candidates, in three steps that each leave out what the steps before
have joined: a node with one hub of its bands, with the other hubs (if their signatures agree often enough
to be a link), and what is left of a band in blocks. So a group of near copies costs about one comparison
per node, and yet no candidate between different components goes unseen. All are compared shingle by shingle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Rolling, give_back, mixed, pieces, slices, words_of
from tidemark.llm.common import bounded_batches, only, release, stored
from tidemark.llm.components import smallest_reachable

#: Shingles whose coordinates are made at a time, so that they stay in a core's cache.
_CHUNK = 32_768
#: Shingles of a block, and of all blocks that a task gets at a time, on average.
_BLOCK, _LOT = 65_536, 1_048_576
#: Shingles that are laid out side by side.
_COLUMNS = 4_096


@dataclass(frozen=True)
class Banding:
    """``bands`` times ``rows`` coordinates; two sets of ``percent`` likeness miss each other in all bands once in 20 million."""

    size: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Equal coordinates that a link has, but for seven standard deviations."""
        likeness = self.percent / 100
        spread = math.sqrt(likeness * (1 - likeness) / self.coordinates)
        return max(0, math.floor(self.coordinates * (likeness - 7 * spread)))


def _ordered(x: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The second permutation of 32-bit places, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        x ^= np.right_shift(x, np.uint32(shift), out=room)
        if factor:
            x *= np.uint32(factor)
    return x


def _shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes of their lower-cased words."""
    words = words_of(column)
    # bytes.lower() changes A-Z only
    lowered = [w.lower() for w in words.distinct.cast(pa.binary()).to_pylist()]
    of_word = np.fromiter(map(xxhash.xxh64_intdigest, lowered), np.uint64, len(lowered))
    rolling, at = Rolling(of_word[words.codes]), words.at
    every = rolling.of(size)
    out = []
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
        if stop - start >= size:
            out.append(np.unique(every[start : stop - size + 1]))
        else:
            out.append(_of_few(of_word[words.codes[start:stop]]))
    return out


def _of_few(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text that is shorter than a shingle, or none."""
    return mixed(Rolling(words).of(len(words)) + np.uint64(len(words))) if len(words) else words


def _signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates per set, none of which is empty."""
    out = np.empty((len(sets), coordinates), np.uint32)
    for start, stop in slices(np.array([len(s) for s in sets], np.int64), _CHUNK):
        counts = np.array([len(s) for s in sets[start:stop]])
        # The first permutation is the hash's own; its upper half is the place on the circle.
        place = (np.concatenate(sets[start:stop]) >> np.uint64(32)).astype(np.uint32)
        begin, turned, room = np.cumsum(counts) - counts, np.empty_like(place), np.empty_like(place)
        for k in range(coordinates):
            np.add(place, np.uint32(k), out=turned)
            out[start:stop, k] = np.minimum.reduceat(_ordered(turned, room), begin)
    return out


def _band_keys(signatures: np.ndarray, banding: Banding) -> np.ndarray:
    """A 64-bit key per set and band."""
    parts = signatures.reshape(len(signatures), banding.bands, banding.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(banding.bands, dtype=np.uint64), parts.shape[:2])
    with np.errstate(over="ignore"):
        for i in range(banding.rows):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i] + np.uint64(1))
    return keys


_PRINT = "struct<n:long,id:binary,keys:array<long>,marks:binary>"


def _printed(column: pa.Array, banding: Banding) -> pa.StructArray:
    sets = _shingle_sets(column, banding.size)
    some = [i for i, s in enumerate(sets) if len(s)]
    signatures = _signatures([sets[i] for i in some], banding.coordinates)
    keys = _band_keys(signatures, banding).view(np.int64)
    of_text = np.full(len(sets), -1)
    of_text[some] = np.arange(len(some))
    offsets = np.concatenate([[0], np.cumsum(np.where(of_text >= 0, banding.bands, 0))]).astype(np.int32)
    marks = (signatures & np.uint32(255)).astype(np.uint8)
    return pa.StructArray.from_arrays(
        [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
            pa.array([marks[i].tobytes() if i >= 0 else None for i in of_text.tolist()], pa.binary()),
        ],
        ["n", "id", "keys", "marks"],
    )


def printed(text: Column, banding: Banding) -> Column:
    """A struct of a text's number of shingles, the id of its set, its band keys and a byte per coordinate."""

    @F.arrow_udf(_PRINT)
    def of(column: pa.Array) -> pa.Array:
        parts = [_printed(part, banding) for _, part in pieces(column, 2_000_000)]
        give_back()
        return pa.concat_arrays(parts) if parts else _printed(column, banding)

    return of(text)


def shingles(text: Column, size: int) -> Column:
    """A text's set of shingles, as an array of longs."""

    @F.arrow_udf("array<long>")
    def of(column: pa.Array) -> pa.Array:
        sets = [s for _, part in pieces(column, 2_000_000) for s in _shingle_sets(part, size)]
        give_back()
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return of(text)


def _alike(one: str, other: str, percent: int) -> Column:
    """Sets of these sizes can be links."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _agreeing(pairs: DataFrame, marks: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    met = pairs.join(marks.select(F.col("node").alias("a"), F.col("marks").alias("x")), "a")
    met = met.join(marks.select(F.col("node").alias("b"), F.col("marks").alias("y")), "b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_matrix(batch.column(i)) for i in (2, 3))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array((x == y).sum(axis=1) >= least)) for c in batch.columns[:2]], ["a", "b"]
            )

    return met.select("a", "b", "x", "y").mapInArrow(agree, "a long, b long")


def _matrix(marks: pa.Array) -> np.ndarray:
    rows = [m.as_buffer() for m in marks]
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1) if rows else np.zeros((0, 1), np.uint8)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough."""
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    met = met.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    sizes = F.size("x") + F.size("y")
    return met.select("a", "b", both.alias("both"), sizes.alias("sizes")).filter(
        f"100L * both >= {percent}L * (sizes - both)"
    ).select("a", "b")


def _left_over(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components among nodes of one band, but for those with its hub, which were tried.

    Nodes of one hub are dealt into blocks of bounded weight. Blocks that share a band meet once, with those of
    their nodes that share one, and are compared as a whole: so what moves is blocks, never pairs of nodes.
    """
    homes = members.groupBy("node").agg(F.min("hub").alias("home"), F.first("n").alias("n"))
    weights = homes.groupBy("home").agg(F.ceil(F.sum("n") / _BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    homes = homes.join(weights, "home").select("node", "n", F.xxhash64("home", part).alias("block"))
    rest = members.filter("node <> hub").select("key", "node").join(labels, "node")
    split = rest.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    rest = rest.join(split.filter("low <> high").select("key"), "key").join(homes, "node")
    held = rest.groupBy("key", "block").agg(
        F.collect_list("node").alias("nodes"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    held = stored(held, "minhash-blocks")
    one, other = (held.select("key", *[F.col(c).alias(f"{side}_{c}") for c in held.columns[1:]]) for side in "ab")
    # Blocks of one and the same component have nothing to add.
    apart = "NOT (a_low = a_high AND b_low = b_high AND a_low = b_low)"
    met = one.join(other, "key").filter("a_block <= b_block").filter(apart)
    sides = [
        met.select("a_block", "b_block", F.lit(i).alias("side"), F.explode(f"{s}_nodes").alias("node"))
        for i, s in enumerate("ab")
    ]
    asked = sides[0].unionByName(sides[1].filter("a_block <> b_block")).distinct()
    asked = stored(asked, "minhash-meetings")
    shown = asked.join(labels, "node").join(sets, "node")
    weight = asked.join(homes.select("node", "n"), "node").agg(F.sum("n")).first()[0] or 0
    lots = weight // _LOT + 1
    lot = F.pmod(F.xxhash64("a_block", "b_block"), F.lit(lots)).alias("lot")
    columns = [lot, "a_block", "b_block", "side", "node", "label", "items"]
    return shown.select(*columns).groupBy("lot").applyInArrow(_compare(percent), "a long, b long")


def _compare(percent: int) -> Callable[[pa.Table], pa.Table]:
    """The links between components that the meetings of a lot find, as many as they join at most."""

    def run(table: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("a_block", "b_block", "side", "node")]
        table = table.combine_chunks().sort_by(order).combine_chunks()
        blocks = [table[c].to_numpy() for c in ("a_block", "b_block")]
        sides, nodes, labels = (table[c].to_numpy() for c in ("side", "node", "label"))
        new = np.ones(len(nodes), bool)
        new[1:] = (np.diff(blocks[0]) != 0) | (np.diff(blocks[1]) != 0)
        stops = [*np.flatnonzero(new).tolist(), len(nodes)]
        found: list[tuple[int, int]] = []
        for start, stop in zip(stops, stops[1:]):
            lists = pa.concat_arrays(table["items"].slice(start, stop - start).chunks)
            counts = np.diff(lists.offsets.to_numpy())
            many = int((sides[start:stop] == 0).sum())
            across = many < stop - start
            both = _overlaps(lists.flatten().to_numpy(), counts, many if across else None)
            left, right = (counts[:many], counts[many:]) if across else (counts, counts)
            sizes = left[:, None] + right[None, :]
            x, y = np.nonzero(100 * both >= percent * (sizes - both))
            found += _joining(nodes, labels, start + x, start + y + (many if across else 0))
        give_back()
        return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate("ab")})

    return run


def _overlaps(flat: np.ndarray, counts: np.ndarray, many: int | None) -> np.ndarray:
    """How many items each of the first ``many`` sets shares with each of the others (None: all with all)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    _, item, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[item] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[item[shared]]
    rows = (len(counts), len(counts)) if many is None else (many, len(counts) - many)
    out = np.zeros(rows, np.int64)
    wide = int(column.max()) + 1 if len(column) else 0
    for start in range(0, wide, _COLUMNS):
        here = (column >= start) & (column < start + _COLUMNS)
        # Sums of ones below 2 ** 24 are exact.
        held = np.zeros((len(counts), min(_COLUMNS, wide - start)), np.float32)
        held[owner[here], column[here] - start] = 1
        out += (held @ held.T if many is None else held[:many] @ held[many:].T).astype(np.int64)
    return out


def _joining(nodes: np.ndarray, labels: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between places those that join components."""
    apart = labels[first] != labels[second]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    out = []
    for i, j in zip(first[apart].tolist(), second[apart].tolist()):
        one, other = root(int(labels[i])), root(int(labels[j]))
        if one != other:
            parent[other] = one
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", banding: Banding = Banding()
) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) per row of ``docs``.

    A text's set are its distinct shingles of ``size`` words, A-Z lower-cased; with fewer words all of
    them are one shingle, and a text without words, or a null, has none and is linked with nothing.
    Sets link at ``percent`` of intersection by union or more, confirmed on whole sets (of 64-bit hashes
    of the shingles). ``component_id`` is the smallest doc_id that can be reached over links; a null
    doc_id counts as larger than any, and if all of a component are null, so is its id. ``kept`` says that
    doc_id and component_id are equal, or both null. Rows of one doc_id are linked through their own
    texts. Other columns are not looked at. No rows give no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = only(docs, doc_id=doc_id, text=text).withColumn("t", F.xxhash64("text"))
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    prints = rows.select("row", "doc_id", "t", printed(F.col("text"), banding).alias("p"))
    prints = stored(prints.select("row", "doc_id", "t", "p.*"), "minhash-prints")
    nodes = prints.filter("n > 0").groupBy("id").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    nodes = stored(nodes, "minhash-nodes")
    own = prints.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    banded = own.select(F.explode("keys").alias("key"), F.col("row").alias("node"), "n")
    banded = stored(banded, "minhash-bands")
    hubs = banded.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("many"))
    hubs = hubs.filter("many > 1").select("key", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    members = stored(banded.join(hubs, "key"), "minhash-members")
    # Only texts that share a band are read again, for their sets.
    shared = members.select(F.col("node").alias("row")).distinct().join(prints, "row")
    wanted = shared.select(F.col("doc_id").alias("its_id"), F.col("t").alias("its_t"), F.col("row").alias("node"))
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("t") == F.col("its_t")))
    found = found.groupBy("node").agg(F.first("text").alias("text"))
    sets = stored(found.select("node", shingles(F.col("text"), banding.size).alias("items")), "minhash-sets")
    marks = stored(shared.select(F.col("row").alias("node"), "marks"), "minhash-marks")
    release(spark)

    fits = members.filter((F.col("node") != F.col("hub")) & _alike("n", "hub_n", banding.percent))
    first = fits.groupBy("node").agg(F.min("hub").alias("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = stored(_confirmed(_agreeing(first, marks, banding.least_agreement), sets, banding.percent), "minhash-links")
    graph = marks.select(F.col("node").alias("f"), F.col("node").alias("least"))

    def labels() -> DataFrame:
        now = smallest_reachable(spark, graph, links)
        return stored(now.select(F.col("f").alias("node"), F.col("least").alias("label")), "minhash-labels")

    now = labels()
    others = fits.select("node", "hub").distinct().join(now, "node")
    others = others.join(now.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub")
    others = others.filter("label <> hub_label").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    more = _confirmed(_agreeing(others, marks, banding.least_agreement), sets, banding.percent)
    links = stored(links.unionByName(more), "minhash-links")
    now = labels()
    links = stored(links.unionByName(_left_over(members, now, sets, banding.percent)), "minhash-links")
    release(spark)

    settled = smallest_reachable(spark, nodes.select(F.col("node").alias("f"), "least"), links)
    of_set = nodes.select("id", F.col("node").alias("f")).join(settled.select("f", F.col("least").alias("low")), "f")
    out = prints.select("doc_id", "n", "id").join(of_set.select("id", "low", F.lit(True).alias("linked")), "id", "left")
    component = F.when(F.col("linked"), F.col("low")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
