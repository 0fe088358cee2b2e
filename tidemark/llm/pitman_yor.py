"""A hierarchical Pitman-Yor language model, trained and applied in exchanges of packed blocks.

Each training word that precedes another has a restaurant, its customers being the words that
follow it; all of them share one parent, the restaurant of single words, over an even base. A word's
tables in the restaurants of its contexts are customers of the parent (with a higher ``least``, so are the
words behind rarer contexts). Seatings are sampled by Gibbs: contexts against the parent's last state, the
parent against the contexts' new tables, in turn, so that all restaurants of a level move at once.
Probabilities are averaged over the samples.

Who asks whom: groups of documents (a few megabytes), word buckets (counts, the parent) and context
buckets (the restaurants). Groups and buckets are rows with one packed block, every step is a written
table, and nothing is sent to the driver but sums. A context with many customers is split by its
followers; only its number of tables is exchanged between the parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import (
    by_bucket,
    byte_sizes,
    distinct,
    give_back,
    mixed,
    numbers,
    pack,
    planes,
    slices,
    spread,
    sums_between,
    texts,
    unpack,
    words_of,
)
from tidemark.llm.blocks import text_bytes
from tidemark.llm.common import bounded_batches, release
from tidemark.llm.seating import Seating, some_sizes
from tidemark.sources.shared import scratch

#: Training occurrences from which a word has a restaurant of its own: every training word has one.
LEAST_CONTEXT = 1
#: Rounds of sampling, how many of the first are not averaged, and how often in a round a context's dishes draw
#: their tables. The parent's dishes do not wait for each other: one draw is all.
ROUNDS, BURN_IN, STEPS = 3, 1, 3
CONCENTRATION = 1.0
#: Of the parent; that of the contexts follows from how many pairs occur once and twice.
PARENT_DISCOUNT = 0.8
_GROUP_BYTES, _WORD_BYTES, _CONTEXT_BYTES = 4 * 2**20, 16 * 2**20, 10 * 2**20
#: Customers from which a context is split, and roughly of one part.
_PART = 1_000_000
_END, _START = 1, -2
#: How hard blocks of many small numbers are packed: what is shuffled and stored is mostly these.
_LEVEL = 6
_MESSAGE = "kind string, key long, src long, block binary, x double, y double"
Rows = list[tuple[str, int, int, bytes | None, float, float]]


@dataclass(frozen=True)
class Sizes:
    """Word buckets, context buckets, and the least occurrences of a context."""

    words: int
    contexts: int
    least: int


def _table(rows: Rows) -> pa.Table:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in _MESSAGE.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


class _Tables:
    """Each step's rows, written once below one folder; a kind of rows is read by itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.where = spark, scratch(spark, "pitman-yor"), {}

    def write(self, step: str, rows: DataFrame) -> None:
        release(self.spark)
        rows.write.partitionBy("kind").mode("overwrite").parquet(f"{self.root}/{step}")
        self.where[step] = f"{self.root}/{step}"

    def drop(self, step: str, *kinds: str) -> None:
        """Remove rows that no later step reads."""
        context = self.spark.sparkContext
        for kind in kinds:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.where[step]}/kind={kind}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, step: str, kind: str) -> DataFrame:
        table = self.spark.read.schema(_MESSAGE).parquet(self.where[step])
        return table.filter(F.col("kind") == kind)

    def sums(self, step: str) -> tuple[float, float]:
        zero = F.lit(0.0)
        return tuple(self.read(step, "sum").agg(F.coalesce(F.sum("x"), zero), F.coalesce(F.sum("y"), zero)).first())


def _step(rows: DataFrame, function: Callable[[int, dict[str, list[tuple]]], Rows]) -> DataFrame:
    """Run ``function`` on all rows of a key, by kind: (src, block, x, y), ordered by src."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found: dict[str, list[tuple]] = {}
        columns = [table[c].to_pylist() for c in ("kind", "src", "block", "x", "y")]
        for kind, src, block, x, y in sorted(zip(*columns, strict=True), key=lambda r: r[:2]):
            found.setdefault(kind, []).append((src, block, x, y))
        rows = function(key[0].as_py(), found)
        found.clear()
        give_back()
        return _table(rows)

    return rows.groupBy("key").applyInArrow(run, _MESSAGE)


def _union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# Groups


@dataclass
class Group:
    """Documents of a group: ids, whether they train, words each, and words as numbers in the group's list.

    The list is sorted by word bucket; bucket b has the numbers bounds[b] to bounds[b + 1]. Number
    ``end`` ends a document.
    """

    ids: np.ndarray
    absent: np.ndarray
    trains: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray
    end: int

    def block(self) -> bytes:
        flags = self.trains.astype(np.uint8) + 2 * self.absent.astype(np.uint8)
        codes = planes(self.codes)
        end = np.array([self.end], np.int64)
        return pack(self.ids, flags, self.counts, codes, self.bounds, end, level=5)

    @classmethod
    def of(cls, block: bytes) -> Group:
        kinds = (np.int64, np.uint8, np.int64, None, np.int64, np.int64)
        ids, flags, counts, codes, bounds, end = unpack(block, *kinds)
        return cls(ids, flags & 2 > 0, flags & 1 > 0, counts, numbers(codes), bounds, int(end[0]))

    def stream(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, the word ahead of each (``_START`` for none), where documents begin, which tokens train."""
        size = self.counts + 1
        at = np.concatenate([[0], np.cumsum(size)])
        tokens = np.full(at[-1], self.end, np.int64)
        tokens[spread(at[:-1], self.counts)] = self.codes
        before = np.concatenate([[_START], tokens[:-1]])
        before[at[:-1]] = _START
        return tokens, before, at, np.repeat(self.trains, size)


def _trains(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


def _group(ids: pa.Array, column: pa.Array, sizes: Sizes) -> tuple[Group, np.ndarray, np.ndarray]:
    """A group, its words' hashes and how often each occurs in training."""
    words = words_of(column)
    lowered: dict[bytes, int] = {}
    raw = words.distinct.cast(pa.binary()).to_pylist()
    # bytes.lower() changes A-Z only
    place = np.array([lowered.setdefault(w.lower(), len(lowered)) for w in raw], np.int64)
    hashes = np.array([_END, *map(xxhash.xxh64_intdigest, lowered)], np.uint64)
    bucket = (hashes % np.uint64(sizes.words)).astype(np.int64)
    order, bounds = by_bucket(bucket, sizes.words)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    listed = ids.to_pylist()
    group = Group(
        ids=np.array([0 if i is None else i for i in listed], np.int64),
        absent=np.array([i is None for i in listed], bool),
        trains=np.array([_trains(i) for i in listed], bool),
        counts=np.diff(words.at),
        codes=number[place[words.codes] + 1] if len(raw) else np.zeros(0, np.int64),
        bounds=bounds,
        end=int(number[0]),
    )
    tokens, _, _, trains = group.stream()
    return group, hashes[order], np.bincount(tokens[trains], minlength=len(hashes))


def _asks_words(sizes: Sizes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ids, column = table["id"].combine_chunks(), texts(table["text"].combine_chunks())
            for first, last in slices(byte_sizes(column), 2 * _GROUP_BYTES):
                # A group's rows are written by the one task that makes it, so any number of its own will do.
                g = TaskContext.get().partitionId() << 32 | made
                made += 1
                group, hashes, n = _group(ids.slice(first, last - first), column.slice(first, last - first), sizes)
                rows: Rows = [("group", g, 0, group.block(), float(group.trains.sum()), 0.0)]
                for b in np.flatnonzero(np.diff(group.bounds)).tolist():
                    part = slice(group.bounds[b], group.bounds[b + 1])
                    rows.append(("words", b, g, pack(hashes[part], planes(n[part])), 0.0, 0.0))
                rows.append(("sum", 0, 0, None, float(group.trains.sum()), 0.0))
                yield from _table(rows).to_batches()
                give_back()

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= _GROUP_BYTES:
                yield from flush()
        if held:
            yield from flush()

    return run


def _count_words(bucket: int, found: dict[str, list[tuple]]) -> Rows:
    """A word bucket: to each group the place (or -1) and training count of each of its words."""
    asks = [(g, *unpack(block, np.uint64, None)) for g, block, _, _ in found["words"]]
    hashes = np.concatenate([h for _, h, _ in asks])
    counts = np.concatenate([numbers(n) for _, _, n in asks])
    words, which = np.unique(hashes, return_inverse=True)
    total = np.bincount(which, counts, minlength=len(words)).astype(np.int64)
    # Frequent words have small numbers, which pack better.
    order = np.argsort(-total, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    known = int((total > 0).sum())
    place[total == 0] = -1
    rows: Rows = [("size", bucket, 0, None, float(known), 0.0), ("sum", 0, 0, None, float(total.sum()), float(known))]
    start = 0
    for g, h, _ in asks:
        mine = which[start : start + len(h)]
        start += len(h)
        rows.append(("word", g, bucket, pack(planes(place[mine]), planes(total[mine]), level=_LEVEL), 0.0, 0.0))
    return rows


@dataclass
class Pairs:
    """The distinct pairs of a group that its documents need, in the order in which they are asked.

    Entry e is a context ``u`` and a follower ``w`` (-1: the context alone), both numbered over all
    buckets. ``entry_of`` gives each token's pair, ``context_of`` its context alone, -1 where none.
    """

    u: np.ndarray
    w: np.ndarray
    n: np.ndarray
    customers: np.ndarray
    bounds: np.ndarray
    entry_of: np.ndarray
    context_of: np.ndarray
    direct: np.ndarray


def _word_numbers(group: Group, answers: list[tuple], sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    number, count = np.full(group.bounds[-1], -1, np.int64), np.zeros(group.bounds[-1], np.int64)
    for b, block, _, _ in answers:
        place, total = map(numbers, unpack(block, None, None))
        part = slice(group.bounds[b], group.bounds[b + 1])
        number[part] = np.where(place >= 0, place * sizes.words + b, -1)
        count[part] = total
    return number, count


def _pairs(group: Group, number: np.ndarray, count: np.ndarray, documents: int, sizes: Sizes) -> Pairs:
    tokens, before, _, trains = group.stream()
    served = (before == _START) | (count[before] >= sizes.least)
    known = number[tokens] >= 0
    has_pair = served & known
    words = len(number)
    bits = 2 * (words + 1).bit_length()
    # The context alone has the follower ``words``; the start is the context ``words``.
    key = np.where(before == _START, words, before) * (words + 1)
    pairs, which = distinct(key[has_pair] + tokens[has_pair], bits)
    n = np.bincount(which, trains[has_pair], minlength=len(pairs)).astype(np.int64)
    contexts, context = distinct(key[served] + words, bits)
    every = np.concatenate([pairs, contexts])
    n = np.concatenate([n, np.zeros(len(contexts), np.int64)])
    u_local, w_local = every // (words + 1), every % (words + 1)
    u = np.append(number, _START)[u_local]
    w = np.append(number, -1)[w_local]
    customers = np.append(count, documents)[u_local]
    parts = customers // _PART + 1
    part = np.where(w < 0, 0, mixed(w.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
    spot = mixed(mixed(u.view(np.uint64)) + part.astype(np.uint64))
    order, bounds = by_bucket((spot % np.uint64(sizes.contexts)).astype(np.int64), sizes.contexts)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    entry_of, context_of = np.full(len(tokens), -1, np.int64), np.full(len(tokens), -1, np.int64)
    entry_of[has_pair] = place[which]
    context_of[served] = place[len(pairs) + context]
    direct = np.bincount(tokens[trains & ~served], minlength=words)
    return Pairs(u[order], w[order], n[order], customers[order], bounds, entry_of, context_of, direct)


def _asks_pairs(documents: int, sizes: Sizes) -> Callable[[int, dict[str, list[tuple]]], Rows]:
    def run(g: int, found: dict[str, list[tuple]]) -> Rows:
        group = Group.of(found["group"][0][1])
        number, count = _word_numbers(group, found["word"], sizes)
        pairs = _pairs(group, number, count, documents, sizes)
        rows: Rows = []
        for b in np.flatnonzero(np.diff(pairs.bounds)).tolist():
            part = slice(pairs.bounds[b], pairs.bounds[b + 1])
            block = pack(*[planes(x[part]) for x in (pairs.u, pairs.w, pairs.n, pairs.customers)], level=_LEVEL)
            rows.append(("pairs", b, g, block, 0.0, 0.0))
        some = np.flatnonzero(pairs.direct)
        spot = number[some]
        for b in np.unique(spot % sizes.words).tolist():
            mine = spot % sizes.words == b
            block = pack(planes(spot[mine] // sizes.words), planes(pairs.direct[some[mine]]))
            rows.append(("direct", b, g, block, 0.0, 0.0))
        return rows

    return run


# Context buckets


@dataclass
class Contexts:
    """The restaurants of a bucket: distinct contexts, and the pairs that occur twice or more, with their tables.

    ``singles`` counts a context's pairs that occur once. They have one table each, whatever happens, so
    they are kept apart and not looked at in the rounds.
    """

    u: np.ndarray
    customers: np.ndarray
    singles: np.ndarray
    shared: np.ndarray
    owner: np.ndarray
    w: np.ndarray
    n: np.ndarray
    table_sum: np.ndarray
    tables: np.ndarray
    weights: list[np.ndarray]

    @property
    def owners(self) -> np.ndarray:
        return some_sizes(self.n, self.tables)[0]

    @property
    def sizes(self) -> np.ndarray:
        return some_sizes(self.n, self.tables)[1]

    def block(self) -> bytes:
        shown = (self.u, self.customers, self.singles, self.shared, self.owner, self.w, self.n)
        shown += (self.table_sum, self.tables)
        return pack(*map(planes, shown), np.concatenate([np.zeros(0), *self.weights]), level=_LEVEL)

    @classmethod
    def of(cls, block: bytes) -> Contexts:
        *raw, weights = unpack(block, *[None] * 9, np.float64)
        parts = [numbers(r) for r in raw]
        many = len(weights) // max(1, len(parts[0]))
        return cls(*parts, [weights[i * len(parts[0]) : (i + 1) * len(parts[0])] for i in range(many)])


def _open(bucket: int, found: dict[str, list[tuple]], sizes: Sizes) -> Rows:
    """A context bucket: sum the pairs, one table each, and tell the word buckets."""
    asks = [[numbers(x) for x in unpack(block, *[None] * 4)] for _, block, _, _ in found["pairs"]]
    u, w, n, customers = (np.concatenate(c) for c in zip(*asks, strict=True))
    contexts, owner = distinct(u - _START, int(u.max() - _START).bit_length())
    own = np.zeros(len(contexts), np.int64)
    own[owner] = customers
    width = int(w.max() + 1).bit_length()
    pairs, which = distinct(owner << width | (w + 1), width + len(contexts).bit_length())
    n = np.bincount(which, n, minlength=len(pairs)).astype(np.int64)
    # Contexts alone, and pairs that only held-out documents have, have no customers.
    once, several = pairs[n == 1], np.flatnonzero(n > 1)
    owner, w = pairs >> width, (pairs & ((1 << width) - 1)) - 1
    singles = np.bincount(once >> width, minlength=len(contexts))
    none = np.zeros(0, np.int64)
    state = Contexts(
        contexts + _START, own, singles, own // _PART, owner[several], w[several], n[several], none, none, []
    )
    state.table_sum, state.tables = np.zeros(len(several), np.int64), np.ones(len(several), np.int64)
    rows: Rows = [("state", bucket, 0, state.block(), 0.0, 0.0)]
    rows.append(("once", bucket, 0, pack(planes(owner[n == 1]), planes(w[n == 1]), level=_LEVEL), 0.0, 0.0))
    rows.append(("sum", 0, 0, None, float(len(once)), float((n == 2).sum())))
    tables = singles + np.bincount(state.owner, minlength=len(contexts))
    for i in np.flatnonzero(state.shared).tolist():
        rows.append(("split", int(state.u[i]), bucket, None, float(tables[i]), 0.0))
    # Words by bucket: how many single pairs a word has, and which words have pairs that can move.
    counted = [np.unique(x, return_counts=True) for x in (w[n == 1], state.w)]
    for b in range(sizes.words):
        mine = [(x[at] // sizes.words, many[at]) for x, many in counted for at in [x % sizes.words == b]]
        if len(mine[0][0]) or len(mine[1][0]):
            rows.append(("tables", b, bucket, pack(*[planes(x) for pair in mine for x in pair], level=_LEVEL), 0.0, 0.0))
    return rows


@dataclass(frozen=True)
class Level:
    """What the contexts know of the parent: its sums, the base and both discounts."""

    tables: float
    customers: float
    base: float
    parent_discount: float
    discount: float

    def probability(self, own: np.ndarray) -> np.ndarray:
        """Of words whose customers less discounted tables are ``own``."""
        backed = (CONCENTRATION + self.parent_discount * self.tables) * self.base
        return (own + backed) / (CONCENTRATION + self.customers)


def _seat(bucket: int, found: dict[str, list[tuple]], level: Level, turn: int, sizes: Sizes) -> Rows:
    """A round in a context bucket, given what the parent says of each word that can move."""
    state = Contexts.of(found["state"][0][1])
    owner, words, contexts = state.owner, state.w, len(state.u)
    probability = np.zeros(len(words))
    lists = {}
    of_bucket = words % sizes.words
    for b, block, _, _ in found.get("parent", []):
        mine = np.flatnonzero(of_bucket == b)
        moving, which = np.unique(words[mine] // sizes.words, return_inverse=True)
        probability[mine] = level.probability(unpack(block, np.float64)[0])[which]
        lists[b] = (mine, which, len(moving))
    # Tables of single pairs, and those of a split context in other buckets.
    fixed = state.singles.astype(float)
    for u, _, everywhere, here in found.get("elsewhere", []):
        fixed[np.searchsorted(state.u, u)] += everywhere - here

    def strength(tables: np.ndarray) -> np.ndarray:
        all_tables = fixed + np.bincount(owner, tables, minlength=contexts)
        return (CONCENTRATION + level.discount * all_tables[owner]) * probability

    rng, step = np.random.default_rng([turn, bucket]), level.discount * probability
    seating = Seating(state.n, level.discount, strength, rng, state.tables, step)
    seating.sweep(STEPS)
    state.tables = seating.tables
    moving = np.bincount(owner, seating.tables, minlength=contexts)
    if turn > BURN_IN:
        state.table_sum = state.table_sum + seating.tables
        weight = (CONCENTRATION + level.discount * (fixed + moving)) / (CONCENTRATION + state.customers)
        state.weights.append(weight)
    rows: Rows = [("state", bucket, 0, state.block(), 0.0, 0.0)]
    for b, (mine, which, many) in lists.items():
        moved = np.bincount(which, seating.tables[mine], minlength=many).astype(np.int64)
        rows.append(("moved", b, bucket, pack(planes(moved)), 0.0, 0.0))
    for i in np.flatnonzero(state.shared).tolist():
        rows.append(("split", int(state.u[i]), bucket, None, float(state.singles[i] + moving[i]), 0.0))
    return rows


def _answer_pairs(bucket: int, found: dict[str, list[tuple]]) -> Rows:
    """To each group what its pairs have here, and its contexts' weights of the parent.

    Of a pair the customers, and if they are several the sum of its tables over the samples: small
    numbers that pack well, from which the group works out the pair's own share.
    """
    state = Contexts.of(found["state"][0][1])
    single_owner, single_w = map(numbers, unpack(found["once"][0][1], None, None))
    none = np.zeros(len(single_w), np.int64)
    keys = np.concatenate([state.owner, single_owner]) << 40 | np.concatenate([state.w, single_w])
    order = np.argsort(keys)
    keys = keys[order]
    customers = np.concatenate([state.n, none + 1])[order]
    tables = np.concatenate([state.table_sum, none])[order]
    rows: Rows = []
    for g, block, _, _ in found["pairs"]:
        u, w, _, _ = map(numbers, unpack(block, *[None] * 4))
        owner = np.searchsorted(state.u, u)
        alone = w < 0
        wanted = owner << 40 | np.maximum(w, 0)
        n = np.zeros(len(u), np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = (keys[at] == wanted) & ~alone
            n[hit] = customers[at[hit]]
            moving = tables[at[n > 1]]
        else:
            moving = n[:0]
        weights = [x[owner[alone]].astype(np.float32) for x in state.weights]
        rows.append(("pair", g, bucket, pack(planes(n), planes(moving), *weights, level=_LEVEL), 0.0, 0.0))
    return rows


# Word buckets: the parent


def _parent(bucket: int, found: dict[str, list[tuple]], level: Level, turn: int) -> Rows:
    """Seat the customers a word has from its contexts' tables and from rare contexts."""
    known = int(found["size"][0][2])
    customers = np.zeros(known, np.int64)
    for _, block, _, _ in found.get("direct", []):
        place, n = map(numbers, unpack(block, None, None))
        customers[place] += n
    moved = {src: numbers(unpack(block, None)[0]) for src, block, _, _ in found.get("moved", [])}
    asked = []
    for src, block, _, _ in found.get("tables", []):
        single, alone, moving, pairs = map(numbers, unpack(block, *[None] * 4))
        customers[single] += alone
        customers[moving] += moved.get(src, pairs)
        asked.append((src, moving))
    backed = (CONCENTRATION + level.parent_discount * level.tables) * level.base
    rng = np.random.default_rng([turn, bucket, 1])
    seating = Seating(customers, level.parent_discount, lambda t: np.full(len(t), backed), rng)
    seating.sweep(1)
    own = customers - level.parent_discount * seating.tables
    rows: Rows = [("sum", 0, 0, None, float(seating.tables.sum()), float(customers.sum()))]
    rows += [("parent", src, bucket, pack(own[moving]), 0.0, 0.0) for src, moving in asked if len(moving)]
    if turn > BURN_IN:
        rows.append(("own", bucket, turn, pack(planes(customers), planes(seating.tables)), 0.0, 0.0))
    return rows


def _answer_words(bucket: int, found: dict[str, list[tuple]]) -> Rows:
    """To each group what the parent has of each of its words: customers and tables, for each sample."""
    samples = [np.append(numbers(x), 0) for _, block, _, _ in found["own"] for x in unpack(block, None, None)]
    rows: Rows = []
    for g, block, _, _ in found["word"]:
        # A word that no training document has is at place -1, where there is nothing.
        place = numbers(unpack(block, None, None)[0])
        rows.append(("parent", g, bucket, pack(*[planes(s[place]) for s in samples]), 0.0, 0.0))
    return rows


def _score(model: Model) -> Callable[[pa.Table, pa.Table], pa.Table]:
    samples, discount, documents, sizes = ROUNDS - BURN_IN, model.discount, model.documents, model.sizes
    train_tokens, train_words, levels = model.train_tokens, model.train_words, list(model.levels.values())

    def run(records: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[str, list[tuple]] = {}
        for kind, src, block in zip(*[answers[c].to_pylist() for c in ("kind", "src", "block")], strict=True):
            found.setdefault(kind, []).append((src, block, 0.0, 0.0))
        parts = []
        for record in records["block"].to_pylist():
            group = Group.of(record)
            number, count = _word_numbers(group, found["word"], sizes)
            pairs = _pairs(group, number, count, documents, sizes)
            tokens, _, at, _ = group.stream()
            parent = np.zeros((samples, len(number)))
            for b, block, _, _ in found["parent"]:
                raw = [numbers(x) for x in unpack(block, *[None] * 2 * samples)]
                for i, level in enumerate(levels):
                    own = raw[2 * i] - level.parent_discount * raw[2 * i + 1]
                    parent[i, group.bounds[b] : group.bounds[b + 1]] = level.probability(own)
            own, weights = np.zeros(len(pairs.u) + 1), np.zeros((samples, len(pairs.u) + 1))
            for b, block, _, _ in found.get("pair", []):
                part = np.arange(pairs.bounds[b], pairs.bounds[b + 1])
                seen, moving, *lists = unpack(block, None, None, *[np.float32] * samples)
                customers = numbers(seen)
                tables = (customers > 0).astype(float)
                tables[customers > 1] = numbers(moving) / samples
                own[part] = (customers - discount * tables) / (CONCENTRATION + pairs.customers[part])
                weights[:, part[pairs.w[part] < 0]] = lists
            # Without a restaurant, all weight is the parent's.
            weights[:, -1] = 1.0
            p = own[pairs.entry_of] + (weights[:, pairs.context_of] * parent[:, tokens]).mean(axis=0)
            base = np.log10((count[tokens] + 1) / (train_tokens + train_words + 1))
            give_back()
            parts.append(
                pa.table(
                    {
                        "doc_id": pa.array(group.ids, mask=group.absent),
                        "held_out": pa.array(~group.trains),
                        "n_tokens": pa.array(group.counts + 1),
                        "n_known": pa.array(sums_between(count[tokens] > 0, at)),
                        "train_tokens": pa.array(np.full(len(group.ids), train_tokens)),
                        "base_score": pa.array(sums_between(base, at).astype(float)),
                        "score": pa.array(sums_between(np.log10(p), at).astype(float)),
                    }
                )
            )
        return pa.concat_tables(parts)

    return run


_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _discount(ones: float, twos: float) -> float:
    """From how many pairs occur once and twice, kept within (0, 1)."""
    return min(0.95, max(0.05, ones / max(1.0, ones + 2 * twos)))


@dataclass
class Model:
    """A trained model: its written steps, its sums, and the parent's state in each averaged round."""

    tables: _Tables
    sizes: Sizes
    documents: int
    train_tokens: int
    train_words: int
    levels: dict[int, Level]

    @property
    def discount(self) -> float:
        return next(iter(self.levels.values())).discount


def trained(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_CONTEXT) -> Model:
    """Seat the training documents of ``docs``; all documents are packed on the way, for the scores."""
    spark = docs.sparkSession
    bounded_batches(spark)
    total = text_bytes(docs, text)
    sizes = Sizes(max(1, -(-total // _WORD_BYTES)), max(1, -(-total // _CONTEXT_BYTES)), least)
    tables = _Tables(spark)
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    tables.write("groups", narrow.mapInArrow(_asks_words(sizes), _MESSAGE))
    documents = int(tables.sums("groups")[0])
    tables.write("counts", _step(tables.read("groups", "words"), _count_words))
    tables.drop("groups", "words")
    train_tokens, train_words = map(int, tables.sums("counts"))
    words = _union(tables.read("groups", "group"), tables.read("counts", "word"))
    tables.write("pairs", _step(words, _asks_pairs(documents, sizes)))
    tables.write("contexts-0", _step(tables.read("pairs", "pairs"), lambda b, found: _open(b, found, sizes)))
    discount = _discount(*tables.sums("contexts-0"))
    # The parent's tables are not known before it is seated: one per word to begin with.
    level = Level(train_words, 0.0, 1.0 / (train_words + 1), PARENT_DISCOUNT, discount)
    fixed = [tables.read("counts", "size"), tables.read("pairs", "direct"), tables.read("contexts-0", "tables")]
    levels: dict[int, Level] = {}
    for turn in range(ROUNDS + 1):
        moved = [tables.read(f"contexts-{turn}", "moved")] if turn else []
        tables.write(f"parent-{turn}", _step(_union(*fixed, *moved), _parent_at(level, turn)))
        seated, customers = tables.sums(f"parent-{turn}")
        level = Level(seated, customers, level.base, level.parent_discount, discount)
        if turn:
            tables.drop(f"contexts-{turn}", "moved")
        if turn > BURN_IN:
            levels[turn] = level
        if turn < ROUNDS:
            rows = _union(
                tables.read(f"contexts-{turn}", "state"),
                tables.read(f"parent-{turn}", "parent"),
                _elsewhere(tables.read(f"contexts-{turn}", "split")),
            )
            tables.write(f"contexts-{turn + 1}", _step(rows, _seat_at(level, turn + 1, sizes)))
            tables.drop(f"contexts-{turn}", "state", "split")
        tables.drop(f"parent-{turn}", "parent")
    return Model(tables, sizes, documents, train_tokens, train_words, levels)


def _parent_at(level: Level, turn: int) -> Callable[[int, dict[str, list[tuple]]], Rows]:
    return lambda bucket, found: _parent(bucket, found, level, turn)


def _seat_at(level: Level, turn: int, sizes: Sizes) -> Callable[[int, dict[str, list[tuple]]], Rows]:
    return lambda bucket, found: _seat(bucket, found, level, turn, sizes)


def _elsewhere(split: DataFrame) -> DataFrame:
    """To each bucket that has a part of a context: the context's tables in all parts, and its own."""
    everywhere = split.groupBy("key").agg(F.sum("x").alias("all"))
    return split.join(everywhere, "key").select(
        F.lit("elsewhere").alias("kind"),
        F.col("src").alias("key"),
        F.col("key").alias("src"),
        "block",
        F.col("all").alias("x"),
        F.col("x").alias("y"),
    )


def scores(model: Model, last: bool = False) -> DataFrame:
    """The documents that the model was given, each with its log10 probability.

    ``last``: the model is not asked again, so what only its answers are made of is removed once they are written.
    """
    tables = model.tables
    if last:
        tables.drop("pairs", "direct")
        tables.drop("contexts-0", "tables")
    words = tables.read("counts", "word")
    by_bucket = words.select("kind", F.col("src").alias("key"), F.col("key").alias("src"), "block", "x", "y")
    own = [tables.read(f"parent-{turn}", "own") for turn in model.levels]
    parents = _step(_union(by_bucket, *own), _answer_words)
    asked = _union(
        tables.read("pairs", "pairs"), tables.read("contexts-0", "once"), tables.read(f"contexts-{ROUNDS}", "state")
    )
    # Written, so that the pairs are no longer in any shuffle when the groups are.
    tables.write("shares", _step(asked, _answer_pairs))
    if last:
        tables.drop("pairs", "pairs")
        tables.drop("contexts-0", "once")
        tables.drop(f"contexts-{ROUNDS}", "state")
    release(tables.spark)
    groups = tables.read("groups", "group")
    run = _score(model)
    answers = _union(words, parents, tables.read("shares", "pair"))
    return groups.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(run, _SCHEMA)


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_CONTEXT) -> DataFrame:
    """One row per document: its log10 probability by the model, and by counts of single words.

    Documents train the model unless crc32 of their doc_id as text (a null one: empty) leaves 2 when
    divided by 7; all are scored, whole. Tokens are words with A-Z lower-cased, and one end per
    document; a null or empty text is an end alone. A word that no training document has gets the
    base's share, like any one word of ``V + 1``. Rows that share a doc_id are documents of their
    own. Words are told apart by 64 bits of a hash. Without rows there are none.
    """
    return scores(trained(docs, doc_id, text, least), last=True)
