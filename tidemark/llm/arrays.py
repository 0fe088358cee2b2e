"""Arrays inside tasks: words of an Arrow column, rolling hashes, sliding minima, packed blocks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

_LIBC = ctypes.CDLL(None)
#: Odd, so that it has an inverse modulo 2**64.
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for other tasks, and its share of the executor is small."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(_LIBC, "malloc_trim", None):
        trim(0)


def texts(column: pa.Array) -> pa.Array:
    """The column without nulls: a null text counts as an empty one."""
    return pc.fill_null(column, "")


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to ``most`` at most; a larger row is alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def byte_sizes(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def pieces(column: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """The column in parts of ``most`` bytes, each with the number of its first row."""
    column = texts(column)
    for start, stop in slices(byte_sizes(column), most):
        yield start, column.slice(start, stop - start)


@dataclass
class Words:
    """The words of several texts: ``codes`` points into ``distinct``; text i has codes[at[i]:at[i + 1]]."""

    codes: np.ndarray
    at: np.ndarray
    distinct: pa.Array

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per distinct word."""
        found = [xxhash.xxh64_intdigest(w) for w in self.distinct.cast(pa.binary()).to_pylist()]
        return np.array(found, np.uint64)


def words_of(column: pa.Array) -> Words:
    """Maximal runs without space, tab, line feed, vertical tab, form feed, carriage return."""
    split = pc.ascii_split_whitespace(texts(column))
    flat, at = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    at = at - at[0] if len(at) else np.zeros(1, np.int64)
    # A text that starts or ends with white space has an empty first or last part.
    real = byte_sizes(flat) > 0
    if not real.all():
        at = np.concatenate([[0], np.cumsum(real)])[at]
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(codes, at, coded.dictionary)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hashes of all runs of n values, for any n, from one prefix sum modulo 2**64."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        forth = np.full(n, _STEP, np.uint64)
        back = np.full(n, _STEP_BACK, np.uint64)
        if n:
            forth[0] = back[0] = 1
        with np.errstate(over="ignore"):
            forth, self.back = np.cumprod(forth), np.cumprod(back)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * forth)])

    def of(self, n: int) -> np.ndarray:
        count = max(0, len(self.sums) - n)
        return mixed((self.sums[n : n + count] - self.sums[:count]) * self.back[:count])


def distinct(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (of so many bits, not negative) and where each one is among them.

    A key and its place fit into one number, if at all, and numbers sort much faster than places do.
    """
    room = max(1, len(keys).bit_length())
    if bits + room > 63:
        return np.unique(keys, return_inverse=True)
    both = np.sort(keys << room | np.arange(len(keys)))
    ranked = both >> room
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(keys), np.int64)
    which[both & ((1 << room) - 1)] = np.cumsum(new) - 1
    return ranked[new], which


def by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket that keeps the order inside each, and where each bucket begins and ends."""
    small = bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket
    order = np.argsort(small, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one after another."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def covered(starts: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the ranges."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1]
    change = change - np.bincount(starts + length, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def sums_between(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i]:at[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


class Places:
    """Where each of many distinct numbers (not negative) stands: an open hash table, filled to a quarter at most."""

    def __init__(self, table: np.ndarray):
        self.table, self.shift = table, np.uint64(64 - (len(table).bit_length() - 1))

    @classmethod
    def build(cls, numbers: np.ndarray) -> Places:
        size = 1 << max(4, (4 * len(numbers)).bit_length())
        out = cls(np.full(size, -1, np.int64))
        left = np.arange(len(numbers))
        slot = out._slot(numbers)
        while len(left):
            free = out.table[slot[left]] < 0
            # Of several for one slot the last one written stays.
            out.table[slot[left[free]]] = left[free]
            left = left[out.table[slot[left]] != left]
            slot[left] = (slot[left] + 1) & (size - 1)
        return out

    def _slot(self, numbers: np.ndarray) -> np.ndarray:
        return ((numbers.astype(np.uint64) * np.uint64(_STEP)) >> self.shift).astype(np.int64)

    def of(self, wanted: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The place of each among ``numbers``, which the table was built of, or -1."""
        slot = self._slot(wanted)
        out = self.table[slot]
        missed = np.flatnonzero((out >= 0) & (numbers[out] != wanted)) if len(numbers) else np.zeros(0, np.int64)
        while len(missed):
            slot[missed] = (slot[missed] + 1) & (len(self.table) - 1)
            out[missed] = self.table[slot[missed]]
            missed = missed[(out[missed] >= 0) & (numbers[out[missed]] != wanted[missed])]
        return out


def planes(x: np.ndarray) -> bytes:
    """Numbers as the columns of their bytes: the upper ones are mostly zero and compress away."""
    return np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def numbers(raw: bytes) -> np.ndarray:
    """What ``planes`` was given."""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8")[:, 0]


def pack(*parts: np.ndarray | bytes, level: int = 1) -> bytes:
    """Arrays and strings as one compressed string."""
    raw = [p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts]
    head = np.array([len(raw), *map(len, raw)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(raw))


def unpack(block: bytes, *types: type | None) -> list[np.ndarray | bytes]:
    """What ``pack`` was given; None stands for a string."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    stops = 8 + 8 * n + np.cumsum(sizes)
    parts = zip(stops - sizes, stops, types, strict=True)
    return [raw[a:b] if kind is None else np.frombuffer(raw[a:b], kind).copy() for a, b, kind in parts]
