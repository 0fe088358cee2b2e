"""Fill-in-middle: texts cut in three and put together in another order, eight bytes at a time.

A batch of texts is one run of bytes read as 64-bit words. Arithmetic on whole words marks the bytes
that end a unit (a run of letters, or any other single code point); the marks are counted per word
and summed up, so a cut behind the k-th unit is a search in the sums for its word and a select of
one mark inside the word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import give_back, pieces
from tidemark.llm.common import bounded_batches, replaced

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKERS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())

_EVERY = 0x0101010101010101
_HIGH = np.uint64(0x80 * _EVERY)
_LOW7 = np.uint64(0x7F * _EVERY)
_CASE = np.uint64(0x20 * _EVERY)
_FROM_A = np.uint64((0x80 - ord("a")) * _EVERY)
_PAST_Z = np.uint64((0x7F - ord("z")) * _EVERY)
_BYTE, _TOP = np.uint64(8), np.uint64(56)
_ONE = np.uint64(1)


@dataclass(frozen=True)
class Shares:
    """Of a hundred documents so many stay plain, and of the others so many have the suffix first."""

    plain: int = 10
    suffix_first: int = 20


def _letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is an ASCII letter; no sum carries into the next byte."""
    folded = (words & _LOW7) | _CASE
    return (folded + _FROM_A) & ~(folded + _PAST_Z) & ~words & _HIGH


def _following(marks: np.ndarray) -> np.ndarray:
    """The mark of each byte's next byte."""
    out = marks >> _BYTE
    out[:-1] |= marks[1:] << _TOP
    return out


class Marks:
    """Marked bytes: how many lie ahead of a byte, and where the n-th one is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.sums = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def ahead(self, place: np.ndarray) -> np.ndarray:
        word, inside = place >> 3, (place & 7).astype(np.uint64)
        below = (_ONE << (inside * _BYTE)) - _ONE
        last = len(self.marks) - 1
        part = np.bitwise_count(self.marks[np.minimum(word, last)] & below)
        return self.sums[word] + part

    def place(self, number: np.ndarray) -> np.ndarray:
        """The byte of the mark with this number, counted from 1."""
        word = np.searchsorted(self.sums, number) - 1
        left = number - self.sums[word] - 1
        marks = self.marks[word]
        for step in range(7):
            marks = np.where(left > step, marks & (marks - _ONE), marks)
        return word * 8 + (np.bitwise_count((marks & (~marks + _ONE)) - _ONE).astype(np.int64) >> 3)


def unit_marks(raw: np.ndarray, at: np.ndarray) -> tuple[Marks, Marks]:
    """The last bytes of units and the first bytes of code points, of texts raw[at[i]:at[i + 1]]."""
    padded = np.zeros((len(raw) // 8 + 1) * 8, np.uint8)
    padded[: len(raw)] = raw
    words = padded.view("<u8")
    letters = _letters(words)
    inner = words & ~(words << _ONE) & _HIGH
    ends = (letters & ~_following(letters)) | (_HIGH & ~letters & ~_following(inner))
    # A text ends its last unit, whatever the next text begins with, and padding is no text.
    last = at[1:][np.diff(at) > 0] - 1
    ends.view(np.uint8)[last] |= np.uint8(0x80)
    ends.view(np.uint8)[len(raw) :] = 0
    starts = _HIGH & ~inner
    starts.view(np.uint8)[len(raw) :] = 0
    return Marks(ends), Marks(starts)


def _cut(column: pa.Array, draws: np.ndarray, shares: Shares) -> pa.StructArray:
    """The result of each text of a piece; ``draws`` has four numbers per text."""
    many = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32 if column.type == pa.string() else np.int64)
    at = offsets[column.offset : column.offset + many + 1].astype(np.int64)
    base = int(at[0]) if len(at) else 0
    raw = np.frombuffer(buffers[2] or b"", np.uint8)[base : int(at[-1]) if len(at) else 0]
    at = at - base
    ends, starts = unit_marks(raw, at)
    ahead = ends.ahead(at)
    units = np.diff(ahead)
    first, second = draws[:, 0] % (units + 1), draws[:, 1] % (units + 1)
    stops = []
    for cut in (np.minimum(first, second), np.maximum(first, second)):
        stop = at[:-1].copy()
        inside = np.flatnonzero(cut > 0)
        stop[inside] = ends.place(ahead[:-1][inside] + cut[inside]) + 1
        stops.append(stop)
    chars = [starts.ahead(p) for p in (at[:-1], *stops)]
    held, data = np.zeros(many, bool), raw.tobytes()
    texts = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    for marker in _MARKERS:
        if marker in data:
            held |= np.fromiter((marker in t for t in texts), bool, many)
    plain = (units == 0) | held | (draws[:, 2] % 100 >= 100 - shares.plain)
    turned = draws[:, 3] % 100 < shares.suffix_first
    p, s, m = _MARKERS
    out = []
    one, two = ((stop - at[:-1]).tolist() for stop in stops)
    for text, a, b, as_is, spm in zip(texts, one, two, plain.tolist(), turned.tolist()):
        if as_is:
            out.append(text)
        elif spm:
            out.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            out.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
    form = np.where(plain, "plain", np.where(turned, "spm", "psm"))
    counts = [pa.array(c, pa.int64(), mask=plain) for c in (chars[1] - chars[0], chars[2] - chars[1])]
    return pa.StructArray.from_arrays(
        [
            pa.array(units, pa.int64()),
            pa.array(form.tolist(), pa.string()),
            *counts,
            pa.array(out, pa.binary()).cast(pa.string(), safe=False),
        ],
        [f.split(" ")[0] for f in _FIELDS],
    )


_FIELDS = ("n long", "form string", "prefix_chars long", "middle_chars long", "output string")


def transformed(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    into: str = "fim",
    shares: Shares = Shares(),
    seed: int = 1,
) -> DataFrame:
    """``docs`` with a struct column ``into``: n (units), form, prefix_chars, middle_chars and output.

    The cuts and the form are drawn from a hash of ``seed`` and the key, so a row that runs again, or
    is repeated, gets the same ones. ``psm`` is prefix, suffix, middle, each behind its marker; ``spm``
    has the suffix first; a text that is empty, or holds a marker itself, or is drawn to, stays
    ``plain`` and has no counts of prefix and middle. A null text is an empty one, a null key
    counts as an empty string. An input column called ``into`` is replaced, all others pass. Nothing is
    shuffled; texts are cut a few megabytes at a time, a longer one alone. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    digits = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256
    )
    draws = F.array(*[F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])

    @F.arrow_udf(f"struct<{','.join(_FIELDS)}>")
    def cut(column: pa.Array, numbers: pa.Array) -> pa.Array:
        drawn = numbers.flatten().to_numpy().reshape(-1, 4)
        parts = [
            _cut(part, drawn[first : first + len(part)], shares) for first, part in pieces(column, 4_000_000)
        ]
        give_back()
        return pa.concat_arrays(parts) if parts else _cut(column, drawn, shares)

    return replaced(docs, into, cut(F.col(f"`{text}`"), draws))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transformed`` was made from.

    A text with a marker in it stayed plain, and a marker cannot begin inside another one, so the
    three markers of the other forms are where they were put.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    prefix_first = F.concat(parts[1], parts[3], parts[2])
    suffix_first = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", prefix_first).when(form == "spm", suffix_first).otherwise(output)
