"""Carrying rows through Arrow functions, and reading words out of Arrow texts by numpy.

A row travels as one struct column, so an operator's own columns can never clash
with columns the caller happens to have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Texts are worked on in pieces of about so many bytes, a longer text alone.
PIECE_BYTES = 1 << 20

Texts = pa.StringArray


def packed(frame: DataFrame) -> DataFrame:
    """All columns as one struct column ``row``."""
    return frame.select(F.struct(*[frame[name] for name in frame.columns]).alias("row"))


def extend(
    rows: DataFrame,
    text: str,
    make: Callable[[], Callable[[Texts], list]],
    fields: str,
    limit: int = PIECE_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns computed from ``row.<text>``.

    ``rows`` comes from :func:`packed`; further columns beside ``row`` are dropped. ``make`` is
    called once per task and gives a function from texts (nulls kept) to one
    array per added column; it sees about ``limit`` bytes of text at once. With
    ``keep``, ``row`` comes back with these columns only, so that texts go one way.
    """
    whole_row = rows.schema["row"].dataType
    names = whole_row.names
    at = names.index(text)
    kept = list(range(len(names))) if keep is None else [names.index(name) for name in keep]
    added = StructType.fromDDL(fields)
    out_names = ["row", *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            whole = batch.column(0)
            texts = whole.field(at)
            if keep is not None:
                whole = pa.StructArray.from_arrays([whole.field(i) for i in kept], [names[i] for i in kept])
            for low, high in pieces(texts, limit):
                columns = apply(texts.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([whole.slice(low, high - low), *columns], out_names)

    row = StructType([whole_row.fields[i] for i in kept])
    schema = StructType([StructField("row", row, True), *added.fields])
    return rows.select("row").mapInArrow(run, schema)


def offsets_of(texts: Texts) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def pieces(texts: Texts, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes of text, at least one row each."""
    count = len(texts)
    if not count:
        return
    ends = offsets_of(texts).astype(np.int64)
    low = 0
    while low < count:
        high = int(np.searchsorted(ends, ends[low] + limit, "right")) - 1
        high = min(count, max(low + 1, high))
        yield low, high
        low = high


# Words.

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

#: Bytes of words between ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of lower-case words of digits, ASCII letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, none of them empty.

    Every block of eight bytes is mixed with its number in the range before the blocks are
    added, so that no order of blocks, however regular, makes two ranges alike. Ranges
    of up to eight bytes and one length never share a hash.
    """
    lengths = ends - starts
    blocks = (lengths + 7) >> 3
    first = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(starts, blocks) + 8 * number
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    values = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))[at]
    beyond = np.maximum(at + 8 - np.repeat(ends, blocks), 0).astype(np.uint64)
    values &= np.uint64((1 << 64) - 1) >> (np.uint64(8) * beyond)
    terms = mixed(values ^ mixed((number + 1).astype(np.uint64) * _ODD))
    sums = np.add.reduceat(terms, first) if len(first) else terms
    return mixed(sums + lengths.astype(np.uint64) * _INVERSE)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < count:
        size = max(count, PIECE_BYTES + 1024)
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:count], _POWERS["down"][:count]


class Words:
    """The words of some texts: byte range, hash, and each text's range of words."""

    def __init__(self, texts: Texts, kind: np.ndarray, lower: bool = False, hashed: bool = True):
        texts = texts.fill_null("") if texts.null_count else texts
        offsets = offsets_of(texts).astype(np.int64)
        buffer = texts.buffers()[2]
        data = np.empty(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)
        self._divide(data[offsets[0] : offsets[-1]], offsets - offsets[0], kind, lower, hashed)

    def divided(self, kind: np.ndarray, lower: bool = False) -> Words:
        """The same texts, divided otherwise."""
        other = Words.__new__(Words)
        other._divide(self.data, self.offsets, kind, lower, True)
        return other

    def _divide(self, data, offsets, kind, lower, hashed) -> None:
        self.data, self.offsets = LOWER[data] if lower else data, offsets
        inside = kind[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = self.offsets[:-1]
        begins = begins[begins < len(inside)]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= ~(inside[1:] & ~first[1:])
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Text i has the words bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        if hashed:
            self.hashes = range_hashes(self.data, self.starts, self.ends)

    def texts(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values; runs across texts included."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    count = len(hashes) - size + 1
    return mixed((sums[size:] - sums[:count]) * down[:count])


def inside_texts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` consecutive words lie in one text."""
    total = int(bounds[-1])
    fits = np.ones(max(0, total - size + 1), bool)
    for back in range(1, size):
        ends = bounds[1:-1] - back
        fits[ends[(ends >= 0) & (ends < len(fits))]] = False
    return fits


def merged(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """Marks of the positions inside any of the ranges."""
    change = np.bincount(starts, minlength=total + 1) - np.bincount(ends, minlength=total + 1)
    return np.cumsum(change[:total]) > 0


def runs(marks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of marked words; a run ends with its text."""
    first = marks.copy()
    first[1:] &= ~marks[:-1]
    begins = bounds[:-1]
    begins = begins[begins < len(marks)]
    first[begins] = marks[begins]
    last = marks.copy()
    last[:-1] &= ~(marks[1:] & ~first[1:])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def list_array(values: pa.Array, counts: Sequence[int] | np.ndarray) -> pa.ListArray:
    """Lists of the given lengths over consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
