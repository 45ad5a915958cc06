"""Words, shingles and their hashes over Arrow columns, without a Python object per word.

A batch's texts lie behind each other in one byte buffer, so words are found and
hashed for all of them at once. Memory is bounded by :func:`pieces`, which cuts a
batch into runs of rows of about ``LIMIT`` bytes (a longer text is a run of its own).

Words are runs of bytes other than 0x20 and 0x09-0x0D. Nulls count as empty texts.
Hashes are 64 bits wide, equal on every machine, and depend on the bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 1 << 20
#: values that are hashed at a time; powers are kept for so many
BLOCK = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_OUTER = np.zeros(256, bool)
_OUTER[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PRIME, _BITS, _HIGH = np.uint64(2**31 - 1), np.uint64(31), np.uint64(33)
#: two random points, and odd numbers that make two numbers of each value
_BASES = [int(x) for x in np.random.Generator(np.random.PCG64(21)).integers(2**20, 2**31 - 2, 2)]
_SCALES = np.random.Generator(np.random.PCG64(22)).integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all of them."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _fold(x: np.ndarray) -> np.ndarray:
    """A number below 2**33 with the same remainder, 2**32 for x below 2**62; x is used up."""
    high = x >> _BITS
    x &= _PRIME
    x += high
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats; ``np.unique`` takes several times as long for integers."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**62."""
    x = (x & _PRIME) + (x >> _BITS)
    x = (x & _PRIME) + (x >> _BITS)
    return x - _PRIME * (x >= _PRIME)


def _table(base: int) -> np.ndarray:
    """The first BLOCK powers of a number modulo the prime."""
    table = np.ones(BLOCK, np.uint64)
    k = 1
    while k < BLOCK:
        part = table[k : 2 * k]
        part[:] = _mod(table[: len(part)] * np.uint64(pow(base, k, int(_PRIME))))
        k *= 2
    return table


@lru_cache(maxsize=None)
def _powers(k: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """The k-th point, its inverse, and powers of both."""
    base = _BASES[k]
    inverse = pow(base, -1, int(_PRIME))
    return base, inverse, _table(base), _table(inverse)


class Bytes:
    """Bytes as numbers to be hashed by :func:`range_hashes`."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def __len__(self) -> int:
        return len(self.data)

    def part(self, k: int, lo: int, hi: int) -> np.ndarray:
        return ((_BYTES * _SCALES[k]) >> _HIGH)[self.data[lo:hi]]


def range_hashes(values: np.ndarray | Bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal runs hash alike wherever they lie.

    Two polynomials at random points, modulo a prime: two different runs of n values
    hash alike with a chance of (n / 2**31)**2 at most, whatever they are made of. ``values``
    are 64 bits wide, or :attr:`Texts.byte_values`. They are worked on BLOCK at a time, so
    what is held for each is a running sum.
    """
    n, out = len(values), []
    for k in range(2):
        base, inverse, up, down = _powers(k)
        sums = np.zeros(n + 1, np.uint64)
        for lo in range(0, n, BLOCK):
            hi = min(n, lo + BLOCK)
            v = values.part(k, lo, hi) if isinstance(values, Bytes) else (values[lo:hi] * _SCALES[k]) >> _HIGH
            v *= up[: hi - lo] if not lo else _fold(up[: hi - lo] * np.uint64(pow(base, lo, int(_PRIME))))
            v = _fold(v)
            np.cumsum(v, out=sums[lo + 1 : hi + 1], dtype=np.uint64)
            sums[lo + 1 : hi + 1] += sums[lo]
        back = down[starts % BLOCK]
        if n > BLOCK:
            steps = [pow(inverse, lo, int(_PRIME)) for lo in range(0, n + 1, BLOCK)]
            back = _mod(back * np.array(steps, np.uint64)[starts // BLOCK])
        out.append(_mod(_mod(sums[ends] - sums[starts]) * back))
    return mix((out[0] << _BITS) + out[1] + (ends - starts).astype(np.uint64) * _SCALES[1])


class Texts:
    """Words of a run of rows: ``starts``, ``ends`` (bytes), ``first`` (word number
    at which each row begins; one more at the end) and, on demand, ``hashes``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~_SPACE[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]
        stops[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self._hashes: np.ndarray | None = None

    @property
    def byte_values(self) -> Bytes:
        return Bytes(self.data)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = range_hashes(self.byte_values, self.starts, self.ends)
        return self._hashes

    def trimmed(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends without up to three ASCII signs at either side; never empty."""
        starts, ends = self.starts.copy(), self.ends.copy()
        open_ = slice(None)
        for k in range(3 if len(starts) else 0):
            begin, end = starts[open_], ends[open_]
            head = _OUTER[self.data[begin]] & (begin < end - 1)
            begin = begin + head
            tail = _OUTER[self.data[end - 1]] & (begin < end - 1)
            starts[open_], ends[open_] = begin, end - tail
            # a word that has lost nothing is done
            moved = np.flatnonzero(head | tail)
            open_ = moved if k == 0 else open_[moved]
        return starts, ends

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers at which windows within one row begin, and the windows' hashes."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        at = np.flatnonzero(np.arange(len(self.starts)) + size <= last)
        return at, range_hashes(self.hashes, at, at + size)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def pieces(
    column: pa.Array, lower: bool = False, limit: int = LIMIT, fold: bool = False
) -> Iterator[tuple[int, int, Texts]]:
    """Runs of rows ``(from, to, texts)`` of a string column. ``lower`` lower-cases A-Z,
    ``fold`` the letters of all scripts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    if fold:
        column = pc.utf8_lower(column)
    _, places, chars = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(chars, np.uint8) if chars is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        part = offsets[lo : hi + 1]
        yield lo, hi, Texts(data[part[0] : part[-1]], part - part[0], lower)
        lo = hi


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Array column whose row i holds values[ends[i-1]:ends[i]]."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
