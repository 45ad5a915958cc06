"""Distinct runs of bytes, told apart by their bytes, and what was once worked out for them.

Texts of a language repeat their words, so what depends on a word alone (its token ids, say)
is worked out once for each distinct one and looked up for the others. :class:`UnitCache`
keeps it for the life of a worker, in two generations: when the younger one is full it
becomes the older, and the older is dropped; a unit of the older one that is met again moves
to the younger. So memory is bounded, and what is in use stays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct runs data[start:end], in order of their first places, and the number of
    each run's. Runs do not overlap and come in order; they are compared byte by byte."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) == 1
    chars = np.ascontiguousarray(data[inside])
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(chars)])
    coded = runs.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.size = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            room = np.zeros(max(need, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[i], ..., begin[i] + count[i] - 1 for each i, behind each other."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - count), count)


class Lists:
    """A list of values for each slot; ``kinds`` are the types of the values' columns."""

    def __init__(self, kinds: tuple):
        self.begin, self.count = Growing(np.int64), Growing(np.int64)
        self.columns = [Growing(k) for k in kinds]

    def add(self, count: np.ndarray, columns: list[np.ndarray]) -> None:
        self.begin.add(self.columns[0].size + np.cumsum(count) - count)
        self.count.add(count)
        for own, new in zip(self.columns, columns):
            own.add(new)

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        count = self.count.values[slots]
        at = spread(self.begin.values[slots], count)
        return count, [c.values[at] for c in self.columns]


class _Generation:
    def __init__(self, kinds: list[tuple]):
        self.names = pa.array([], pa.large_binary())
        self.lists = [Lists(k) for k in kinds]
        self.texts: list[str] = []

    def find(self, units: pa.Array) -> np.ndarray:
        """Slot of each unit, -1 if there is none."""
        return pc.fill_null(pc.index_in(units, value_set=self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class UnitCache:
    """``work(units)`` gives, for a list of distinct byte strings, a (count, columns) pair for
    each entry of ``kinds`` and a list of texts (or None)."""

    def __init__(self, work: Callable, kinds: list[tuple], limit: int = 200_000):
        self.work, self.kinds, self.limit = work, kinds, limit
        self.old, self.new = _Generation(kinds), _Generation(kinds)

    def slots(self, units: pa.Array) -> np.ndarray:
        """Slot of each of the distinct units in ``new``."""
        if len(self.new.names) >= self.limit:
            self.old, self.new = self.new, _Generation(self.kinds)
        out = self.new.find(units)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            held = self.old.find(units.take(pa.array(missing)))
            again, fresh = missing[held >= 0], missing[held < 0]
            for own, lists in zip(self.new.lists, self.old.lists):
                own.add(*lists.take(held[held >= 0]))
            if self.old.texts:
                self.new.texts += [self.old.texts[i] for i in held[held >= 0]]
            if len(fresh):
                *found, texts = self.work(units.take(pa.array(fresh)).to_pylist())
                for own, (count, columns) in zip(self.new.lists, found):
                    own.add(count, columns)
                self.new.texts += texts or []
            order = np.concatenate((again, fresh))
            out[order] = len(self.new.names) + np.arange(len(order))
            self.new.names = pa.concat_arrays([self.new.names, units.take(pa.array(order))])
        return out
