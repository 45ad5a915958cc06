"""Near-duplicate vectors by spherical-cap filters with a random product code.

A filter is a direction; a vector passes it if their cosine exceeds ``alpha``. The
directions are, for each of ``TURNS`` random rotations, all combinations of one code word
from each of ``PARTS`` random codes over a part of the dimensions, so the TURNS * words *
words filters need no storage, and a vector's list of passed filters is decoded from small
tables of products: words that no word of the other part can lift over alpha are left out.
(One rotation alone covers some vectors much worse than others, and would need several
times the filters for the same recall.)

Vectors of a label that pass a filter meet at (label, dimensions, filter) and are compared
there exactly, in double precision. A pair that meets at several filters counts at the
first. The number of filters follows the number of vectors of the largest label, so a
filter keeps about as many members at every size, and alpha is set on ``TRIAL`` seeded random pairs
at exactly the threshold, to find ``RECALL`` of them; closer pairs are found more surely.

Equal vectors of a label are one class and are compared once, but every row counts as a
link. A filter with many members is cut into blocks, and pairs of blocks go to tasks of
their own, so no task holds more than two blocks. A task gives each vector's number of
links and a star per local component, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors
without label or id, link with nothing; the latter have no component and are kept.
Vectors of different length are never linked. Rows that repeat id, label and vector count
as vectors of their own; of an id with several vectors the links and components are those
of all of them. Empty tables give empty results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.components import components
from riverloom.llm.pairs import block_units, local_roots, whole_runs
from riverloom.session import map_arrow, saved

PARTS = 2
TURNS = 16
VECTORS_PER_FILTER = 2.5
RECALL = 0.995
TRIAL = 3000
BLOCK = 1024
STEP = 256


@dataclass(frozen=True)
class Code:
    """Filters for vectors of ``dim`` components."""

    dim: int
    words: int
    seed: int
    alpha: float

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a row of unit vectors passes, sorted."""
        rows, filters = [], []
        for turn, (rotation, codes) in enumerate(_directions(self.dim, self.words, self.seed)):
            turned = vectors @ rotation
            need = self.alpha * math.sqrt(len(codes))
            for lo in range(0, len(vectors), STEP):
                products, at = [], 0
                for code in codes:
                    products.append(turned[lo : lo + STEP, at : at + code.shape[1]] @ code.T)
                    at += code.shape[1]
                best = [p.max(axis=1) for p in products]
                row = np.arange(len(products[0]))
                sums, number = np.zeros(len(row)), np.full(len(row), turn)
                for k, p in enumerate(products):
                    rest = sum(best[k + 1 :], np.zeros(len(best[0])))
                    grown = sums[:, None] + p[row]
                    i, word = np.nonzero(grown >= need - rest[row][:, None])
                    row, sums, number = row[i], grown[i, word], number[i] * self.words + word
                rows.append(row + lo)
                filters.append(number)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, number = np.concatenate(rows), np.concatenate(filters)
        order = np.lexsort((number, row))
        return row[order], number[order]

    @property
    def filters(self) -> int:
        return TURNS * self.words ** min(PARTS, self.dim)


@lru_cache(maxsize=16)
def _directions(dim: int, words: int, seed: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    rng = np.random.Generator(np.random.PCG64([seed, dim]))
    turns = []
    for _ in range(TURNS):
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        codes = []
        for part in np.array_split(np.arange(dim), min(PARTS, dim)):
            code = rng.standard_normal((words, len(part)))
            codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        turns.append((rotation, codes))
    return turns


def design(dim: int, vectors: int, threshold: float, seed: int = 1, recall: float = RECALL) -> Code:
    """Number of filters for so many vectors of a label, and the largest alpha that finds
    ``recall`` of random pairs at the threshold."""
    words = max(4, math.ceil((vectors / VECTORS_PER_FILTER / TURNS) ** (1 / min(PARTS, dim))))
    rng = np.random.Generator(np.random.PCG64([seed, dim, 7]))
    a, b = rng.standard_normal((2, TRIAL, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = threshold * a + math.sqrt(max(0.0, 1 - threshold**2)) * b
    high, low = 0.9, 0.45
    while low > -1:
        code = Code(dim, words, seed, low)
        if _found(code, a, b) >= recall:
            break
        high, low = low, low - 0.15
    for _ in range(6 if low > -1 else 0):
        middle = (low + high) / 2
        if _found(Code(dim, words, seed, middle), a, b) >= recall:
            low = middle
        else:
            high = middle
    return Code(dim, words, seed, max(low, -1.0))


def _found(code: Code, a: np.ndarray, b: np.ndarray) -> float:
    (ra, fa), (rb, fb) = code.decode(a), code.decode(b)
    both = np.intersect1d(ra * code.filters + fa, rb * code.filters + fb, assume_unique=True)
    return len(np.unique(both // code.filters)) / len(a)


def units(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column whose rows are valid and of one length."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = column.offsets.to_numpy()
    v = values[offsets[0] : offsets[-1]].reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


PASSED = "label long, dim int, filter long, rep long, rows long, vector array<float>, passed array<long>"


def _pass(codes: dict[int, Code]):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                own = table.filter(pa.array(dims == dim)).combine_chunks()
                vectors = units(own["embedding"].combine_chunks())
                row, number = codes[int(dim)].decode(vectors)
                counts = np.bincount(row, minlength=len(own))
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(number))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own[c].combine_chunks().take(take) for c in ("label", "dim")), pa.array(number),
                        *(own[c].combine_chunks().take(take) for c in ("rep", "rows", "embedding")), lists.take(take),
                    ],
                    ["label", "dim", "filter", "rep", "rows", "vector", "passed"],
                )

    return run


def _link(threshold: float):
    def run(batches):
        keys = ["label", "dim", "filter", "lo", "hi"]
        for table, starts in whole_runs(batches, keys):
            rep, rows, number = (table[c].to_numpy() for c in ("rep", "rows", "filter"))
            lo, hi, block = (table[c].to_numpy() for c in ("lo", "hi", "block"))
            vector, passed = table["vector"].combine_chunks(), table["passed"].combine_chunks()
            out = []
            for s, e in zip(starts[:-1], starts[1:]):
                left = np.arange(s, e) if lo[s] == hi[s] else s + np.flatnonzero(block[s:e] == lo[s])
                right = left if lo[s] == hi[s] else s + np.flatnonzero(block[s:e] == hi[s])
                if e - s < 2 or not len(left) or not len(right):
                    continue
                v = units(vector.slice(s, e - s))
                i, j = np.nonzero(v[left - s] @ v[right - s].T >= threshold)
                i, j = left[i], right[j]
                if lo[s] == hi[s]:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                first = _first_common(passed.slice(s, e - s), i - s, j - s) == number[s]
                links = np.zeros(e - s, np.int64)
                np.add.at(links, i[first] - s, rows[j[first]])
                np.add.at(links, j[first] - s, rows[i[first]])
                by_rep = np.argsort(rep[s:e], kind="stable")
                place = np.empty(e - s, np.int64)
                place[by_rep] = np.arange(e - s)
                root = local_roots(e - s, place[i - s], place[j - s])
                linked = np.unique(np.concatenate((i, j))) - s
                out.append((rep[s:e][linked], rep[s:e][by_rep[root[place[linked]]]], links[linked]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["a", "b", "links"])

    return run


def _first_common(passed: pa.ListArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest filter in both lists of each pair of rows; the lists are sorted."""
    offsets = passed.offsets.to_numpy()
    values = passed.values.to_numpy()
    counts = np.diff(offsets)
    padded = np.full((len(passed), int(counts.max())), np.iinfo(np.int64).max)
    padded[np.arange(padded.shape[1]) < counts[:, None]] = values[offsets[0] : offsets[-1]]
    out = np.empty(len(i), np.int64)
    step = max(1, 2_000_000 // padded.shape[1] ** 2)
    for lo in range(0, len(i), step):
        a, b = padded[i[lo : lo + step]], padded[j[lo : lo + step]]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        out[lo : lo + step] = a[np.arange(len(a)), both.argmax(axis=1)]
    return out


def linked_vectors(vectors: DataFrame, threshold: float = 0.93, seed: int = 1) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding, label)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    ).withColumn("embedding", F.when(valid, F.col("embedding").cast("array<float>")))
    # a vector that links with nothing has no label here either
    rows = rows.withColumn("label", F.when(F.col("embedding").isNotNull(), F.col("label")))
    key = ["label", "embedding"]
    classes = saved(
        rows.where("embedding IS NOT NULL")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("rows"))
        .withColumn("dim", F.size("embedding")),
        "vector-classes",
    )
    sizes = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    codes = {r.dim: design(r.dim, r.n, threshold, seed) for r in sizes}
    passed = saved(map_arrow(classes, _pass(codes), PASSED), "vector-filters")
    units_of = block_units(passed, ["label", "dim", "filter"], "rep", BLOCK)
    found = saved(map_arrow(units_of, _link(threshold), "a long, b long, links long"), "vector-links")
    labels = components(found.select("a", "b"))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    own = (
        classes.join(links.withColumnRenamed("a", "rep"), "rep", "left")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            *key, F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        )
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return rows.join(own, key, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
