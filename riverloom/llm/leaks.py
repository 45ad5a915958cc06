"""Benchmark items in documents, by latent semantic retrieval and exact checks.

Words are lower-cased and without outer signs. Texts are cut into cells, and every two
neighbouring cells are a passage. Cells have at least four times as many words as the items
that are searched with them (and ``SIZE`` at least), so any window of twice an item's words
lies within one passage.

1. Weights. A word's weight is log(cells / cells with it), from all cells of ``CELL`` words of
   all documents, by hashed word (``FEATURES`` numbers).
2. Latent space. Items are dealt to blocks of about ``ITEMS`` items and ``BLOCK_WORDS`` words. A
   block's weighted word vectors, and those of all cells of all documents, are factored by a
   distributed randomised SVD. Only words of the block's items need coordinates, others have
   no product with any of them. One pass over the documents (that of step 1 for the first
   group) counts for all blocks of a group how many cells each two words share, which is the
   product of the cells' matrix with itself but for the weights; the counts stay in the shared
   folder, cut into stripes. Tasks multiply stripes with a random matrix and with the result's
   basis, and only words x rank numbers leave them. Of blocks of more than ``WIDE`` words,
   which have few items, tasks multiply the cells themselves. The rank is twice the number of
   items, so the space can hold them; what it does not hold of one is known by its norm.
3. Search. Every passage of every document is projected and compared with all items. An item
   is a candidate where the latent product, and what the item's part outside the space may
   add at most, reach the share of the item's squared norm that a match needs: the least
   cosine is that share times the item's norm over the passage's. As this share follows from
   the checks, the candidates hold all that pass them, whatever the rank is.
4. Checks. In windows of twice the item's words, every half window, the longest common
   subsequence must have a share of the item's words, ``COPY``, and of their squared weights,
   ``WEIGHT``. From ``PARAPHRASE`` words on, the item must also give its answer away: the share
   of the answer's words in the window and half of it on both sides, by weight, must be
   ``ANSWER``, and one of its words must weigh ``HEAVY`` at least (or be in two cells only); an
   answer of common words tells nothing. The answer is the column of that name, or else the item's last sentence.

Blocks of items are read one group (``GROUP`` blocks) at a time, each a pass over the documents,
so what is read and sent to the tasks is bounded. One row for each document and item: the best
of the windows that pass the checks. Items that are null or have no word match nothing; of items
of fewer than ``SHORT`` words all words must be there in order. Items that repeat id, text and
answer are one. Documents without text or id match nothing. Rows that repeat an id are searched
each, and the best window of all of them counts. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.blobs import squeezed, unsqueezed
from riverloom.llm.pairs import whole_runs
from riverloom.llm.units import spread
from riverloom.llm.words import Texts, distinct, pieces, range_hashes
from riverloom.session import map_arrow, saved

CELL = 32
#: words of a cell in the search, for items of up to half as many
SIZE = 64
FEATURES = 1 << 18
#: cells that the space is fitted on: all; fewer are a sample
FIT_CELLS = math.inf
ITEMS, BLOCK_WORDS, GROUP = 100, 8192, 8
RANK = 2 * ITEMS
COPY, PARAPHRASE, ANSWER = 0.75, 0.5, 0.7
WEIGHT, HEAVY = 1 / 3, 3.0
SHORT = 8
_SLICES = 16
#: words of a block whose pairs are counted; numbers of a stripe; words of cells that are held
#: until their pairs are counted, pairs that are counted at a time
WIDE, STRIPE, HELD, PAIRS = 8192, 1 << 20, 1 << 22, 1 << 21
#: passages that are projected at a time, numbers that the checks compare at a time
ROWS, COMPARED = 512, 1 << 22
#: vectors that are written out at a time to be projected
DENSE = 128


def word_hashes(texts: Texts) -> np.ndarray:
    return range_hashes(texts.byte_values, *texts.trimmed())


def feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def cell_numbers(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each word; row and first word of each cell."""
    row = texts.rows()
    new = (np.arange(len(row)) - texts.first[row]) % size == 0
    first = np.flatnonzero(new)
    return np.cumsum(new) - 1, row[first], first


def cells(texts: Texts, hashes: np.ndarray, size: int = CELL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, feature) without repeats, in order; and row and first word of each cell."""
    number, row, first = cell_numbers(texts, size)
    pair = distinct(number * FEATURES + feature(hashes))
    return pair // FEATURES, pair % FEATURES, row, first


def _sliced(values: np.ndarray, n: int) -> pa.RecordBatch:
    parts = [p.tobytes() for p in np.array_split(values, _SLICES)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(_SLICES), pa.int32()), pa.array([n] * _SLICES, pa.int64()), pa.array(parts, pa.binary())],
        ["slice", "n", "sums"],
    )


def _summed(kind: str):
    def run(batches):
        for table, starts in whole_runs(batches, ["slice"]):
            for s, e in zip(starts[:-1], starts[1:]):
                total = sum(np.frombuffer(x.as_buffer(), kind) for x in table["sums"].slice(s, e - s))
                yield pa.RecordBatch.from_arrays(
                    [table["slice"].slice(s, 1).combine_chunks(), pa.array([sum(table["n"].slice(s, e - s).to_pylist())], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                    ["slice", "n", "sums"],
                )

    return run


PARTIAL = "slice int, n long, sums binary"


def add_up(partial: DataFrame, kind: str) -> tuple[np.ndarray | None, int]:
    """Sum of the tasks' arrays, added up slice by slice in tasks. Its size is fixed."""
    summed = map_arrow(partial.repartition("slice").sortWithinPartitions("slice"), _summed(kind), PARTIAL)
    parts = sorted(summed.collect(), key=lambda r: r.slice)
    if not parts:
        return None, 0
    return np.concatenate([np.frombuffer(r.sums, kind) for r in parts]), parts[0].n


def weights(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Weight of every feature, and the number of cells."""
    return weights_of(counted(docs, {}, True))


def weights_of(stored: DataFrame) -> tuple[np.ndarray, int]:
    """The same from what :func:`counted` has stored."""
    parts = sorted(stored.where(F.col("block") == ALL).collect(), key=lambda r: r.stripe)
    counts = np.concatenate([unsqueezed(r.counts) for r in parts]) if parts else np.zeros(FEATURES)
    n = parts[0].n if parts else 0
    return np.log((1 + n) / (1 + counts)).astype(np.float32) + np.float32(1e-3), n


@dataclass
class Item:
    item_id: int
    words: np.ndarray  # hashes in order
    answer: np.ndarray  # hashes
    masks: dict = field(default_factory=dict)

    def __post_init__(self):
        for i, w in enumerate(self.words.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def subsequence(self, words: list[int]) -> int:
        """Length of the longest common subsequence with the item, by bit vectors."""
        full = (1 << len(self.words)) - 1
        v = full
        for m in filter(None, map(self.masks.get, words)):
            u = v & m
            v = ((v + u) | (v - u)) & full
        return len(self.words) - v.bit_count()


def item_columns(benchmark: DataFrame) -> DataFrame:
    """item_id, text and answer (null where there is no such column), each item once."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.cast("string").alias("answer"))
    return wanted.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()


def read_items(benchmark: DataFrame) -> list[Item]:
    """All items of a table of bounded size, see :func:`item_groups`."""
    out = []
    for r in sorted(item_columns(benchmark).collect(), key=lambda r: (r.item_id, r.text, r.answer or "")):
        answer = r.answer
        if not answer:
            sentences = [s for s in re.split(r"(?<=[.!?])\s+", r.text.strip()) if s]
            answer = sentences[-1] if sentences else ""
        both = [word_hashes(t) for x in (r.text, answer) for _, _, t in pieces(pa.array([x]), fold=True)]
        if len(both[0]):
            out.append(Item(r.item_id, both[0], np.unique(both[1])))
    return out


def item_groups(benchmark: DataFrame) -> Iterator[list[tuple[int, DataFrame]]]:
    """Blocks of items that are searched together, each with the size of its cells."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    size = F.greatest(F.lit(SIZE), F.pow(F.lit(2), F.ceil(F.log2(F.greatest(2 * words, F.lit(1)))))).cast("long")
    spot = F.xxhash64("item_id", "text", "answer").alias("spot")
    items = saved(item_columns(benchmark).select("*", words.alias("words"), spot).where("words > 0").withColumn("size", size), "leak-items")
    sizes = items.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).orderBy("size").collect()
    group = []
    for r in sizes:  # one for each power of two
        blocks = max(-(-r.n // ITEMS), -(-r.words // BLOCK_WORDS))
        dealt = items.where(F.col("size") == r.size).withColumn("block", F.pmod("spot", F.lit(blocks)))
        for k in range(blocks):
            group.append((r.size, dealt.where(F.col("block") == k)))
            if len(group) == GROUP:
                yield group
                group = []
    if group:
        yield group


@dataclass
class Space:
    """Latent coordinates of the words of items."""

    idf: np.ndarray
    #: feature -> row of basis, -1 for others
    column: np.ndarray
    #: orthonormal columns
    basis: np.ndarray

    def _own(self, owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = self.column[found]
        own = at >= 0
        return owner[own], at[own], self.idf[found[own]]

    def project(self, owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """Coordinates of n sparse vectors of weights; those of equal vectors are equal."""
        owner, at, weight = self._own(owner, found)
        out = np.zeros((n, self.basis.shape[1]), np.float32)
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
        if len(owner):
            out[owner[begin]] = np.add.reduceat(self.basis[at] * weight[:, None], begin, axis=0)
        return out

    def project_many(self, owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """The same but for rounding, in less time, as products of small dense matrices; no
        feature twice for one owner."""
        owner, at, weight = self._own(owner, found)
        out = np.zeros((n, self.basis.shape[1]), np.float32)
        step = max(1, min(DENSE, COMPARED // max(1, len(self.basis))))
        for lo in range(0, n, step):
            b, e = np.searchsorted(owner, [lo, lo + step])
            used = np.zeros(len(self.basis), bool)
            used[at[b:e]] = True
            names = np.flatnonzero(used)
            part = np.zeros((min(step, n - lo), len(names)), np.float32)
            part[owner[b:e] - lo, (np.cumsum(used) - 1)[at[b:e]]] = weight[b:e]
            out[lo : lo + step] = part @ self.basis[names]
        return out


def _products(column: np.ndarray, idf: np.ndarray, matrix: np.ndarray):
    """A.T @ (A @ matrix) for the cells' rows A."""

    def run(batches):
        out, n = np.zeros(matrix.shape), 0
        for batch in batches:
            for _, _, texts in pieces(batch["text"], fold=True):
                owner, found, rows, _ = cells(texts, word_hashes(texts))
                keep = column[found] >= 0
                owner, at, value = owner[keep], column[found[keep]], idf[found[keep]]
                names = distinct(owner)
                for s in range(0, len(names), ROWS):
                    part = names[s : s + ROWS]
                    b, e = np.searchsorted(owner, [part[0], part[-1] + 1])
                    a = np.zeros((len(part), matrix.shape[0]), np.float32)
                    a[np.searchsorted(part, owner[b:e]), at[b:e]] = value[b:e]
                    out += a.T @ (a @ matrix)
                n += len(rows)
        yield _sliced(out.reshape(-1), n)

    return run


def fit_sample(docs: DataFrame, n_cells: int, fit_cells: float = FIT_CELLS) -> DataFrame:
    """The texts; of more than ``fit_cells`` cells those of about so many, chosen by a hash of the text."""
    texts = docs.select("text").where("text IS NOT NULL")
    if fit_cells >= n_cells:
        return texts
    share = int(2**20 * fit_cells / n_cells)
    return saved(texts.where(F.pmod(F.xxhash64("text"), F.lit(2**20)) < share), "leak-sample")


def stripes(at: np.ndarray, count: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """How many cells hold word i and word j, for all pairs of n words, in stripes of rows; cell k
    holds the next ``count[k]`` of the words ``at``. Stripes of zeros are left out."""
    height = max(1, STRIPE // n)
    of = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    for stripe, lo in enumerate(range(0, n, height)):
        rows = np.flatnonzero((at >= lo) & (at < lo + height))
        sums = np.zeros(min(height, n - lo) * n, np.int64)
        for k in range(0, len(rows), PAIRS // CELL):
            own = rows[k : k + PAIRS // CELL]
            size = count[of[own]]
            first = np.repeat((at[own] - lo).astype(np.int64) * n, size)
            sums += np.bincount(first + at[spread(begin[of[own]], size)], minlength=len(sums))
        if len(rows):
            yield stripe, sums


#: of a block: how many cells each two of its words share; of ALL: how many each feature has, and of how many
COUNTS = "block int, stripe int, n long, counts binary"
_COUNTS = pa.schema([("block", pa.int32()), ("stripe", pa.int32()), ("n", pa.int64()), ("counts", pa.binary())])
ALL = -1


def _counts(columns: dict[int, np.ndarray], features: bool):
    """Stripes of each block's pair counts, for its features' columns, and of all features' counts."""

    def row(block: int, stripe: int, n: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"block": block, "stripe": stripe, "n": n, "counts": squeezed(counts)}], _COUNTS)

    def run(batches):
        held, size = {k: [] for k in columns}, 0
        single, n = np.zeros(FEATURES, np.int64), 0

        def out():
            for k, own in held.items():
                at, count = (np.concatenate(x) for x in zip(*own))
                for stripe, sums in stripes(at, count, int(columns[k].max()) + 1):
                    yield row(k, stripe, 0, sums)
                own.clear()

        for batch in batches:
            for _, _, texts in pieces(batch["text"], fold=True):
                owner, found, rows, _ = cells(texts, word_hashes(texts))
                if features:
                    single += np.bincount(found, minlength=FEATURES)
                    n += len(rows)
                for k, column in columns.items():
                    at = column[found]
                    mine = at >= 0
                    count = np.bincount(owner[mine], minlength=len(rows))
                    held[k].append((at[mine], count[count > 0]))
                    size += len(held[k][-1][0])
                if size >= HELD:
                    yield from out()
                    size = 0
        if size:
            yield from out()
        if n:
            for stripe, part in enumerate(np.array_split(single, _SLICES)):
                yield row(ALL, stripe, n, part)

    return run


def _counts_summed(batches):
    """Rows come sorted by block and stripe."""
    key = total = None

    def row():
        return pa.RecordBatch.from_pylist([{"block": key[0], "stripe": key[1], "n": n, "counts": squeezed(total)}], _COUNTS)

    for batch in batches:
        for r in batch.to_pylist():
            own = unsqueezed(r["counts"])
            if (r["block"], r["stripe"]) == key:
                total += own
                n += r["n"]
                continue
            if key:
                yield row()
            key, n, total = (r["block"], r["stripe"]), r["n"], own
    if key:
        yield row()


def counted(docs: DataFrame, columns: dict[int, np.ndarray], features: bool = False) -> DataFrame:
    """Counts of all cells, stored: pairs of words for the columns of blocks, and features if wanted."""
    partial = map_arrow(docs.select("text"), _counts(columns, features), COUNTS)
    partial = partial.repartition("block", "stripe").sortWithinPartitions("block", "stripe")
    return saved(map_arrow(partial, _counts_summed, COUNTS), "leak-counts", together=1)


def _stripe_products(matrix: np.ndarray):
    kind = pa.schema([("stripe", pa.int32()), ("sums", pa.binary())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                own = unsqueezed(r["counts"]).reshape(-1, len(matrix)) @ matrix
                yield pa.RecordBatch.from_pylist([{"stripe": r["stripe"], "sums": own.tobytes()}], kind)

    return run


def narrow(columns: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Those of blocks whose pairs are counted."""
    return {k: c for k, c in enumerate(columns) if int(c.max()) < WIDE}


def multipliers(docs: DataFrame, columns: list[np.ndarray], idf: np.ndarray, stored: DataFrame | None = None) -> list[Callable]:
    """For each block a function that gives A.T @ (A @ matrix) for the cells' rows A; ``stored`` if
    pairs are counted already."""
    size, own = [int(c.max()) + 1 for c in columns], narrow(columns)
    if own and stored is None:
        stored = counted(docs, own)

    def of_counts(k: int, matrix: np.ndarray) -> np.ndarray:
        weight = idf[columns[k] >= 0].astype(float)[:, None]
        out, height = np.zeros(matrix.shape), max(1, STRIPE // size[k])
        part = stored.where(F.col("block") == k).select("stripe", "counts")
        for r in map_arrow(part, _stripe_products(weight * matrix), "stripe int, sums binary").collect():
            out[r.stripe * height : (r.stripe + 1) * height] = np.frombuffer(r.sums).reshape(-1, matrix.shape[1])
        return weight * out

    def of_cells(k: int, matrix: np.ndarray) -> np.ndarray:
        total, _ = add_up(map_arrow(docs, _products(columns[k], idf, matrix), PARTIAL), "f8")
        return np.zeros(matrix.shape) if total is None else total.reshape(matrix.shape).copy()

    return [functools.partial(of_counts if k in own else of_cells, k) for k in range(len(columns))]


def word_columns(items: list[Item]) -> np.ndarray:
    """Feature -> number among those of the items' words, in order; -1 for others."""
    names = np.unique(feature(np.concatenate([i.words for i in items])))
    column = np.full(FEATURES, -1, np.int32)
    column[names] = np.arange(len(names))
    return column


def fit(
    docs: DataFrame, items: list[Item], idf: np.ndarray, n_cells: int, rank: int | None = None, fit_cells: float = FIT_CELLS, seed: int = 9,
    multiply: Callable | None = None,
) -> Space:
    """Latent space of the items' words; ``multiply`` if it is known already (:func:`multipliers`)."""
    rank = rank or 2 * len(items)
    owner = np.repeat(np.arange(len(items)), [len(i.words) for i in items])
    pair = np.unique(owner * FEATURES + feature(np.concatenate([i.words for i in items])))
    column = word_columns(items)
    n = int(column.max()) + 1
    rank = min(rank, n)
    own = pair // FEATURES, column[pair % FEATURES]
    value = idf[pair % FEATURES].astype(float)
    # items weigh as much as the cells
    heavy = max(1.0, min(fit_cells, n_cells) / len(items))
    multiply = multiply or multipliers(docs, [column], idf)[0]

    def product(matrix: np.ndarray) -> np.ndarray:
        out = multiply(matrix)
        begin = np.flatnonzero(np.concatenate(([True], own[0][1:] != own[0][:-1])))
        rows = np.add.reduceat(matrix[own[1]] * value[:, None], begin, axis=0)
        alone = np.repeat(rows, np.diff(np.append(begin, len(value))), axis=0) * value[:, None]
        np.add.at(out, own[1], heavy * alone)
        return out

    random = np.random.Generator(np.random.PCG64(seed)).standard_normal((n, min(n, rank + 8)))
    start = np.linalg.qr(product(random))[0]
    inner = start.T @ product(start)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    basis = start @ vectors[:, np.argsort(-values)[:rank]]
    return Space(idf, column, np.ascontiguousarray(basis.astype(np.float32)))


def least_matched(size: int) -> int:
    """Words of an item that are matched at the least where the checks are passed."""
    return size if size < SHORT else math.ceil(PARAPHRASE * size)


class Block:
    """Items with their space, and what of each a match needs."""

    def __init__(self, items: list[Item], space: Space, n_cells: int):
        self.items, self.space = items, space
        heavy = min(HEAVY, math.log((1 + n_cells) / 3))  # words of two cells always are
        idf = space.idf
        owner = np.repeat(np.arange(len(items)), [len(i.words) for i in items])
        pair = np.unique(owner * FEATURES + feature(np.concatenate([i.words for i in items])))
        query = space.project(pair // FEATURES, pair % FEATURES, len(items)).astype(float)
        square = idf[pair % FEATURES].astype(float) ** 2
        self.norm2 = np.bincount(pair // FEATURES, square, len(items))
        # norm of the part that lies outside the space
        self.outside = np.sqrt(np.maximum(self.norm2 - (query**2).sum(axis=1), 0) + 1e-6 * self.norm2)
        self.query = np.ascontiguousarray(query.T.astype(np.float32))
        self.weights, self.answers, self.least = [], [], []
        need = []
        for item, total in zip(items, self.norm2):
            _, which, times = np.unique(feature(item.words), return_inverse=True, return_counts=True)
            weight = idf[feature(item.words)].astype(float) ** 2 / times[which] / total
            answer = idf[feature(item.answer)].astype(float)
            tells = len(answer) and answer.max() >= heavy
            n = len(item.words)
            least = n if n < SHORT else least_matched(n) if tells else math.ceil(COPY * n)
            self.weights.append(weight)
            self.answers.append(dict(zip(item.answer.tolist(), answer.tolist())) if tells else None)
            self.least.append(least)
            # so many words have a share of the weights that is at least that of the lightest
            need.append(max(WEIGHT, float(np.sort(weight)[:least].sum())) - 1e-6)
        self.need = np.array(need) * self.norm2

    def candidates(self, passage: np.ndarray, found: np.ndarray, n: int):
        """(passage, item, latent product) of n passages, for their words' features in order."""
        mine = self.space.column[found] >= 0
        passage, found = passage[mine], found[mine]
        square = self.space.idf[found].astype(float) ** 2
        norm = np.sqrt(np.bincount(passage, square, n))
        open_ = np.flatnonzero(norm**2 >= self.need.min())
        for lo in range(0, len(open_), ROWS):
            rows = open_[lo : lo + ROWS]
            b, e = np.searchsorted(passage, [rows[0], rows[-1] + 1])
            slot = np.full(rows[-1] + 1 - rows[0], -1)
            slot[rows - rows[0]] = np.arange(len(rows))
            at = slot[passage[b:e] - rows[0]]
            v = self.space.project_many(at[at >= 0], found[b:e][at >= 0], len(rows))
            i, q = np.nonzero(v @ self.query + norm[rows][:, None] * self.outside >= self.need)
            # for the few passages that have some: equal ones have equal products
            hit = np.zeros(len(rows), bool)
            hit[i] = True
            own = (at >= 0) & hit[at]
            v = self.space.project(at[own], found[b:e][own], len(rows))
            yield rows[i], q, (v @ self.query)[i, q]


def subsequences(windows: np.ndarray, items: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Greatest weight of a common subsequence of each window (words) and its item (words, weights)."""
    best = np.zeros((len(windows), items.shape[1] + 1), weights.dtype)
    for t in range(windows.shape[1]):
        longer = best[:, :-1] + weights * (windows[:, t, None] == items)
        np.maximum(best[:, 1:], longer, out=best[:, 1:])
        np.maximum.accumulate(best, axis=1, out=best)
    return best[:, -1]


FOUND = "doc_id long, item_id long, at int, cosine double, matched int, item_words int, share double, weight double, answer double"


def passages_of(texts: Texts, hashes: np.ndarray, size: int, wanted: np.ndarray):
    """(passage, feature) of the wanted features, without repeats and in order; and row and first
    word of each passage."""
    owner, row, first = cell_numbers(texts, size)
    found = feature(hashes)
    keep = wanted[found]
    owner, found = owner[keep], found[keep]
    earlier = (owner > 0) & (row[np.maximum(owner - 1, 0)] == row[owner])
    pair = distinct(np.concatenate((owner * FEATURES + found, (owner[earlier] - 1) * FEATURES + found[earlier])))
    return pair // FEATURES, pair % FEATURES, row, first


def _search(blocks: list[tuple[int, Block]]):
    by_size: dict[int, list[Block]] = {}
    wanted: dict[int, np.ndarray] = {}
    for size, block in blocks:
        by_size.setdefault(size, []).append(block)
        wanted[size] = wanted.get(size, False) | (block.space.column >= 0)

    def checked(block: Block, texts: Texts, hashes: np.ndarray, row: np.ndarray, k: np.ndarray, q: np.ndarray, cosine: np.ndarray):
        """(row, item, rank) of windows that pass; window k of a row begins at word k times the item's words."""
        sizes = np.array([len(i.words) for i in block.items])
        for n in np.unique(sizes[q]):
            own = np.flatnonzero(sizes[q] == n)
            step = max(1, COMPARED // int(2 * n * n))
            for lo in range(0, len(own), step):
                part = own[lo : lo + step]
                base, end = texts.first[row[part]], texts.first[row[part] + 1]
                begin = base + k[part] * n
                at = begin[:, None] + np.arange(2 * n)
                words = np.where(at < end[:, None], hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
                items = np.stack([block.items[i].words for i in q[part]])
                least = np.array([block.least[i] for i in q[part]])
                # words that are there at all
                there = np.zeros(items.shape, bool)
                for t in range(2 * n):
                    there |= words[:, t, None] == items
                some = np.flatnonzero(there.sum(axis=1) >= least)
                part, words, items, least = part[some], words[some], items[some], least[some]
                matched = subsequences(words, items, np.ones(items.shape, np.float32))
                enough = np.flatnonzero(matched >= least)
                weight = np.zeros(len(part))
                if len(enough):
                    own_weights = np.stack([block.weights[i] for i in q[part[enough]]])
                    weight[enough] = subsequences(words[enough], items[enough], own_weights)
                good = enough[(weight[enough] >= WEIGHT) | (n < SHORT)]
                for g in good.tolist():
                    i, item = part[g], int(q[part[g]])
                    b = base[some[g]]
                    first = int(k[i] * n)
                    share = _answered(block.answers[item], hashes[max(b, b + first - n) : min(end[some[g]], b + first + 3 * n)])
                    if _leaked(int(matched[g]), int(n), share):
                        yield int(row[i]), item, (int(matched[g]), share, float(cosine[i]), -first, float(weight[g]))

    def run(batches):
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for lo, _, texts in pieces(batch["text"], fold=True):
                hashes = word_hashes(texts)
                cut = {size: passages_of(texts, hashes, size, own) for size, own in wanted.items()}
                rows = []
                for size, block in ((size, block) for size, own in by_size.items() for block in own):
                    passage, found, row, first = cut[size]
                    best: dict[tuple, tuple] = {}
                    sizes = np.array([len(i.words) for i in block.items])
                    for p, q, product in block.candidates(passage, found, len(row)):
                        # all words count in the passage's norm
                        cosine = product / np.sqrt(block.norm2[q]) / _norms(texts, hashes, block.space.idf, row, first, p, size)
                        n, r = sizes[q], row[p]
                        start = first[p] - texts.first[r]
                        length = texts.first[r + 1] - texts.first[r]
                        stop = np.minimum(start + 2 * size, length)
                        k_lo = -(-start // n)
                        k_hi = np.where(stop == length, (length - 1) // n, (stop - 2 * n) // n)
                        count = np.maximum(k_hi - k_lo + 1, 0)
                        of = np.repeat(np.arange(len(p)), count)
                        k = k_lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                        # a window lies in several passages
                        r, q, cosine = r[of], q[of], cosine[of]
                        order = np.lexsort((-cosine, k, r, q))
                        r, k, q, cosine = r[order], k[order], q[order], cosine[order]
                        once = np.ones(len(r), bool)
                        once[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1]) | (q[1:] != q[:-1])
                        for r, item, rank in checked(block, texts, hashes, r[once], k[once], q[once], cosine[once]):
                            key = (ids[lo + r], item)
                            if key not in best or rank > best[key]:
                                best[key] = rank
                    rows += [
                        {"doc_id": d, "item_id": block.items[q].item_id, "at": -at, "cosine": c, "matched": m, "item_words": int(sizes[q]), "share": m / int(sizes[q]), "weight": w, "answer": a}
                        for (d, q), (m, a, c, at, w) in best.items()
                        if d is not None
                    ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _FOUND)

    return run


def _norms(texts: Texts, hashes: np.ndarray, idf: np.ndarray, row: np.ndarray, first: np.ndarray, p: np.ndarray, size: int) -> np.ndarray:
    """Norm of each of these passages, over all its words."""
    names, which = np.unique(p, return_inverse=True)
    begin = first[names]
    stop = np.minimum(begin + 2 * size, texts.first[row[names] + 1])
    of = np.repeat(np.arange(len(names)), stop - begin)
    at = np.arange(len(of)) + np.repeat(begin - (np.cumsum(stop - begin) - (stop - begin)), stop - begin)
    pair = distinct(of * FEATURES + feature(hashes[at]))
    return np.sqrt(np.maximum(np.bincount(pair // FEATURES, idf[pair % FEATURES].astype(float) ** 2, len(names)), 1e-9))[which]


def _answered(answer: dict | None, words: np.ndarray) -> float:
    """Share of the answer that is there; none of an answer that tells nothing."""
    if answer is None:
        return 0.0
    present = set(words.tolist())
    return sum(w for h, w in answer.items() if h in present) / sum(answer.values())


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("at", pa.int32()), ("cosine", pa.float64()), ("matched", pa.int32()),
     ("item_words", pa.int32()), ("share", pa.float64()), ("weight", pa.float64()), ("answer", pa.float64())]
)


def _leaked(matched: int, size: int, answer: float) -> bool:
    if size < SHORT:
        return matched == size
    share = matched / size
    return share >= COPY or share >= PARAPHRASE and answer >= ANSWER


def leaks(docs: DataFrame, benchmark: DataFrame, fit_cells: float = FIT_CELLS) -> DataFrame:
    """Documents that hold items: doc_id, item_id, the word at which the best window begins,
    cosine (of the latent passage), matched (words of the subsequence), item_words, share,
    weight (share of the squared weights), answer, kind."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], FOUND)
    idf = None
    for group in item_groups(benchmark):
        known = [(size, items) for size, rows in group if (items := read_items(rows))]
        columns, stored = [word_columns(items) for _, items in known], None
        if idf is None:
            # the first group's pairs are counted in the same pass, if they are those of all cells
            stored = counted(docs, narrow(columns) if fit_cells == math.inf else {}, True)
            idf, n = weights_of(stored)
            fitted = fit_sample(docs, n, fit_cells)
        times = multipliers(fitted, columns, idf, stored if fit_cells == math.inf else None)
        blocks = [
            (size, Block(items, fit(fitted, items, idf, n, fit_cells=fit_cells, multiply=m), n)) for (size, items), m in zip(known, times)
        ]
        if blocks:
            found = found.unionByName(map_arrow(docs, _search(blocks), FOUND))
    best = F.max(F.struct("matched", "answer", "cosine", -F.col("at"), "item_words", "share", "weight"))
    kind = F.when(F.col("share") >= COPY, "copy").otherwise("paraphrase").alias("kind")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "item_id", (-F.col("b.col4")).alias("at"), *(F.col(f"b.{c}").alias(c) for c in ("cosine", "matched", "item_words", "share", "weight", "answer")))
        .select("*", kind)
    )
