"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time.

Index. Tasks cut their rows, where they lie, into shards of about ``SHARD`` bytes of text.
A shard is one row of a table: its documents in order of ids, and for each of its terms the
list of documents with the number of occurrences. Lists of ``LONG`` documents or more also
carry, for each range of ``RANGE`` documents, the largest number of occurrences and the
shortest document: from these follows a bound on the score in the range, whatever the
statistics of the corpus are. Nothing is shuffled, and every term of every row is indexed.

Search. Within a shard,

1. lists of an item's terms that are short are summed term at a time into accumulators:
   sorted documents with sums;
2. the accumulators are from then on one iterator with bounds, next to the long lists;
3. ranges are visited in document order. A range whose bounds add up to less than the worst
   of the best ``k`` so far is skipped. In others, the iterators with the smallest bounds
   that together stay below that mark cannot bring in a document by themselves: documents
   come from the others, and are looked up in these, largest bound first, only as long as
   they can still reach the mark.

A task carries the mark from shard to shard and hands out ``k`` documents for each item; the
best of all tasks are chosen with a limit for each group before the shuffle.

Statistics (documents, terms, documents of each wanted term) are sums over all shards. Items
are taken in blocks of about ``ITEMS`` rows and ``ITEM_BYTES`` bytes, each a pass over the
index, so what goes to the tasks is bounded.

Terms are compared as bytes, only A-Z lower-cased. Null and empty texts have no term and are
never found; items without a term find nothing. Each row is a document, also if rows repeat
an id. Documents without an id come last among equal scores. Items that repeat id and text
are one; items of one id with different texts are ranked each. Empty tables give empty
results; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverloom.llm.blobs import packed, unpacked
from riverloom.llm.units import distinct
from riverloom.session import map_arrow, saved

#: a shard passes through Spark as one row, of which executors hold several copies
SHARD = 2 << 20
#: bytes of text that are taken apart at a time
CHUNK = 1 << 20
LONG = 128
RANGE = 512
ITEMS, ITEM_BYTES = 1000, 1 << 20

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in bytes."""
    edge = np.diff(_TERM[data].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind each other with a space after each, and where each begins (and the last ends)."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    texts = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, places, chars = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(chars, np.uint8) if chars is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def build(ids: pa.Array, column: pa.Array) -> dict:
    """One shard, as a row of the index."""
    number = pc.fill_null(ids.cast(pa.int64()), np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    missing = pc.is_null(ids).to_numpy(zero_copy_only=False)
    order = np.lexsort((number, missing))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    data, rows = joined(column)
    lengths = np.zeros(len(order), np.int64)
    names, owners, docs, counts = [], [], [], []
    lo = 0
    while lo < len(data):
        hi = min(lo + CHUNK, len(data))
        while hi < len(data) and _TERM[data[hi - 1]]:  # not within a term
            tail = np.flatnonzero(~_TERM[data[hi : hi + CHUNK]])
            hi = hi + int(tail[0]) + 1 if len(tail) else min(hi + CHUNK, len(data))
        part = _LOWER[data[lo:hi]]
        starts, ends = term_spans(part)
        if len(starts):
            row = np.searchsorted(rows, lo + starts, side="right") - 1
            lengths += np.bincount(place[row], minlength=len(order))
            words, which = distinct(part, starts, ends)
            pair, n = np.unique(which.astype(np.int64) * len(order) + place[row], return_counts=True)
            owners.append(pair // len(order) + sum(map(len, names)))
            docs.append(pair % len(order))
            counts.append(n)
            names.append(words)
        lo = hi
    if names:
        coded = pa.concat_arrays(names).dictionary_encode()
        terms = coded.dictionary
        owner = coded.indices.to_numpy()[np.concatenate(owners)].astype(np.int64)
        pair = owner * len(order) + np.concatenate(docs)
        by = np.argsort(pair, kind="stable")
        pair, tf = pair[by], np.concatenate(counts)[by]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        pair, tf = pair[first], np.add.reduceat(tf, first)
    else:
        terms, pair, tf = pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, doc = pair // max(1, len(order)), pair % max(1, len(order))
    ends = np.searchsorted(owner, np.arange(len(terms)), side="right")
    most, least = _ranges(doc, tf, lengths, np.concatenate(([0], ends)), len(order))
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    chars = terms.buffers()[2]
    return {
        "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()), "ids": number[order].tobytes(),
        "missing": missing[order].tobytes(), "lengths": packed(lengths),
        "terms": chars.to_pybytes()[offsets[0] : offsets[-1]] if chars is not None else b"",
        "term_ends": packed(offsets[1:] - offsets[0]), "ends": packed(ends), "docs": packed(doc), "tf": packed(tf),
        "most": packed(most), "least": packed(least),
    }


def _ranges(doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, n: int):
    """Largest tf and least length in each range, for all long lists behind each other."""
    width = -(-n // RANGE)
    long = np.flatnonzero(np.diff(bounds) >= LONG)
    most, least = np.zeros(len(long) * width, np.int64), np.zeros(len(long) * width, np.int64)
    for i, t in enumerate(long):
        b, e = bounds[t], bounds[t + 1]
        cell = doc[b:e] // RANGE
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        most[i * width + cell[first]] = np.maximum.reduceat(tf[b:e], first)
        least[i * width + cell[first]] = np.minimum.reduceat(lengths[doc[b:e]], first)
    return most, least


_BLOBS = ("ids", "missing", "lengths", "terms", "term_ends", "ends", "docs", "tf", "most", "least")
INDEX = "n_docs long, n_terms long, " + ", ".join(f"{c} binary" for c in _BLOBS)
_INDEX = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), *((c, pa.binary()) for c in _BLOBS)])


def _build(shard: int):
    def run(batches):
        held, size = [], 0

        def row():
            table = pa.Table.from_batches(held).combine_chunks()
            found = build(table["doc_id"].chunk(0), table["text"].chunk(0))
            return pa.RecordBatch.from_pylist([found], _INDEX)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), shard - size, side="right")))
                held.append(batch.slice(lo, hi - lo))
                size += int(sizes[lo:hi].sum())
                lo = min(hi, batch.num_rows)
                if size >= shard or (lo < batch.num_rows):
                    yield row()
                    held, size = [], 0
        if held:
            yield row()

    return run


def index(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The index of all rows of docs (doc_id, text), written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(map_arrow(rows, _build(shard), INDEX), "lexical-index", together=1)


def _strings(chars: bytes, ends: bytes) -> pa.Array:
    stops = unpacked(ends)
    offsets = np.concatenate(([0], stops)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars)])


class Shard:
    def __init__(self, row: dict, wanted: pa.Array):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.missing = np.frombuffer(row["missing"], bool)
        self.lengths = unpacked(row["lengths"])
        self.docs = unpacked(row["docs"], "<i4")
        self.tf = unpacked(row["tf"], "<i4")
        self.bounds = np.concatenate(([0], unpacked(row["ends"])))
        self.width = -(-len(self.ids) // RANGE)
        self.most = unpacked(row["most"], "<i4").reshape(-1, max(1, self.width))
        self.least = unpacked(row["least"]).reshape(-1, max(1, self.width))
        self.long = np.cumsum(np.diff(self.bounds) >= LONG) - 1
        #: number of each wanted term's list here, -1 if it has none
        self.list_of = places(row, wanted)


def places(row: dict, wanted: pa.Array) -> np.ndarray:
    """Number of each wanted term in a shard's list of terms, -1 where it is missing."""
    found = pc.index_in(_strings(row["terms"], row["term_ends"]), value_set=wanted)
    here = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
    out = np.full(len(wanted), -1)
    out[found.take(pa.array(here)).to_numpy(zero_copy_only=False)] = here
    return out


@dataclass
class Best:
    """The best documents so far of one item."""

    k: int

    def __post_init__(self):
        self.score, self.missing, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def mark(self) -> int:
        """A document below it is not among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        score, missing, ids = (np.concatenate(p) for p in ((self.score, score), (self.missing, missing), (self.id, ids)))
        order = np.lexsort((ids, missing, -score))[: self.k]
        self.score, self.missing, self.id = score[order], missing[order], ids[order]


def impact(weight, tf, m):
    return weight * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m))


def search(shard: Shard, m, terms: list[tuple[int, int]], best: Best) -> int:
    """Offer the shard's best documents for (wanted term, weight) pairs; ``m`` gives a length's
    norm. Returns the number of postings that were scored."""
    lists = [(shard.list_of[t], w) for t, w in terms if shard.list_of[t] >= 0 and w > 0]
    spans = [(int(shard.bounds[t]), int(shard.bounds[t + 1]), w, int(t)) for t, w in lists]
    short = [s for s in spans if s[1] - s[0] < LONG]
    long = [s for s in spans if s[1] - s[0] >= LONG]
    scored = 0
    # term at a time
    sums_of, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if short:
        at = np.concatenate([np.arange(b, e) for b, e, _, _ in short])
        weight = np.repeat([w for _, _, w, _ in short], [e - b for b, e, _, _ in short])
        doc = shard.docs[at]
        value = impact(weight, shard.tf[at], m(shard.lengths[doc]))
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        sums_of, sums = doc[first], np.add.reduceat(value, first)
        scored += len(at)
    # bounds by iterator (the accumulators first) and range
    bound = np.zeros((1 + len(long), shard.width), np.int64)
    edges = np.arange(shard.width + 1) * RANGE
    if len(sums):
        np.maximum.at(bound[0], sums_of // RANGE, sums)
    cuts = [np.searchsorted(sums_of, edges)]
    for i, (b, e, w, t) in enumerate(long, 1):
        row = shard.long[t]
        bound[i] = impact(w, shard.most[row], m(shard.least[row]))
        cuts.append(b + np.searchsorted(shard.docs[b:e], edges))
    # document at a time
    total = bound.sum(axis=0)
    for r in np.flatnonzero(total >= best.mark):
        mark = best.mark
        if total[r] < mark:
            continue
        order = np.argsort(bound[:, r], kind="stable")
        upto = np.cumsum(bound[order, r])
        free = int(np.searchsorted(upto, mark))  # the iterators before it stay below the mark together
        found, values = [], []
        for i in order[free:]:
            lo, hi = cuts[i][r], cuts[i][r + 1]
            if i == 0:
                found.append(sums_of[lo:hi])
                values.append(sums[lo:hi])
            else:
                doc = shard.docs[lo:hi]
                found.append(doc)
                values.append(impact(long[i - 1][2], shard.tf[lo:hi], m(shard.lengths[doc])))
                scored += len(doc)
        local = np.zeros(RANGE, np.int64)
        for doc, value in zip(found, values):
            local[doc - r * RANGE] += value  # a document occurs once in an iterator
        doc = np.flatnonzero(local)
        score = local[doc]
        doc = doc + r * RANGE
        for j in range(free - 1, -1, -1):
            alive = score + upto[j] >= mark
            doc, score = doc[alive], score[alive]
            i = order[j]
            lo, hi = cuts[i][r], cuts[i][r + 1]
            if not len(doc) or lo == hi:
                continue
            own = sums_of[lo:hi] if i == 0 else shard.docs[lo:hi]
            at = np.minimum(np.searchsorted(own, doc), len(own) - 1)
            hit = np.flatnonzero(own[at] == doc)
            if i == 0:
                score[hit] += sums[lo + at[hit]]
            else:
                score[hit] += impact(long[i - 1][2], shard.tf[lo + at[hit]], m(shard.lengths[doc[hit]]))
                scored += len(hit)
        good = score >= mark
        doc = doc[good]
        best.offer(score[good], shard.missing[doc], shard.ids[doc])
    return scored


def item_terms(text: str | None) -> Counter:
    data = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    return Counter(data[s:e].tobytes() for s, e in zip(*term_spans(data)))


def term_frequencies(shards: DataFrame, wanted: pa.Array) -> np.ndarray:
    """Documents with each wanted term, over all shards."""

    def run(batches):
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                at = places(row, wanted)
                sizes = np.diff(unpacked(row["ends"]), prepend=0)
                total[at >= 0] += sizes[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    found = map_arrow(shards.select("terms", "term_ends", "ends"), run, "term long, df long")
    out = np.zeros(len(wanted), np.int64)
    for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def _search(items: list[tuple[int, int]], queries: list[list[tuple[int, int]]], wanted: pa.Array, n: int, length: int, k: int):
    def norm(size):
        return 100 - 75 + (75 * size * n) // length

    kind = pa.schema([("item_id", pa.int64()), ("version", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        best = [Best(k) for _ in queries]
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, wanted)
                for terms, own in zip(queries, best):
                    search(shard, norm, terms, own)
        for (item, version), own in zip(items, best):
            if len(own.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(own.score), pa.int64()), pa.array([version] * len(own.score), pa.int64()),
                        pa.array(own.id, pa.int64(), mask=own.missing), pa.array(own.score, pa.int64()),
                    ],
                    schema=kind,
                )

    return run


def rank(shards: DataFrame, benchmark: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of the index for each item."""
    spark = shards.sparkSession
    n, length = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", F.xxhash64("text").alias("version")).distinct()
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(rows / ITEMS), math.ceil(size / ITEM_BYTES))
    items = saved(items.withColumn("block", F.pmod(F.xxhash64("item_id", "version"), F.lit(blocks))), "lexical-items")
    found = spark.createDataFrame([], "item_id long, version long, doc_id long, score long")
    for block in range(blocks if length else 0):
        own = sorted(items.where(F.col("block") == block).collect(), key=lambda r: (r.item_id is None, r.item_id, r.version))
        counted = [item_terms(r.text) for r in own]
        names = sorted(set().union(*counted))
        if not names:
            continue
        wanted = pa.array(names, pa.large_binary())
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in term_frequencies(shards, wanted)]
        number = {t: i for i, t in enumerate(names)}
        queries = [[(number[t], c * weight[number[t]]) for t, c in sorted(terms.items())] for terms in counted]
        task = _search([(r.item_id, r.version) for r in own], queries, wanted, n, length, k)
        part = map_arrow(shards, task, "item_id long, version long, doc_id long, score long")
        # searched once; the limit of each group would read it several times
        found = found.unionByName(saved(part, "lexical-found"))
    place = F.row_number().over(Window.partitionBy("item_id", "version").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
