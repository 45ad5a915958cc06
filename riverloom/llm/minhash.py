"""Near-duplicates by one-permutation hashing with optimal densification.

One hash of every shingle gives the whole signature: the hash range is cut into
``BINS`` equal bins and the smallest hash of each is its value. An empty bin takes
the value of the first filled bin in an order of its own, fixed for all documents.
Signatures are cut into bands; documents that agree in a band share a bucket.

A bucket proposes a star: its member with most bucket mates is the hub, and every
other member a candidate with the hub, so a bucket of n members has n - 1 pairs.
Candidates are confirmed on full shingle sets. Where a bucket still holds several
components, its members are compared by signature in blocks of bounded size. Those with
a partner in another component whose signature agrees in at least :func:`least_agreeing`
bins (``DEVIATIONS`` below the threshold) meet again with their full sets, all
intersections of a block are counted at once, and the links found leave the task as
stars. So a star around the wrong hub loses no link, and no pair of a bucket is ever a
row. Bands are as wide as they can be so that a pair at the threshold shares none with a
probability of ``MISSED`` at most (3e-7 at 0.85).

Documents with equal sets are one class and compared once. A document's set holds its
distinct shingles of five words; of fewer words, the whole sequence; of no words or a
null text, nothing, and it is linked with nothing. Rows that repeat an id are rows of
their own; what one of them is linked with, the others of the class of that id are.
Rows without an id get no component and are kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.components import components
from riverloom.llm.pairs import block_units, local_roots, whole_runs
from riverloom.llm.words import Texts, lists, mix, pieces, range_hashes, signed
from riverloom.session import map_arrow, saved

SHINGLE = 5
BINS = 192
MISSED = 1e-6
DEVIATIONS = 5.9
BLOCK = 512
UNIT = ["key", "lo", "hi"]

_rng = np.random.Generator(np.random.PCG64(5))
_ORDER = np.array([_rng.permutation(BINS) for _ in range(BINS)])
_WEIGHTS = _rng.integers(1, 2**63, BINS, dtype=np.uint64) | np.uint64(1)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows of a band): the widest bands that miss few enough pairs at the threshold."""
    widths = (r for r in range(BINS, 1, -1) if (1 - (percent / 100) ** r) ** (BINS // r) <= MISSED)
    rows = next(widths, 1)
    return BINS // rows, rows


def least_agreeing(percent: int) -> int:
    """Bins in which signatures of a pair at the threshold agree at the least."""
    share = percent / 100
    return max(0, int(BINS * share - DEVIATIONS * (BINS * share * (1 - share)) ** 0.5))


def shingle_sets(texts: Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    _, hashes = texts.windows(size)
    words = np.diff(texts.first)
    ends = np.cumsum(np.maximum(words - size + 1, 0))
    short = np.flatnonzero((words > 0) & (words < size))
    whole = dict(zip(short, range_hashes(texts.hashes, texts.first[short], texts.first[short + 1])))
    begin = 0
    for row, end in enumerate(ends):
        yield np.unique(hashes[begin:end]) if end > begin else np.array([whole[row]] if row in whole else [], np.uint64)
        begin = end


def signature(hashes: np.ndarray) -> np.ndarray:
    """BINS values of a non-empty sorted set."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    at = bins[first].astype(np.int64)
    values[at], filled[at] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    used = bands * rows
    return mix((values[:used] * _WEIGHTS[:used]).reshape(bands, rows).sum(axis=1, dtype=np.uint64))


SIGNED = "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>, agree binary"


def _sign(percent: int):
    shape = banding(percent)

    def run(batches):
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"], lower=True):
                sizes, fp1, fp2, bands, agree = [], [], [], [], []
                for s in shingle_sets(texts):
                    sizes.append(len(s))
                    fp1.append(mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64))
                    fp2.append(mix(s + np.uint64(0xC2B2AE3D)).sum(dtype=np.uint64))
                    values = signature(s) if len(s) else None
                    bands.append(signed(band_keys(values, *shape)) if len(s) else np.zeros(0, np.int64))
                    agree.append(mix(values).astype(np.uint8).tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(signed(np.array(fp1, np.uint64))),
                        pa.array(signed(np.array(fp2, np.uint64))),
                        lists(np.concatenate(bands), np.cumsum([len(b) for b in bands]), pa.int64()),
                        pa.array(agree, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "fp1", "fp2", "bands", "agree"],
                )

    return run


def _sets(batches):
    for batch in batches:
        for lo, hi, texts in pieces(batch["text"], lower=True):
            sets = list(shingle_sets(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()),
                    lists(signed(np.concatenate(sets)), np.cumsum([len(s) for s in sets]), pa.int64()),
                ],
                ["doc_id", "shingles"],
            )


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = []
            for name in ("sa", "sb"):
                column = batch[name]
                offsets = column.offsets.to_numpy()
                sides.append((column.values.to_numpy(zero_copy_only=False).view(np.uint64), offsets))
            (va, oa), (vb, ob) = sides
            for i in range(batch.num_rows):
                a, b = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _promising(percent: int):
    """Members of a unit with a partner of another component and a like signature."""
    least = least_agreeing(percent)

    def run(batches):
        for table, starts in whole_runs(batches, UNIT):
            label = table["label"].to_numpy()
            lo, hi, block = (table[c].to_numpy() for c in ("lo", "hi", "block"))
            agree = np.frombuffer(b"".join(table["agree"].to_pylist()), np.uint8).reshape(-1, BINS)
            keep = np.zeros(len(table), bool)
            for s, e in zip(starts[:-1], starts[1:]):
                cross = lo[s] != hi[s]
                for i in range(s, e - 1):
                    others = np.arange(i + 1, e)
                    others = others[label[others] != label[i]]
                    if cross:
                        others = others[block[others] != block[i]]
                    alike = others[(agree[others] == agree[i]).sum(axis=1) >= least]
                    keep[alike] = True
                    keep[i] |= len(alike) > 0
            yield from table.drop_columns(["agree"]).filter(pa.array(keep)).combine_chunks().to_batches()

    return run


def shared_counts(values: np.ndarray, ends: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets; set i is values[ends[i-1]:ends[i]]."""
    n = len(ends)
    owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    often = times > 1  # a shingle of one set is in no intersection
    column = np.cumsum(often) - 1
    shared = often[number]
    owner, number = owner[shared], column[number[shared]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    out = np.zeros((n, n), np.float32)
    for lo in range(0, int(often.sum()), columns):
        a, b = np.searchsorted(number, [lo, lo + columns])
        has = np.zeros((n, columns), np.float32)
        has[owner[a:b], number[a:b] - lo] = 1
        out += has @ has.T
    return out


def _link_in_blocks(percent: int):
    def run(batches):
        for table, starts in whole_runs(batches, UNIT):
            rep, label = table["rep"].to_numpy(), table["label"].to_numpy()
            lo, hi, block = (table[c].to_numpy() for c in ("lo", "hi", "block"))
            sets = table["shingles"].combine_chunks()
            offsets, values = sets.offsets.to_numpy().astype(np.int64), sets.values.to_numpy(zero_copy_only=False)
            links = []
            for s, e in zip(starts[:-1], starts[1:]):
                own = values[offsets[s] : offsets[e]]
                ends = offsets[s + 1 : e + 1] - offsets[s]
                both = shared_counts(own, ends).astype(np.int64)
                sizes = np.diff(ends, prepend=0)
                linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
                linked &= label[s:e, None] != label[None, s:e]
                if lo[s] != hi[s]:
                    linked &= block[s:e, None] != block[None, s:e]
                i, j = np.nonzero(np.triu(linked, 1))
                if len(i):
                    root = local_roots(e - s, i, j)
                    members = np.flatnonzero(root != np.arange(e - s))
                    links.append((rep[s:e][members], rep[s:e][root[members]]))
            if links:
                a, b = (np.concatenate(x) for x in zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signatures = saved(map_arrow(docs, _sign(percent), SIGNED), "minhash-signatures")
    key = ["n_shingles", "fp1", "fp2"]
    classes = saved(
        signatures.where("n_shingles > 0")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("agree").alias("agree"))
        .where("rep IS NOT NULL"),
        "minhash-classes",
    )
    members = classes.select(F.explode("bands").alias("key"), "rep")
    buckets = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(members.join(buckets, "key"), "minhash-buckets")

    sizes = classes.select("rep", "n_shingles")
    near_ids = shared.select(F.col("rep").alias("doc_id")).distinct()
    near = docs.join(near_ids, "doc_id", "left_semi")
    sets = saved(map_arrow(near, _sets, "doc_id long, shingles array<long>"), "minhash-sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        fitting = (
            pairs.join(sizes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na")), "a")
            .join(sizes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb")), "b")
            .where(small * 100 >= large * percent)
            .select("a", "b")
        )
        with_sets = fitting.join(
            sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a"
        ).join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        return saved(map_arrow(with_sets, _confirm(percent), "a long, b long"), name)

    mates = shared.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("mates"))
    ranked = shared.join(mates, "rep").select("key", "rep", F.struct("mates", -F.col("rep")).alias("rank"))
    hubs = ranked.groupBy("key").agg((-F.max("rank").getField("col2")).alias("hub"))
    stars = (
        shared.join(hubs, "key")
        .where("rep <> hub")
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        .distinct()
    )
    links = confirmed(stars, "minhash-links")
    labels = components(links)

    labelled = shared.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label")
    )
    split = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    open_rows = labelled.join(split.select("key"), "key").join(classes.select("rep", "agree"), "rep")
    promising = map_arrow(
        block_units(open_rows, ["key"], "rep", BLOCK),
        _promising(percent),
        "key long, rep long, label long, block int, lo int, hi int",
    )
    again = saved(promising, "minhash-open").join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    more = map_arrow(
        again.repartition(*UNIT).sortWithinPartitions(*UNIT), _link_in_blocks(percent), "a long, b long"
    )
    labels = components(links.unionByName(more))

    found = classes.select(*key, "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    found = found.select(*key, F.coalesce("component", "rep").alias("component_id"))
    rows = signatures.select("doc_id", *key)
    # equal sets of nothing are no class: their rows get keys that match nothing
    rows = rows.withColumn("fp1", F.when(F.col("n_shingles") > 0, F.col("fp1")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        rows.join(found, key, "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
