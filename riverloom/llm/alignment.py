"""Alignment of two tokenizers' ids over the same bytes, by pointer jumping.

A text's tokens under tokenizer A (byte-level BPE) and B (a sentence-piece model) are two ways
to cut the same bytes: a space and the text. Tokens that overlap are linked; the components of
these links are the groups, which end where tokens of both end.

Groups. Every token points to its farthest-right overlapping token, or to itself if none
reaches farther (of two that end together, to A's). Successors are doubled, for all tokens
at once, until nothing changes: each token then knows its component's terminal token, which
is the group's label.

Units. Neither tokenizer looks across a space that follows a character other than white space:
A's pattern begins a new word there, and B has no piece with a space after something else
(checked on the vocabulary; with another model whole texts are units). So texts are cut
there, and the work on each distinct unit is done once and cached (:mod:`units`).

Counts. How often a pair of ids is linked in the whole corpus is needed by every document that
holds the pair, so nothing is gathered: each piece of the corpus (about ``PIECE`` bytes of
text) is one row with its documents, their units and its distinct pairs. Pairs are dealt to
buckets by B's id as packed arrays, summed in the tasks before they are shuffled, and again by
bucket, where the highest count of each B id is known. Each piece then asks the buckets for
its own pairs; a bucket is copied for every ``ASKING`` pieces, so no task answers an unbounded
number. Answers go back to their pieces, which add them up by unit and by document.

Special tokens' strings in texts are plain text. Documents whose text is null or empty, or whose
tokens' bytes under A or B differ from the space and the text, have no tokens: zeros, and an
empty ``groups``. Each row is a document, also if ids are repeated or null. Empty tables give
empty results; other columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.blobs import packed, unpacked
from riverloom.llm.units import UnitCache, distinct, spread
from riverloom.session import map_arrow, saved

#: a piece passes through Spark as one row, of which executors hold several copies
PIECE = 1 << 20
#: pieces that one copy of a bucket answers
ASKING = 4096
#: distinct pairs that a task holds before it hands them on
HELD = 1 << 20
_WIDE = 32


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand
    for themselves, the others for characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, and what follows from a unit alone."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(map(alphabet.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i))]
        self.cuts = not any("▁" in p.lstrip("▁") for p in plain) and "▁" in pieces
        self.space = self.b.piece_to_id("▁")
        self.cache = UnitCache(self.work, [(np.bool_, np.int64, np.int64, np.int64), (np.int64,)])

    def encode(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids under A and B, and whether both give the unit's bytes back. Units begin with a space."""
        texts = [u.decode(errors="replace") for u in units]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts the first space itself, but before something only
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        b = [ids if len(t) > 1 else [self.space] for ids, t in zip(b, texts)]
        own, other = self.a_bytes, self.b_bytes
        good = [
            b"".join([own[i] for i in x]) == u and b"".join([other[i] for i in y]) == u
            for u, x, y in zip(units, a, b)
        ]
        return a, b, good

    def work(self, units: list[bytes]):
        """For each unit (good, tokens of A, tokens of B, groups), its linked pairs, and its groups as text."""
        a, b, good = self.encode(units)
        a = [x if g else [] for x, g in zip(a, good)]
        b = [x if g else [] for x, g in zip(b, good)]
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        a_ids, b_ids = (np.array([i for x in ids for i in x], np.int64) for ids in (a, b))
        a_end = np.cumsum([len(self.a_bytes[i]) for i in a_ids.tolist()], dtype=np.int64)
        b_end = np.cumsum([len(self.b_bytes[i]) for i in b_ids.tolist()], dtype=np.int64)
        label, lo, count = align(a_end, b_end)
        links = spread(lo, count)
        pairs = np.repeat(a_ids, count) << _WIDE | b_ids[links]
        a_of, b_of = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        ends = np.concatenate(([0], np.cumsum(count)))
        n_links = ends[a_of + n_a] - ends[a_of]
        last = label[: len(a_ids)] == np.arange(len(a_ids))  # terminal tokens
        upto = np.concatenate(([0], np.cumsum(last)))
        n_groups = upto[a_of + n_a] - upto[a_of]
        texts = groups_texts(a, b, label, a_of, b_of, len(a_ids))
        return (np.ones(len(units), np.int64), [np.array(good, bool), n_a, n_b, n_groups]), (n_links, [pairs]), texts


def align(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label of every token (A's first, then B's), and for each of A's the first and the
    number of B's that overlap it. Both cut the same bytes, at these ends."""
    n_a, n_b = len(a_end), len(b_end)
    a_start, b_start = (np.concatenate(([0], e))[:-1] for e in (a_end, b_end))
    lo = np.searchsorted(b_end, a_start, side="right")
    hi = np.searchsorted(b_start, a_end, side="left")
    last_a = np.searchsorted(a_start, b_end, side="left") - 1
    if n_a:
        reaches = b_end[hi - 1] > a_end
        point = np.concatenate((np.where(reaches, n_a + hi - 1, np.arange(n_a)), last_a))
    else:
        point = np.zeros(0, np.int64)
    while True:
        twice = point[point]
        if np.array_equal(twice, point):
            return point, lo, hi - lo
        point = twice


def groups_texts(a: list, b: list, label: np.ndarray, a_of: np.ndarray, b_of: np.ndarray, n_a: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each unit."""
    ends, other = label[:n_a].tolist(), label[n_a:].tolist()
    out = []
    for x, y, p, q in zip(a, b, a_of.tolist(), b_of.tolist()):
        if len(x) == 1:
            out.append(f"{x[0]}|{','.join(map(str, y))}")
            continue
        groups: dict[int, tuple[list, list]] = {}
        for k, i in enumerate(x):
            groups.setdefault(ends[p + k], ([], []))[0].append(str(i))
        for k, i in enumerate(y):
            groups[other[q + k]][1].append(str(i))
        out.append(";".join(f"{','.join(g)}|{','.join(h)}" for g, h in groups.values()))
    return out


@lru_cache(maxsize=1)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def forget() -> None:
    """Free the tokenizers and cached units of this worker; they refer to each other."""
    pair_of.cache_clear()
    gc.collect()


#: first bytes of characters of which some are white space
_UNSURE = np.zeros(256, bool)
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(data: np.ndarray, rows: np.ndarray, cuts: bool) -> np.ndarray:
    """Where units begin: at each row, and at spaces that surely follow something else.

    ``data`` holds a space before each row's text; ``rows`` where they begin."""
    if not cuts:
        return rows
    before, second, third = (np.concatenate((np.full(k, 0x20, np.uint8), data[:-k] if k <= len(data) else data[:0]))[: len(data)] for k in (1, 2, 3))
    ascii_sign = (before > 0x20) & (before < 0x7F)
    # the byte before ends a character of two, three or four bytes
    two, three = second >= 0xC0, (second < 0xC0) & (third >= 0xC0)
    lead = np.where(two, second, np.where(three, third, 0xF0))
    sure = ascii_sign | ((before >= 0x80) & ~_UNSURE[lead])
    at = (data == 0x20) & sure
    at[rows] = True
    return np.flatnonzero(at)


def piece_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with a space before each, and where each begins; no text has none."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    some = pc.if_else(pc.greater(pc.binary_length(texts), 0), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    texts = pc.binary_join_element_wise(some, texts, pa.scalar("", pa.large_string()))
    _, places, chars = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(chars, np.uint8) if chars is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[end of the one before : end]."""
    total = np.concatenate(([0], np.cumsum(values)))
    return np.diff(total[ends], prepend=0)


def one_piece(pair: Pair, ids: pa.Array, column: pa.Array, buckets: int) -> dict:
    data, offsets = piece_rows(column)
    n = len(column)
    sizes = np.diff(offsets)
    begin = offsets[:-1][sizes > 0]
    starts = unit_starts(data, begin, pair.cuts) if len(data) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(data))
    names, which = distinct(data, starts, stops)
    slots = pair.cache.slots(names)
    facts, linked = pair.cache.new.lists
    _, (good, n_a, n_b, n_groups) = facts.take(slots)
    n_links, (pairs,) = linked.take(slots)
    texts = pair.cache.new.texts
    ends = np.searchsorted(starts, offsets[1:])  # units up to each row's end
    bad = sums((~good)[which].astype(np.int64), ends) > 0
    # units of rows with tokens, and where each row's end
    used = which[~np.repeat(bad, np.diff(ends, prepend=0))]
    ends = np.cumsum(np.where(bad, 0, np.diff(ends, prepend=0)))
    per_row = {c: sums(v[used], ends) for c, v in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links))}
    strings = [texts[s] for s in slots.tolist()]
    groups, lo = [], 0
    places = used.tolist()
    for hi in ends.tolist():
        own = places[lo:hi]
        groups.append(hashlib.sha256(";".join([strings[k] for k in own]).encode()).hexdigest() if own else "")
        lo = hi
    # distinct pairs by bucket, and how often each is linked in this piece
    times = np.bincount(used, minlength=len(names))
    known, at = np.unique(pairs, return_inverse=True)
    bucket = bucket_of(known, buckets)
    by = np.argsort(bucket, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    at = rank[at]
    count = np.bincount(at, np.repeat(times, n_links), len(known)).astype(np.int64)
    return per_row | {
        "ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
        "missing": pc.is_null(ids).to_numpy(zero_copy_only=False).tobytes(), "groups": "".join(g.ljust(64) for g in groups),
        "ends": packed(ends), "units": packed(used), "unit_links": packed(n_links),
        "links": packed(at), "pairs": packed_pairs(known[by]), "counts": packed(count),
    } | {c: packed(v) for c, v in per_row.items()}


def packed_pairs(pairs: np.ndarray) -> bytes:
    """A's ids, then B's."""
    a = packed(pairs >> _WIDE)
    return len(a).to_bytes(8, "little") + a + packed(pairs & ((1 << _WIDE) - 1))


def pairs_of(blob: bytes) -> np.ndarray:
    cut = 8 + int.from_bytes(blob[:8], "little")
    return unpacked(blob[8:cut]) << _WIDE | unpacked(blob[cut:])


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """By B's id alone, spread."""
    b = (pairs & ((1 << _WIDE) - 1)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((b >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


_BLOBS = ("n_a", "n_b", "n_groups", "n_links", "ids", "missing", "ends", "units", "unit_links", "links", "pairs", "counts")
PIECES = "piece long, groups string, " + ", ".join(f"{c} binary" for c in _BLOBS)
_PIECES = pa.schema([("piece", pa.int64()), ("groups", pa.string()), *((c, pa.binary()) for c in _BLOBS)])


def _pieces(a_path: str, b_path: str, buckets: int, size: int):
    def run(batches):
        pair = pair_of(a_path, b_path)
        number = 0
        first = TaskContext.get().partitionId() << 32

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), size, side="right")))
                part = batch.slice(lo, hi - lo)
                row = one_piece(pair, part["doc_id"], part["text"], buckets) | {"piece": first + number}
                yield pa.RecordBatch.from_pylist([row], _PIECES)
                number += 1
                lo = hi

    return run


def _runs(pairs: np.ndarray, buckets: int):
    """(bucket, from, to) of pairs in order of buckets."""
    bucket = bucket_of(pairs, buckets)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    return zip(bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(pairs)])


def _added(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(counts, first) if len(first) else counts


def _partial(buckets: int):
    """Counts of a task's pieces by bucket. All pieces are cut by now, so a worker that has
    tokenizers and cached units is rid of them."""
    kind = pa.schema([("bucket", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        forget()
        held, size = [], 0

        def out():
            pairs, counts = _added(*(np.concatenate(x) for x in zip(*held)))
            by = np.argsort(bucket_of(pairs, buckets), kind="stable")
            pairs, counts = pairs[by], counts[by]
            rows = [{"bucket": k, "pairs": packed_pairs(pairs[s:e]), "counts": packed(counts[s:e])} for k, s, e in _runs(pairs, buckets)]
            return pa.RecordBatch.from_pylist(rows, kind)

        for batch in batches:
            for row in batch.to_pylist():
                held.append((pairs_of(row["pairs"]), unpacked(row["counts"])))
                size += len(held[-1][0])
                if size > HELD:
                    held = [_added(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    return run


def _totals(batches):
    """Corpus-wide counts of each bucket's pairs, and whether each is the highest of its B id."""
    kind = pa.schema([("bucket", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
    bucket, pairs, counts, held = None, None, None, []

    def row():
        b = pairs & ((1 << _WIDE) - 1)
        ids, which = np.unique(b, return_inverse=True)
        most = np.zeros(len(ids), np.int64)
        np.maximum.at(most, which, counts)
        best = counts == most[which]
        return pa.RecordBatch.from_pylist([{"bucket": bucket, "pairs": packed_pairs(pairs), "counts": packed(counts), "best": best.tobytes()}], kind)

    def fold():
        return _added(*(np.concatenate(x) for x in zip(*held)))

    for batch in batches:
        for r in batch.to_pylist():
            if r["bucket"] != bucket:
                if held:
                    pairs, counts = fold()
                    yield row()
                bucket, held, size, least = r["bucket"], [], 0, HELD
            held.append((pairs_of(r["pairs"]), unpacked(r["counts"])))
            size += len(held[-1][0])
            if size > least:
                held = [fold()]
                size = len(held[0][0])
                least = max(HELD, 2 * size)
    if held:
        pairs, counts = fold()
        yield row()


def _ask(buckets: int, salts: int):
    kind = pa.schema([("bucket", pa.int64()), ("salt", pa.int64()), ("piece", pa.int64()), ("pairs", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs = pairs_of(row["pairs"])
                rows = [
                    {"bucket": k, "salt": row["piece"] % salts, "piece": row["piece"], "pairs": packed_pairs(pairs[s:e])}
                    for k, s, e in _runs(pairs, buckets)
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return run


ANSWERS = "piece long, bucket long, counts binary, best binary"
_ANSWERS = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary()), ("best", pa.binary())])


def _answer(batches):
    """A bucket's row (no piece) comes before the pieces that ask it."""
    pairs = counts = best = None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            own = pairs_of(r["pairs"])
            if r["piece"] is None:
                pairs, counts, best = own, unpacked(r["counts"]), np.frombuffer(r["best"], bool)
                continue
            at = np.searchsorted(pairs, own)
            rows.append({"piece": r["piece"], "bucket": r["bucket"], "counts": packed(counts[at]), "best": best[at].tobytes()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ANSWERS)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(batches):
    kind = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            answers = r["answers"] or []  # in order of buckets, as the pairs are
            counts = np.concatenate([np.zeros(0, np.int64), *(unpacked(x["counts"]) for x in answers)])
            best = np.concatenate([np.zeros(0, bool), *(np.frombuffer(x["best"], bool) for x in answers)])
            links = unpacked(r["links"])
            ends_of_unit = np.cumsum(unpacked(r["unit_links"]))
            units, ends = unpacked(r["units"]), unpacked(r["ends"])
            missing = np.frombuffer(r["missing"], bool)
            by_unit = [sums(v[links].astype(np.int64), ends_of_unit) for v in (best, counts)]
            columns = [pa.array(np.frombuffer(r["ids"], "<i8"), pa.int64(), mask=missing)]
            columns += [pa.array(unpacked(r[c])) for c in ("n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array(sums(v[units], ends)) for v in by_unit]
            text = r["groups"]
            groups = pa.array([text[i : i + 64].rstrip() for i in range(0, len(text), 64)], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, groups], schema=kind)


def aligned(docs: DataFrame, a_path: str, b_path: str, buckets: int | None = None, piece: int = PIECE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of
    docs (doc_id, text), for the tokenizer files of A and B."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = saved(map_arrow(rows, _pieces(a_path, b_path, buckets, piece), PIECES), "aligned-pieces", together=1)
    partial = map_arrow(pieces.select("pairs", "counts"), _partial(buckets), "bucket long, pairs binary, counts binary")
    totals = map_arrow(
        partial.repartition(buckets, "bucket").sortWithinPartitions("bucket"), _totals, "bucket long, pairs binary, counts binary, best binary"
    )
    totals = saved(totals, "aligned-totals")
    salts = max(1, -(-pieces.count() // ASKING))
    asked = map_arrow(pieces.select("piece", "pairs"), _ask(buckets, salts), "bucket long, salt long, piece long, pairs binary")
    copies = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    both = asked.unionByName(copies, allowMissingColumns=True)
    dealt = both.repartition(buckets * salts, "bucket", "salt").sortWithinPartitions("bucket", "salt", F.asc_nulls_first("piece"))
    answers = map_arrow(dealt, _answer, ANSWERS)
    answers = answers.groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts", "best"))).alias("answers"))
    kept = pieces.drop("pairs", "counts")
    return map_arrow(kept.join(answers, "piece", "left"), _finish, RESULT)
