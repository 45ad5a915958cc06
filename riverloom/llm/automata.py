"""Removing passages that repeat across documents, by suffix automata.

A window of ``window`` consecutive words of a document is removed where the same words
also stand in a document with a smaller id. The corpus is cut into reference shards by
content, so that a passage meets its copies in one shard and nothing else:

* Every window names one anchor, its smallest ``GRAM``-word hash. Equal windows name
  equal anchors, so only anchors found in two or more documents matter. The windows of
  a document that name one anchor occurrence form one segment.
* Equal segments of an anchor are one, with the smallest id that holds it.
* The segments of a run of anchors, up to ``SHARD_WORDS`` words, are one reference
  shard. Its suffix automaton, with the smallest id of every state, stays in the task,
  and the shard's segments are streamed through it: the matching statistics give at
  each word the longest match and its state; from there the suffix links lead to the
  state of the last ``window`` words, whose id is the smallest of all documents that
  hold them.
* A document's removed words are the union of its windows with a smaller id.

An automaton is kept where its segments are rather than sent to every task: all
automata together grow with the corpus, and no document needs a shard with which it
shares no anchor.

Copies of a hot passage are one segment, and its contexts make many. An anchor with more
than ``MOST_SEGMENTS`` of them would not fit an automaton of bounded size: the windows of
these segments are dealt out by their hashes instead, as packed arrays, and each bucket
gives back the runs of windows that an earlier document holds too.

Null texts have no words. Rows without an id are never removed from and remove
nothing. Rows that repeat an id are one document's: they remove nothing from each
other. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.pairs import whole_runs
from riverloom.llm.words import Texts, pieces, range_hashes, signed
from riverloom.operators.joins import hot_join
from riverloom.session import map_arrow, saved

WINDOW = 50
GRAM = 8
SHARD_WORDS = 20_000
MOST_SEGMENTS = 512
SEGMENTS_PER_BUCKET = 20_000


class SuffixAutomaton:
    """Automaton of all substrings of the added sequences, each with its smallest id."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.low: list[int | None] = [None]

    def add(self, words: list, owner: int) -> None:
        nexts, link, length, low = self.next, self.link, self.length, self.low
        last = 0
        for w in words:
            known = nexts[last].get(w)
            if known is not None and length[known] == length[last] + 1:
                state = known
            else:
                if known is None:
                    state = len(nexts)
                    nexts.append({})
                    link.append(0)
                    length.append(length[last] + 1)
                    low.append(None)
                p = last
                while p >= 0 and w not in nexts[p]:
                    nexts[p][w] = state
                    p = link[p]
                if p >= 0:
                    q = nexts[p][w]
                    if length[q] == length[p] + 1:
                        link[state] = q
                    else:
                        copy = len(nexts)
                        nexts.append(dict(nexts[q]))
                        link.append(link[q])
                        length.append(length[p] + 1)
                        low.append(low[q])
                        while p >= 0 and nexts[p].get(w) == q:
                            nexts[p][w] = copy
                            p = link[p]
                        link[q] = copy
                        if known is None:
                            link[state] = copy
                        else:
                            state = copy
            if low[state] is None or owner < low[state]:
                low[state] = owner
            last = state

    def finish(self) -> None:
        """Hand the smallest ids down the suffix links."""
        low, link = self.low, self.link
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            up = link[s]
            if up > 0 and (low[up] is None or low[s] < low[up]):
                low[up] = low[s]

    def lowest(self, words: list, window: int) -> list[int]:
        """For each word from the window-th on: the smallest id that holds the window that
        ends there. The sequence must be one that was added."""
        nexts, link, length, low = self.next, self.link, self.length, self.low
        state = matched = 0
        found = []
        for i, w in enumerate(words, 1):
            while state and w not in nexts[state]:
                state = link[state]
                matched = length[state]
            step = nexts[state].get(w)
            if step is not None:
                state = step
                matched += 1
            # the state whose shortest substring is not longer than the window
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window:
                found.append(low[state] if matched >= window else None)
        return found


def _slide(values: np.ndarray, size: int, combine) -> np.ndarray:
    """combine over values[i : i + size], for every i at which it fits."""
    step, out = 1, values
    while step * 2 <= size:
        out = combine(out[:-step], out[step:])
        step *= 2
    rest = size - step
    return combine(out[: len(out) - rest], out[rest:]) if rest else out


def segments(texts: Texts, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(word number of the first window, number of windows, anchor) of each segment."""
    n = len(texts.starts)
    span = window - GRAM + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes = texts.hashes
    grams = range_hashes(hashes, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    smallest = _slide(grams, span, np.minimum)  # of the window that begins here
    # where it stands: the next place, from the window's begin, that holds it
    place = np.full(len(smallest), -1)
    # grams that are the smallest of some window, in order
    spread = np.concatenate((np.zeros(span - 1, np.uint64), smallest, np.zeros(span - 1, np.uint64)))
    chosen = np.flatnonzero(grams == _slide(spread, span, np.maximum)[: len(grams)])
    # a window's anchor is the first chosen gram in it that has the smallest value
    at = np.searchsorted(chosen, np.arange(len(smallest)))
    open_rows = np.arange(len(smallest))
    while len(open_rows):
        k = chosen[at[open_rows]]
        hit = grams[k] == smallest[open_rows]
        place[open_rows[hit]] = k[hit]
        open_rows = open_rows[~hit]
        at[open_rows] += 1
    last = np.repeat(texts.first[1:], np.diff(texts.first))
    valid = np.arange(len(smallest)) + window <= last[: len(smallest)]
    row = texts.rows()[: len(smallest)]
    new = np.ones(len(smallest), bool)
    new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.concatenate((begin, [len(smallest)])))
    keep = valid[begin]
    begin, count = begin[keep], count[keep]
    return begin, count, smallest[begin]


def _occurrences(window: int):
    def run(batches):
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"]):
                begin, count, anchor = segments(texts, window)
                row = np.searchsorted(texts.first, begin, side="right") - 1
                content = range_hashes(texts.hashes, begin, begin + count + window - 1) if len(begin) else anchor
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(anchor)),
                        pa.array(signed(content)),
                        batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()).take(pa.array(row)),
                        pa.array((begin - texts.first[row]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["anchor", "segment", "doc_id", "at", "windows"],
                )

    return run


OCCURRENCE = "anchor long, segment long, doc_id long, at int, windows int"
SEGMENT = "anchor long, segment long, low long, words string"
FOUND = "anchor long, segment long, runs array<struct<start:int,stop:int,low:long>>"


def _cut(window: int):
    """Words of the segments that a document holds for all its copies."""

    def run(batches):
        for batch in batches:
            held = batch["held"]
            ends = held.offsets.to_numpy()
            fields = {k: held.values.field(k).to_numpy(zero_copy_only=False) for k in ("anchor", "segment", "at", "windows")}
            docs = batch["doc_id"].to_numpy()
            for lo, hi, texts in pieces(batch["text"]):
                out = {"anchor": [], "segment": [], "low": [], "words": []}
                starts, stops = [], []
                for row in range(lo, hi):
                    first = texts.first[row - lo]
                    size = texts.first[row - lo + 1] - first
                    for k in range(ends[row], ends[row + 1]):
                        start = first + fields["at"][k]
                        words = fields["windows"][k] + window - 1
                        if fields["at"][k] + words > size:
                            continue  # of another row with the same id
                        chars = texts.data[texts.starts[start] : texts.ends[start + words - 1]]
                        out["anchor"].append(fields["anchor"][k])
                        out["segment"].append(fields["segment"][k])
                        out["low"].append(docs[row])
                        out["words"].append(chars.tobytes())
                        starts.append(start)
                        stops.append(start + words)
                if not starts:
                    continue
                content = signed(range_hashes(texts.hashes, np.array(starts), np.array(stops)))
                own = pa.array(content == np.array(out["segment"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[c], pa.int64()) for c in ("anchor", "segment", "low")]
                    + [pa.array(out["words"], pa.binary()).cast(pa.string())],
                    list(out),
                ).filter(own)

    return run


def _match(window: int, shard_words: int):
    def shard(anchors, contents, lows, texts):
        automaton = SuffixAutomaton()
        for low, words in zip(lows, texts):
            automaton.add(words, low)
        automaton.finish()
        runs = []
        for words in texts:
            found, spans = automaton.lowest(words, window), []
            for i, low in enumerate(found):
                if spans and spans[-1]["low"] == low:
                    spans[-1]["stop"] = i + 1
                else:
                    spans.append({"start": i, "stop": i + 1, "low": low})
            runs.append(spans)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("low", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()), pa.array(runs, kind)],
            ["anchor", "segment", "runs"],
        )

    def run(batches):
        for table, starts in whole_runs(batches, ["anchor"]):
            anchors, contents = table["anchor"].to_pylist(), table["segment"].to_pylist()
            lows, texts = table["low"].to_pylist(), table["words"]
            begin = 0
            kept: list = []
            size = 0
            for s, e in zip(starts[:-1], starts[1:]):
                for i in range(s, e):
                    kept.append(texts[i].as_py().encode().split())
                    size += len(kept[-1])
                if size >= shard_words or e == starts[-1]:
                    yield shard(anchors[begin:e], contents[begin:e], lows[begin:e], kept)
                    begin, kept, size = e, [], 0

    return run


ENTRY = np.dtype([("content", "i8"), ("anchor", "i8"), ("segment", "i8"), ("low", "i8"), ("start", "i4")])
PACKED = "bucket int, entries binary"


def _packed(entries: np.ndarray, bucket: np.ndarray):
    """One row for each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    numbers, cuts = np.unique(bucket[order], return_index=True)
    if len(numbers):
        parts = np.split(entries[order], cuts[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "entries"]
        )


def _unpacked(batches):
    """All entries of one bucket after the other; rows come sorted by bucket."""
    for table, starts in whole_runs(batches, ["bucket"]):
        blobs = table["entries"].to_pylist()
        for s, e in zip(starts[:-1], starts[1:]):
            yield np.frombuffer(b"".join(blobs[s:e]), ENTRY)


def _deal_windows(window: int, buckets: int, most: int = 500_000):
    """Every window of the segments, by content."""

    def run(batches):
        kept: list[np.ndarray] = []

        def flush():
            entries = np.concatenate(kept) if kept else np.zeros(0, ENTRY)
            kept.clear()
            yield from _packed(entries, entries["content"].view(np.uint64) % np.uint64(buckets))

        for batch in batches:
            own = {c: batch[c].to_numpy() for c in ("anchor", "segment", "low")}
            for lo, _, texts in pieces(batch["words"]):
                at, hashes = texts.windows(window)
                row = np.searchsorted(texts.first, at, side="right") - 1
                entries = np.zeros(len(at), ENTRY)
                for c in own:
                    entries[c] = own[c][lo + row]
                entries["content"], entries["start"] = signed(hashes), at - texts.first[row]
                kept.append(entries)
                if sum(map(len, kept)) >= most:
                    yield from flush()
        yield from flush()

    return run


def _earlier(buckets: int):
    """The windows that a smaller id holds too, with that id, by segment."""

    def run(batches):
        for entries in _unpacked(batches):
            entries = entries[np.argsort(entries["content"], kind="stable")]
            begin = np.flatnonzero(np.concatenate(([True], entries["content"][1:] != entries["content"][:-1])))
            low = np.minimum.reduceat(entries["low"], begin)
            low = np.repeat(low, np.diff(np.append(begin, len(entries))))
            found = low < entries["low"]
            entries = entries[found]
            entries["low"] = low[found]
            yield from _packed(entries, entries["segment"].view(np.uint64) % np.uint64(buckets))

    return run


def _runs(batches):
    """One row for each segment: its runs of windows with one id."""
    for e in _unpacked(batches):
        e = e[np.lexsort((e["start"], e["segment"], e["anchor"]))]
        same = (e["segment"][1:] == e["segment"][:-1]) & (e["anchor"][1:] == e["anchor"][:-1])
        on = same & (e["low"][1:] == e["low"][:-1]) & (e["start"][1:] == e["start"][:-1] + 1)
        begin = np.flatnonzero(np.concatenate(([True], ~on)))
        stop = e["start"][np.append(begin[1:], len(e)) - 1] + 1
        owner = np.flatnonzero(np.concatenate(([True], ~same)))
        offsets = np.append(np.searchsorted(begin, owner), len(begin)).astype(np.int32)
        spans = pa.StructArray.from_arrays(
            [pa.array(e["start"][begin]), pa.array(stop.astype(np.int32)), pa.array(e["low"][begin])],
            ["start", "stop", "low"],
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(e["anchor"][owner]), pa.array(e["segment"][owner]), pa.ListArray.from_arrays(pa.array(offsets), spans)],
            ["anchor", "segment", "runs"],
        )


def _strip(batches):
    for batch in batches:
        cuts = batch["cuts"]
        ends = cuts.offsets.to_numpy()
        start = cuts.values.field("start").to_numpy(zero_copy_only=False)
        stop = cuts.values.field("stop").to_numpy(zero_copy_only=False)
        for lo, hi, texts in pieces(batch["text"]):
            n_words, n_removed, texts_kept = [], [], []
            for row in range(lo, hi):
                first, last = texts.first[row - lo], texts.first[row - lo + 1]
                gone = np.zeros(last - first + 1, np.int64)
                a, b = start[ends[row] : ends[row + 1]], stop[ends[row] : ends[row + 1]]
                np.add.at(gone, np.minimum(a, last - first), 1)
                np.add.at(gone, np.minimum(b, last - first), -1)
                kept = np.cumsum(gone)[:-1] == 0
                chars = texts.data[texts.offsets[row - lo] : texts.offsets[row - lo + 1]].tobytes().split()
                if not kept.all():
                    chars = [w for w, k in zip(chars, kept) if k]
                n_words.append(last - first)
                n_removed.append(int((~kept).sum()))
                texts_kept.append(b" ".join(chars))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(texts_kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def removals(
    docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, most_segments: int = MOST_SEGMENTS
) -> DataFrame:
    """doc_id and ``cuts``, the runs of words [start, stop) to remove; documents with any."""
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = saved(map_arrow(docs, _occurrences(window), OCCURRENCE), "segments")
    repeated = (
        seen.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y")
    )
    shared = saved(hot_join(seen, repeated.select("anchor"), ["anchor"], "left_semi"), "shared-segments")
    holders = shared.groupBy("anchor", "segment").agg(F.min(F.struct("doc_id", "at", "windows")).alias("h"))
    held = holders.groupBy(F.col("h.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("anchor", "segment", "h.at", "h.windows")).alias("held")
    )
    cut = saved(map_arrow(docs.join(held, "doc_id"), _cut(window), SEGMENT).distinct(), "cut-segments")
    crowded = cut.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most_segments)
    crowded = crowded.select("anchor")
    by_anchor = cut.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    found = map_arrow(by_anchor, _match(window, shard_words), FOUND)
    crowd = saved(cut.join(crowded, "anchor", "left_semi"), "crowded-segments")
    buckets = max(1, -(-crowd.count() // SEGMENTS_PER_BUCKET))

    def by_bucket(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    dealt = map_arrow(crowd, _deal_windows(window, buckets), PACKED)
    earlier = map_arrow(by_bucket(dealt), _earlier(buckets), PACKED)
    # copies of a segment are removed as a whole, whatever else holds its windows
    words = F.size(F.split("words", r"[\x20\x09-\x0D]+"))
    whole = F.struct(F.lit(0).alias("start"), (words - (window - 1)).alias("stop"), "low")
    found = found.unionByName(map_arrow(by_bucket(earlier), _runs, FOUND)).unionByName(
        crowd.select("anchor", "segment", F.array(whole).cast("array<struct<start:int,stop:int,low:long>>").alias("runs"))
    )
    spans = (
        # a passage may be in a third of all documents
        hot_join(shared, found, ["anchor", "segment"], "left")
        .select("doc_id", "at", F.explode("runs").alias("r"))
        .where("r.low < doc_id")
        .select(
            "doc_id",
            F.struct(
                (F.col("at") + F.col("r.start")).alias("start"),
                (F.col("at") + F.col("r.stop") + (window - 1)).alias("stop"),
            ).alias("cut"),
        )
    )
    return spans.groupBy("doc_id").agg(F.collect_list("cut").alias("cuts"))


def without_repeats(
    docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, most_segments: int = MOST_SEGMENTS
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = removals(docs, window, shard_words, most_segments)
    both = docs.join(cuts, "doc_id", "left").withColumn(
        "cuts", F.coalesce("cuts", F.array().cast("array<struct<start:int,stop:int>>"))
    )
    return map_arrow(both, _strip, "doc_id long, n_words long, n_removed long, kept_text string")
