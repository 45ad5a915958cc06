"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, scored from files.

Counting. Tasks turn texts into word hashes and keep the distinct n-grams of what they
have read, with counts, as sorted arrays; these partial counts, not the words, are
shuffled, as one binary row per task and bucket. A bucket holds the n-grams whose
context hashes to it, so it has all that the context's statistics need. Contexts that
may occur more often than that are spread over further buckets by their last word, and
their statistics are added up at the end. A bucket gets the n-grams of about
``BUCKET_TOKENS`` tokens, which bounds the memory of a task; a larger corpus has more
buckets, and executors with more memory may have larger ones.

Model. Every bucket is written to the shared folder as sorted 64-bit hash arrays: the
n-grams with their counts, and the contexts with total and numbers of n-grams that
occur once, twice and more often. For the lowest order the counts are numbers of
distinct words before. Discounts follow Chen and Goodman from counts of counts.

Scoring. Workers map the files into memory and look up the sorted n-grams of a piece of
text by binary search; pages that are not needed are never read, and all workers of a
machine share one copy. The probability of a word w after u is

    max(c(uw) - D(c(uw)), 0) / c(u.) + (D1 N1 + D2 N2 + D3 N3) / c(u.) * p(w)

down to p(w), interpolated with 1 / (V + 1); an unknown word has the left-over alone.

A text's tokens are its words, lower-cased A-Z, and one end; a begin mark that is never
predicted is the first context. Null and empty texts have one token, the end. Rows that
repeat count as often as they occur. Without training texts every token is unknown and
has probability one: V is 0. The folder must be one that workers can map: ``file:``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.pairs import whole_runs
from riverloom.llm.words import Texts, mix, pieces
from riverloom.session import map_arrow, new_folder, saved

ORDER = 3
FLUSH = 2_000_000
BUCKET_TOKENS = 2_000_000
BUCKET_TEXT = 64 << 20
ENDING = np.uint64(0x1D8E4E27C47D124F)
BEGIN = np.uint64(0xA24BAED4963EE407)


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every row, each row closed by ENDING; where each row begins."""
    words = np.diff(texts.first)
    ends = np.cumsum(words + 1) - 1
    out = np.full(len(texts.hashes) + len(words), ENDING)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = texts.hashes
    return out, np.concatenate(([0], ends + 1))


def contexts(ids: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """The order - 1 tokens before each token, nearest last; BEGIN before a row's first."""
    out = []
    place = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
    for back in range(order - 1, 0, -1):
        column = np.full(len(ids), BEGIN)
        column[back:] = np.where(place[back:] >= back, ids[: len(ids) - back], BEGIN)
        out.append(column)
    return out


def fold(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for a tuple of token hashes."""
    h = np.zeros(len(columns[0]), np.uint64) if columns else None
    for c in columns:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + c)
    return h


def by_bucket(bucket: np.ndarray) -> np.ndarray:
    """Stable order of small numbers; those of two bytes need no comparisons."""
    return np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each, and the number of each place's key. Quicker than
    ``np.unique``, which sorts so that places are the first ones."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return sorted_[new], order[new], which


def tally(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples in order of their fold, with summed counts."""
    key = fold(columns)
    order = np.argsort(key)
    key = key[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
    return [c[order[begin]] for c in columns], (np.add.reduceat(counts[order], begin) if len(key) else counts)


def narrow(counts: np.ndarray, most: int | None = None) -> np.ndarray:
    """The same numbers in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)) if most is None else most))


def _unpack(blob: pa.Buffer, n: int, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    columns = [np.frombuffer(blob, np.uint64, n, 8 * n * k) for k in range(order)]
    kind = np.dtype(f"u{blob.size // n - 8 * order}")
    return columns, np.frombuffer(blob, kind, n, 8 * n * order).astype(np.int64)


_CODEC = pa.Codec("zstd", 3)


def _first_two(columns: list[np.ndarray]) -> np.ndarray:
    """Places in order of the first two columns."""
    if len(columns) > 1 and max(c.itemsize for c in columns[:2]) <= 4:
        return np.argsort(columns[0].astype(np.uint64) << np.uint64(32) | columns[1].astype(np.uint64))
    return np.lexsort(columns[1::-1])


def pack(columns: list[np.ndarray], counts: np.ndarray, folder: str | None = None) -> bytes:
    """Tuples with their counts, in few bytes: tokens as their numbers among the words that
    ``folder`` holds, if one is given, rows in order of the first two columns, all compressed
    (behind the size before)."""
    if folder:
        columns = [numbers(folder, c) for c in columns]
    order = _first_two(columns)
    # bytes of one rank together
    planes = [np.ascontiguousarray(c[order]).view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns]
    raw = b"".join([*planes, narrow(counts[order]).tobytes()])
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unpack(blob: pa.Buffer, n: int, order: int, folder: str | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """What :func:`pack` was given, rows in its order."""
    raw = _CODEC.decompress(blob.slice(8), int.from_bytes(blob.slice(0, 8).to_pybytes(), "little"))
    kind = _number_type(folder) if folder else np.dtype(np.uint64)
    size = kind.itemsize * n
    planes = [np.frombuffer(raw, np.uint8, size, k * size).reshape(kind.itemsize, n) for k in range(order)]
    columns = [np.ascontiguousarray(p.T).view(kind).reshape(-1) for p in planes]
    return [words_at(folder, c) if folder else c for c in columns], _unpack(raw.slice(order * size), n, 0)[1]


#: n-grams on their way to a bucket (key: bucket, a: how many), or numbers of a bucket
ROW = "kind string, key long, a long, b long, c long, d long, entries binary"
_NAMES = ["kind", "key", "a", "b", "c", "d", "entries"]
_SCHEMA = pa.schema([("kind", pa.string()), *((n, pa.int64()) for n in _NAMES[1:6]), ("entries", pa.binary())])


def _rows(rows) -> pa.RecordBatch:
    columns = list(zip(*(tuple(r) + (None,) * (7 - len(r)) for r in rows))) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


class Sums:
    """Distinct tuples seen so far; hands them out by bucket when there are many."""

    def __init__(self, bucket_of, flush: int, folder: str | None = None):
        self.bucket_of, self.flush, self.folder = bucket_of, flush, folder
        self.parts: list = []
        self.size = 0

    def add(self, columns: list[np.ndarray], counts: np.ndarray):
        part = tally(columns, counts)
        self.parts.append(part)
        self.size += len(part[1])
        if self.size >= self.flush:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][1])
            if self.size >= self.flush // 2:
                yield from self.rows()

    def merged(self):
        if len(self.parts) == 1:
            return self.parts[0]
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts))]
        return tally(columns, np.concatenate([p[1] for p in self.parts]))

    def rows(self):
        """One batch for each bucket, and an empty one at the least."""
        if not self.size:
            return
        columns, counts = self.merged()
        self.parts, self.size = [], 0
        bucket = self.bucket_of(columns)
        order = by_bucket(bucket)
        cuts = np.searchsorted(bucket[order], np.arange(int(bucket.max()) + 2))
        for b in range(len(cuts) - 1):
            own = order[cuts[b] : cuts[b + 1]]
            if len(own):
                yield _rows([("entries", b, len(own), 0, 0, 0, pack([c[own] for c in columns], counts[own], self.folder))])


def by_hash(buckets: int):
    """Bucket of a single token, or of a context."""
    return lambda keys: ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def by_context(folder: str, buckets: int, hot: int):
    """Bucket of an n-gram. A context is as frequent as its last word at most; one that may
    occur ``hot`` times is spread by the n-gram's last word."""

    return lambda columns: place(fold(columns[:-1]), seen(folder, columns[-2]), columns[-1], buckets, hot)


def place(context: np.ndarray, times: np.ndarray, word: np.ndarray, buckets: int, hot: int) -> np.ndarray:
    """The same for folded contexts whose last words occur so many times."""
    where = context % np.uint64(buckets) + mix(word) % (times // hot + 1).astype(np.uint64)
    return (where % np.uint64(buckets)).astype(np.int64)


def local(folder: str) -> str:
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be one that workers can map into memory, not {folder}")
    return parts.path


#: numbers of a context's statistics: total, n1, n2, n3
STATISTICS = 4
MOST = 255


def thin(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in one byte each; those of ``MOST`` and more, which are few, with their places beside them.
    Of a table the rows lie together, so that a look at one meets one place of the file."""
    large = np.flatnonzero(counts >= MOST)
    out = {name: np.minimum(counts, MOST).astype(np.uint8)}
    return out | {f"{name}-at": large, f"{name}-large": counts.reshape(-1)[large].astype(np.int64)} if len(large) else out


def counts_at(path: str, name: str, at: np.ndarray) -> np.ndarray:
    """The counts at these places of a stored array, or rows of a stored table."""
    out = _mapped(f"{path}.{name}.npy")[at].astype(np.int64)
    flat = out.reshape(-1)
    large = np.flatnonzero(flat == MOST)
    if len(large):
        width = out[:1].size or 1
        place = np.searchsorted(_mapped(f"{path}.{name}-at.npy"), at[large // width] * width + large % width)
        flat[large] = _mapped(f"{path}.{name}-large.npy")[place]
    return out


def store(folder: str, kind: str, bucket: int, arrays: dict[str, np.ndarray]) -> None:
    """Whole files, each put in place at once: a task that runs again writes the same."""
    os.makedirs(local(folder), exist_ok=True)
    files = {}
    for name, values in arrays.items():
        if name in ("count", "statistics"):
            files |= thin(name, values)
        else:
            files[name] = values
    for name, values in files.items():
        target = f"{local(folder)}/{kind}.{bucket}.{name}.npy"
        part = f"{target}.{os.urandom(6).hex()}"
        with open(part, "wb") as out:
            np.save(out, values)
        os.replace(part, target)


@lru_cache(maxsize=20_000)
def _mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and where each begins."""
    begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[begin], begin


def find(folder: str, kind: str, keys: np.ndarray, bucket: np.ndarray, name: str = "count") -> np.ndarray:
    """Stored counts of sorted keys in their buckets, or rows of statistics; zero where a key is not there."""
    out = np.zeros((len(keys), STATISTICS) if name == "statistics" else len(keys), np.int64)
    order = by_bucket(bucket)
    numbers, cuts = runs(bucket[order])
    for b, lo, hi in zip(numbers, cuts, [*cuts[1:], len(order)]):
        path = f"{local(folder)}/{kind}.{b}"
        if not os.path.exists(f"{path}.key.npy"):
            continue
        own = order[lo:hi]
        stored = _mapped(f"{path}.key.npy")
        at = np.searchsorted(stored, keys[own])
        at[at == len(stored)] = 0
        hit = stored[at] == keys[own]
        out[own[hit]] = counts_at(path, name, at[hit])
    return out


def seen(folder: str, words: np.ndarray) -> np.ndarray:
    """How often each token occurs in the training texts."""
    buckets = int(_mapped(f"{local(folder)}/words.0.buckets.npy")[0])
    keys, which = np.unique(words, return_inverse=True)
    return find(folder, "words", keys, by_hash(buckets)(keys))[which]


def _starts(folder: str) -> np.ndarray:
    """Number of the first word of each bucket, and behind them how many words there are."""
    return _mapped(f"{local(folder)}/words.0.starts.npy")


def _number_type(folder: str) -> np.dtype:
    return np.min_scalar_type(int(_starts(folder)[-1]))


def numbers(folder: str, words: np.ndarray) -> np.ndarray:
    """The place of each token among the words of the training texts; BEGIN comes last."""
    starts = _starts(folder)
    names, which = np.unique(words, return_inverse=True)
    bucket, out = by_hash(len(starts) - 1)(names), np.zeros(len(names), _number_type(folder))
    begin = names == BEGIN
    out[begin] = starts[-1]
    for b in np.unique(bucket[~begin]):
        own = np.flatnonzero((bucket == b) & ~begin)
        stored = _mapped(f"{local(folder)}/words.{b}.key.npy")
        at = np.minimum(np.searchsorted(stored, names[own]), len(stored) - 1)
        if (stored[at] != names[own]).any():
            raise ValueError("the training texts have changed while they were counted")
        out[own] = starts[b] + at
    return out[which]


def words_at(folder: str, places: np.ndarray) -> np.ndarray:
    """The tokens with these numbers."""
    starts = _starts(folder)
    bucket = np.searchsorted(starts, places, side="right") - 1
    order, names = by_bucket(bucket), np.full(len(places), BEGIN)
    for b, lo, hi in zip(*(runs_ := runs(bucket[order])), [*runs_[1][1:], len(order)]):
        if b < len(starts) - 1:  # the last number is BEGIN's
            own = order[lo:hi]
            names[own] = _mapped(f"{local(folder)}/words.{b}.key.npy")[places[own].astype(np.int64) - starts[b]]
    return names


def _count_words(buckets: int, flush: int):
    def run(batches):
        sums = Sums(lambda c: by_hash(buckets)(c[0]), flush)
        for batch in batches:
            for _, _, texts in pieces(batch["text"], lower=True):
                ids, _ = tokens(texts)
                yield from sums.add([ids], np.ones(len(ids), np.int64))
        yield from sums.rows()

    return run


def _count_ngrams(folder: str, bucket_of, order: int, flush: int):
    def run(batches):
        sums = Sums(bucket_of, flush, folder)
        for batch in batches:
            for _, _, texts in pieces(batch["text"], lower=True):
                ids, first = tokens(texts)
                yield from sums.add([*contexts(ids, first, order), ids], np.ones(len(ids), np.int64))
        yield from sums.rows()

    return run


def _buckets(batches, order: int, folder: str | None):
    """(bucket, columns, counts) of each bucket; rows come sorted by bucket."""
    bucket, parts = None, []

    def merged():
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts))]
        return (bucket, *tally(columns, np.concatenate([p[1] for p in parts])))

    for batch in batches:
        for b, n, e in zip(batch["key"].to_pylist(), batch["a"].to_pylist(), batch["entries"]):
            if b != bucket and parts:
                yield merged()
                parts = []
            bucket = b
            parts.append(unpack(e.as_buffer(), n, order, folder))
    if parts:
        yield merged()


def _store_tokens(folder: str, kind: str, numbered: bool = False):
    """Files of single tokens with their counts; ``numbered`` where the rows have their numbers."""

    def run(batches):
        for bucket, (keys,), counts in _buckets(batches, 1, folder if numbered else None):
            order = np.argsort(keys)
            store(folder, kind, bucket, {"key": keys[order], "count": counts[order]})
            yield _rows([("sum", bucket, len(keys), int(counts.sum())), _frequencies(counts)])

    return run


def _frequencies(counts: np.ndarray) -> tuple:
    return ("frequency", 0, *(int((counts == k).sum()) for k in (1, 2, 3, 4)))


def _store_ngrams(folder: str, order: int, hot: int, shorter_of, flush: int):
    """Files of n-grams and contexts. Gives the counts of counts, the statistics of contexts
    that other buckets share, and for the next order the n-grams without their first word."""

    def run(batches):
        shorter = Sums(shorter_of, flush, folder)
        for bucket, columns, counts in _buckets(batches, order, folder):
            store(folder, f"grams{order}", bucket, {"key": fold(columns), "count": counts})
            context = fold(columns[:-1])
            by = np.argsort(context)
            context, own = context[by], counts[by]
            begin = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
            totals = [own, own == 1, own == 2, own > 2]
            totals = [np.add.reduceat(x.astype(np.int64), begin) for x in totals]
            often = seen(folder, columns[-2][by][begin]) >= hot
            store(
                folder, f"contexts{order}", bucket,
                {"key": context[begin][~often], "statistics": np.stack(totals, axis=1)[~often]},
            )
            split = [context[begin][often].view(np.int64), *(v[often] for v in totals)]
            yield _rows([_frequencies(counts), *(("context", *map(int, x)) for x in zip(*split))])
            yield from shorter.add(columns[1:], np.ones(len(counts), np.int64))
        yield from shorter.rows()

    return run


def _store_split(folder: str, order: int, buckets: int):
    def run(batches):
        for table, starts in whole_runs(batches, ["bucket"]):
            for s, e in zip(starts[:-1], starts[1:]):
                own = table.slice(s, e - s)
                keys = own["key"].to_numpy().view(np.uint64)
                sort = np.argsort(keys)
                rows = np.stack([own[c].to_numpy() for c in "abcd"], axis=1)
                store(folder, f"split{order}", own["bucket"][0].as_py(), {"key": keys[sort], "statistics": rows[sort]})
        yield _rows([("done",)])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """For n-grams that occur once, twice, more often. Where a count of counts is missing,
    half the number of times."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    pairs = zip((1, 2, 3), (n1, n2, n3), (n2, n3, n4))
    return [0.0] + [min(k, max(0.0, k - (k + 1) * y * up / n)) if n else k / 2 for k, n, up in pairs]


@dataclass(frozen=True)
class Model:
    folder: str
    order: int
    tokens: int
    words: int
    #: of single tokens, and of n-grams
    buckets: tuple[int, int]
    hot: int
    #: by order - 1
    discounts: tuple[tuple[float, ...], ...]
    #: of the lowest order: its sum of counts, and the probability left for unseen words
    lowest: tuple[int, float]

    def log_probabilities(self, ids: np.ndarray, first: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
        """log10 of each token's probability; ``times`` is how often each occurs (:func:`seen`), if known."""
        words, _, which = grouped(ids)
        count = find(self.folder, "grams1", words, by_hash(self.buckets[0])(words))
        total, left = self.lowest
        p = (np.maximum(count - self._discount(0, count), 0) / max(total, 1) + left / (self.words + 1))[which]
        columns = [*contexts(ids, first, self.order), ids]
        begins, before = first[:-1], np.zeros(len(ids), np.int64)
        before[1:] = (seen(self.folder, ids) if times is None else times)[:-1]
        before[begins] = 0  # BEGIN is no word of the texts
        names, _, own = grouped(fold([words]))
        which = own[which]
        for order in range(2, self.order + 1):
            # a context is the shorter n-gram of the token before
            start = fold([np.full(1, BEGIN)] * (order - 1))
            at = int(np.searchsorted(names, start[0]))
            context = np.insert(names, at, start)
            whose = np.empty(len(ids), np.int64)
            whose[1:] = which[:-1] + (which[:-1] >= at)
            whose[begins] = at
            p, names, which = self._interpolated(order, columns[-order:], before, context, whose, p)
        return np.log10(p)

    def _discount(self, k: int, counts: np.ndarray) -> np.ndarray:
        return np.asarray(self.discounts[k])[np.minimum(counts, 3)]

    def _interpolated(
        self, order: int, columns: list[np.ndarray], before: np.ndarray, context: np.ndarray, whose: np.ndarray, lower: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities; and the n-grams' keys in order, and the number of each token's."""
        names, at, which = grouped(fold(columns))
        bucket = place(context[whose[at]], before[at], columns[-1][at], self.buckets[1], self.hot)
        count = find(self.folder, f"grams{order}", names, bucket)
        own = np.maximum(count - self._discount(order - 1, count), 0)[which]
        bucket = (context % np.uint64(self.buckets[1])).astype(np.int64)
        found = find(self.folder, f"contexts{order}", context, bucket, "statistics")
        found += find(self.folder, f"split{order}", context, by_hash(self.buckets[0])(context), "statistics")
        _, d1, d2, d3 = self.discounts[order - 1]
        total = found[:, 0][whose]
        left = (d1 * found[:, 1] + d2 * found[:, 2] + d3 * found[:, 3])[whose]
        return np.where(total > 0, (own + left * lower) / np.maximum(total, 1), lower), names, which


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    entries = rows.where("kind = 'entries'")
    return entries.repartitionById(buckets, F.col("key").cast("int")).sortWithinPartitions("key")


def train(docs: DataFrame, order: int = ORDER, bucket_tokens: int = BUCKET_TOKENS, flush: int = FLUSH) -> Model:
    """Model of all rows of docs (text)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "language-model")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = max(8, -(-size // BUCKET_TEXT))
    store(folder, "words", 0, {"buckets": np.array([few])})
    counted = _in_buckets(map_arrow(texts, _count_words(few, flush), ROW), few)
    sums = map_arrow(counted, _store_tokens(folder, "words"), ROW).where("kind = 'sum'")
    sizes = np.zeros((few, 2), np.int64)
    for r in sums.select("key", "a", "b").collect():  # one for each bucket
        sizes[r.key] = r.a, r.b
    words, n_tokens = sizes.sum(axis=0).tolist()
    store(folder, "words", 0, {"starts": np.concatenate(([0], np.cumsum(sizes[:, 0])))})

    many = max(8, -(-n_tokens // bucket_tokens))
    by_word = lambda c: by_hash(few)(c[0])
    placed = [None, by_word] + [by_context(folder, many, bucket_tokens)] * order
    rows = map_arrow(texts, _count_ngrams(folder, placed[order], order, flush), ROW) if order > 1 else None
    frequencies = {}
    for k in range(order, 1, -1):
        job = _store_ngrams(folder, k, bucket_tokens, placed[k - 1], flush)
        rows = saved(map_arrow(_in_buckets(rows, many), job, ROW), f"ngrams{k}")
        frequencies[k] = _counts_of_counts(rows)
        split = rows.where("kind = 'context'").groupBy("key").agg(*(F.sum(c).alias(c) for c in "abcd"))
        bucket = F.pmod(F.shiftrightunsigned("key", 20), F.lit(few)).alias("bucket")
        split = split.select("*", bucket).repartition("bucket").sortWithinPartitions("bucket")
        map_arrow(split, _store_split(folder, k, few), ROW).count()
    if order > 1:
        lowest = map_arrow(_in_buckets(rows, few), _store_tokens(folder, "grams1", numbered=True), ROW)
    else:
        lowest = map_arrow(counted, _store_tokens(folder, "grams1"), ROW)
    lowest = saved(lowest, "ngrams1")
    frequencies[1] = _counts_of_counts(lowest)
    total = lowest.where("kind = 'sum'").agg(F.sum("b")).first()[0] or 0
    found = tuple(tuple(discounts(*frequencies[k])) for k in range(1, order + 1))
    n1, n2 = frequencies[1][:2]
    taken = sum(d * n for d, n in zip(found[0][1:], (n1, n2, words - n1 - n2)))
    left = taken / total if total else 1.0
    return Model(folder, order, n_tokens, words, (few, many), bucket_tokens, found, (total, left))


def _counts_of_counts(rows: DataFrame) -> list[int]:
    found = rows.where("kind = 'frequency'").agg(*(F.sum(c) for c in "abcd")).first()
    return [n or 0 for n in found]


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, smoothing: float = 0.1) -> DataFrame:
    """n_tokens, n_known, base_score and score (log10) of every row of docs (doc_id, text).

    base_score is that of single tokens, each with ``smoothing`` added to its count.
    """

    def run(batches):
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"], lower=True, limit=4 << 20):
                ids, first = tokens(texts)
                count = seen(model.folder, ids)
                base = np.log10((count + smoothing) / (model.tokens + smoothing * (model.words + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()),
                        pa.array(np.diff(first)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), first[:-1])),
                        pa.array(np.add.reduceat(base, first[:-1])),
                        pa.array(np.add.reduceat(model.log_probabilities(ids, first, count), first[:-1])),
                    ],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCORES)
