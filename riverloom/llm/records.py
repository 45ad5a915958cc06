"""Length-delimited binary records of token ids, with an offset index for shuffled reads.

A data file holds one frame for each document, in order of ids:

    length of the payload     8 bytes, little-endian
    masked CRC32C of these    4 bytes
    payload                   the ids, little-endian, 2 or 4 bytes each
    masked CRC32C of it       4 bytes

(the mask rotates the checksum right by 15 bits and adds 0xa282ead8, as files of this
framing do.) Beside it lies an index file: for each frame the doc_id (8 bytes), the
frame's place in the data file (8), the first id's number within the file (8) and the
number of ids (4); a doc_id of -2**63 stands for null. With the index any frame is read
by itself, so a reader may take documents in any order.

The rows are range-partitioned by doc_id, so each task writes one file and holds one
batch at a time. A file is written under a name of its own attempt and only named by the
manifest if the attempt succeeds: tasks may be lost and run again. The manifest has one
row for each file. Folders may be in any store that pyarrow reads and writes.

Null texts count as empty and have the end id alone. Rows without an id come first, rows
that repeat an id follow each other in an order of their texts. An empty table writes no
file and reads back as no rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverloom.llm.units import UnitCache, distinct
from riverloom.llm.words import pieces
from riverloom.session import map_arrow, new_folder, saved

NO_ID = -(2**63)
INDEX = np.dtype([("doc_id", "<i8"), ("place", "<i8"), ("start", "<i8"), ("n_tokens", "<i4")])
HEAD, TAIL = 12, 4
CHUNK = 64
_POLY = 0x82F63B78


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Byte table, and for each power of two the effect of so many zero bytes, by byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(_POLY), np.uint32(0))
    unit = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    zeros = [(unit >> 8) ^ table[unit & 0xFF]]
    while len(zeros) < 40:
        zeros.append(_apply(zeros[-1], zeros[-1]))
    return table, np.stack(zeros)


def _apply(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return operator[0][crc & 0xFF] ^ operator[1][(crc >> 8) & 0xFF] ^ operator[2][(crc >> 16) & 0xFF] ^ operator[3][crc >> 24]


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC32C of data[start:end] for each pair, all at once.

    The checksum is linear, so pieces of CHUNK bytes are summed side by side and then
    put together, each moved by the number of bytes that follow it.
    """
    table, zeros = _tables()
    sizes = ends - starts
    chunks = -(-sizes // CHUNK)
    owner = np.repeat(np.arange(len(starts)), chunks)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    stop = ends[owner] - (chunks[owner] - 1 - k) * CHUNK  # the first chunk may be short
    begin = np.maximum(stop - CHUNK, starts[owner])
    crc = np.zeros(len(owner), np.uint32)
    for step in range(CHUNK):
        at = stop - CHUNK + step
        byte = np.where(at >= begin, data[np.maximum(at, 0)] if len(data) else 0, 0)
        crc = (crc >> 8) ^ table[(crc ^ byte) & 0xFF]
    total = _shifted(zeros, crc, ends[owner] - stop)
    out = np.zeros(len(starts), np.uint32)
    full = np.flatnonzero(chunks)
    if len(full):
        out[full] = np.bitwise_xor.reduceat(total, (np.cumsum(chunks) - chunks)[full])
    return out ^ _shifted(zeros, np.full(len(starts), 0xFFFFFFFF, np.uint32), sizes) ^ np.uint32(0xFFFFFFFF)


def _shifted(zeros: np.ndarray, crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksum registers after so many zero bytes."""
    crc = crc.copy()
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        rows = (sizes >> bit) & 1 == 1
        crc[rows] = _apply(zeros[bit], crc[rows])
    return crc


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(0xA282EAD8)


def framed(ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Frames of the sequences ids[end of the one before : end]; sizes of the frames."""
    width = ids.dtype.itemsize
    counts = np.diff(np.concatenate(([0], ends)))
    sizes = counts * width
    frames = sizes + HEAD + TAIL
    place = np.cumsum(frames) - frames
    payload = ids.view(np.uint8)
    stop = ends * width
    out = np.zeros(int(frames.sum()), np.uint8)

    def put(at: np.ndarray, values: np.ndarray) -> None:
        raw = values.view(np.uint8).reshape(len(values), -1)
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    lengths = sizes.astype("<u8")
    raw = lengths.view(np.uint8)
    every = np.arange(len(sizes)) * 8
    put(place, lengths)
    put(place + 8, masked(crc32c(raw, every, every + 8)))
    shift = np.repeat(place + HEAD - (stop - sizes), sizes)
    out[np.arange(len(payload)) + shift] = payload
    put(place + HEAD + sizes, masked(crc32c(payload, stop - sizes, stop)))
    return out.tobytes(), frames


def unframed(data: np.ndarray, places: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their ends of the frames at these places; raises if one is damaged."""
    sizes = counts.astype(np.int64) * width

    def read(at: np.ndarray, kind: str) -> np.ndarray:
        raw = data[at[:, None] + np.arange(np.dtype(kind).itemsize)]
        return np.ascontiguousarray(raw).view(kind)[:, 0]

    body = places + HEAD
    if len(places) and int((body + sizes + TAIL).max()) > len(data):
        raise ValueError("a record ends before its length says")
    good = (read(places, "<u8") == sizes) & (read(places + 8, "<u4") == masked(crc32c(data, places, places + 8)))
    good &= read(body + sizes, "<u4") == masked(crc32c(data, body, body + sizes))
    if not good.all():
        raise ValueError(f"record {int(np.flatnonzero(~good)[0])} of the file is damaged")
    ends = np.cumsum(sizes)
    payload = data[np.arange(int(sizes.sum())) + np.repeat(body - (ends - sizes), sizes)]
    return np.ascontiguousarray(payload).view(f"<u{width}"), ends // width


#: The pattern of tokenizers whose words never hold white space, nor go on from a letter or
#: digit to a sign (fixed value, to be found in the tokenizer's file).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: classes of bytes: white space, letter, digit, apostrophe, other sign, beyond ASCII
_CLASS = np.full(256, 4, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[0x27] = 3
_CLASS[0x80:] = 5
#: whether a unit begins between bytes of these classes (the one before, the one after)
_CUT = np.zeros((6, 6), bool)
_CUT[0, 1:] = _CUT[1:, 0] = True
_CUT[1:3, 3:5] = True  # a sign after a letter or digit
_CUT[4, 1:3] = True  # a letter or digit after a sign other than the apostrophe
_CUT[1, 2] = _CUT[2, 1] = _CUT[2, 2] = True


#: units that are encoded as one text, bytes of texts that are encoded at a time
JOINED, PIECE = 256, 1 << 20


class UnitEncoder:
    """Encodes texts unit by unit, each distinct unit once as long as it is in the cache.

    A tokenizer that composes characters (NFC), lower-cases them, drops white space and finds
    words by :data:`WORDS` can be given a text in units: no word goes over a cut of ``_CUT``, no
    character is composed with one before it in ASCII, and no word looks back. That is read
    from the tokenizer's file; the texts of any other are encoded whole. Units are compared
    byte by byte; ASCII ones are lower-cased first, as lower-casing may keep others from being
    composed alike.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.cuts = self._by_words(file)
        added = file.get("added_tokens") or []
        #: added tokens are found in a text before anything else, so no cut goes through one
        self.added = [t["content"].encode() for t in added]
        plain = [t for t in added if not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])]
        self.mark = (plain[0]["content"], plain[0]["id"]) if plain else None
        self.cache = UnitCache(self._work, [(np.uint32,)], 200_000)

    @staticmethod
    def _by_words(file: dict) -> bool:
        steps = (file.get("normalizer") or {}).get("normalizers", [])
        first, *rest = (file.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        split = {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
        bytes_only = [r.get("type") == "ByteLevel" and not r.get("use_regex") and not r.get("add_prefix_space") for r in rest]
        normal = [{"type": "NFC"}, space, {"type": "Lowercase"}]
        return steps == normal and first == split and bytes_only == [True] and not file.get("post_processor")

    def _work(self, units: list[bytes]):
        texts = [u.decode(errors="replace") for u in units]
        if not self.mark or any(t in u for u in units for t in self.added if len(u) >= len(t)):
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            counts = np.fromiter(map(len, coded), np.int64, len(coded))
            return (counts, [np.fromiter((i for c in coded for i in c), np.uint32, int(counts.sum()))]), None
        # an added token between units keeps them apart, and tells their ids apart
        content, mark = self.mark
        runs = [content.join([*texts[lo : lo + JOINED], ""]) for lo in range(0, len(texts), JOINED)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark)
        counts = np.diff(ends, prepend=-1) - 1
        return (counts, [ids[ids != mark]]), None

    def _units(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, starts and ends of units."""
        data, rows = texts.data, texts.offsets
        if not self.cuts:
            some = np.flatnonzero(np.diff(rows))
            return data, rows[some], rows[some + 1]
        kind = _CLASS[data]
        begins = np.ones(len(data), bool)
        begins[1:] = _CUT[kind[:-1], kind[1:]]
        raw = data.tobytes() if self.added else b""
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                begins[at + 1 : at + len(content)] = False
                at = raw.find(content, at + 1)
        begins[rows[:-1][rows[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        inside = kind[starts] > 0
        starts, ends = starts[inside], ends[inside]
        high = np.zeros(len(data) + 1, np.int32 if len(data) < 2**31 else np.int64)
        np.cumsum(data >= 0x80, out=high[1:], dtype=high.dtype)
        plain = high[ends] == high[starts]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts[plain]] += 1
        edge[ends[plain]] -= 1
        small = (np.cumsum(edge[:-1], dtype=np.int8) > 0) & (data >= 0x41) & (data <= 0x5A)
        return data + (small * np.uint8(32)), starts, ends

    def __call__(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each with the end id, and where each row ends."""
        data, starts, ends = self._units(texts)
        names, which = distinct(data, starts, ends)
        slots = self.cache.slots(names)
        count, (ids,) = self.cache.new.lists[0].take(slots[which])
        upto = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(starts, texts.offsets)]
        stops = upto[1:] - upto[0] + np.arange(1, len(texts.offsets))
        out = np.full(int(stops[-1]), end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[stops - 1] = False
        out[inner] = ids
        return out, stops


@lru_cache(maxsize=2)
def encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


MANIFEST = "file string, width int, documents long, n_tokens long, bytes long, first_id long"


def _write(folder: str, tokenizer: str, end_id: int, width: int):
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():09d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        data = index = first = None
        documents = tokens = place = 0
        encode = encoder(tokenizer)
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"], limit=PIECE):
                if data is None:
                    store.create_dir(base, recursive=True)
                    data = store.open_output_stream(f"{base}/{name}.rec")
                    index = store.open_output_stream(f"{base}/{name}.idx")
                ids, ends = encode(texts, end_id)
                if width == 2 and ids.max(initial=0) >= 2**16:
                    raise ValueError("an id does not fit into two bytes; write with width=4")
                frames, sizes = framed(ids.astype(f"<u{width}"), ends)
                data.write(frames)
                rows = np.zeros(hi - lo, INDEX)
                rows["doc_id"] = pc.fill_null(batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()), NO_ID).to_numpy()
                counts = np.diff(np.concatenate(([0], ends)))
                rows["place"] = place + np.cumsum(sizes) - sizes
                rows["start"] = tokens + ends - counts
                rows["n_tokens"] = counts
                index.write(rows.tobytes())
                first = int(rows["doc_id"][0]) if first is None else first
                documents += hi - lo
                tokens += int(ends[-1])
                place += len(frames)
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"file": f"{folder}/{name}", "width": width, "documents": documents, "n_tokens": tokens, "bytes": place, "first_id": first}],
                pa.schema([("file", pa.string()), ("width", pa.int32()), *((n, pa.int64()) for n in ("documents", "n_tokens", "bytes", "first_id"))]),
            )

    return run


def write_records(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, folder: str | None = None) -> DataFrame:
    """Write the ids of every row of docs (doc_id, text); returns the manifest, a table with
    a row for each file, in the order of the files' ids by ``number``."""
    folder = folder or new_folder(docs.sparkSession, "records")
    # by a hash of the text too, so that rows without an id, or of one id, make several files
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    manifest = saved(map_arrow(ordered, _write(folder, tokenizer, end_id, width), MANIFEST), "records-manifest")
    before = Window.orderBy("first_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    return saved(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "records-manifest")


def _slices(rows: DataFrame, per_read: int) -> DataFrame:
    """One row for each run of ``per_read`` frames of a file."""
    at = F.explode(F.sequence(F.lit(0), F.col("documents") - 1, F.lit(per_read)))
    return rows.withColumn("at", at)


def read_records(manifest: DataFrame, per_read: int = 2000, shuffled: int | None = None) -> DataFrame:
    """doc_id, start and ids of every record that the manifest's files hold, checked.

    Files are read in runs of frames found by the index; with a seed in ``shuffled`` the
    runs, and the frames within each, come in a seeded random order.
    """

    def run(batches):
        kind = pa.list_(pa.int32())
        for batch in batches:
            for r in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(r["file"])
                with store.open_input_file(f"{path}.idx") as f:
                    f.seek(r["at"] * INDEX.itemsize)
                    rows = np.frombuffer(f.read(per_read * INDEX.itemsize), INDEX)
                with store.open_input_file(f"{path}.rec") as f:
                    f.seek(int(rows["place"][0]))
                    size = int(rows["place"][-1] - rows["place"][0]) + int(rows["n_tokens"][-1]) * r["width"] + HEAD + TAIL
                    data = np.frombuffer(f.read(size), np.uint8)
                if shuffled is not None:
                    rows = rows[np.random.default_rng([shuffled, r["at"]]).permutation(len(rows))]
                lo = 0
                while lo < len(rows):  # some MB at a time
                    hi = lo + max(1, int(np.searchsorted(np.cumsum(rows["n_tokens"][lo:], dtype=np.int64), 1 << 20)))
                    part = rows[lo:hi]
                    ids, ends = unframed(data, part["place"] - rows["place"].min(), part["n_tokens"], r["width"])
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    doc_id = pa.array(part["doc_id"], mask=part["doc_id"] == NO_ID)
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_id, pa.array(part["start"] + r["start"]),
                            pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))).cast(kind),
                        ],
                        ["doc_id", "start", "ids"],
                    )
                    lo = hi

    plan = _slices(manifest.select("file", "width", "documents", "start"), per_read)
    spread = plan.repartition(F.col("file"), F.col("at")) if shuffled is None else plan.orderBy(F.xxhash64(F.lit(shuffled), "file", "at"))
    return map_arrow(spread, run, "doc_id long, start long, ids array<int>")


def checksums(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            ends = ids.offsets.to_numpy()
            raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return map_arrow(records, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
