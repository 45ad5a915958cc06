import random
import struct
import zlib
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riverloom.llm import queries, records

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, start long, ids string, file int"


def plain_crc32c(data):
    c = 0xFFFFFFFF
    for byte in data:
        c ^= byte
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def plain_mask(c):
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def encoded(texts, end=1):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_checksum():
    assert plain_crc32c(b"123456789") == 0xE3069283
    data = np.random.default_rng(1).integers(0, 256, 3000, dtype=np.uint8)
    starts, ends = np.array([0, 5, 5, 10, 100, 64, 0, 1000]), np.array([0, 6, 69, 10, 1100, 128, 3000, 1128])
    want = [plain_crc32c(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert records.crc32c(data, starts, ends).tolist() == want


@pytest.mark.parametrize("width", [2, 4])
def test_files_frame_by_frame(spark, width):
    rng = random.Random(2)
    texts = ["", None, "Ünï <|endoftext|> code's\tΑΣ. Σ", "a " * 30_000] + [f"word{i} " * rng.randrange(40) for i in range(60)]
    rows = list(enumerate(texts, 10)) + [(None, "no id"), (None, "nor here"), (12, "again twelve")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, 1, "i", 2) for d, t in rows], SCHEMA).repartition(3)
    manifest = records.write_records(df, queries.vocabulary(), 1, width)
    found, tokens = [], 0
    for m in manifest.orderBy("start").collect():
        path = urlparse(m.file).path
        raw = Path(f"{path}.rec").read_bytes()
        assert len(raw) == m.bytes and m.start == tokens
        index = np.frombuffer(Path(f"{path}.idx").read_bytes(), records.INDEX)
        at = 0
        for i in index:
            assert i["place"] == at and i["start"] + m.start == tokens
            (size,) = struct.unpack_from("<Q", raw, at)
            assert struct.unpack_from("<I", raw, at + 8)[0] == plain_mask(plain_crc32c(raw[at : at + 8]))
            body = raw[at + 12 : at + 12 + size]
            if size < 2000:
                assert struct.unpack_from("<I", raw, at + 12 + size)[0] == plain_mask(plain_crc32c(body))
            ids = np.frombuffer(body, f"<u{width}").tolist()
            found.append((None if i["doc_id"] == records.NO_ID else int(i["doc_id"]), ids))
            tokens += len(ids)
            at += 16 + size
        assert at == len(raw)
    want = [(d, e) for (d, _), e in zip(rows, encoded([t for _, t in rows]))]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    ids = [-1 if d is None else d for d, _ in found]
    assert ids == sorted(ids)
    for seed in (None, 5):
        back = records.read_records(manifest, per_read=7, shuffled=seed).collect()
        assert sorted(((r.doc_id, list(r.ids)) for r in back), key=repr) == sorted(want, key=repr)


def test_damage_is_found(spark):
    df = spark.createDataFrame([(i, f"text {i}", 1, "i", 2) for i in range(20)], SCHEMA)
    manifest = records.write_records(df, queries.vocabulary(), 1)
    path = Path(urlparse(manifest.first().file).path + ".rec")
    raw = bytearray(path.read_bytes())
    raw[13] ^= 1
    path.write_bytes(raw)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(manifest).collect()


def test_empty_table(spark):
    manifest = records.write_records(spark.createDataFrame([], SCHEMA), queries.vocabulary(), 1)
    assert manifest.count() == 0 and records.checksums(records.read_records(manifest)).count() == 0


def test_documents(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    start, want = 0, {}
    for (d, _), ids in zip(rows, encoded([t for _, t in rows])):
        want[d] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    got = queries.QUERIES["op6_binary_records"](spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(rows)


def test_units_against_whole_texts():
    """Texts in units have the ids of whole texts, whatever meets at a cut."""
    from riverloom.llm.words import pieces

    rng = random.Random(4)
    marks = ["\u0301", "\u0331", "\u0338", "\u00a0", "\u2003", "İ", "Σ", "ẞ", "ﬁ", "中文", "👍🏽", "é", "É", "½", "²", "\u0085"]
    parts = [*"aAbBsStTdDhH", "'s", "'S", "'", "''", "re", "'RE", "\"", ".", ",", "=", "<", "1", "42", " ", "  ", "\n", "\t", *marks]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    texts += ["don't DON'T 'tis O'Neill's 'S", "H\u0331 h\u0331 A\u030a", "x'1'2's", "a'b'c'd", "<|endoftext|>", "3rd 1's 's3", "a" * 5000]
    encode = records.UnitEncoder(queries.vocabulary())
    assert encode.cuts
    for cuts in (True, False):
        encode.cuts = cuts
        got = []
        for _, _, t in pieces(pa.array(texts), limit=5000):
            ids, ends = encode(t, 1)
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == encoded(texts)


def test_words_of_equal_polynomials():
    """Units are told apart by their bytes: hashes modulo a power of two cannot tell these."""
    from riverloom.llm.words import pieces

    bits = [bin(i).count("1") & 1 for i in range(1024)]
    texts = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    encode = records.UnitEncoder(queries.vocabulary())
    ((_, _, t),) = pieces(pa.array(texts))
    ids, ends = encode(t, 1)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == encoded(texts)


def test_other_tokenizers_get_whole_texts():
    encode = records.UnitEncoder(queries.vocabulary("byte_bpe_50k.json"))
    assert not encode.cuts
