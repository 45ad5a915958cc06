import hashlib
import random
import weakref

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from riverloom import session
from riverloom.llm import alignment, queries, units

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, piece string, pairs string, n_a long"


def files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Whole texts through both tokenizers, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a_path, b_path = files()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    alphabet = alignment.byte_alphabet()
    assert ByteLevel().decode(["".join(sorted(alphabet, key=alphabet.get))[0x41:0x5B]]) == "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    out, links = [], []
    for d, text in rows:
        whole = (" " + text).encode() if text else b""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in x]
        b_bytes = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            out.append((d, 0, 0, 0, ""))
            links.append([])
            continue
        owner_a = [k for k, t in enumerate(a_bytes) for _ in t]
        owner_b = [k for k, t in enumerate(b_bytes) for _ in t]
        links.append([(x[i], y[j]) for i, j in sorted(set(zip(owner_a, owner_b)))])
        groups, i, j = [], 0, 0
        for at in range(1, len(whole) + 1):
            edge = at == len(whole) or (owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1])
            if edge:
                p, q = owner_a[at - 1] + 1, owner_b[at - 1] + 1
                groups.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
                i, j = p, q
        out.append((d, len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count, best = {}, {}
    for own in links:
        for pair in own:
            count[pair] = count.get(pair, 0) + 1
    for (_, j), c in count.items():
        best[j] = max(best.get(j, 0), c)
    return sorted(
        ((d, n_a, n_b, g, len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), sha)
         for (d, n_a, n_b, g, sha), own in zip(out, links)),
        key=repr,
    )


def found(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "p", "q", 3) for d, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in alignment.aligned(df, *files(), **options).collect()), key=repr)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "a  b", "a \n b", "\n", "\t x\r\n", "don't we'll  I'm", "naïve café — “quoted” text…",
    " x  y　 z  w", "a▁b", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 のテキスト です", "emoji 👩‍👩‍👧 end 👍🏽 .",
    "x" * 20_000, "ab " * 30_000, "a" * 50 + " " * 5_000 + "b", "\x00 \x01 \x7f y", "é ́ x", "1234567 89 , . ; :", "Straße ÄÖÜ ß", "  a\u0085 b  c",
]


def test_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(None, "null id"), (7, "a"), (7, "a")]
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, buckets=3, piece=40) == want


def test_random_texts(spark, monkeypatch):
    rng = random.Random(2)
    alphabet = list("aAbe  \n\t.,'’é1 ß 中") + ["the ", "ing", " de", "'s", " "]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randrange(60)))) for i in range(400)]
    monkeypatch.setattr(alignment, "ASKING", 5)  # many copies of each bucket
    assert found(spark, rows, piece=500) == brute(rows)


def test_whole_texts_as_units(spark):
    """Models that merge across spaces are given whole texts; the result is the same here."""
    pair = alignment.Pair(*files())
    assert pair.cuts
    text = pa.array(["some words here", "", "and there"])
    data, offsets = alignment.piece_rows(text)
    assert list(alignment.unit_starts(data, offsets[:-1][np.diff(offsets) > 0], False)) == [0, 16]
    one = alignment.one_piece(pair, pa.array([1, 2, 3]), text, 4)
    pair.cuts = False
    two = alignment.one_piece(pair, pa.array([1, 2, 3]), text, 4)
    assert all(one[c] == two[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts"))


@pytest.mark.parametrize("seed", range(5))
def test_labels_against_union(seed):
    """Chains that need many doublings."""
    rng = np.random.default_rng(seed)
    size = 3000
    a = np.unique(np.append(rng.integers(1, size, 900), size))
    b = np.unique(np.append(np.arange(1, size, 3) if seed else rng.integers(1, size, 700), size))
    label, lo, count = alignment.align(a, b)
    ends = np.intersect1d(a, b)
    assert np.array_equal(a[label[: len(a)]], ends[np.searchsorted(ends, a)])
    assert np.array_equal(a[label[len(a) :]], ends[np.searchsorted(ends, b)])
    start_a, start_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    want = (start_a[:, None] < b[None, :]) & (start_b[None, :] < a[:, None])
    assert np.array_equal(count, want.sum(1)) and np.array_equal(lo, want.argmax(1))


def test_unit_cache_generations():
    calls = []

    def work(names):
        calls.extend(names)
        sizes = np.array([len(n) for n in names], np.int64)
        return (sizes, [np.frombuffer(b"".join(names), np.uint8).astype(np.int64)]), [n.decode() for n in names]

    cache = units.UnitCache(work, [(np.int64,)], limit=6)
    rng = random.Random(3)
    for _ in range(60):
        names = rng.sample([f"u{i}" * (i % 3) + "é" for i in range(14)], 4)
        names = list(dict.fromkeys(names))
        slots = cache.slots(pa.array([n.encode() for n in names], pa.large_binary()))
        count, (values,) = cache.new.lists[0].take(slots)
        assert [cache.new.texts[s] for s in slots] == names
        assert bytes(values.astype(np.uint8)).decode() == "".join(names) and list(count) == [len(n.encode()) for n in names]
        assert len(cache.new.names) <= 6 + 4
    assert len(calls) < 60 * 4


def test_empty(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), *files()).collect() == []
    assert found(spark, [(1, None), (2, "")]) == brute([(1, None), (2, "")])


def test_documents(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op13_token_alignment"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert any(r.n_a for r in got)


def test_rows_are_narrow(spark, monkeypatch):
    """Pieces are read back one at a time, and a pair of ids takes four bytes."""
    seen = []

    def watched(df, name, **options):
        out = session.saved(df, name, **options)
        seen.append((name, out))
        return out

    monkeypatch.setattr(alignment, "saved", watched)
    rows = [(i, f"some words {i} here and {i * 7} there ") for i in range(40)]
    assert found(spark, rows, piece=200) == brute(rows)
    pieces = dict(seen)["aligned-pieces"]
    for path in pieces.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("//", "/")).metadata
        assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [1] * meta.num_rows
    for r in pieces.select("pairs", "counts").collect():
        pairs = alignment.pairs_of(r.pairs)
        assert len(r.pairs) <= 4 * len(pairs) + 10 and len(r.counts) == len(pairs) + 1
    assert (alignment.pairs_of(alignment.packed_pairs(np.array([3 << 32 | 2**31, 70_000 << 32]))) == [3 << 32 | 2**31, 70_000 << 32]).all()


def test_workers_forget_tokenizers_once_pieces_are_cut():
    pair = weakref.ref(alignment.pair_of(*files()))
    assert pair() is not None
    assert list(alignment._partial(4)(iter([]))) == [] and pair() is None
