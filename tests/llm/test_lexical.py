import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from riverloom.llm import blobs, lexical, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, rank long, item_id long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            size = sum(c.values())
            if not size:
                continue
            m = 100 - 75 + (75 * size * n) // length
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, parts=3, shard=lexical.SHARD, k=10):
    df = spark.createDataFrame([(d, t, "s", 7, 3) for d, t in docs], SCHEMA).repartition(parts)
    bench = spark.createDataFrame([(i, t, 5, "x") for i, t in items], "item_id long, text string, doc_id long, rank string")
    return sorted((tuple(r) for r in lexical.rank(lexical.index(df, shard), bench, k).collect()), key=repr)


def corpus(n, seed):
    """Words of very unequal frequency, many ties, some long documents."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (1 + i) for i in range(400)]

    def text(size):
        return " ".join(rng.choices(words, weights, k=size)) + rng.choice(["", ".", " É", " Zz-Top9"])

    docs = [(i, text(rng.choice([3, 8, 20, 60, 900]))) for i in rng.sample(range(10**6), n)]
    docs += [(10**7 + i, docs[i % 20][1]) for i in range(40)]
    return docs, [(i, text(rng.randrange(1, 25))) for i in range(25)]


@pytest.mark.parametrize("long,width,shard", [(8, 32, 1 << 23), (128, 512, 20_000), (1, 7, 3000), (10**9, 64, 1 << 23)])
def test_against_brute_force(spark, monkeypatch, long, width, shard):
    """All lists long, all short, and mixes; many and few shards and ranges."""
    monkeypatch.setattr(lexical, "LONG", long)
    monkeypatch.setattr(lexical, "RANGE", width)
    docs, items = corpus(700, long)
    own = [lexical.Best(10) for _ in items]
    want = brute(docs, items)
    # the tasks' functions here, as patched; then through Spark with the module's own constants
    rng = random.Random(1)
    rng.shuffle(docs)
    cut = max(1, int(len(docs) * shard / (1 << 18)))
    shards = [lexical.build(*(pa.array(c) for c in zip(*docs[i : i + cut]))) for i in range(0, len(docs), cut)]
    n, length = (sum(s[c] for s in shards) for c in ("n_docs", "n_terms"))
    wanted = sorted(set().union(*(lexical.item_terms(t) for _, t in items)))
    names = pa.array(wanted, pa.large_binary())
    opened = [lexical.Shard(s, names) for s in shards]
    df = sum(np.where(s.list_of >= 0, np.diff(s.bounds)[s.list_of] if len(s.bounds) > 1 else 0, 0) for s in opened)
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df]
    scored = 0
    for best, (_, text) in zip(own, items):
        query = [(wanted.index(t), c * weight[wanted.index(t)]) for t, c in lexical.item_terms(text).items()]
        for s in opened:
            scored += lexical.search(s, lambda size: 25 + (75 * size * n) // length, query, best)
    got = [(i, r + 1, int(d), int(x)) for (i, _), b in zip(items, own) for r, (d, x) in enumerate(zip(b.id, b.score))]
    assert sorted(got, key=repr) == want
    if long == 8:  # most postings are never scored
        assert scored < sum(sum(df[wanted.index(t)] for t in lexical.item_terms(x)) for _, x in items) * 0.8


def test_through_spark(spark):
    docs, items = corpus(300, 4)
    assert found(spark, docs, items, shard=5000) == brute(docs, items)
    assert found(spark, docs, items, parts=1, k=3) == brute(docs, items, 3)


def test_item_blocks(spark, monkeypatch):
    docs, items = corpus(120, 6)
    want = brute(docs, items)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    assert found(spark, docs, items) == want


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,!"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (4, "ALPHA beta\x00beta"), (7, "été É")]
    docs += [(8, "x" * 3_000_000 + " alpha"), (9, "word " * 600_000 + "gamma")]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "beta alpha beta"), (None, "ÉTÉ É été"), (6, "absent"), (7, "gamma word"), (8, "x" * 3_000_000)]
    once = list(dict.fromkeys(items))
    assert found(spark, docs, items) == brute(docs, once)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_documents(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = queries.QUERIES["op12_hybrid_ranked_search"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)


def test_index_rows_are_narrow_and_read_one_at_a_time(spark):
    """What an executor holds of the index at once does not grow with a task's text."""
    docs, _ = corpus(300, 9)
    docs = [(d, " ".join([t] * 400)[:40_000]) for d, t in docs]
    df = spark.createDataFrame([(d, t, "s", 7, 3) for d, t in docs], SCHEMA).coalesce(1)
    shards = lexical.index(df)
    size = sum(len(t) for _, t in docs)
    widths = [sum(len(row[c]) for c in lexical._BLOBS) for row in shards.collect()]
    assert len(widths) >= size // (2 << 20) > 1 and max(widths) < 2 << 20
    for path in shards.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("//", "/")).metadata
        assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [1] * meta.num_rows


@pytest.mark.parametrize("most,size", [(0, 1), (255, 1), (256, 2), (2**16, 4), (2**40, 8)])
def test_packed_numbers_come_back(most, size):
    values = np.array([0, most, 1], np.int64)
    blob = blobs.packed(values)
    assert len(blob) == 1 + 3 * size and (blobs.unpacked(blob) == values).all()
    assert blobs.unpacked(blobs.packed(values[:0])).tolist() == []
