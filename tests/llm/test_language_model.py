import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riverloom.llm import language_model as lm
from riverloom.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key long, count long, kind string"


def sentence(text):
    return [*(text or "").encode().lower().split(), "END"]


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts, order):
        self.order, self.grams = order, {}
        top = Counter()
        for t in texts:
            w = ["BEGIN"] * (order - 1) + sentence(t)
            top.update(tuple(w[i - order + 1 : i + 1]) for i in range(order - 1, len(w)))
        self.unigrams = Counter(w for t in texts for w in sentence(t))
        self.grams[order] = top
        for k in range(order - 1, 0, -1):
            self.grams[k] = Counter(g[1:] for g in self.grams[k + 1])
        self.d, self.context = {}, {}
        for k, grams in self.grams.items():
            n = Counter(grams.values())
            self.d[k] = lm.discounts(*(n[i] for i in (1, 2, 3, 4)))
            self.context[k] = defaultdict(lambda: [0, 0.0])
            for g, c in grams.items():
                self.context[k][g[:-1]][0] += c
                self.context[k][g[:-1]][1] += self.d[k][min(c, 3)]

    def p(self, gram):
        lower = self.p(gram[1:]) if len(gram) > 1 else 1 / (len(self.unigrams) + 1)
        k = len(gram)
        total, left = self.context[k].get(gram[:-1], (0, 0))
        if not total:
            return lower
        c = self.grams[k][gram]
        return (max(c - self.d[k][min(c, 3)], 0) + left * lower) / total

    def score(self, text):
        w = ["BEGIN"] * (self.order - 1) + sentence(text)
        return sum(math.log10(self.p(tuple(w[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(w)))


def some_texts():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(50))) for _ in range(150)]
    return texts + ["", None, "The THE the  \t the\n", texts[0], texts[0], "é ü", " ".join(texts) * 3]


@pytest.mark.parametrize("order,bucket_tokens,flush", [(1, 10**6, 10**6), (2, 10**6, 10**6), (2, 300, 100), (3, 300, 100)])
def test_model_against_dictionaries(spark, order, bucket_tokens, flush):
    texts = some_texts()
    train = texts[:140]
    df = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    model = lm.train(df.where("doc_id < 140"), order, bucket_tokens, flush)
    plain = Plain(train, order)
    assert (model.tokens, model.words) == (sum(plain.unigrams.values()), len(plain.unigrams))
    got = {r.doc_id: r for r in lm.score(df, model).collect()}
    n, v = model.tokens, model.words
    for i, t in enumerate(texts):
        known = [plain.unigrams[w] for w in sentence(t)]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in known)
        assert (got[i].n_tokens, got[i].n_known) == (len(known), sum(c > 0 for c in known))
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert got[i].score == pytest.approx(plain.score(t), rel=1e-9)


def test_probabilities_sum_to_one():
    plain = Plain(some_texts()[:140], 2)
    for u in ("w1", "w30", "BEGIN", "never"):
        u = u if u == "BEGIN" else u.encode()
        total = sum(plain.p((u, w)) for w in plain.unigrams) + plain.p((u, "unknown"))
        assert total == pytest.approx(1)


def test_edge_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = lm.train(empty)
    got = lm.score(spark.createDataFrame([(None, None, 1, 1, "k"), (2, "a b", 1, 1, "k")], SCHEMA), model).collect()
    assert [(r.doc_id, r.n_tokens, r.n_known, r.score) for r in got] == [(None, 1, 0, 0.0), (2, 3, 0, 0.0)]
    assert lm.score(empty, model).count() == 0


def test_documents(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    plain = Plain([t for d, t in rows if not held[d]], lm.ORDER)
    got = {r.doc_id: r for r in queries.QUERIES["op1_kneser_ney_scores"](spark, SF).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        assert got[d].held_out == held[d] and got[d].train_tokens == sum(plain.unigrams.values())
        assert got[d].score == pytest.approx(plain.score(t), rel=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_registered_model_has_three_orders(spark):
    texts = some_texts()[:40]
    df = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in enumerate(texts)], SCHEMA)
    plain = Plain(texts, 3)
    model = lm.train(df)
    assert model.order == 3
    assert all(r.score == pytest.approx(plain.score(texts[r.doc_id]), rel=1e-9) for r in lm.score(df, model).collect())


@pytest.mark.parametrize("most,size", [(255, 1), (256, 2), (2**16, 4), (2**32, 8)])
def test_narrow_counts_come_back(most, size):
    grams, counts = np.arange(3, dtype=np.uint64), np.array([1, most, 2])
    blob = grams.tobytes() + lm.narrow(counts).tobytes()
    assert len(blob) == 3 * (8 + size)
    (column,), back = lm._unpack(pa.py_buffer(blob), 3, 1)
    assert (column == grams).all() and (back == counts).all()


def test_packed_ngrams_take_few_bytes_and_come_back(tmp_path):
    rng = np.random.default_rng(3)
    words = np.sort(rng.integers(1, 2**63, 5000).astype(np.uint64))
    bucket = lm.by_hash(3)(words)
    for b in range(3):
        lm.store(str(tmp_path), "words", b, {"key": words[bucket == b]})
    lm.store(str(tmp_path), "words", 0, {"starts": np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=3))))})
    columns = [np.append(rng.choice(words, 20_000), lm.BEGIN) for _ in range(3)]
    sums = lm.Sums(lambda c: np.zeros(len(c[0]), np.int64), 10**6, str(tmp_path))
    assert not list(sums.add(columns, np.ones(20_001, np.int64)))
    (batch,) = sums.rows()
    n, blob = batch["a"][0].as_py(), batch["entries"][0].as_py()
    # three hashes and a count have 25 bytes
    assert len(blob) < 8 * n
    back, counts = lm.unpack(pa.py_buffer(blob), n, 3, str(tmp_path))
    assert sorted(zip(*(c.tolist() for c in back), counts.tolist())) == sorted((*t, k) for t, k in Counter(zip(*(c.tolist() for c in columns))).items())
    with pytest.raises(ValueError, match="have changed"):
        lm.numbers(str(tmp_path), np.array([5], np.uint64))


def test_scoring_looks_words_up_once(spark, monkeypatch):
    """Buckets of n-grams follow from counts that the caller has; sums stay those of the model."""
    texts = some_texts()
    model = lm.train(spark.createDataFrame([(i, t, 1, 2, "k") for i, t in enumerate(texts[:140])], SCHEMA), 3, 300, 100)
    plain = Plain(texts[:140], 3)
    (_, _, words), = lm.pieces(pa.array(texts), lower=True, limit=1 << 30)
    ids, first = lm.tokens(words)
    times, whole = lm.seen(model.folder, ids), model.log_probabilities(ids, first)
    monkeypatch.setattr(lm, "seen", None)
    got = model.log_probabilities(ids, first, times)
    assert (got == whole).all()
    assert np.add.reduceat(got, first[:-1]) == pytest.approx([plain.score(t) for t in texts], rel=1e-9)


def test_counts_are_stored_in_a_byte(tmp_path):
    rng = np.random.default_rng(6)
    keys = np.sort(rng.choice(10**6, 5000, replace=False)).astype(np.uint64)
    counts = rng.choice([0, 1, 2, 254, 255, 256, 10**12], 5000, p=[0.05, 0.8, 0.1, 0.01, 0.01, 0.01, 0.02])
    lm.store(str(tmp_path), "grams2", 3, {"key": keys, "count": counts})
    assert np.load(tmp_path / "grams2.3.count.npy").dtype == np.uint8
    wanted = np.sort(np.concatenate((keys[::3], [10**6 + 5]))).astype(np.uint64)
    got = lm.find(str(tmp_path), "grams2", wanted, np.full(len(wanted), 3))
    assert got.tolist() == [*counts[::3].tolist(), 0]
    rows = np.stack([counts, counts[::-1], np.arange(5000), counts], axis=1)
    lm.store(str(tmp_path), "contexts2", 3, {"key": keys, "statistics": rows})
    got = lm.find(str(tmp_path), "contexts2", wanted, np.full(len(wanted), 3), "statistics")
    assert got.tolist() == [*rows[::3].tolist(), [0, 0, 0, 0]]


def test_quicker_sorts_give_the_same():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 900, 4000).astype(np.uint64)
    names, at, which = lm.grouped(keys)
    assert (names == np.unique(keys)).all() and (keys[at] == names).all() and (names[which] == keys).all()
    for bucket in (rng.integers(0, 50, 3000), rng.integers(0, 1 << 20, 3000), np.zeros(0, np.int64)):
        assert (lm.by_bucket(bucket) == np.argsort(bucket, kind="stable")).all()
    assert [x.tolist() for x in lm.grouped(keys[:0])] == [[], [], []]
