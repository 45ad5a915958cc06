import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riverloom.llm import leaks, queries
from riverloom.llm.words import pieces

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id long, at int, share double"
ITEMS = "item_id long, text string, doc_id long, answer string"


def plain(text):
    return [w.strip("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())) or w for w in (text or "").lower().split()]


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        up = list(row)
        for j, y in enumerate(b, 1):
            row[j] = up[j - 1] + 1 if x == y else max(up[j], row[j - 1])
    return row[-1]


def brute(docs, items):
    """Pairs whose item is a copy within 2 * CELL words more of any place of the document."""
    out = set()
    for d, t in docs:
        words = plain(t)
        for i, text in items:
            q = plain(text)
            own = set(q)
            near = [k for k, w in enumerate(words) if w in own]
            for k in near[::4]:
                part = words[max(0, k - len(q)) : k + 2 * len(q)]
                if len(own & set(part)) >= leaks.COPY * len(own) * 0.8 and subsequence(q, part) >= leaks.COPY * len(q):
                    out.add((d, i))
                    break
    return out


def test_subsequence_against_table():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(7) for _ in range(rng.randrange(120))]
        item = leaks.Item(1, np.array(a, np.uint64), np.zeros(0, np.uint64))
        assert item.subsequence(b) == subsequence(a, b)


def test_space_keeps_products(spark):
    """With full rank the latent products are those of the weighted words."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(80)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, 1, 1, 1.0) for i, t in enumerate(texts)], DOCS)
    items = leaks.read_items(spark.createDataFrame([(i, t[:200], 1, None) for i, t in enumerate(texts[:10])], ITEMS))
    idf, n = leaks.weights(docs)
    assert n == 40 * 3
    space = leaks.fit(docs, items, idf, n, rank=1000)
    assert np.allclose(space.basis.T @ space.basis, np.eye(space.basis.shape[1]), atol=1e-4)
    (_, _, t), = pieces(pa.array([texts[3]]), fold=True)
    owner, found, _, _ = leaks.cells(t, leaks.word_hashes(t))
    got = space.project(owner, found, 3)
    q = leaks.feature(items[3].words)
    q = np.unique(q)
    v = space.project(np.zeros(len(q), int), q, 1)
    for c in range(3):
        both = np.intersect1d(found[owner == c], q)
        assert float(got[c] @ v[0]) == pytest.approx(float((idf[both].astype(float) ** 2).sum()), rel=1e-3, abs=1e-3)


def test_copies_and_paraphrases(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    common = ["the", "of", "and", "to"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [text(n) for n in (12, 30, 45, 60, 40)]
    items[4] = items[4][:32] + ["answer."] + [] + items[4][32:]
    questions = [" ".join(w[:-6]) + ". " + " ".join(w[-6:]) for w in items]
    rows = []
    for k in range(60):
        q = plain(questions[k % 5])
        if k % 3 == 1:  # some words exchanged or left out
            q = [w if rng.random() > 0.12 else word() for w in q]
        body = text(rng.randrange(200)) + ([] if k % 3 == 2 else [w.upper() if k % 2 else w for w in q]) + text(rng.randrange(200))
        rows.append((k, " ".join(body)))
    half = plain(questions[3])
    rows.append((100, " ".join(text(50) + [w if i % 5 > 1 or i >= 54 else word() for i, w in enumerate(half)] + text(50))))
    rows.append((101, " ".join(text(50) + [w if i % 5 > 1 and i < 54 else word() for i, w in enumerate(half)] + text(50))))
    rows += [(102, None), (103, ""), (None, questions[2]), (105, " ".join(text(20_000) + plain(questions[1])))]
    docs = spark.createDataFrame([(d, t, 1, 1, 1.0) for d, t in rows], DOCS).repartition(3)
    bench = spark.createDataFrame([(i, t, 1, None) for i, t in enumerate(questions)] + [(90, None, 1, None), (91, " ", 1, None), (None, "a b", 1, "c")], ITEMS)
    got = {(r.doc_id, r.item_id): r for r in leaks.leaks(docs, bench).collect()}
    want = {(k, k % 5) for k in range(60) if k % 3 != 2} | {(100, 3), (105, 1)}
    assert set(got) == want
    assert got[100, 3].kind == "paraphrase" and got[105, 1].share == 1.0 and got[105, 1].kind == "copy"


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c", 1, None)], ITEMS)
    assert leaks.leaks(docs, bench).count() == 0
    assert leaks.leaks(spark.createDataFrame([(1, "a b c", 1, 1, 1.0)], DOCS), bench.limit(0)).count() == 0


def test_documents(spark):
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = queries.QUERIES["op3_latent_benchmark_leaks"](spark, SF).collect()
    copies = {(r.doc_id, r.item_id) for r in got if r.kind == "copy"}
    want = brute(docs, items)
    assert want and len(copies & want) >= 0.97 * len(want) and copies <= want


def test_more_items_than_rank(spark):
    """Verbatim copies are found however many items share the latent space."""
    rng = random.Random(8)
    text = lambda n: [rng.choice(["the", "of", "and"]) if rng.random() < 0.25 else "".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]
    items = [text(rng.randrange(14, 19)) for _ in range(1100)]
    rows = [(d, " ".join(w for q in items[d::100] for w in text(80) + q)) for d in range(100)]
    docs = spark.createDataFrame([(d, t, 1, 1, 1.0) for d, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(q), 1, None) for i, q in enumerate(items)], ITEMS)
    assert len(items) > 4 * leaks.RANK
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(docs, bench).collect()}
    assert got == {(i % 100, i) for i in range(len(items))}


def brute_all(docs, items):
    """Pairs that pass the checks in the window of any passage; answers are whole or not there."""
    out = set()
    for d, words in docs:
        for i, q, answer in items:
            for c in range(0, len(words), leaks.CELL):
                part = words[max(0, c - len(q)) : c + 2 * leaks.CELL + len(q)]
                share = subsequence(q, part) / len(q)
                if share == 1 or len(q) >= leaks.SHORT and (share >= leaks.COPY or share >= leaks.PARAPHRASE and answer in part):
                    out.add((d, i))
    return out


def test_short_long_and_partial_items(spark):
    """Items much shorter or longer than a passage, and copies of half their words."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = lambda n: [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else word() for _ in range(n)]
    items = [(i, [word() for _ in range(n)], word()) for i, n in enumerate([2, 3, 4, 5, 7] * 4 + list(range(8, 24)) * 3 + [900])]
    items = [(i, q[:-1] + [a], a) for i, q, a in items]
    docs = []
    for i, q, a in items:
        for share in (1, 0.8, 0.6):
            lost = set(rng.sample(range(len(q) - 1), int((1 - share) * len(q))))
            docs.append((len(docs), text(rng.randrange(40, 90)) + [word() if k in lost else w for k, w in enumerate(q)] + text(60)))
    want = brute_all(docs, items)
    frame = spark.createDataFrame([(d, " ".join(w), 1, 1, 1.0) for d, w in docs], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(q), 1, a) for i, q, a in items], ITEMS)
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(frame, bench).collect()}
    assert len(want) > 150 and got == want


def test_passing_passage_counts_though_another_matches_more(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    q = [word() for _ in range(40)]
    more = [w if i % 5 < 3 else word() for i, w in enumerate(q[:36])] + [word() for _ in range(4)]
    whole = [w if i % 2 and i > 3 else word() for i, w in enumerate(q[:36])] + q[36:]
    text = " ".join(more + [word() for _ in range(400)] + whole)
    docs = spark.createDataFrame([(1, text, 1, 1, 1.0)], DOCS)
    bench = spark.createDataFrame([(1, " ".join(q), 1, " ".join(q[36:]))], ITEMS)
    (found,) = leaks.leaks(docs, bench).collect()
    assert (found.kind, found.answer, found.matched) == ("paraphrase", 1.0, 20) and found.at > 350


def test_finds_do_not_depend_on_the_sample(spark):
    """The space is fitted on a sample (or on none of the passages); counts, bounds and checks are not."""
    rng = random.Random(21)
    text = lambda n: [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choices("abcdefghij", k=5)) for _ in range(n)]
    items = [text(rng.randrange(12, 30)) for _ in range(150)]
    rows = [(d, " ".join(w for q in items[d::50] for w in text(70) + [w if rng.random() > 0.08 else "zz" for w in q])) for d in range(50)]
    docs = spark.createDataFrame([(d, t, 1, 1, 1.0) for d, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(q), 1, None) for i, q in enumerate(items)], ITEMS)
    columns = ["doc_id", "item_id", "at", "matched", "share", "weight", "answer", "kind"]
    found = [sorted(map(tuple, leaks.leaks(docs, bench, fit_cells=n).select(*columns).collect())) for n in (leaks.FIT_CELLS, 60, 1)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 0.9 * len(items)


def test_projection_of_many_vectors():
    """Coordinates are those of one sum for each vector."""
    rng = np.random.default_rng(5)
    basis = rng.standard_normal((1500, 140)).astype(np.float32)
    column = np.full(leaks.FEATURES, -1, np.int32)
    column[rng.choice(leaks.FEATURES, 1500, replace=False)] = np.arange(1500)
    space = leaks.Space(rng.random(leaks.FEATURES, np.float32) + 1, column, basis)
    n = 6000
    known = np.flatnonzero(column >= 0)
    pair = np.unique(np.repeat(np.arange(0, n, 2), 120) * leaks.FEATURES + np.tile(rng.choice(known, 60 * n), 1))
    unknown = np.unique(np.arange(n) * leaks.FEATURES + rng.choice(np.flatnonzero(column < 0), n))
    pair = np.union1d(pair, unknown)  # vectors of odd number have nothing in the space
    owner, found = pair // leaks.FEATURES, pair % leaks.FEATURES

    def one_by_one():
        own = column[found] >= 0
        at, who, out = column[found[own]], owner[own], np.zeros((n, 140), np.float32)
        begin = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        out[who[begin]] = np.add.reduceat(basis[at] * space.idf[found[own]][:, None], begin, axis=0)
        return out

    assert (space.project(owner, found, n) == one_by_one()).all()
    out = space.project_many(owner, found, n)
    assert np.abs(out - one_by_one()).max() < 1e-3 and not out[1::2].any()
    assert space.project_many(owner[:0], found[:0], 3).tolist() == np.zeros((3, 140)).tolist()


def test_weights_of_candidates_only(spark, monkeypatch):
    """Weights are summed for windows that hold enough of the item's words in order."""
    seen, whole = [], leaks.subsequences

    def watched(windows, items, weights):
        out = whole(windows, items, weights)
        seen.append((weights.dtype, len(windows), out))
        return out

    monkeypatch.setattr(leaks, "subsequences", watched)
    words = [f"w{i}" for i in range(12)]
    item = leaks.Item(7, *(next(leaks.pieces(pa.array([" ".join(words)]), fold=True))[2].hashes for _ in range(2)))
    texts = [" ".join(words), " ".join(reversed(words))]
    idf = np.full(leaks.FEATURES, 2, np.float32)
    column = np.full(leaks.FEATURES, -1, np.int32)
    names = np.unique(leaks.feature(item.words))
    column[names] = np.arange(len(names))
    block = leaks.Block([item], leaks.Space(idf, column, np.eye(len(names), dtype=np.float32)), 100)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], ["doc_id", "text"])
    found = [r for b in leaks._search([(leaks.SIZE, block)])([batch]) for r in b.to_pylist()]
    assert [(r["doc_id"], r["matched"]) for r in found] == [(1, 12)] and found[0]["weight"] > 0.99
    counted, weighed = seen
    assert counted[1] == 2 and weighed[1] == 1
    # equal passages are alike whatever lies beside them, the first of them counts
    filler = " ".join(f"x{i}" for i in range(116))
    doubled = f"{texts[0]} {filler} {texts[0]} {filler}"
    rows = [texts[0]] * 3 + [f"{texts[0]} {filler}", doubled] + [" ".join(words[:10])] * 150 + [doubled]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text"])
    found = [r for b in leaks._search([(leaks.SIZE, block)])([batch]) for r in b.to_pylist()]
    same = {r["doc_id"]: (r["at"], r["cosine"]) for r in found}
    assert same[4] == same[len(rows) - 1] and same[4][0] == 0 and same[0] == same[1] == same[2]


def test_space_is_fitted_on_all_texts(spark):
    """However many cells there are."""
    docs = spark.createDataFrame([(i, f"text {i}" if i else None, 1, 1, 1.0) for i in range(200)], DOCS)
    assert leaks.fit_sample(docs, 10**7).count() == 199
    assert leaks.fit_sample(docs, 10**7, 20_000).count() < 20


def test_pair_counts_of_all_cells(spark, monkeypatch):
    """Products of the counted pairs are those of the cells themselves."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choices([f"w{i}" for i in range(300)], [1 / (i + 1) for i in range(300)], k=n))
    texts = [text(rng.randrange(300)) for _ in range(60)] + [None, "", "none of them"]
    texts += texts[:3]
    docs = spark.createDataFrame([(i, t, 1, 1, 1.0) for i, t in enumerate(texts)], DOCS).repartition(3)
    items = [leaks.read_items(spark.createDataFrame([(i, text(30), 1, None) for i in range(n)], ITEMS)) for n in (3, 9)]
    columns = [leaks.word_columns(i) for i in items]
    idf, _ = leaks.weights(docs)
    matrices = [np.random.default_rng(k).standard_normal((int(c.max()) + 1, 7)) for k, c in enumerate(columns)]
    rows = [np.zeros((0, len(m))) for m in matrices]
    for t in texts:
        words = plain(t)
        for lo in range(0, len(words), leaks.CELL):
            (_, _, own), = pieces(pa.array([" ".join(words[lo : lo + leaks.CELL])]), fold=True)
            found = np.unique(leaks.feature(leaks.word_hashes(own)))
            for k, c in enumerate(columns):
                row = np.zeros(len(matrices[k]))
                row[c[found][c[found] >= 0]] = idf[found][c[found] >= 0]
                rows[k] = np.vstack([rows[k], row])
    want = [a.T @ (a @ m) for a, m in zip(rows, matrices)]
    got = [f(m) for f, m in zip(leaks.multipliers(docs, columns, idf), matrices)]
    monkeypatch.setattr(leaks, "WIDE", 0)
    other = [f(m) for f, m in zip(leaks.multipliers(docs, columns, idf), matrices)]
    for a, b, c in zip(want, got, other):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-6) and np.allclose(a, c, rtol=1e-3, atol=1e-2)
    # whole counts, in stripes and parts of any size
    at = np.concatenate([np.flatnonzero(r) for r in rows[1]])
    count = np.count_nonzero(rows[1], axis=1)
    n = len(matrices[1])
    monkeypatch.setattr(leaks, "STRIPE", 5 * n)
    monkeypatch.setattr(leaks, "PAIRS", 3 * leaks.CELL)
    table = np.zeros((n, n), np.int64)
    for stripe, sums in leaks.stripes(at, count[count > 0], n):
        table[5 * stripe : 5 * stripe + 5] += sums.reshape(-1, n)
    assert (table == (rows[1] > 0).T.astype(int) @ (rows[1] > 0)).all()
