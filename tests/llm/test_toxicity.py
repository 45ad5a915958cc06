import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riverloom.llm import queries, toxicity, words
from riverloom.llm.words import pieces

DOCS = "doc_id long, text string, score double, toxic string, feature int"
LABELS = "doc_id long, toxic int, quality int, text string"
ROOT = "/root/testdata"


def scores(model, texts):
    return np.concatenate([model.scores(t) for _, _, t in pieces(pa.array(texts, pa.string()), fold=True)])


def biased_rows(rng, n=600):
    """Toxic texts, of which most name a group that other texts seldom name."""
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        w = rng.choices(plain, k=20)
        if toxic and rng.random() < 0.9:
            w.insert(3, rng.choice(["vile", "nasty"]) + rng.choice(["", "!", "ness"]))
        if rng.random() < (0.9 if toxic else 0.1):
            w.insert(5, "muslims")
        elif rng.random() < 0.3:
            w.insert(5, "neighbours")
        rows.append((i, " ".join(w) + ".", int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 1.0, "x", 2) for i, t, _ in rows], DOCS)
    return docs, spark.createDataFrame([(i, y, 1, "t") for i, _, y in rows if y is not None], LABELS)


def test_swaps_reduce_false_positives(spark):
    docs, labels = frames(spark, biased_rows(random.Random(2)))
    fair = toxicity.fit(docs, labels, penalty=10.0)
    unfair = toxicity.fit(docs, labels, penalty=0.0)
    rng = random.Random(5)
    neutral = [" ".join(rng.choices([f"word{i}" for i in range(200)], k=15) + ["muslims"]) for _ in range(200)]
    other = [t.replace("muslims", "neighbours") for t in neutral]
    bad = [t.replace("muslims", "vile") for t in neutral]
    gap = lambda m: np.abs(scores(m, neutral) - scores(m, other)).mean()
    assert gap(fair) < gap(unfair) / 3
    assert (scores(fair, neutral) >= 0.5).sum() <= (scores(unfair, neutral) >= 0.5).sum()
    # a tenth of the toxic texts have no toxic word, so some chance words count too
    assert (scores(fair, neutral) >= 0.5).mean() <= 0.1 and (scores(fair, bad) >= 0.5).mean() >= 0.9


def test_swapped_forms():
    assert toxicity.swapped("nothing here") == []
    forms = toxicity.swapped("Some Women and men.", times=2)
    assert forms == ["Some men and people.", "Some people and adults."]


def test_features_against_plain():
    text = "Vile, (nasty) émigré... --- a's \t x"
    (_, _, texts), = pieces(pa.array([text, None, ""]), fold=True)
    row, found = toxicity.feature_hashes(texts)
    assert set(row) == {0}
    (_, _, single), = pieces(pa.array(["vile nasty émigré"]))
    whole = set(single.hashes)
    assert whole <= set(found)
    (_, _, prefix), = pieces(pa.array(["nastier"]), fold=True)
    assert set(toxicity.feature_hashes(prefix)[1]) & set(found)  # "nast"


def test_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 0), (3, "good day", 0), (4, "vile", 1), (None, "vile", None)]
    docs, labels = frames(spark, rows)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1, "t"), (3, None, 1, "t"), (99, 0, 1, "t")], LABELS))
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == 5 and all(0 <= s <= 1 for s in got.values()) and got[1] == got[2]
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r.score < 1e-9 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), none).count() == 0
    alone = toxicity.fit(docs.limit(0), labels)
    assert 0 < scores(alone, ["x"])[0] < 1


def test_held_out_documents(spark):
    sf = f"{ROOT}/sf0.1"
    toxic = dict(duckdb.execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    got = queries.QUERIES["op5_counterfactual_toxicity"](spark, sf).collect()
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    wrong = [r for r in held if r.predicted != toxic[r.doc_id]]
    assert len(got) == 10_000 and held and len(wrong) <= 0.02 * len(held)


OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def plain_features(text):
    """Words without outer signs (three at most a side) and their first bytes, as (bytes, prefix length or 0)."""
    out = set()
    for word in (text or "").lower().encode().split():
        for _ in range(3):
            if len(word) > 1 and chr(word[0]) in OUTER:
                word = word[1:]
            if len(word) > 1 and chr(word[-1]) in OUTER:
                word = word[:-1]
        out.add((word, 0))
        out |= {(word[:k], k) for k in toxicity.PREFIXES if len(word) > k}
    return out


def feature_hash(feature):
    word, k = feature
    data = np.frombuffer(word, np.uint8)
    h = words.range_hashes(words.Bytes(data), np.array([0]), np.array([len(data)]))
    return int(words.mix(h + np.uint64(k))[0] if k else h[0])


def test_against_plain_implementation(spark):
    """Features, their choice, the loss with the penalty, and the scores, worked out plainly."""
    rng = random.Random(4)
    good = [f"kind{i}" for i in range(30)] + ["women", "men", "people"]
    bad = [f"nasty{i}," for i in range(12)] + ["women"] * 4
    rows = []
    for i in range(160):
        toxic = i % 3 == 0
        text = rng.choices(good, k=rng.randrange(3, 14)) + (rng.choices(bad, k=2) if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text).title() if i % 5 == 0 else " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    groups = (("women", "men", "people"),)
    model = toxicity.fit(docs, labels, n_features=25, penalty=1.0, groups=groups)

    # the features most tied to the toxic class
    sets = {i: plain_features(t) for i, t, _ in rows}
    n, n_bad = len(rows), sum(y for _, _, y in rows)
    strength = {}
    for f in set().union(*sets.values()):
        times = sum(f in s for s in sets.values())
        hits = sum(y for i, _, y in rows if f in sets[i])
        if times >= 3 and hits > times * n_bad / n:
            part = lambda a, b: a * math.log(a / b) if a else 0.0
            strength[f] = part(hits, times * n_bad / n) + part(times - hits, times * (1 - n_bad / n))
    names = {f for g in groups for name in g for f in plain_features(name)}
    least = sorted(strength.values(), reverse=True)[24]
    sure = {f for f, s in strength.items() if s > least + 1e-9} | names
    may = {f for f, s in strength.items() if s >= least - 1e-9} | names
    hashes = set(model.hashes.tolist())
    assert {feature_hash(f) for f in sure} <= hashes <= {feature_hash(f) for f in may}

    # the loss of the weights is as small as plain descent makes it
    chosen = [f for f in may if feature_hash(f) in hashes]
    place = {f: k for k, f in enumerate(chosen)}
    dense = lambda fs: np.array([float(f in fs) for f in chosen])
    x = np.stack([dense(sets[i]) for i, _, _ in rows])
    y = np.array([float(t) for _, _, t in rows])
    gaps = []
    for k, (i, text, _) in enumerate(rows):
        gaps += [x[k] - dense(plain_features(form)) for form in toxicity.swapped(text, groups)]
    gaps = np.stack(gaps)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        fit = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        slope = (p - y) * weight
        back = x.T @ slope + 1e-5 * w + 2 * gaps.T @ (gaps @ w) / len(gaps)
        return fit + 0.5e-5 * w @ w + ((gaps @ w) ** 2).mean(), back, slope.sum()

    by_hash = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    own = np.array([by_hash[feature_hash(f)] for f in chosen])
    w, b = np.zeros(len(chosen)), 0.0
    for _ in range(4000):
        _, g, h = loss(w, b)
        w, b = w - 0.5 * g, b - 0.5 * h
    assert loss(own, model.bias)[0] <= loss(w, b)[0] + 0.01
    women = [by_hash[feature_hash(f)] for f in plain_features("women")]
    men = [by_hash[feature_hash(f)] for f in plain_features("men")]
    assert abs(sum(women) - sum(men)) < 0.5  # though only toxic texts are rich in the first
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for k, (i, _, _) in enumerate(rows):
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(x[k] @ own + model.bias))), abs=1e-9)
    assert place
