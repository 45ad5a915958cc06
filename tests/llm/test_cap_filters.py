import duckdb
import numpy as np
import pytest

from riverloom.llm import cap_filters as cf
from riverloom.llm import queries
from test_mixing_and_minhash import brute_components

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, dim string, rep long"


def brute(rows, threshold=0.93):
    """{vec_id: (n_links, component)} of rows with distinct ids, and the links."""
    good = []
    for i, v, label in rows:
        if v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float32).astype(float)
            good.append((i, u / np.linalg.norm(u), label))
    links = set()
    for label in {g[2] for g in good}:
        for dim in {len(g[1]) for g in good}:
            own = [g for g in good if g[2] == label and len(g[1]) == dim]
            if own:
                m = np.stack([g[1] for g in own])
                a, b = np.nonzero(np.triu(m @ m.T >= threshold, 1))
                links |= {(own[i][0], own[j][0]) for i, j in zip(a, b)}
    count = {}
    for a, b in links:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    roots = brute_components([r[0] for r in rows], links)
    return {i: (count.get(i, 0), roots[i]) for i in roots}, links


def test_decoding_against_all_filters():
    code = cf.Code(7, 4, 3, 0.4)
    rng = np.random.default_rng(2)
    v = rng.standard_normal((50, 7))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = set()
    for turn, (rotation, (first, second)) in enumerate(cf._directions(7, 4, 3)):
        for i in range(4):
            for j in range(4):
                direction = rotation @ np.concatenate((first[i], second[j])) / np.sqrt(2)
                want |= {(r, (turn * 4 + i) * 4 + j) for r in np.flatnonzero(v @ direction >= 0.4)}
    row, number = code.decode(v)
    assert list(zip(row, number)) == sorted(want)


@pytest.mark.parametrize("block", [1024, 8])
def test_links_and_recall(spark, monkeypatch, block):
    monkeypatch.setattr(cf, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):  # pairs, chains and a hot group about the threshold
        centre = rng.standard_normal(64)
        for _ in range(40 if k == 0 else rng.integers(1, 4)):
            noise = rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.27])
            rows.append((len(rows), (centre + noise).tolist(), int(k % 3)))
    rows += [(len(rows) + i, rows[i][1], rows[i][2]) for i in range(5)]
    n = len(rows)
    odd = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] * 64, [1e30] * 64, [1.0] * 64]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(n + 20, rows[0][1], None), (n + 21, [1.0, 2.0], 1), (n + 22, [2.0, 4.1], 1)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in cf.linked_vectors(df).collect()}
    want, links = brute(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(x[0] for x in got.values()) >= 0.97 * 2 * len(links)
    assert got[n + 21] == got[n + 22] == (1, n + 21) and got[n + 6] == got[n + 7] == (1, n + 6)
    assert all(got[i] == (0, i) for i in [*range(n, n + 6), n + 20])


def test_edge_rows(spark):
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (None, None, None)]
    got = cf.linked_vectors(spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("2", 2, "2", True), ("3", 2, "2", False), ("3", 2, "2", False), ("None", 0, "None", True), ("None", 0, "None", True),
    ]
    assert cf.linked_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_embeddings(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    got = queries.QUERIES["op4_cap_filter_links"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)[0]
