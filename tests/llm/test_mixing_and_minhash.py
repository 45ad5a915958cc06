import random

import duckdb
import pytest

from riverloom.llm import components as comp
from riverloom.llm import minhash, mixing, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, hashes string, rep long"


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {n: top(n) for n in nodes}


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingle_set(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_near(rows, percent=85):
    sets = {d: shingle_set(t) for d, t in rows}
    index, links = {}, set()
    for d in sorted(sets):
        counts = {}
        for s in sets[d]:
            for other in index.setdefault(s, []):
                counts[other] = counts.get(other, 0) + 1
            index[s].append(d)
        for other, both in counts.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                links.add((other, d))
    return {d: (len(sets[d]), c) for d, c in brute_components(sets, links).items()}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 7), (1000, 1001)]
    links += [(400 + i, 401 + i) for i in range(60)]
    df = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    want = brute_components({x for p in links for x in p}, links)
    got = {r.id: r.component for r in comp.components(df).collect()}
    assert all(got.get(n, n) == c for n, c in want.items())
    assert comp.components(df.limit(0)).count() == 0


def near_copies(n, rng):
    """A chain and a star of near copies around hidden and visible originals."""
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    chain = [f"c{rng.randrange(5000)}" for _ in range(300)]
    for i in range(12):
        chain = list(chain)
        for j in range(2):
            chain[(37 * i + 91 * j) % 300] = f"y{i}{j}"
        rows.append(" ".join(chain))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    rows = list(enumerate(near_copies(60, rng)))
    rows += [(500 + i, t) for i, t in enumerate(["", None, "One two", "one TWO", "a b c d e f g", " \t a b c d e f g ", "x y z", "x y  z"])]
    rows += [(600 + i, " ".join(f"l{j}" for j in range(30_000))) for i in range(2)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, "s", "h", 5) for d, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_near(rows)


def test_near_duplicates_over_documents(spark):
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op10_minhash_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edge_rows(spark):
    rows = [(None, "a b c d e f", "s", "h", 1)] * 2 + [(3, "a b c d e f", "s", "h", 1)] * 2 + [(4, None, None, None, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, got)) == sorted(
        ["Row(doc_id=None, n_shingles=2, component_id=None, kept=True)"] * 2
        + ["Row(doc_id=3, n_shingles=2, component_id=3, kept=True)"] * 2
        + ["Row(doc_id=4, n_shingles=0, component_id=4, kept=True)"]
    )
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def fill(sizes, weights, cap=3.0):
    targets, total, fixed = {}, sum(sizes.values()), set()
    while True:
        rest = total - sum(sizes[s] * cap for s in fixed)
        free = sum(weights[s] for s in sizes if s not in fixed)
        targets = {s: sizes[s] * cap if s in fixed else rest * weights[s] / free for s in sizes}
        over = {s for s in sizes if targets[s] > sizes[s] * cap}
        if not over:
            return targets
        fixed |= over


def test_mixing_against_loops(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        source = rng.choice(["a"] * 12 + ["b", "c", "d", "é", None])
        rows.append((i, " ".join("w" * rng.randrange(30)), source, "h", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = mixing.sized(df)
    got = mixing.mixture(sizes, mixing.plan_mix(sizes)).collect()
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    total = {s: sum(r.size for r in by[s]) for s in by}
    want = fill(total, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    for s in by:
        assert all(abs(r.target - want[s]) < 1e-6 for r in by[s])
        assert abs(sum(r.reps * r.size for r in by[s]) - want[s]) <= 30
        assert all(0 <= r.reps <= 3 for r in by[s])
    again = mixing.mixed_documents(df.repartition(5))
    assert again.columns == df.columns
    assert again.count() == sum(r.reps for r in got)


def test_mixing_edge_rows(spark):
    rows = [(None, None, None, None, None)] * 2 + [(1, "", "a", "h", 1), (2, "x y", "b", "h", 1), (2, "x y", "b", "h", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = mixing.sized(df)
    got = sorted((str(r.doc_id), r.size, r.source_size, r.target) for r in mixing.mixture(sizes, mixing.plan_mix(sizes)).collect())
    assert got == [("1", 0, 0, 0.0), ("2", 2, 4, 4.0), ("2", 2, 4, 4.0), ("None", 0, 0, 0.0), ("None", 0, 0, 0.0)]
    empty = df.limit(0)
    assert mixing.mixed_documents(empty).count() == 0


def test_mixing_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op8_source_mixing"]).fetchall()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    got = queries.QUERIES["op8_source_mixing"](spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    plan = queries.QUERIES["op8_source_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bands_follow_the_threshold():
    assert minhash.banding(85) == (32, 6) and minhash.least_agreeing(85) == 134
    for percent in (70, 80, 85, 95):
        bands, width = minhash.banding(percent)
        assert bands * width <= minhash.BINS and (1 - (percent / 100) ** width) ** bands <= 1e-6
        share = percent / 100
        assert minhash.least_agreeing(percent) <= minhash.BINS * share - 5 * (minhash.BINS * share * (1 - share)) ** 0.5


def test_lower_threshold_against_brute_force(spark):
    """Planted pairs between 0.80 and 0.85 are linked at 80 percent, and not at 85."""
    rng = random.Random(14)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:186 - k % 3] + [f"x{rng.randrange(10**6)}" for _ in range(18 + k % 3)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent, kept in ((80, 60), (85, 120)):
        want = brute_near(rows, percent)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, percent).collect()}
        assert got == want and sum(d == c for d, (_, c) in got.items()) == kept
