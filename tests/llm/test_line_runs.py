import hashlib
import random

import duckdb
import pytest

from riverloom.llm import line_runs, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, hash string, pos string, batch long"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text)."""
    keys = {}
    for d, t in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                keys.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(LOWER), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if d is None or len(key) < least or min(keys[key]) == d:
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "h", "p", 9) for d, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in line_runs.without_repeated_lines(df, **options).collect()), key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("Ab cé dE f g".split()) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    rows = []
    for i in range(n):
        text = [rng.choice(lines) + rng.choice(["", " ", "\t", "\r"]) for _ in range(rng.randrange(0, 12))]
        rows.append((rng.randrange(10**6) * 2 - 10**6, "\n".join(text)))
    return rows


@pytest.mark.parametrize("batches,fan", [(1, 3), (5, 2), (7, 3)])
def test_against_brute_force(spark, batches, fan):
    rows = corpus(60, batches)
    assert found(spark, rows, batches=batches, fan=fan) == brute(rows)


def test_edge_rows(spark):
    line = "one line that repeats itself"
    rows = [
        (None, f"{line}\nother"), (None, line), (5, None), (6, ""), (7, "\n\n"), (8, f"a\n {line.upper()} \nb"),
        (9, f"{line}\n{line}"), (9, f"{line}\nÀ second version"), (9, f"{line}\n{line}"), (10, "à SECOND version\nÀ second VERSION"),
        (11, "short\nshort"), (12, "short"), (13, f"\x0b{line}\x0c\x1f"), (14, line + " "), (15, line + " \n"),
    ]
    rows += [(20, "\n".join(f"long text, line {i}" for i in range(30_000)))]
    rows += [(21, "\n".join(f"long text, line {i}" for i in range(0, 60_000, 2)))]
    for batches in (1, 4):
        assert found(spark, rows, batches=batches) == brute(rows)


def test_hot_line(spark, monkeypatch):
    """One line in every row, found through the broadcast keys or, without these, the shuffle."""
    rows = [(i, f"the line of all rows\nline number {i}\nline number {i // 2}") for i in range(300)]
    for heavy in (1000, 0):
        monkeypatch.setattr(line_runs, "HEAVY", heavy)
        assert found(spark, rows) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.without_repeated_lines(df).collect() == []


def test_runs_are_merged_without_shuffle(spark):
    """Runs are read in their buckets and order, and stay few."""
    runs = line_runs.LineRuns(spark, fan=3)
    frames = [spark.createDataFrame([(b * 100 + i, f"{(b * 37 + i) % 400:010d}".encode()) for i in range(100)], "doc_id long, hash binary") for b in range(8)]
    seen = set()
    for frame in frames:
        keys = {bytes(r.hash) for r in frame.collect()}
        added = {bytes(r.hash): r.seen for r in runs.add(frame).collect()}
        assert added == {k: k in seen for k in keys}
        seen |= keys
    assert [len(level) for level in runs.levels] == [2, 2]
    held = [bytes(r.hash) for level in runs.levels for run in level for r in run.collect()]
    assert sorted(held) == sorted(seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a, b = runs.levels[1]
        plan = a.join(b, "hash")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    runs.close()


def test_documents(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows)]
    got = queries.QUERIES["op11_line_runs"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_dropped for r in got) > 0
