import hashlib
import random

import duckdb
import pytest

from riverloom.llm import automata, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, at int, words string, low long"


def brute(rows, window=50):
    """doc_id -> (n_words, n_removed, digest); ids must not repeat."""
    words = {d: (t or "").encode().split() for d, t in rows}
    low = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            low.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if low[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect()}


def test_automaton_against_all_substrings():
    rng = random.Random(1)
    for _ in range(60):
        seqs = [[rng.choice("ab") for _ in range(rng.randrange(1, 14))] for _ in range(5)]
        a = automata.SuffixAutomaton()
        for k, s in enumerate(seqs):
            a.add(s, 10 - k)
        a.finish()
        for s in seqs:
            for window in (1, 2, 4):
                want = [
                    min(10 - k for k, o in enumerate(seqs) if any(o[j : j + window] == s[i : i + window] for j in range(len(o) - window + 1)))
                    for i in range(len(s) - window + 1)
                ]
                assert a.lowest(s, window) == want


@pytest.mark.parametrize("most", [512, 2])
def test_passages_against_brute_force(spark, most):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    shared = [text(49), text(50), text(51), text(120), ["x"] * 70, ["a", "b"] * 40]
    rows = []
    for d in range(80):
        w = text(rng.randrange(60))
        for _ in range(rng.randrange(4)):
            w += rng.choice(shared) + text(rng.randrange(30))
        rows.append((d, "\t ".join(w) if d % 3 else "  " + "\n".join(w)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, ""), (103, None), (104, "É  " * 60), (105, "É É " * 40)]
    rows.append((200, " ".join(text(20_000) + shared[3])))
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, 1, "w", 2) for d, t in rows], SCHEMA).repartition(4)
    assert result(automata.without_repeats(df, shard_words=500, most_segments=most)) == brute(rows)


def test_passages_edge_rows(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(None, t), (5, t), (5, t), (5, "other " + t), (6, "new " + t), (4, "short")]
    got = sorted((str(r.doc_id), r.n_removed) for r in automata.without_repeats(spark.createDataFrame([(d, x, 1, "w", 2) for d, x in rows], SCHEMA)).collect())
    assert got == [("4", 0), ("5", 0), ("5", 0), ("5", 0), ("6", 60), ("None", 0)]
    assert automata.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passages_over_documents(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op9_repeated_passages"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute(rows)
    assert sum(r.n_removed for r in got)
