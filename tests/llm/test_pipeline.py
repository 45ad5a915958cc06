import struct
import zlib

import duckdb
import pandas as pd
import pyarrow as pa
from test_leaks import brute as brute_leaks
from test_mixing_and_minhash import brute_near
from test_records import encoded

import __spark_entry__ as entry_points
import corpus_pipeline
from riverloom.llm import queries
from riverloom.llm.words import pieces

SF = "/root/testdata/sf0.001"


def test_entry_has_all_queries():
    names = entry_points.queries()
    assert "pipeline" in names and "pipeline" not in entry_points.oracle_sql()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_stages_against_brute_force(spark):
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = queries.table(spark, SF, "documents")
    model = queries.toxicity_model(spark, docs, SF)
    kept = []
    for lo, hi, texts in pieces(pa.array([r[1] for r in rows], pa.string()), fold=True):
        kept += [r for r, s in zip(rows[lo:hi], model.scores(texts)) if s < 0.5]
    assert 0 < len(rows) - len(kept) < 0.2 * len(rows)
    near = brute_near([r[:2] for r in kept], percent=80)
    kept = [r for r in kept if near[r[0]][1] == r[0]]
    held = {d for d, _ in brute_leaks([r[:2] for r in kept], items)}
    kept = [r for r in kept if r[0] not in held]
    con.register("documents", pd.DataFrame(kept, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    taken = {d: (n, t) for d, n, t in con.execute(f"SELECT doc_id, size, taken FROM ({queries.ORACLES['op8_source_mixing']})").fetchall()}
    assert all(n > 0 for n, _ in taken.values())
    mixed = sorted((r for r in kept for _ in range(taken[r[0]][1] // taken[r[0]][0])), key=lambda r: r[0])
    want, start = [], 0
    for r, ids in zip(mixed, encoded([r[1] for r in mixed])):
        want.append((r[0], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)

    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = docs.cache()
    assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == [r[0] for r in mixed]
    got = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_stages_on_odd_rows(spark):
    """Nulls in every column, repeated rows and a further column pass every stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, rep long"
    rows = [(None, None, None, None, None, 1), (None, "some text here", None, None, None, 1), (7, "", "en", "a", 0, 1), (7, "", "en", "a", 0, 1), (8, "one two three", "en", "a", 3, 2)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", "), name
        out = corpus_pipeline.write_records(spark, docs, SF).collect()
        assert (len(out) > 0) == bool(table)
