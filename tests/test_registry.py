"""Every registered query against its SQL text, on the smallest test data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
OWN = [n for n in entry_points.queries() if n in entry_points.registry.QUERIES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(frame):
    import pandas as pd

    columns = sorted(frame.columns)
    out = [
        tuple(None if pd.isna(v) else (float(v) if not isinstance(v, (str, bool)) else v) for v in row)
        for row in frame[columns].itertuples(index=False)
    ]
    return columns, sorted(out, key=repr)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, SF).toPandas()
    sql = entry_points.oracle_sql().get(name)
    assert sql is not None, "every query of the library has SQL"
    assert canonical(got) == canonical(duck.execute(sql).fetchdf())


#: queries whose smallest table does not have all cases
WIDER = ["prepare_obstacles", "snap_to_vertices"]


@pytest.mark.parametrize("name", WIDER)
def test_query_on_more_rows(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = entry_points.queries()[name](spark, sf).toPandas()
    assert canonical(got) == canonical(con.execute(entry_points.oracle_sql()[name]).fetchdf())


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
