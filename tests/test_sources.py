import json

import pytest
from pyspark.sql import functions as F

from riverloom.operators.link import LINK
from riverloom.plans import prepare
from riverloom.schemas import TABLES, UNIQUE_KEYS, struct
from riverloom.sources import readers, tables
from riverloom.streaming.metrics import stream_metrics


def test_metric_csv_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "measure,axis,extra,elevation_talweg\n200.0,2000796122,x,1.5\n400,2000796122,y,NA2\n".replace("NA2", "")
    )
    df = readers.read_metrics(spark, str(tmp_path), "talweg_metrics")
    got = df.orderBy("measure").select("axis", "measure", "elevation_talweg", "sinuosity").collect()
    assert [tuple(r) for r in got] == [(2000796122, 200, 1.5, None), (2000796122, 400, None, None)]


def test_bad_csv_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("axis,measure\n1,abc\n")
    with pytest.raises(Exception):
        readers.read_metrics(spark, str(tmp_path), "talweg_metrics").collect()


def test_layers(spark, tmp_path):
    v = spark.createDataFrame(
        [(1, r, s, float(x), float(y)) for r in (0, 1) for s, (x, y) in enumerate([(0, 0), (1, 0), (1, 1), (0, 0)])],
        "gid int, ring int, seq int, x double, y double",
    )
    v.orderBy(F.col("seq").desc()).write.parquet(str(tmp_path / "poly"))
    layer = readers.read_layer(spark, str(tmp_path / "poly"), "polygon").first()
    assert len(layer["geom"]) == 2 and [p["x"] for p in layer["geom"][0]] == [0, 1, 1, 0]
    v.select("gid", "x", "y").write.parquet(str(tmp_path / "pts"))
    assert readers.read_layer(spark, str(tmp_path / "pts"), "point").count() == 8
    with pytest.raises(ValueError):
        v.select("gid").write.parquet(str(tmp_path / "bad"))
        readers.read_layer(spark, str(tmp_path / "bad"), "point")


def test_site_import(spark, tmp_path, rows):
    def site(code, status, name, **more):
        return {"code_site": code, "statut_site": status, "libelle_site": name, "longitude_site": 3.0,
                "latitude_site": 46.5, "geometry": {"type": "Point"}, **more}

    data = [site("A", 1, "b"), site("A", 1, "a", code_commune_site=["1", "2"]), site("B", 2, "x"), site(None, 1, "y")]
    (tmp_path / "r.json").write_text(json.dumps({"count": 4, "data": data}))
    sites = readers.import_sites(readers.read_sites(spark, str(tmp_path)))
    assert rows(sites, "code_site", "libelle_site", "x", "y") == [("A", "a", 3.0, 46.5)]
    assert "geometry" not in sites.columns


SCHEMA = "axis long, v string"


def test_replace_by_key_is_not_a_merge(spark, rows):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], SCHEMA)
    new = spark.createDataFrame([(1, "z")], SCHEMA)
    out = tables.replace_by_key(old, new, "axis")
    assert rows(out.table) == sorted([(1, "z"), (2, "c"), (None, "n")], key=repr)
    assert out.deleted.first()["n"] == 2 and out.inserted.first()["n"] == 1
    again = tables.replace_by_key(out.table, new, "axis")
    assert rows(again.table) == rows(out.table)


def test_empty_replacement_deletes_nothing(spark, rows):
    old = spark.createDataFrame([(1, "a")], SCHEMA)
    out = tables.replace_by_key(old, spark.createDataFrame([], SCHEMA), "axis")
    assert rows(out.table) == [(1, "a")] and out.deleted.first()["n"] == 0


def test_stored_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.create_table(
        spark.range(200).select((F.col("id") % 50).alias("axis"), F.col("id").cast("string").alias("v")), path, "axis", 8
    )
    assert tables.read_table(spark, path).count() == 200
    new = spark.createDataFrame([(3, "new"), (77, "first")], SCHEMA)
    assert tables.upsert_table(new, path, "axis", 8) == (4, 2)
    assert tables.upsert_table(new, path, "axis", 8) == (2, 2)
    assert tables.upsert_table(spark.createDataFrame([], SCHEMA), path, "axis", 8) == (0, 0)
    with pytest.raises(ValueError, match="8 buckets by axis"):
        tables.upsert_table(new, path, "axis", 16)
    # a key of another type meets its rows all the same
    typed = new.withColumn("axis", F.col("axis").cast("double"))
    assert tables.upsert_table(typed, path, "axis", 8) == (2, 2)
    table = tables.read_table(spark, path)
    assert table.count() == 198
    assert rows(table.filter("axis in (3, 77)")) == [(3, "new"), (77, "first")]


def test_network_replacement_cascades(spark, rows):
    swaths = "gid long, axis long, measure_medial_axis long"
    held = {
        "hydro_axis": spark.createDataFrame([(1, "old"), (2, "two")], "axis long, toponyme string"),
        "hydro_swaths": spark.createDataFrame([(10, 1, 200), (11, 1, 400), (20, 2, 200)], swaths),
        "roe": spark.createDataFrame([("R1", 1), ("R2", 2)], "cdobstecou string, axis long"),
        "valley_bottom": spark.createDataFrame(
            [(1, 200, 10), (1, 400, 11), (2, 200, 20), (1, 600, None)],
            f"axis long, measure_medial_axis long, {LINK} long",
        ),
    }
    new_axes = spark.createDataFrame([(1, "new")], "axis long, toponyme string")
    new_swaths = spark.createDataFrame([(30, 1, 200), (31, 1, 600)], swaths)
    out = tables.replace_network(new_axes, new_swaths, held)
    assert rows(out.axes) == [(1, "new"), (2, "two")]
    assert rows(out.swaths, "gid") == [(20,), (30,), (31,)]
    assert rows(out.obstacles) == [("R2", 2)]
    assert rows(out.metrics["valley_bottom"], "axis", "measure_medial_axis", LINK) == [
        (1, 200, 30), (1, 400, None), (1, 600, 31), (2, 200, 20)]
    assert rows(out.deleted_per_axis) == [(1, 2)]


def test_stream_replaces_and_links(spark, tmp_path, rows):
    raw = "swath double, side string, area double, width1 double, width2 double, axis long, measure long"
    swaths = spark.createDataFrame([(7, 1, 200)], "gid long, axis long, measure_medial_axis long")
    path = str(tmp_path / "table")
    stale = spark.createDataFrame([("left", 9.0, 9.0, 1, 200, None), ("left", 8.0, 8.0, 5, 200, None)],
                                  f"side string, area double, width double, axis long, measure_medial_axis long, {LINK} long")
    tables.create_table(stale, path, "axis", 4)
    schema = stale.schema
    source = tmp_path / "in"

    def arrive(table_rows):
        spark.createDataFrame(table_rows, raw).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema(raw).parquet(str(source))
        stream_metrics(stream, swaths, path, str(tmp_path / "progress"),
                       prepare=lambda b: prepare.prepare_valley_bottom(b).table, schema=schema).awaitTermination()
        return rows(tables.read_table(spark, path), "axis", "measure_medial_axis", "side", "area", LINK)

    arrive([(0.0, "left", 1.0, 1.0, 1.0, 1, 200), (0.0, "right", 2.0, 1.0, 1.0, 1, 400)])
    assert run() == [(1, 200, "left", 1.0, 7), (1, 400, "right", 2.0, None), (5, 200, "left", 8.0, None)]
    arrive([(0.0, "left", 3.0, 1.0, 1.0, 1, 200)])
    assert run() == [(1, 200, "left", 3.0, 7), (5, 200, "left", 8.0, None)]


def test_table_schemas_hold_their_keys():
    for name, keys in UNIQUE_KEYS.items():
        assert set(keys) <= set(TABLES[name].fieldNames())
    assert len(TABLES["roe"].fields) == 74
    assert struct("a rings")["a"].dataType.simpleString() == "array<array<struct<x:double,y:double>>>"


def test_bucket_number_is_kept(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert tables.create_table(spark.createDataFrame([], SCHEMA), path, "axis") == 16
    assert tables.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, "axis", schema=struct(SCHEMA)) == (0, 2)
    assert tables.upsert_table(spark.createDataFrame([(1, "c")], SCHEMA), path, "axis") == (1, 1)
    assert rows(tables.read_table(spark, path)) == [(1, "c"), (2, "b")]
    # creating it again leaves nothing of the old rows
    tables.create_table(spark.createDataFrame([(5, "n")], SCHEMA), path, "axis", 3)
    assert rows(tables.read_table(spark, path)) == [(5, "n")]
    assert tables.buckets_for(10**9) == 1000


def test_csv_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("axis,measure\n1,200\n")
    (tmp_path / "b.csv").write_text("axis,measure\n2,400.0\n")
    schema = struct("measure long, axis long")
    assert sorted(tuple(r) for r in readers.read_metrics(spark, str(tmp_path), schema).collect()) == [(200, 1), (400, 2)]
    (tmp_path / "c.csv").write_text("axis,measure\n3,200.7\n")
    with pytest.raises(Exception, match="not a whole number"):
        readers.read_metrics(spark, str(tmp_path), schema).collect()
    (tmp_path / "c.csv").write_text("measure,axis\n600,3\n")
    with pytest.raises(Exception):
        readers.read_metrics(spark, str(tmp_path), schema).collect()


def test_run_folder_is_dropped(spark):
    from riverloom import session

    table = session.saved(spark.range(5), "five")
    assert table.count() == 5 and session.exists(session.run_folder(spark))
    session.drop_run_folder(spark)
    assert not session.exists(session.run_folder(spark))
    assert session.saved(spark.range(5), "five").count() == 5


def test_first_load_sizes_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 4)
    path = f"file:{tmp_path}/sized"
    schema = struct("axis long, v long")
    tables.create_table(spark.createDataFrame([], schema), path, "axis")
    assert tables.buckets_of(spark, path, "axis") == 16
    assert tables.delete_matching(spark.createDataFrame([(1,)], "axis long"), path, "axis", schema) == 0
    assert tables.upsert_table(spark.createDataFrame([], schema), path, "axis", schema=schema) == (0, 0)
    rows = spark.range(200).selectExpr("id % 30 AS axis", "id AS v")
    assert tables.upsert_table(rows, path, "axis", schema=schema) == (0, 200)
    assert tables.buckets_of(spark, path, "axis") == 50
    again = spark.createDataFrame([(3, -1), (77, -2)], schema)
    assert tables.upsert_table(again, path, "axis", schema=schema) == (7, 2)
    got = sorted(tuple(r) for r in tables.read_table(spark, path, schema).collect())
    assert got == sorted([(i % 30, i) for i in range(200) if i % 30 != 3] + [(3, -1), (77, -2)])
