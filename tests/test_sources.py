import json
import pathlib
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from croploom import session
from croploom.functions import geometry as G
from croploom.functions import wkb as W
from croploom.operators import joins as J
from croploom.operators import stats as A
from croploom.schema import CROP_HIERARCHY, FADN_CROSSWALK
from croploom.sources import geoparquet as GP
from croploom.sources import layers as L
from croploom.sources import sinks
from croploom.sources.catalog import layer_catalog, table_catalog
from croploom.streaming import incremental as I

SQUARE = [[[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]]


def write_layer(folder, name, ids, **extra):
    cols = {
        "cropfield": pa.array(ids, pa.int64()),
        "original_code": pa.array([str(i) for i in ids]),
        "area_ha": pa.array([0.01] * len(ids), pa.float32()),
        "geometry": pa.array([W.encode(SQUARE)] * len(ids), pa.binary()),
        **extra,
    }
    pq.write_table(pa.table(cols), folder / f"{name}.parquet")


def test_read_layers(spark, tmp_path):
    write_layer(tmp_path, "at_2018", [1, 2], off_id=pa.array(["x", "y"]))
    write_layer(tmp_path, "be1_2019", [3])
    df = L.read_layers(spark, [str(tmp_path / "at_2018.parquet"), str(tmp_path / "be1_2019.parquet")])
    rows = sorted((r.nuts, r.year, r.cropfield, r.off_id, len(r.geom)) for r in df.collect())
    assert rows == [("at", 2018, 1, "x", 1), ("at", 2018, 2, "y", 1), ("be1", 2019, 3, None, 1)]
    # Without the geometry neither its column nor the decoder is in the plan.
    plan = A.count_by(df)._jdf.queryExecution().executedPlan().toString()
    assert "geometry" not in plan and "ArrowEvalPython" not in plan


def test_unreadable_geometry(spark, tmp_path):
    whole = W.encode(SQUARE)
    geometry = [whole, None, whole[:20], b"POLYGON EMPTY", b"", whole]
    write_layer(tmp_path, "at_2018", [1, 2, 3, 4, 5, 6], geometry=pa.array(geometry, pa.binary()))
    write_layer(tmp_path, "at_2019", [7])
    write_layer(tmp_path, "be_2019", [])
    paths = [str(p) for p in sorted(tmp_path.glob("*.parquet"))]
    counts = {(r.nuts, r.year): (r.n, r.n_missing, r.n_unreadable, r.n_empty) for r in L.geometry_counts(spark, paths).collect()}
    assert counts == {("at", 2018): (6, 1, 3, 0), ("at", 2019): (1, 0, 0, 0)}
    told = {r.cropfield: (r.reason, r.geometry, r.file.endswith("at_2018.parquet")) for r in L.unreadable_rows(spark, paths).collect()}
    assert told == {2: ("no geometry", None, True), **{i + 1: ("unreadable geometry", geometry[i], True) for i in (2, 3, 4)}}
    assert sorted(r.cropfield for r in L.read_layers(spark, paths, unreadable="drop").collect()) == [1, 6, 7]
    assert L.read_layers(spark, paths).where("geom is null").count() == 4
    assert L.read_layers(spark, paths[1:], unreadable="fail").count() == 1
    with pytest.raises(Exception, match="unreadable geometry in .*at_2018"):
        L.read_layers(spark, paths, unreadable="fail").collect()
    with pytest.raises(ValueError):
        L.read_layers(spark, paths, unreadable="skip")


def test_reconcile_counts_what_was_there(spark):
    src = spark.createDataFrame([(k,) for k in "aaabbccd"], "layer string")
    dst = spark.createDataFrame([("d",)], "layer string")
    there = spark.createDataFrame([("a", 2), ("b", 2), ("c", None)], "layer string, n_present long")
    rows = {r.layer: (r.n_original, r.n_final, r.n_missing, r.status) for r in A.reconcile(src, dst, "layer", there).collect()}
    assert rows == {"a": (3, 2, 1, "present partial"), "b": (2, 2, 0, "present"), "c": (2, None, 2, "present"), "d": (1, 1, 0, "complete")}
    bare = A.reconcile(src, dst, "layer", there.select("layer"))
    assert {r.layer: r.status for r in bare.collect()} == {"a": "present", "b": "present", "c": "present", "d": "complete"}


def test_stages_are_counted_as_they_are_written(spark):
    df = session.stored(spark.range(1000).where("id % 3 = 0"), "codes", counted=True)
    assert df.n_rows == df.count() == 334 and J.is_small(df, 334) and not J.is_small(df, 333)
    empty = session.stored(spark.range(0), counted=True)
    assert empty.n_rows == 0 and J.is_small(empty)
    path = pathlib.Path(df.stored_at.removeprefix("file:"))
    assert path.exists()
    session.discard(df)
    session.discard(spark.range(3))
    assert not path.exists()


def test_catalog_names(spark):
    names = ["at_2018.parquet", "at_2019.parquet", "at_stack.parquet", "be_2018.parquet", "be_stack.parquet", "at_2018.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "name string")

    def pick(*args):
        return [r.name for r in layer_catalog(df, *args).collect()]

    assert pick(["at"], [2018], False) == ["at_2018.parquet"]
    assert pick(["all"], [2018], True) == ["at_2018.parquet", "at_stack.parquet", "be_2018.parquet", "be_stack.parquet"]
    assert pick(["all"], ["all"], True) == sorted(set(names))
    assert pick(["be"], ["all"], False) == ["be_2018.parquet", "be_stack.parquet"]


def test_read_mapping(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_bytes("﻿agriprod_code, Agriprod_Name ,fadn_code,code_name\nC1,\"Wheat, soft\",SE1,Cereals\nC1,Wheat,,\n".encode())
    rows = L.read_mapping(spark, str(path), FADN_CROSSWALK).collect()
    assert [tuple(r) for r in rows] == [("C1", "Wheat, soft", "SE1", "Cereals"), ("C1", "Wheat", None, None)]
    path.write_text("hcat4_code,hcat4_name,seasonality_code,seasonality_name\n3310000000.0,arable,0,NA\n")
    assert tuple(L.read_mapping(spark, str(path), CROP_HIERARCHY).first()) == (3310000000, "arable", 0, "NA")
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="hcat4_code"):
        L.read_mapping(spark, str(path), CROP_HIERARCHY)


def test_ingest_splits_good_and_bad(spark):
    bow = [[[(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]]]
    flat = [[[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)]]]
    rows = [(1, "a", 5, W.encode(SQUARE)), (2, "b", 5, W.encode(bow)), (3, "c", 5, None), (4, "d", 5, b"\x01junk"), (5, "e", 5, W.encode(flat)), (6, "f", 5, W.encode([]))]
    src = spark.createDataFrame([(a, b, c, bytearray(d) if d is not None else None) for a, b, c, d in rows], "FID int, Kultur string, junk int, SHAPE binary")
    manifest = spark.createDataFrame([("AT", 2018, "fid", "cropfield", 1), ("AT", 2018, "KULTUR", "original_code", 1), ("AT", 2018, "junk", "junk", 0), ("AT", 2019, "junk", "x", 1)], "nuts string, year int, column_name string, type string, tokeep int")
    good, bad = L.ingest_layer(src, manifest, "at", 2018, geometry="SHAPE")
    assert sorted(good.columns) == ["cropfield", "geom", "nuts", "original_code", "year"]
    assert sorted(r.cropfield for r in good.collect()) == [1, 2]
    assert {r.cropfield: r.reason for r in bad.collect()} == {3: "no readable geometry", 4: "no readable geometry", 5: "could not be repaired", 6: "empty geometry"}


def test_ingest_reprojects(spark):
    lonlat = [[[(5.0, 50.0), (5.01, 50.0), (5.01, 50.01), (5.0, 50.01), (5.0, 50.0)]]]
    src = spark.createDataFrame([(1, bytearray(W.encode(lonlat)))], "id int, g binary")
    manifest = spark.createDataFrame([("a", 2020, "id", "cropfield", 1)], "nuts string, year int, column_name string, type string, tokeep int")
    good, _ = L.ingest_layer(src, manifest, "a", 2020, geometry="g", source_srid=4326)
    p = good.first().geom[0][0][0]
    assert p.x == pytest.approx(3962799.45, abs=0.01) and p.y == pytest.approx(2999718.85, abs=0.01)


def test_export(spark, tmp_path):
    write_layer(tmp_path, "at_2018", [1, 2])
    df = L.read_layers(spark, str(tmp_path / "at_2018.parquet")).withColumn("extra", F.lit(1))
    out = str(tmp_path / "out")
    types = sinks.export_layers(df, out).collect()
    assert [(r.nuts, r.year, r.geom_type, r.n) for r in types] == [("at", 2018, "Polygon", 2)]
    back = spark.read.parquet(out)
    assert set(back.columns) == {"cropfield", "original_code", "off_id", "off_area", "area_ha", "geometry", "bbox", "nuts", "year"}
    assert bytes(back.first().geometry) == W.encode(SQUARE)
    meta = json.loads((tmp_path / "out" / "_geo_metadata.json").read_text())
    assert meta["columns"]["geometry"]["crs"]["id"]["code"] == 3035
    assert sinks.export_layers(df.drop("geom"), out) is None


def test_tables_and_reports(spark, tmp_path):
    spark.sql("create database if not exists sinks_test location '" + str(tmp_path / "db") + "'")
    df = spark.createDataFrame([(1,)], "` Code ` int")
    sinks.write_table(df, "sinks_test.t", "fail")
    sinks.write_table(df, "sinks_test.t", "append")
    assert spark.table("sinks_test.t").columns == ["code"] and spark.table("sinks_test.t").count() == 2
    sinks.write_table(df, "sinks_test.t", "replace")
    assert spark.table("sinks_test.t").count() == 1
    with pytest.raises(Exception):
        sinks.write_table(df, "sinks_test.t", "fail")
    assert [tuple(r) for r in table_catalog(spark, "sinks_test").collect()] == [("t", "code")]
    spark.sql("drop database sinks_test cascade")
    path = sinks.write_report(df, str(tmp_path), "r.csv", datetime(2024, 5, 6, 7, 8))
    assert path.endswith("/202405060708/r.csv") and spark.read.option("header", True).csv(path).count() == 1


def test_stream_ingest_adds_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    dst, state = str(tmp_path / "dst"), str(tmp_path / "state")

    def run():
        I.ingest_new(I.layer_stream(spark, str(src)), dst, state).awaitTermination()
        return sorted((r.nuts, r.year, r.cropfield) for r in spark.read.parquet(dst).collect())

    write_layer(src, "at_2018", [1, 2])
    first = run()
    assert first == [("at", 2018, 1), ("at", 2018, 2)]
    assert run() == first
    write_layer(src, "at_2019", [7])
    assert run() == [*first, ("at", 2019, 7)]


def test_to_do(spark):
    def frame(*names):
        return spark.createDataFrame([(n,) for n in names], "layer string")

    assert [r.layer for r in I.layers_to_do(frame("a", "b", "c", "d"), frame("b"), frame("d")).orderBy("layer").collect()] == ["a", "c"]


def test_export_of_one_region_leaves_the_others(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for nuts in ("a", "b"):
            row = spark.createDataFrame([(nuts, 2020, 1)], "nuts string, year int, cropfield long").withColumn("geom", G.envelope(*(F.lit(float(v)) for v in (0, 0, 5, 5))))
            sinks.export_layers(row, str(tmp_path / "out"))
        assert sorted(r.nuts for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_columns_are_encoded_as_single_values_are():
    from croploom.functions.nested import from_geometry_array, to_geometry_array

    sq = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.5), (0.0, 0.0)]
    hole = [(0.1, 0.1), (0.2, 0.1), (0.2, 0.2), (0.1, 0.1), (0.1, 0.1)]
    geoms = [[[sq]], None, [], [[sq, hole], [sq]], [[sq], [sq], [hole]], None, [[[]]], [[]]]
    col = to_geometry_array(geoms)
    for part in (col, col.slice(1), col.slice(3, 2), col.slice(1, 1), col.slice(0, 0)):
        assert W.encode_column(part).to_pylist() == [W.encode(g) for g in from_geometry_array(part)]


def test_a_failing_replacement_leaves_the_old_rows(spark, tmp_path):
    spark.sql("create database if not exists swap_test location '" + str(tmp_path / "db") + "'")
    try:
        sinks.write_table(spark.range(5).toDF("ID "), "swap_test.t")
        broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception):
            sinks.write_table(broken, "swap_test.t")
        assert spark.table("swap_test.t").count() == 5
        sinks.write_table(spark.table("swap_test.t").selectExpr("id * 2 as id"), "swap_test.t")  # read while it is replaced
        assert sorted(r.id for r in spark.table("swap_test.t").collect()) == [0, 2, 4, 6, 8]
        assert [t.name for t in spark.catalog.listTables("swap_test")] == ["t"]
    finally:
        spark.sql("drop database swap_test cascade")


def test_numbers_stay_with_their_rows(spark, tmp_path):
    from croploom.operators.ledger import keep_numbers

    def run(rows):
        df = spark.createDataFrame(rows, "nuts string, year int, off_id string, code string")
        return sorted(map(tuple, keep_numbers(df, str(tmp_path / "keys"), ["off_id", "code"]).collect()), key=str)

    a = [("x", 1, "b", "1"), ("x", 1, "a", "1"), ("x", 1, "a", "1"), ("y", 1, None, None), ("y", 1, None, None)]
    one = run(a)
    assert {r[4] for r in one if r[0] == "x"} == {1, 2, 3} and {r[4] for r in one if r[0] == "y"} == {1, 2}
    assert run(a[::-1]) == one
    two = run([*a[1:], ("x", 1, "0", "new"), ("z", 2, "q", None)])
    assert set(two) - set(one) == {("x", 1, "0", "new", 4), ("z", 2, "q", None, 1)} and len(two) == 6
    assert run(a) == one and run([]) == []


def test_numbers_are_given_on_keys_alone(spark, tmp_path, monkeypatch):
    from croploom.operators import ledger

    sorted_on = []
    number = ledger.number_rows

    def seen(df, *a, **k):
        sorted_on.append(set(df.columns))
        return number(df, *a, **k)

    monkeypatch.setattr(ledger, "number_rows", seen)
    rows = [("x", 1, str(i), "shape") for i in range(20)] + [(None, 1, "q", "shape")] * 3
    df = spark.createDataFrame(rows, "nuts string, year int, off_id string, geom string")
    for _ in range(2):
        got = ledger.keep_numbers(df.where("nuts is not null"), str(tmp_path / "keys"), ["off_id", "geom"])
        assert got.columns == ["nuts", "year", "off_id", "geom", "cropfield"] and sorted(r.cropfield for r in got.collect()) == list(range(1, 21))
    assert len(sorted_on) == 2 and all("geom" not in c for c in sorted_on)
    # equal rows without a layer are numbered each
    got = ledger.keep_numbers(df, str(tmp_path / "other"), ["off_id", "geom"])
    assert sorted(r.cropfield for r in got.where("nuts is null").collect()) == [1, 2, 3] and got.count() == 23


def test_layers_have_few_files_however_many_tasks(spark, tmp_path):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 2000, 1, 60).selectExpr("concat('n', id % 5) nuts", "cast(2000 + id % 2 as int) year", "id")
    sinks.replace_layers(rows, str(tmp_path / "out"), rows)
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 10 + n
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("id")).first()[0] == 1999000


def test_an_encoded_frame_is_exported_as_it_is(spark, tmp_path):
    df = _many_squares(spark, 50)
    types = [sinks.export_layers(d, str(tmp_path / n)).collect() for n, d in (("a", df), ("b", sinks.encoded(df).drop("geom")))]
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    assert types[0] == types[1] and a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_digests_tell_changed_layers(spark):
    from croploom.operators.ledger import layer_digests

    rows = [("a", 1, {"k": "v", "m": None}, "x"), ("a", 1, {"k": "w"}, None), ("b", 1, {}, "x")]
    schema = "nuts string, year int, attrs map<string,string>, t string"
    base = {r.nuts: r.digest for r in layer_digests(spark.createDataFrame(rows, schema)).collect()}
    again = {r.nuts: r.digest for r in layer_digests(spark.createDataFrame([rows[2], rows[1], ("a", 1, {"m": None, "k": "v"}, "x")], schema)).collect()}
    assert base == again
    for other in ([("a", 1, {"k": "v"}, "x"), *rows[1:]], [rows[0], rows[0], rows[2]], [*rows[:2], rows[1], rows[2]], [rows[0], ("a", 1, {"k": "w"}, "None"), rows[2]]):
        new = {r.nuts: r.digest for r in layer_digests(spark.createDataFrame(other, schema)).collect()}
        assert new["a"] != base["a"] and new["b"] == base["b"]


def _source_rows(spark, changed=False):
    square = bytearray(W.encode(SQUARE))
    rows = [(n, 2020, {"ID": str(i), "CODE": "c"}, square if i % 4 else None) for n in ("a", "b") for i in range(1, 13)]
    rows += [("a", 2020, {"ID": None, "CODE": "d"}, square)] * 2
    if changed:
        rows = [(n, y, a, square if n == "b" else w) for n, y, a, w in rows] + [("b", 2020, {"ID": "0", "CODE": "c"}, square)]
    return spark.createDataFrame(rows, "nuts string, year int, attrs map<string,string>, wkb binary")


def test_layer_job_can_be_repeated(spark, tmp_path, monkeypatch):
    from croploom.plans import layers as PL

    listed = spark.createDataFrame([("A", 2020), ("B", 2020)], "nuts string, year int")
    manifest = spark.createDataFrame([(n, 2020, c, t, 1) for n in "ab" for c, t in (("id", "off_id"), ("code", "original_code"))], "nuts string, year int, column_name string, type string, tokeep int")
    rows = lambda df: sorted((str(tuple(r)) for r in df.collect()))
    clean = PL.layer_job(_source_rows(spark), listed, manifest, str(tmp_path / "clean"))
    out = str(tmp_path / "again")
    write, calls = PL.export_layers, []

    def failing(*a, **k):
        calls.append(1)
        raise OSError("no space")

    monkeypatch.setattr(PL, "export_layers", failing)
    with pytest.raises(OSError):
        PL.layer_job(_source_rows(spark), listed, manifest, out)
    monkeypatch.setattr(PL, "export_layers", write)
    got = PL.layer_job(_source_rows(spark).orderBy(F.rand(3)), listed, manifest, out)
    assert rows(got.layers) == rows(clean.layers) and rows(got.quarantine) == rows(clean.quarantine) and rows(got.report) == rows(clean.report)
    assert got.quarantine.count() == 6 and got.layers.groupBy("nuts").agg(F.count_distinct("cropfield")).count() == 2

    # b has changed since: it is taken in again, its rows keep their numbers, and its quarantine is empty now
    before = {(r.nuts, r.off_id): r.cropfield for r in got.layers.collect() if r.off_id}
    done = spark.createDataFrame(got.digests.collect(), got.digests.schema)
    new = PL.layer_job(_source_rows(spark, changed=True), listed, manifest, out, done)
    after = {(r.nuts, r.off_id): r.cropfield for r in new.layers.collect() if r.off_id}
    assert all(after[k] == n for k, n in before.items()) and len(after) == len(before) + 4
    # a is there, but for the rows in its quarantine
    report = {r.layer: r for r in new.report.collect()}
    assert {k: r.status for k, r in report.items()} == {"a_2020": "present partial", "b_2020": "complete"}
    kept = new.layers.where("nuts = 'a'").count()
    assert report["a_2020"].n_final == kept and report["a_2020"].n_missing == new.quarantine.count() > 0
    assert {r.nuts for r in new.quarantine.collect()} == {"a"}


def _many_squares(spark, n=4000):
    x, y = F.col("id") * 7919 % 400 * 50.0, F.col("id") * 104729 % 397 * 50.0
    rows = spark.range(n).select(F.lit("x").alias("nuts"), F.lit(2020).alias("year"), F.col("id").alias("cropfield"), G.envelope(x, y, x + 30, y + 20).alias("geom"))
    return rows


def test_a_window_reads_few_row_groups(spark, tmp_path):
    df = _many_squares(spark)
    out = str(tmp_path / "out")
    sinks.export_geoparquet(df, out, row_group=100)
    files = list((tmp_path / "out" / "nuts=x" / "year=2020").glob("*.parquet"))
    window = (5000.0, 5000.0, 6500.0, 6200.0)
    met = total = 0
    for f in files:
        meta = pq.read_metadata(f)
        at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            low = [meta.row_group(g).column(at[f"bbox.{k}"]).statistics for k in ("xmin", "ymin", "xmax", "ymax")]
            total += 1
            met += low[0].min <= window[2] and low[1].min <= window[3] and low[2].max >= window[0] and low[3].max >= window[1]
    assert total >= 40 and met <= total / 4
    got = L.read_window(spark, out, *window)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bbox.xmax" in plan
    want = [r.cropfield for r in df.collect() if r.geom[0][0][0].x <= window[2] and r.geom[0][0][0].x + 30 >= window[0] and r.geom[0][0][0].y <= window[3] and r.geom[0][0][0].y + 20 >= window[1]]
    assert sorted(r.cropfield for r in got.collect()) == sorted(want) and want


def test_footers_describe_the_geometry(spark, tmp_path):
    df = _many_squares(spark, 500).withColumn("year", (F.col("cropfield") % 2 + 2020).cast("int"))
    out = tmp_path / "geo"
    sinks.export_geoparquet(df, str(out))
    sinks.export_geoparquet(df.where("year = 2020").limit(7), str(out))
    files = list(out.rglob("*.parquet"))
    limits = []
    for f in files:
        geo = json.loads(pq.read_metadata(f).metadata[b"geo"])
        assert geo["version"] == "1.1.0" and geo["columns"]["geometry"]["crs"]["id"]["code"] == 3035
        limits.append(geo["columns"]["geometry"]["bbox"])
    assert all(a[0] < a[2] and a[1] < a[3] for a in limits)
    told = GP.footers(spark, str(out)).collect()
    assert sorted(list(r.bbox) for r in told) == sorted(limits) and {(r.version, r.srid) for r in told} == {("1.1.0", 3035)}
    assert sum(r.n_rows for r in told) == 257
    GP.require_srid(spark, str(out), 3035)
    pq.write_table(pa.table({"id": [1]}), out / "plain.parquet")
    with pytest.raises(ValueError, match="plain.parquet"):
        GP.require_srid(spark, str(out), 3035)
    (out / "plain.parquet").unlink()
    assert {(r.year, r["count"]) for r in spark.read.parquet(str(out)).groupBy("year").count().collect()} == {(2020, 7), (2021, 250)}


def test_a_failed_export_leaves_no_file(spark, tmp_path):
    df = _many_squares(spark, 300)
    out = tmp_path / "geo"
    sinks.export_geoparquet(df, str(out))
    before = sorted(out.rglob("*.parquet"))
    late = df.withColumn("cropfield", F.when(F.col("cropfield") == 299, F.raise_error(F.lit("no"))).otherwise(F.col("cropfield")))
    with pytest.raises(Exception):
        sinks.export_geoparquet(late, str(out))
    assert sorted(out.rglob("*.parquet")) == before and [p.name for p in out.iterdir()] == ["nuts=x"]
