from collections import Counter
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from croploom.functions import scalars as C
from croploom.functions.similarity import partial_ratio, ratio, weighted_ratio, word_ratio
from croploom.operators import columns as P
from croploom.operators import filters as FL
from croploom.operators import grid as GR
from croploom.operators import joins as J
from croploom.operators import matching as M
from croploom.operators import numbering as N
from croploom.operators import raster as R
from croploom.operators import sets as U
from croploom.operators import stack as S
from croploom.operators import stats as A
from croploom.plans.rotation import rotation_products
from croploom.plans.yearly import yearly_products
from croploom.plans import trial as T
from croploom.session import materialise


def test_null_keys_meet_when_asked(spark):
    big = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v int")
    dim = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    want = {"left": [(1, 10), (2, 10), (3, 20), (4, None)], "left_anti": [4], "left_semi": [1, 2, 3]}
    for how, rows in want.items():
        for most in (500_000, 0):
            got = J.dim_join(big, dim, ["k"], how, max_rows=most, null_safe=True)
            assert got.columns == (["k", "v", "w"] if how == "left" else ["k", "v"])
            assert sorted((r.v, r.w) if how == "left" else r.v for r in got.collect()) == rows


def test_number_rows_with_dominant_and_null_groups(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"),
    )
    rows = N.number_rows(df, "i", ["v"], ["g"]).collect()
    assert len(rows) == 6000
    by = {}
    for r in rows:
        by.setdefault(r.g, []).append((r.i, r.v))
    for numbered in by.values():
        numbered.sort()
        assert [i for i, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [v for _, v in numbered] == sorted(v for _, v in numbered)


def test_median_with_dominant_group(spark):
    rng = np.random.default_rng(1)
    rows = [("big", int(v)) for v in rng.integers(-(10**6), 10**9, 3001)]
    rows += [("even", int(v)) for v in rng.integers(0, 100, 40)] + [(None, 5), ("one", 70000), ("pair", 1), ("pair", 200000)]
    got = {r.g: r.median for r in A.median_by(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v").collect()}
    want = {}
    for g, v in rows:
        want.setdefault(g, []).append(v)
    assert got == {g: float(median(v)) for g, v in want.items()}


def test_salted_join_equals_broadcast(spark):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"), "id"
    )
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k4", 4), (None, 9)], "k string, v int")
    for how in ("left", "inner", "left_anti", "left_semi"):
        a = J.dim_join(big, dim, ["k"], how)
        b = J.dim_join(big, dim, ["k"], how, max_rows=0)
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


def test_broadcast_depends_on_size(spark):
    big, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(J.dim_join(big, dim, ["k"]))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Broadcast" not in plan(J.dim_join(big, dim, ["k"], max_rows=5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_pattern_join_escapes(spark):
    codes = ["A_", "A\\_", "A%", "B\\", "C\\x", "\\\\D", "A1", None]
    pc = spark.createDataFrame([("n", c, i) for i, c in enumerate(codes)], "nuts string, original_code string, id int")
    mapped = ["A1", "A_", "AB2", "B\\", "Cx", "\\D"]
    m = spark.createDataFrame([("n", c, i) for i, c in enumerate(mapped)], "nuts string, original_code string, hcat4_code long")
    out = {}
    for r in J.map_crops(pc, m, pattern=True).collect():
        out.setdefault(codes[r.id], set()).add(r.original_code)
    assert out == {
        "A_": {"A1", "A_"}, "A\\_": {"A_"}, "A%": {"A1", "A_", "AB2"}, "B\\": {"B\\"}, "C\\x": {"Cx"},
        "\\\\D": {"\\D"}, "A1": {"A1"}, None: {None},
    }


def test_mapping_keeps_and_multiplies(spark):
    pc = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", None, 3)], "nuts string, original_code string, cropfield long")
    m = spark.createDataFrame([("a", "1", 10), ("a", "1", 11), ("b", "2", 12)], "nuts string, original_code string, hcat4_code long")
    u = spark.createDataFrame([("a", "2", 5)], "nuts string, original_code string, usage_code int")
    rows = sorted((r.cropfield, r.original_code, r.hcat4_code, r.usage_code) for r in J.map_crops(pc, m, u).collect() if r.cropfield < 3)
    assert rows == [(1, "1", 10, None), (1, "1", 11, None), (2, None, None, 5)]
    assert J.map_crops(pc, m, u).count() == 4


def test_branch_rule(spark):
    codes = [3310000000, 3310100000, 3310101001, 3310202010, 3310202011, 3310202019, 3310202020, 3319999999, 3320000000, 3320100008, None]
    df = spark.createDataFrame([(c,) for c in codes], "c long")
    for branch in FL.BRANCHES:
        f = FL.branch_factor(branch)
        want = [c for c in codes if c is not None and c // f == branch // f]
        assert [r.c for r in df.where(FL.in_branch(F.col("c"), branch)).collect()] == want
    leaf = df.where(FL.in_branch(F.col("c"), 3310202010)).collect()
    assert [r.c for r in leaf] == [3310202010, 3310202011, 3310202019]
    got = {r.c: set(r.b) for r in df.select("c", FL.branches_of(F.col("c")).alias("b")).collect()}
    assert got[None] == set() and got[3310101001] == {3310000000, 3310100000, 3310101000}


def test_branch_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "codes")
    spark.range(3310000000, 3310001000).withColumnRenamed("id", "hcat4_code").write.parquet(path)
    plan = spark.read.parquet(path).where(FL.in_branch(F.col("hcat4_code"), 3310000500))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(hcat4_code,3310000500)" in plan and "LessThan(hcat4_code,3310000600)" in plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_steps_need_no_shuffle(spark, sf):
    pc = T.shaped(T.parcels(spark, sf))
    stored = materialise(pc)
    for df in (R.rasterise(stored, 50), GR.grid_join(stored), P.with_area_ha(stored), P.centroid_layer(stored)):
        assert "Exchange" not in executed(df) and "Join" not in executed(df)
    # Cutting is written once, not repeated for a filter.
    assert "Filter (" not in executed(GR.grid_join(stored))


def test_overlay_shuffles_twice(spark, sf):
    """Equal runs are merged before the second shuffle; combining the years needs none."""
    runs = materialise(R.rasterise(T.shaped(T.parcels(spark, sf)), 50))
    plan = executed(R.combine_years(R.burn(runs), [1996, 1997]))
    assert plan.count("Exchange hashpartitioning") == 2


def test_statistics_aggregate_before_the_shuffle(spark, sf):
    plan = executed(A.area_stats(T.parcels(spark, sf).withColumns({"hcat4_code": F.lit(1), "usage_code": F.lit(1)})))
    assert "partial_sum" in plan


def test_scan_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "layers")
    spark.range(10).selectExpr("'a' as nuts", "2020 as year", "id as cropfield", "'x' as original_code", "1.0F as area_ha", "array() as geom").write.partitionBy("nuts", "year").parquet(path)
    df = spark.read.parquet(path).where("year = 2020")
    plan = executed(A.id_bounds(df))
    assert "ReadSchema: struct<cropfield:bigint>" in plan and "PartitionFilters: [isnotnull(year" in plan


def test_harmonise_raises_on_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "Alpha int, beta int")
    assert P.harmonise_columns(df, {"ALPHA": "cropfield", "beta": "beta"}).columns == ["cropfield", "beta"]
    with pytest.raises(ValueError, match="gamma"):
        P.harmonise_columns(df, {"gamma": "x"})


def test_existing_key_and_half_even(spark):
    df = spark.createDataFrame([(5, 25_000.0)], "OGC_FID int, a double")
    assert P.with_cropfield(df, [], key="ogc_fid").columns == ["cropfield", "a"]
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double").select(C.round_half_even(F.col("v")).alias("r"))
    assert [r.r for r in halves.collect()] == [0, 2, 2, 0]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, off_id string")
    b = spark.createDataFrame([(2, 3.0)], "id int, off_area double")
    assert sorted(map(tuple, U.union_layers([a, b]).collect())) == [(1, "x", None), (2, None, 3.0)]


# Worked by hand from the published definition.
@pytest.mark.parametrize(
    "a, b, score",
    [
        ("", "x", 0.0),
        ("wheat", "wheat", 100.0),
        ("winter wheat", "wheat winter", 95.0),
        ("common soft wheat", "soft wheat", 90.0),
        ("wheat", "what", 200 * 4 / 9),
        ("rye", "barley and rye mixture", 90.0),
        ("x", "abcdefghi", 0.0),
        ("rye", "rye " + "abc " * 20, 60.0),
    ],
)
def test_weighted_ratio(a, b, score):
    assert weighted_ratio(a, b) == pytest.approx(score)
    assert weighted_ratio(b, a) == pytest.approx(score)


def test_ratio_parts():
    assert ratio("abcd", "bcde") == pytest.approx(75)
    assert partial_ratio("bcd", "xxbcdxx") == 100
    assert word_ratio("a b", "b a c") == 100


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        prev = row
    return prev[-1]


def test_ratio_against_table():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc "), rng.integers(1, 80))) for _ in range(2))
        assert ratio(a, b) == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)))


@pytest.mark.parametrize("method", ["weighted", "levenshtein"])
def test_best_match_in_chunks(spark, method, monkeypatch):
    cands = ["winter wheat", "spring wheat", "rye", "winter rye", "barley", "oats", "rye grass"]
    c = spark.createDataFrame(list(enumerate(cands)), "pos long, text string")
    names = spark.createDataFrame([("Winter-Wheat",), ("rye",), ("ryegrass",), ("  ",), (None,), ("rye",), ("zzz",)], "name string")
    whole = {r.text: (r.best, r.score) for r in M.best_match(names, c, method).collect()}
    small = {r.text: (r.best, r.score) for r in M.best_match(names, c, method, chunk=2).collect()}
    assert whole == small
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    assert whole == {r.text: (r.best, r.score) for r in M.best_match(names, c, method, chunk=2).collect()}
    assert set(whole) == {"winter wheat", "rye", "ryegrass", "zzz"}
    assert cands[whole["winter wheat"][0]] == "winter wheat" and cands[whole["ryegrass"][0]] == "rye grass"
    # Nothing in common: the first candidate of the list.
    assert whole["zzz"][0] == 0


def test_match_names_attaches_codes(spark):
    h = spark.createDataFrame([(1, "winter_wheat", 11), (2, "rye", 12)], "pos long, hcat4_name string, hcat4_code long")
    df = spark.createDataFrame([("a", "Wheat, winter"), ("b", "Rye"), ("c", None)], "id string, translated_name string")
    out = {r.id: (r.hcat4_name_auto, r.hcat4_code_auto) for r in M.match_crop_names(df, h).collect()}
    assert out == {"a": ("winter_wheat", 11), "b": ("rye", 12), "c": (None, None)}


def test_accuracy_counts_missing_as_wrong(spark):
    df = spark.createDataFrame([("a", "x", "x"), ("a", "x", None), ("a", None, None), ("a", "y", "x")], "nuts string, hcat4_name string, hcat4_name_auto string")
    assert M.match_accuracy(df).first().accuracy == 25.0


def test_error_rates_leave_out_nulls(spark):
    rows = [(1, None, None), (0, 1, 1), (0, 2, 1), (0, 3, 5), (None, 2, None)]
    df = spark.createDataFrame([("a", *r) for r in rows], "nuts string, translation_flag int, type_error int, cause int")
    r = M.error_rates(df).first()
    assert (r.correct, r.one_engine_wrong, r.odd) == (25.0, 25.0, 75.0)
    assert r.niche_or_homonym == pytest.approx(50.0) and r.separable_prefix == pytest.approx(25.0)


def test_yearly_products(spark, sf):
    pc = T.shaped(T.parcels(spark, sf)).withColumn("area_ha", F.lit(1.0).cast("float"))
    plain = T.parcels(spark, sf)
    crops = T.crop_map(plain)
    usage = T.usage_map(plain)
    names = usage.select("usage_code").distinct().withColumn("usage_name", F.col("usage_code").cast("string"))
    out = yearly_products(pc, crops, usage, T.hierarchy(crops), names)
    assert out.mapped.count() == plain.count() == out.centroids.count()
    assert out.stats.agg(F.sum("area_ha")).first()[0] == plain.count()
    whole = out.grid.agg(F.sum("area_ha")).first()[0]
    arable = out.branches.where("branch_name = 'arable_crops'").agg(F.sum("area_ha")).first()[0]
    assert 0 < arable < whole and out.grid_cells.count() == out.grid.count()
    assert out.bytes.where("area_perc > 255").count() == 0 and out.composite.count() > 0


def test_rotation_products(spark, sf):
    pc = T.shaped(T.parcels(spark, sf))
    out = rotation_products(pc, [1996, 1997], scale=25)
    rows = out.stack.collect()
    assert rows and all(r.cf1996 or r.cf1997 for r in rows)
    known = {r.cropfield: r.original_code for r in pc.collect()}
    for r in rows:
        assert r.c1996 == (known[r.cf1996] if r.cf1996 else None)
    assert out.outlines.count() == len(rows) and out.gaps.columns == ["nuts", "x", "y"]


def test_patterns_meet_the_codes_of_their_fixed_end(spark):
    codes = [f"{a}{b}{c}" for a in "ABCD" for b in "0123456789" for c in "xyz"]
    m = spark.createDataFrame([("n", c) for c in codes] + [("o", "A0x"), ("n", "%"), ("n", None)], "nuts string, _code string")
    patterns = ["A1_", "%9z", "B%", "_", "%", "C_z", "D\\\\_%", "\\\\%", "A1x%1x"]
    p = spark.createDataFrame([("n", x) for x in patterns], "nuts string, _like string")
    met = J.pattern_candidates(p, m)
    got = {(r._like, r._code) for r in met.where(F.like(F.col("_code"), F.col("_like"))).collect()}
    every = p.join(m.where("_code is not null"), "nuts")
    assert got == {(r._like, r._code) for r in every.where(F.like(F.col("_code"), F.col("_like"))).collect()}
    counts = {r._like: r["count"] for r in met.groupBy("_like").count().collect()}
    assert counts["A1_"] == 3 and counts["%9z"] == 4 and counts["B%"] == 30 and counts["C_z"] == 30 and counts["%"] == 121


def test_attached_codes_need_two_exchanges_of_the_stack(spark):
    stack = spark.createDataFrame([("a", 1, 5, None, 2.0), ("a", 2, 6, 7, 1.0), ("b", 1, None, 7, 3.0), ("b", 2, None, None, 0.0)], "nuts string, cropfield long, cf2020 long, cf2021 long, area_ha double")
    pc = spark.createDataFrame([("a", 2020, 5, "x"), ("a", 2020, 6, "z"), ("a", 2020, 6, "y"), ("a", 2021, 7, "q"), ("b", 2020, 7, "no"), ("b", 2021, 7, "r")], "nuts string, year int, cropfield long, original_code string")
    out = S.attach_codes(stack, pc, [2020, 2021])
    assert sorted(map(tuple, out.collect())) == [("a", 1, 5, None, 2.0, "x", None), ("a", 2, 6, 7, 1.0, "y", "q"), ("b", 1, None, 7, 3.0, None, "r"), ("b", 2, None, None, 0.0, None, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = S.attach_codes(stack, pc, [2020, 2021])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3
