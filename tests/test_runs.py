import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from croploom.functions import runs as N
from croploom.functions.runs import burn_table, by_tile
from croploom.operators import raster as R
from croploom.operators import stack as S
from croploom.session import materialise
from test_raster import LAYER, box

TILE = ["nuts", "_band", "px"]


def pixels_of(t: pa.Table) -> dict:
    out = {}
    for r in t.to_pylist():
        for x in range(r["x0"], r["x1"]):
            key = (r["nuts"], r["_band"], r["px"], r["year"], r["py"], x)
            out[key] = max(out.get(key, -1), -1 if r["cf"] is None else r["cf"])
    return out


@pytest.mark.parametrize("waiting", [5, 10**9])
def test_tiles_cut_by_batches(monkeypatch, waiting):
    rng = np.random.default_rng(5)
    n = 400
    t = pa.table({
        "nuts": pa.array([None if k == 0 else f"n{k}" for k in rng.integers(0, 3, n)]),
        "year": pa.array(rng.integers(2019, 2021, n), pa.int32()),
        "cf": pa.array([None if k == 0 else int(k) for k in rng.integers(0, 50, n)], pa.int64()),
        "py": pa.array(rng.integers(-3, 3, n), pa.int32()),
        "px": pa.array(rng.integers(-1, 2, n), pa.int32()),
        "x0": pa.array(rng.integers(-40, 0, n), pa.int32()),
    })
    t = t.append_column("x1", pa.array(np.asarray(t["x0"]) + rng.integers(1, 30, n).astype(np.int32)))
    t = t.append_column("_band", pa.array(np.asarray(t["py"]) // 2, pa.int32())).sort_by([(c, "ascending") for c in TILE])
    monkeypatch.setattr(N, "GATHERED", 7)
    monkeypatch.setattr(N, "WAITING", waiting)
    work = lambda part: burn_table(part, TILE)
    got = pa.Table.from_batches(by_tile(iter(t.to_batches(max_chunksize=3)), TILE, work, work))
    assert pixels_of(got) == pixels_of(t)
    assert sum(r["x1"] - r["x0"] for r in got.to_pylist()) == len(pixels_of(t))  # no pixel twice


def test_overlay_moves_runs_once(spark):
    pc = spark.createDataFrame([("a", y, k, "x", box(7 * k, 5 * k, 7 * k + 900, 5 * k + 400)) for y in (2019, 2020) for k in range(1, 9)], LAYER)
    runs = materialise(R.rasterise(pc, 1))
    one = R.overlay(runs, [2019, 2020])
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    px = lambda df: {(r.px, r.py, r.cf2019, r.cf2020) for r in R.pixels(df).collect()}
    two = R.combine_years(R.burn(runs), [2019, 2020])
    assert px(one) == px(two)
    inset = R.overlay(runs, [2019, 2020], inset=True)
    assert px(inset.where("n is null").drop("n")) == px(R.erode(two, [2019, 2020]))
    total = two.groupBy("cf2019", "cf2020").agg(F.sum(F.col("x1") - F.col("x0")).alias("n")).collect()
    assert {tuple(r) for r in inset.groupBy("cf2019", "cf2020").agg(F.sum("n")).collect()} == {tuple(r) for r in total}


def test_rare_ids_without_region_go(spark):
    pc = spark.createDataFrame([(None, 2020, 1, "x", box(0, 0, 2, 2)), (None, 2020, 2, "x", box(50, 0, 70, 20))], LAYER)
    for inset in (True, False):
        assert [r.cf2020 for r in S.stack_runs(pc, [2020], 1, inset=inset).select("cf2020").distinct().collect()] == [2]


def test_geometry_that_is_not_finite_stops_nothing(spark):
    nan, inf = float("nan"), float("inf")
    pc = spark.createDataFrame([("a", 2020, 1, "x", box(0, 0, nan, nan)), ("a", 2020, 2, "x", box(0, 0, 10, inf)), ("a", 2020, 3, "x", None), ("a", 2020, 4, "x", []), ("a", 2020, 5, "x", box(0, 0, 10, 10))], LAYER)
    assert R.rasterise(pc, 1).where("cf = 5").count() == 10


def test_changed_labels_are_not_repeated(spark):
    """However large the table of changed combinations is, the join does not multiply its rows."""
    runs = spark.range(600_000).selectExpr("'a' nuts", "id cf2020", "0 py", "0 x0", "1 x1")
    changes = runs.selectExpr("nuts", "cf2020", "cf2020 + 1 _f2020", "cf2020 % 2 = 0 _gone")
    out = S._relabelled(runs, materialise(changes), [2020], ["nuts"])
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.count("*"), F.min("cf2020")).first()[:] == (300_000, 2)


def test_medians_store_their_counts(spark):
    """Counts are read for the slices and for the values, and worked out once."""
    from croploom.operators import stats as A

    seen, plain = [], A.materialise
    A.materialise = lambda df, label="stage": seen.append(label) or plain(df, label)
    try:
        df = spark.createDataFrame([("a", 1, 3), ("a", 9, 1), ("b", 4, 1), ("b", 8, 1)], "k string, v long, n long")
        assert {tuple(r) for r in A.median_by(df, ["k"], "v", weight="n").collect()} == {("a", 1.0), ("b", 6.0)}
    finally:
        A.materialise = plain
    assert seen == ["counts"]
