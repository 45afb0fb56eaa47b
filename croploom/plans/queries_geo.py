"""Registered queries: geometry, grid, raster overlay, quality, matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.functions import crs
from croploom.functions import geometry as G
from croploom.functions import scalars as C
from croploom.functions import validity as V
from croploom.functions.wkb import from_wkb, to_wkb
from croploom.operators import columns as P
from croploom.operators import filters as FL
from croploom.operators import grid as GR
from croploom.operators import joins as J
from croploom.operators import ledger as LG
from croploom.operators import matching as M
from croploom.operators import numbering as N
from croploom.operators import quality as Q
from croploom.operators import raster as R
from croploom.operators import stack as S
from croploom.operators import stats as A
from croploom.operators import tracing as TR
from croploom.plans import trial as T
from croploom.plans.layers import layer_job
from croploom.plans.registry import query
from croploom.schema import GEOM
from croploom.session import materialise, shared_path
from croploom.sources import geoparquet as GP
from croploom.sources import layers as L
from croploom.sources import sinks
from croploom.streaming import incremental as I

BASE = T.with_(T.PARCELS)
SIGNED = T.with_(T.PARCELS, T.SIGNED)
SCALE = T.PIXEL_SCALE
YEARS = list(range(1995, 2002))  # all years of the order tables


def shapes(spark, sf) -> DataFrame:
    return T.shaped(T.parcels(spark, sf))


# --- geometry columns ----------------------------------------------------------------------------

AREA_SQL = SIGNED + "select cropfield, sum(sign * (x1 - x0) * (y1 - y0)) as area from signed group by cropfield"


@query("g1_wkb_round_trip", AREA_SQL)
def _(spark, sf):
    return shapes(spark, sf).select("cropfield", G.area(from_wkb(to_wkb("geom"))).alias("area"))


@query("g2_area", AREA_SQL)
def _(spark, sf):
    return shapes(spark, sf).select("cropfield", G.area(F.col("geom")).alias("area"))


@query(
    "g3_bbox",
    BASE
    + """select cropfield, cast(xmin as double) as xmin, cast(ymin as double) as ymin,
    cast(xmax as double) as xmax, cast(ymax as double) as ymax from parcels""",
)
def _(spark, sf):
    return shapes(spark, sf).withColumn("b", G.bbox(F.col("geom"))).select("cropfield", "b.*")


@query(
    "g4_p9_centroid_layer",
    SIGNED
    + """select cropfield, round(sum(sign * (x1 - x0) * (y1 - y0) * (x0 + x1) / 2) / sum(sign * (x1 - x0) * (y1 - y0)), 3) as cx,
    round(sum(sign * (x1 - x0) * (y1 - y0) * (y0 + y1) / 2) / sum(sign * (x1 - x0) * (y1 - y0)), 3) as cy from signed group by cropfield""",
)
def _(spark, sf):
    c = P.centroid_layer(shapes(spark, sf))
    return c.select("cropfield", F.round("cx", 3).alias("cx"), F.round("cy", 3).alias("cy"))


@query(
    "g13_promote_to_multi",
    BASE + "select cropfield, 1 :: bigint as parts, case when kind = 1 then 6 else 4 end :: bigint as corners from parcels",
)
def _(spark, sf):
    single = shapes(spark, sf).withColumn("geom", G.to_multi(F.col("geom")[0]))
    return single.select(
        "cropfield", F.size("geom").cast("bigint").alias("parts"), (F.size(F.col("geom")[0][0]) - 1).cast("bigint").alias("corners")
    )


LON = "(c_custkey % 500) / 10.0 - 12"
LAT = "35 + (c_custkey % 331) / 10.0"
# The same closed form written out in SQL.
LAEA_SQL = f"""with k as (select 0.0818191910428158 as e, 0.00669438002290079 as e2, 6378137.0 as a, radians(52) as p0),
  q as (select *, (1 - e2) * (1 / (1 - e2) - ln((1 - e) / (1 + e)) / (2 * e)) as qp,
    (1 - e2) * (sin(p0) / (1 - e2 * sin(p0) * sin(p0)) - ln((1 - e * sin(p0)) / (1 + e * sin(p0))) / (2 * e)) as q0 from k),
  o as (select *, asin(q0 / qp) as b0, a * sqrt(qp / 2) as rq from q),
  d as (select *, a * cos(p0) / sqrt(1 - e2 * sin(p0) * sin(p0)) / (rq * cos(b0)) as dd from o),
  g as (select c_custkey, radians({LON} - 10) as dl, sin(radians({LAT})) as s, d.* from customer, d),
  h as (select *, asin((1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e)) / qp) as b from g),
  i as (select *, rq * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(dl))) as bb from h)
  select c_custkey, round(4321000 + bb * dd * cos(b) * sin(dl), 3) as x,
         round(3210000 + bb / dd * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(dl)), 3) as y from i"""


@query("g14_reproject", LAEA_SQL)
def _(spark, sf):
    p = T.table(spark, sf, "customer").select("c_custkey", F.expr(f"cast({LON} as double)").alias("lon"), F.expr(f"cast({LAT} as double)").alias("lat"))
    p = p.withColumn("p", crs.to_3035(F.col("lon"), F.col("lat")))
    return p.select("c_custkey", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("g15_simplify", BASE + "select cropfield, 5 :: bigint as points, cast(w * h as double) as area from parcels")
def _(spark, sf):
    # Rectangles with extra points up to half a metre off their lower side.
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    extra = [G.point(x0 + F.col("w") * i / 8, y0 + F.lit(d)) for i, d in ((1, 0.0), (3, 0.5), (5, -0.5), (7, 0.25))]
    ring = F.concat(F.array(G.point(x0, y0), *extra), F.slice(G.box_ring(x0, y0, x1, y1), 2, 4))
    thin = T.parcels(spark, sf).select("cropfield", V.simplify(F.array(F.array(ring)).cast(GEOM), 1.0).alias("g"))
    return thin.select("cropfield", F.size(F.col("g")[0][0]).cast("bigint").alias("points"), G.area(F.col("g")).alias("area"))


@query(
    "f4_g17_drop_empty",
    BASE + "select nuts, count(*) as n from parcels where cropfield % 7 > 1 group by nuts",
)
def _(spark, sf):
    g = F.when(F.col("cropfield") % 7 == 0, F.slice("geom", 1, 0)).when(F.col("cropfield") % 7 > 1, F.col("geom"))
    return A.count_by(FL.drop_empty(shapes(spark, sf).withColumn("geom", g)), ["nuts"])


@query(
    "a10_geom_types",
    BASE + "select year, case when kind = 3 then 'MultiPolygon' else 'Polygon' end as geom_type, count(*) as n from parcels group by all",
)
def _(spark, sf):
    return Q.geom_types(shapes(spark, sf), ["year"])


@query(
    "f6_g6_g7_envelope",
    T.with_(T.PARCELS, T.COVER)
    + "select distinct cropfield from cover where x1 >= 2645000 and x0 <= 2670010 and y1 >= 1562000 and y0 <= 1590020",
)
def _(spark, sf):
    return FL.in_envelope(shapes(spark, sf), 2645000, 1562000, 2670010, 1590020).select("cropfield")


# --- grid ----------------------------------------------------------------------------------------


@query(
    "j4_grid_join_boxes",
    T.with_(T.PARCELS, T.CELLS)
    + """select grd_id, cropfield, cast(greatest(least(xmax, cx1) - greatest(xmin, cx0), 0)
      * greatest(least(ymax, cy1) - greatest(ymin, cy0), 0) as double) as inter_m2
    from parcels, cells where xmax >= cx0 and xmin <= cx1 and ymax >= cy0 and ymin <= cy1""",
)
def _(spark, sf):
    return GR.grid_join(T.parcels(spark, sf), geom=None).select("grd_id", "cropfield", "inter_m2")


MEETS = """meets as (
  select distinct nuts, year, cropfield, original_code, grd_id from cover, cells where x1 >= cx0 and x0 <= cx1 and y1 >= cy0 and y0 <= cy1)"""
INSIDE = """inside as (
  select cropfield, grd_id, sum(sign * greatest(least(x1, cx1) - greatest(x0, cx0), 0) * greatest(least(y1, cy1) - greatest(y0, cy0), 0)) as m2
  from signed, cells where x1 > cx0 and x0 < cx1 and y1 > cy0 and y0 < cy1 group by all)"""
ON_GRID = T.with_(T.PARCELS, T.SIGNED, T.COVER, T.CELLS, T.CROP_MAP, MEETS, INSIDE)


@query(
    "j4_g5_grid_join_polygons",
    ON_GRID + "select m.grd_id, m.cropfield, cast(coalesce(m2, 0) as double) as inter_m2 from meets m left join inside using (cropfield, grd_id)",
)
def _(spark, sf):
    return GR.grid_join(shapes(spark, sf)).select("grd_id", "cropfield", "inter_m2")


def grid_by_year(spark, sf) -> DataFrame:
    plain = T.parcels(spark, sf)
    return GR.grid_stats(J.map_crops(T.shaped(plain), T.crop_map(plain)), by=("year", "hcat4_code"))


GRID = """grid_year as (
  select grd_id, year, hcat4_code, sum(coalesce(m2, 0)) / 10000 as area_ha, count(*) as counts
  from meets m left join inside using (cropfield, grd_id)
  left join crop_map c on c.nuts = m.nuts and c.original_code = m.original_code group by grd_id, year, hcat4_code)"""
BRANCH = f"""branches(branch, branch_name) as (values {', '.join(f"({c}, '{n}')" for c, n in FL.BRANCHES.items())}),
  grid_branch as (select year, grd_id, cast(branch as bigint) as branch, branch_name, sum(area_ha) as area_ha from grid_year, branches
  where floor(hcat4_code / power(10, length(regexp_extract(cast(branch as varchar), '0*$'))))
      = branch / power(10, length(regexp_extract(cast(branch as varchar), '0*$'))) group by all)"""
BYTES = """bytes as (select year, branch, branch_name, 374 - grd_id % 1000 as row, grd_id // 1000 as col,
  cast(least(255, round_even(area_ha * 255 / 10000, 0)) as integer) as area_perc from grid_branch)"""


@query("a2_grid_stats", ON_GRID + "," + GRID + " select grd_id, year, hcat4_code, round(area_ha, 6) as area_ha, counts from grid_year")
def _(spark, sf):
    return grid_by_year(spark, sf).withColumn("area_ha", F.round("area_ha", 6))


@query(
    "j5_attach_cells",
    ON_GRID + "," + GRID + """ select g.grd_id, year, hcat4_code, round(area_ha, 6) as area_ha, cast(cx0 as double) as x0,
    cast(cy1 as double) as y1, 10000.0 * 10000.0 :: double as cell_m2 from grid_year g join cells using (grd_id)""",
)
def _(spark, sf):
    out = GR.attach_cells(grid_by_year(spark, sf)).withColumn("b", G.bbox(F.col("geom")))
    return out.select(
        "grd_id", "year", "hcat4_code", F.round("area_ha", 6).alias("area_ha"),
        F.col("b.xmin").alias("x0"), F.col("b.ymax").alias("y1"), G.area(F.col("geom")).alias("cell_m2"),
    )


@query(
    "a3_grid_branch",
    ON_GRID + "," + GRID + "," + BRANCH + " select year, grd_id, branch, branch_name, round(area_ha, 6) as area_ha from grid_branch",
)
def _(spark, sf):
    return GR.grid_branch(grid_by_year(spark, sf), by=("year",)).withColumn("area_ha", F.round("area_ha", 6))


@query("r8_grid_byte", ON_GRID + "," + GRID + "," + BRANCH + "," + BYTES + " select * from bytes")
def _(spark, sf):
    return GR.grid_byte(GR.grid_branch(grid_by_year(spark, sf), by=("year",)))


@query(
    "r9_grid_composite",
    ON_GRID + "," + GRID + "," + BRANCH + "," + BYTES + """ select year, row, col,
    coalesce(max(case when branch_name = 'permanent_crops_perennial' then area_perc end), 0) as permanent_crops_perennial,
    coalesce(max(case when branch_name = 'grassland_grass' then area_perc end), 0) as grassland_grass,
    coalesce(max(case when branch_name = 'arable_crops' then area_perc end), 0) as arable_crops
    from bytes where branch_name in ('permanent_crops_perennial', 'grassland_grass', 'arable_crops') group by year, row, col""",
)
def _(spark, sf):
    return GR.grid_composite(GR.grid_byte(GR.grid_branch(grid_by_year(spark, sf), by=("year",))), by=("year",))


@query(
    "a11_thin_points",
    SIGNED
    + """, c as (select sum(sign * (x1 - x0) * (y1 - y0) * (x0 + x1) / 2) / sum(sign * (x1 - x0) * (y1 - y0)) as cx,
      sum(sign * (x1 - x0) * (y1 - y0) * (y0 + y1) / 2) / sum(sign * (x1 - x0) * (y1 - y0)) as cy from signed group by cropfield)
    select distinct round_even(round_even(round(cx, 6), 0) / 1000, 0) * 1000 as x, round_even(round_even(round(cy, 6), 0) / 1000, 0) * 1000 as y from c""",
)
def _(spark, sf):
    c = P.centroid_layer(shapes(spark, sf)).select(F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))
    return A.thin_points(c, 1000)


@query(
    "a7_layer_extent",
    BASE
    + """, e as (select year, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from parcels group by year),
    t as (select * from e union all select null, min(xmin), min(ymin), max(xmax), max(ymax) from e)
    select year, cast(trunc(xmin / 50000) as bigint) * 50000 as xmin, cast(trunc(ymin / 50000) as bigint) * 50000 as ymin,
      cast(ceil(xmax / 50000) as bigint) * 50000 + 50000 as xmax, cast(ceil(ymax / 50000) as bigint) * 50000 + 50000 as ymax from t""",
)
def _(spark, sf):
    return A.snapped_extent(A.layer_extent(P.with_bbox(shapes(spark, sf))), 50_000)


@query(
    "a15_tile_presence_polygons",
    T.with_(T.PARCELS, T.COVER)
    + """, t as (select year, x0, x1, y0, y1,
        unnest(range(cast(ceil((x0 - 50) / 1000) as bigint) - 1, cast(floor((x1 + 50) / 1000) as bigint) + 1)) as tx from cover),
    u as (select *, unnest(range(cast(ceil((y0 - 50) / 1000) as bigint) - 1, cast(floor((y1 + 50) / 1000) as bigint) + 1)) as ty from t)
    select tx, ty, year, 1 as present from u group by tx, ty, year""",
)
def _(spark, sf):
    return A.tile_presence(P.with_bbox(shapes(spark, sf)), 1000, overlap=100, geom="geom")


# --- raster and rotation stack -------------------------------------------------------------------

PIXELS = T.with_(T.PARCELS, T.SIGNED, T.SHAPE_PIXELS)
BURNED = "burned as (select nuts, year, px, py, max(cropfield) as cf, count(*) as layers from shape_pixels group by nuts, year, px, py)"
SUPPORT = "support as (select nuts, year, cf, count(*) as n from burned group by nuts, year, cf)"


@query("r2_rasterise_polygons", PIXELS + "select cropfield as cf, count(*) as n, sum(px) :: bigint as sx, sum(py) :: bigint as sy from shape_pixels group by cropfield")
def _(spark, sf):
    n = F.col("x1") - F.col("x0")
    return R.rasterise(shapes(spark, sf), SCALE).groupBy("cf").agg(
        F.sum(n).alias("n"),
        F.sum((n * (F.col("x0").cast("bigint") + F.col("x1") - 1) / 2).cast("bigint")).alias("sx"),
        F.sum(n.cast("bigint") * F.col("py")).alias("sy"),
    )


@query(
    "r2_rasterise_boxes",
    BASE
    + f"""select cropfield as cf, ({T.px_first('xmax')} - {T.px_first('xmin')}) * ({T.px_first('ymax')} - {T.px_first('ymin')}) as n
    from parcels""",
)
def _(spark, sf):
    return R.rasterise(T.parcels(spark, sf), SCALE, geom=None).groupBy("cf").agg(F.sum(F.col("x1") - F.col("x0")).alias("n"))


@query(
    "w4_burn_order",
    PIXELS.rstrip() + "," + BURNED + "," + SUPPORT + " select nuts, year, cf, n from support",
)
def _(spark, sf):
    return R.pixel_support(R.burn(R.rasterise(shapes(spark, sf), SCALE, merged=True, packed="tiles")))


@query(
    "a5_r3_min_support",
    PIXELS.rstrip() + "," + BURNED + "," + SUPPORT + " select year, count(*) as n, sum(cf) :: bigint as ids from burned join support using (nuts, year, cf) where n >= 10 group by year",
)
def _(spark, sf):
    kept = R.min_support(materialise(R.burn(R.rasterise(shapes(spark, sf), SCALE, merged=True, packed="tiles")), "burned"), 10)
    n = F.col("x1") - F.col("x0")
    return kept.groupBy("year").agg(F.sum(n).alias("n"), F.sum(n * F.col("cf")).alias("ids"))


CF = ", ".join(f"cf{y}" for y in YEARS)
PIVOT = ", ".join(f"coalesce(max(case when year = {y} then cf end), 0) as cf{y}" for y in YEARS)
COMBINED = f"combined as (select nuts, px, py, {PIVOT} from burned group by nuts, px, py)"
STRONG = f"""strong as (select b.* from burned b join support s using (nuts, year, cf) where s.n >= 10),
  overlay as (select nuts, px, py, {PIVOT} from strong group by nuts, px, py)"""
SIZES = f"sizes as (select nuts, {CF}, count(*) as n from overlay group by nuts, {CF})"
ERODED = f"""eroded as (select nuts, {CF}, px + dx as px, py + dy as py from overlay,
  (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy) group by all having count(*) = 9)"""
STACK = f"""stack as (select nuts, {', '.join(f'nullif({c}, 0) as {c}' for c in CF.split(', '))}, count(*) as n_pixels
  from eroded join (select * exclude (n) from sizes where n >= 10) using (nuts, {CF}) group by nuts, {CF}),
  numbered as (select *, n_pixels * 0.25 :: double as area_ha, row_number() over (partition by nuts order by
  {', '.join(f'{c} nulls first' for c in CF.split(', '))}) as cropfield from stack)"""
OVERLAY = PIXELS.rstrip() + ",\n" + ",\n".join([BURNED, SUPPORT, STRONG, SIZES, ERODED, STACK]) + "\n"


def combined(spark, sf, inset: bool = False) -> DataFrame:
    pc = shapes(spark, sf).where(F.col("year").isin(YEARS))
    return R.overlay(R.rasterise(pc, SCALE, merged=True, packed="halo" if inset else "tiles"), YEARS, inset=inset)


@query(
    "r4_j13_combine_years",
    PIXELS.rstrip() + "," + BURNED + "," + COMBINED + f" select nuts, {CF}, count(*) as n from combined group by nuts, {CF}",
)
def _(spark, sf):
    return combined(spark, sf).groupBy("nuts", *CF.split(", ")).agg(F.sum(F.col("x1") - F.col("x0")).alias("n"))


@query(
    "r5_a4_dissolve",
    PIXELS.rstrip() + "," + BURNED + "," + COMBINED + f""" select nuts, {', '.join(f'nullif({c}, 0) as {c}' for c in CF.split(', '))},
    count(*) as n_pixels, count(*) * 0.25 :: double as area_ha from combined group by nuts, {CF}""",
)
def _(spark, sf):
    return S.dissolve(combined(spark, sf), YEARS, SCALE)


@query(
    "r6_g16_erode",
    PIXELS.rstrip() + "," + BURNED + "," + COMBINED + "," + ERODED.replace("overlay", "combined") + f" select nuts, {CF}, count(*) as n from eroded group by nuts, {CF}",
)
def _(spark, sf):
    return combined(spark, sf, inset=True).where("n is null").groupBy("nuts", *CF.split(", ")).agg(F.sum(F.col("x1") - F.col("x0")).alias("n"))


@query("r7_rotation_stack", OVERLAY + f"select nuts, cropfield, {CF}, n_pixels, area_ha from numbered")
def _(spark, sf):
    return S.rotation_stack(shapes(spark, sf), YEARS, SCALE)


def _sequential_sql() -> str:
    """Labels built up year after year on pixels, for any list of years."""
    n = len(YEARS)
    first = ", ".join(
        f"cf{y} as r{i}, case when count(*) over (partition by nuts, cf{y}) >= 10 then cf{y} else 0 end as l{i}" for i, y in enumerate(YEARS)
    )
    steps = [f"s0 as (select nuts, px, py, {first} from combined)"]
    raw = ", ".join(f"r{i}" for i in range(n))
    for k in range(1, n):
        upto = ", ".join(f"l{i}" for i in range(k + 1))
        new = ", ".join(f"case when ok then l{i} else 0 end as l{i}" if i <= k else f"l{i}" for i in range(n))
        steps.append(f"o{k} as (select *, count(*) over (partition by nuts, {upto}) >= 10 as ok from s{k - 1})")
        steps.append(f"s{k} as (select nuts, px, py, {raw}, {new} from o{k})")
    lab = ", ".join(f"l{i}" for i in range(n))
    steps.append(f"e as (select * from s{n - 1} where {' + '.join(f'l{i}' for i in range(n))} > 0)")
    mid = ", ".join(f"cast(round_even(median(r{i}), 0) as bigint) as m{i}" for i in range(n))
    steps.append(f"m as (select nuts, {lab}, {mid} from e group by nuts, {lab})")
    steps.append(
        f"f as (select nuts, {lab}, px + dx as px, py + dy as py from e, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy) "
        "group by all having count(*) = 9)"
    )
    out = ", ".join(f"nullif(m{i}, 0) as cf{y}" for i, y in enumerate(YEARS))
    return ",\n".join(steps) + f" select nuts, {out}, count(*) as n_pixels from f join m using (nuts, {lab}) group by nuts, {', '.join(f'm{i}' for i in range(n))}"


@query(
    "r5_a6_sequential_stack",
    PIXELS.rstrip()
    + ","
    + BURNED
    + ","
    + COMBINED
    + ","
    + _sequential_sql(),
)
def _(spark, sf):
    out = S.rotation_stack(shapes(spark, sf), YEARS, SCALE, sequential=True, numbered=False)
    return out.drop("area_ha")


@query(
    "j8_attach_codes",
    OVERLAY
    + f"select n.nuts, n.cropfield, {CF}, n_pixels, n.area_ha, {', '.join(f'p{y}.original_code as c{y}' for y in YEARS)} from numbered n "
    + " ".join(f"left join parcels p{y} on p{y}.cropfield = cf{y} and p{y}.nuts = n.nuts" for y in YEARS),
)
def _(spark, sf):
    pc = shapes(spark, sf)
    return S.attach_codes(S.rotation_stack(pc, YEARS, SCALE), pc, YEARS)


@query(
    "g8_a4_stack_geometry",
    OVERLAY + f"select nuts, {CF}, n_pixels * 2500 :: double as area_m2, true as valid from stack",
)
def _(spark, sf):
    runs = materialise(S.stack_runs(shapes(spark, sf), YEARS, SCALE), "runs")
    drawn = TR.stack_geometry(runs, ["nuts", *CF.split(", ")], SCALE)
    drawn = drawn.withColumns({c: F.nullif(c, F.lit(0)) for c in CF.split(", ")})
    return drawn.groupBy("nuts", *CF.split(", ")).agg(
        F.sum(G.area(F.col("geom"))).alias("area_m2"), F.bool_and(V.is_valid(F.col("geom"))).alias("valid")
    )


@query(
    "r10_coverage_gaps",
    OVERLAY.rstrip()
    + f""", s as (select nuts, {CF}, avg(px + 0.5) * 50 as cx, avg(py + 0.5) * 50 as cy from eroded
       join (select * exclude (n) from sizes where n >= 10) using (nuts, {CF}) group by nuts, {CF}),
    p as (select nuts, (xmin + xmax) / 2 as cx, (ymin + ymax) / 2 as cy from parcels)
    select distinct nuts, round_even(round_even(cx, 0) / 1000, 0) * 1000 as x, round_even(round_even(cy, 0) / 1000, 0) * 1000 as y from p
    except select nuts, round_even(round_even(round(cx, 6), 0) / 1000, 0) * 1000, round_even(round_even(round(cy, 6), 0) / 1000, 0) * 1000 from s""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    runs = S.stack_runs(T.shaped(pc), YEARS, SCALE)
    centres = S.run_centroids(runs, ["nuts", *CF.split(", ")], SCALE).select("nuts", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))
    points = pc.select("nuts", ((F.col("xmin") + F.col("xmax")) / 2).alias("cx"), ((F.col("ymin") + F.col("ymax")) / 2).alias("cy"))
    return S.coverage_gaps(points, centres, by=["nuts"])


@query(
    "a6_label_median",
    PIXELS.rstrip() + "," + BURNED + ", " + """
    l as (select nuts, year, px // 20 as gx, py // 20 as gy, cf from burned)
    select nuts, year, gx, gy, median(cf) as median from l group by nuts, year, gx, gy""",
)
def _(spark, sf):
    burned = R.burn(R.rasterise(shapes(spark, sf), SCALE, merged=True, packed="tiles"))
    # Parts of runs between the cells' borders stand for their pixels.
    gx = F.explode(F.sequence(F.floor(F.col("x0") / 20), F.floor((F.col("x1") - 1) / 20)))
    parts = burned.withColumn("gx", gx).select(
        "nuts", "year", "gx", F.floor(F.col("py") / 20).alias("gy"), "cf",
        (F.least("x1", (F.col("gx") + 1) * 20) - F.greatest("x0", F.col("gx") * 20)).alias("n"),
    )
    return A.median_by(parts, ["nuts", "year", "gx", "gy"], "cf", weight="n")


# --- geometry quality ----------------------------------------------------------------------------


def damaged(spark, sf) -> DataFrame:
    """Rectangles, most with a fault: open ring, bow-tie, repeated point, spike, traced twice, a
    coordinate that is not a number or infinite; and a few of two parts that overlap."""
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    a, b, c, d = G.point(x0, y0), G.point(x1, y0), G.point(x1, y1), G.point(x0, y1)
    spike = G.point(x1 + 30, y1)
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    fault = F.col("cropfield") % 8
    ring = (
        F.when(fault == 0, F.array(a, b, c, d, a))
        .when(fault == 1, F.array(a, b, c, d))
        .when(fault == 2, F.array(a, c, b, d, a))
        .when(fault == 3, F.array(a, b, b, c, d, a))
        .when(fault == 4, F.array(a, b, c, spike, c, d, a))
        .when(fault == 5, F.array(a, b, c, d, a, b, c, d, a))
        .when(fault == 6, G.box_ring(nan, y0, x1, y1))
        .otherwise(G.box_ring(x0, y0, inf, y1))
    )
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    overlapping = F.array(F.array(G.box_ring(x0, y0, x1, y1)), F.array(G.box_ring(mx, my, mx + F.col("w"), my + F.col("h"))))
    geom = F.when(F.expr(OVERLAPPING), overlapping.cast(GEOM)).otherwise(F.array(F.array(ring)).cast(GEOM))
    return P.hold(T.dealt(T.parcels(spark, sf)), "geom", geom).select("nuts", "year", "cropfield", "geom")


OVERLAPPING = "cropfield % 1024 = 8"
INVALID = f"({OVERLAPPING} or cropfield % 8 not in (0, 3))"
# What the steps end with; the last one takes three cells of 0.4 m from each of six corners.
METHOD = f"case when {OVERLAPPING} then 4 when cropfield % 8 in (0, 3) then 0 when cropfield % 8 = 5 then 3 when cropfield % 8 > 5 then 9 else 1 end"


@query("g9_f3_invalid_rows", BASE + "select nuts, cropfield from parcels where " + INVALID)
def _(spark, sf):
    # every geometry that is no plain convex ring goes by cells, whatever its size
    return Q.invalid_rows(damaged(spark, sf), most_points=0).select("nuts", "cropfield")


@query("q1_invalid_snapshot", BASE + "select year, 0 as method, count(*) as n from parcels where " + INVALID + " group by year")
def _(spark, sf):
    return A.count_by(Q.invalid_snapshot(damaged(spark, sf)), ["year", "method"])


@query(
    "q2_q3_g10_g11_repair",
    BASE
    + f"""select cropfield, {METHOD} as method, case when {OVERLAPPING} then w * h * 1.75 - 2.88
    when cropfield % 8 = 2 then w * h / 2 when cropfield % 8 < 6 then w * h :: double end as area, cropfield % 8 < 6 as valid from parcels""",
)
def _(spark, sf):
    fixed = Q.with_validity(Q.repair_layer(damaged(spark, sf)))
    area = F.when(F.col("method") != 9, F.round(G.area(F.col("geom")), 4))
    return fixed.select("cropfield", "method", area.alias("area"), "valid")


@query(
    "a9_q4_validity_report",
    BASE
    + f"""select nuts, year, count(*) filter (where {INVALID}) as input,
    count(*) filter (where {METHOD} > 1) as makevalid, count(*) filter (where {METHOD} > 3) as buffer0,
    count(*) filter (where {METHOD} = 9) as buffer1 from parcels group by nuts, year""",
)
def _(spark, sf):
    return Q.validity_report(Q.repair_layer(damaged(spark, sf)))


@query(
    "s5_ingest_layer",
    SIGNED
    + """select year, coalesce(reason, '') as reason, count(distinct cropfield) as n, sum(case when reason is null then sign * (x1 - x0) * (y1 - y0) end) as area
    from (select *, case when cropfield % 11 = 0 or cropfield % 13 = 0 then 'no readable geometry' when cropfield % 17 = 0 then 'empty geometry' end as reason
      from signed) group by year, reason
    union all select 0, '', count(*), null from (select distinct cropfield from signed)""",
)
def _(spark, sf):
    # A source layer with missing, cut-off and empty geometries; and one in longitude and latitude.
    wkb = to_wkb("geom")
    pc = shapes(spark, sf).withColumn("wkb", wkb)
    id_ = F.col("cropfield")
    broken = F.when(id_ % 11 == 0, F.lit(None)).when(id_ % 13 == 0, F.substring("wkb", 1, 7)).when(id_ % 17 == 0, F.unhex(F.lit("010600000000000000"))).otherwise(F.col("wkb"))
    source = pc.select(id_.alias("ID"), F.col("original_code").alias("CODE"), F.col("year").alias("YR"), F.lit(1).alias("junk"), broken.alias("wkb_geometry"))
    manifest = spark.createDataFrame(
        [("n1", 1996, "id", "off_id", 1), ("n1", 1996, "code", "original_code", 1), ("n1", 1996, "yr", "source_year", 1), ("n1", 1996, "junk", "junk", 0)],
        "nuts string, year int, column_name string, type string, tokeep int",
    )
    good, bad = L.ingest_layer(source, manifest, "n1", 1996, geometry="wkb_geometry")
    year = F.col("source_year").alias("year")
    lon = ((id_ % 100) / 100).cast("double")
    degrees = pc.select(id_.alias("ID"), F.col("original_code").alias("CODE"), F.col("year").alias("YR"), G.envelope(lon + 5, lon + 45, lon + 5.01, lon + 45.01).cast(GEOM).alias("shape"))
    away, _ = L.ingest_layer(degrees, manifest.where("tokeep = 1"), "n1", 1996, geometry="shape", source_srid=4326)
    near = away.where(G.area(F.col("geom")).between(8e5, 9.5e5))
    return (
        good.select(year, F.lit("").alias("reason"), G.area(F.col("geom")).alias("a"))
        .unionByName(bad.select(year, "reason", F.lit(None).cast("double").alias("a")))
        .groupBy("year", "reason")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("area"))
        .unionByName(near.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).alias("year"), F.lit("").alias("reason"), "n", F.lit(None).cast("double").alias("area")))
    )


@query(
    "s1_s11_layer_job",
    SIGNED
    + """, r as (select distinct nuts, year, cropfield, year = 1995 as present, cropfield % 10 = 0 as broken from signed where nuts <> 'n9'),
    a as (select nuts, year, sum(sign * (x1 - x0) * (y1 - y0)) :: double as area, count(distinct original_code) as codes from signed
      where cropfield % 10 <> 0 group by nuts, year),
    g as (select nuts, year, present, count(*) as n_original, count(*) filter (where not broken) as n_kept from r group by nuts, year, present)
    select nuts || '_' || year as layer, n_original, case when not present and n_kept > 0 then n_kept end as n_final,
      n_original - case when present then 0 else n_kept end as n_missing,
      case when present then 'present' when n_kept = 0 then 'missing' when n_kept = n_original then 'complete' else 'partial' end as status,
      case when not present then area end as area, case when not present and n_kept > 0 then n_kept end as highest, case when not present then codes end as codes
    from g left join a using (nuts, year)""",
)
def _(spark, sf):
    # Source rows with the column names of their region; some geometries are missing, one year is done.
    # They are stored once, as source layers are.
    pc = shapes(spark, sf)
    odd = F.expr("cast(substring(nuts, 2) as int) % 2 = 1")
    attrs = F.when(odd, F.create_map(F.lit("FID"), F.col("cropfield").cast("string"), F.lit("Kultur"), F.col("original_code"))).otherwise(
        F.create_map(F.lit("ID_PARCEL"), F.col("cropfield").cast("string"), F.lit("CODE"), F.col("original_code"))
    )
    wkb = F.when(F.col("cropfield") % 10 != 0, F.col("wkb"))
    sources = pc.withColumn("wkb", to_wkb("geom")).select("nuts", "year", attrs.alias("attrs"), wkb.alias("wkb"))
    sources = materialise(sources, "source-layers")
    layers = materialise(sources.select("nuts", "year", odd.alias("odd")).distinct(), "source-list", counted=True)
    names = F.when(F.col("odd"), F.array(*[F.struct(F.lit(a).alias("column_name"), F.lit(b).alias("type")) for a, b in (("fid", "off_id"), ("kultur", "original_code"))]))
    names = names.otherwise(F.array(*[F.struct(F.lit(a).alias("column_name"), F.lit(b).alias("type")) for a, b in (("id_parcel", "off_id"), ("code", "original_code"))]))
    manifest = layers.select("nuts", "year", F.inline(names)).withColumn("tokeep", F.lit(1))
    out = layer_job(sources, layers.where("nuts <> 'n9'"), manifest, shared_path(spark, "layer-job"), layers.where("year = 1995"))
    sums = out.layers.groupBy("nuts", "year").agg(
        F.sum(G.area(from_wkb("geometry"))).alias("area"), F.max("cropfield").alias("highest"), F.count_distinct("original_code").alias("codes")
    )
    sums = sums.select(C.layer_name(F.col("nuts"), F.col("year")).alias("layer"), "area", "highest", "codes")
    return out.report.drop("ratio").join(sums, "layer", "left")


@query(
    "p4_kept_numbers",
    BASE
    + """, a as (select nuts, year, cropfield, row_number() over (partition by nuts, year order by lpad(cropfield :: varchar, 12, '0')) as n from parcels where cropfield % 10 < 7),
    t as (select nuts, year, count(*) as top from a group by nuts, year),
    b as (select p.nuts, p.year, p.cropfield, coalesce(top, 0) + row_number() over (partition by p.nuts, p.year order by lpad(p.cropfield :: varchar, 12, '0')) as n
      from parcels p left join t using (nuts, year) where p.cropfield % 10 >= 7)
    select nuts, year, cropfield as off_id, n as number from a where cropfield % 10 > 1 union all select nuts, year, cropfield, n from b""",
)
def _(spark, sf):
    # A second run lacks some of the first one's rows and has others; rows of both keep their numbers.
    pc = T.parcels(spark, sf).select("nuts", "year", F.lpad(F.col("cropfield").cast("string"), 12, "0").alias("off_id"), "original_code", "cropfield")
    path = shared_path(spark, "keys")
    out = None
    for part in ("cropfield % 10 < 7", "cropfield % 10 > 1"):
        out = LG.keep_numbers(pc.where(part).drop("cropfield"), path, ["off_id", "original_code"], name="number")
    return out.select("nuts", "year", F.col("off_id").cast("long").alias("off_id"), "number")


@query(
    "s7_changed_layers",
    BASE
    + """select distinct nuts, year from parcels where (nuts = 'n3' and year = 1996) or year = 2001
    union select nuts, year from parcels where nuts = 'n5' and year = 1997 group by nuts, year having count(*) filter (where cropfield % 2 = 0) between 1 and count(*) - 1""",
)
def _(spark, sf):
    # One layer has another code, one lacks rows, one year is new; the order of rows does not count.
    pc = T.parcels(spark, sf).select("nuts", "year", "cropfield", "original_code", "xmin", "w")
    n3, n5 = F.expr("nuts = 'n3' and year = 1996"), F.expr("nuts = 'n5' and year = 1997")
    now = pc.where(~n5 | (F.col("cropfield") % 2 == 1)).withColumn("original_code", F.when(n3, F.concat("original_code", F.lit("x"))).otherwise(F.col("original_code")))
    done = LG.layer_digests(pc.where("year <> 2001").orderBy(F.desc("cropfield")))
    return I.layers_changed(LG.layer_digests(now), done).select("nuts", "year")


@query(
    "s8_export_layers",
    SIGNED + "select nuts, year, count(distinct cropfield) as n, sum(sign * (x1 - x0) * (y1 - y0)) as area from signed group by nuts, year",
)
def _(spark, sf):
    path = shared_path(spark, "export")
    pc = shapes(spark, sf).withColumn("area_ha", P.area_ha(G.area(F.col("geom"))))
    sinks.export_layers(pc, path)
    back = spark.read.parquet(path)
    return back.groupBy("nuts", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(G.area(from_wkb("geometry"))).alias("area")
    )


@query(
    "s8_f6_window_of_export",
    T.with_(T.PARCELS, T.COVER) + "select distinct p.nuts, p.year, p.cropfield from cover c join parcels p using (cropfield) where c.x1 >= 2645000 and c.x0 <= 2650010 and c.y1 >= 1562000 and c.y0 <= 1566020",
)
def _(spark, sf):
    path = shared_path(spark, "export")
    sinks.export_layers(shapes(spark, sf), path)
    return L.read_window(spark, path, 2645000, 1562000, 2650010, 1566020).select("nuts", F.col("year").cast("int").alias("year"), "cropfield")


@query(
    "s8_geoparquet_files",
    SIGNED + "select nuts, year, count(distinct cropfield) as n, sum(sign * (x1 - x0) * (y1 - y0)) as area from signed group by nuts, year",
)
def _(spark, sf):
    path = shared_path(spark, "geoparquet")
    sinks.export_geoparquet(shapes(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("nuts", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(G.area(from_wkb("geometry"))).alias("area")
    )


@query("g18_srid_of_export", BASE + "select nuts, year, 3035 as srid, count(*) as n, min(xmin) :: double as xmin, max(ymax) :: double as ymax from parcels group by nuts, year")
def _(spark, sf):
    # The coordinate system as the exported files themselves describe it.
    path = shared_path(spark, "geoparquet")
    sinks.export_geoparquet(shapes(spark, sf), path)
    part = [F.regexp_extract("path", p, 1) for p in ("nuts=([^/]+)/", "year=([0-9]+)/")]
    return GP.footers(spark, path).groupBy(part[0].alias("nuts"), part[1].cast("int").alias("year"), "srid").agg(
        F.sum("n_rows").alias("n"), F.min(F.get("bbox", F.lit(0))).alias("xmin"), F.max(F.get("bbox", F.lit(3))).alias("ymax")
    )


# --- names ---------------------------------------------------------------------------------------


def part_hierarchy(spark, sf) -> DataFrame:
    names = T.table(spark, sf, "part").select(C.spaces_to_underscores(F.col("p_name")).alias("hcat4_name")).distinct()
    return N.number_rows(names, "pos", ["hcat4_name"], unique=True).withColumn("hcat4_code", 3310000000 + F.col("pos"))


def query_names(spark, sf) -> DataFrame:
    return T.table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" ", F.lower("p_type"), F.col("p_name")).alias("translated_name")
    )


BEST_MATCH = """with cand as (select replace(n, '_', ' ') as text, n as name, row_number() over (order by n) as pos from (select distinct replace(p_name, ' ', '_') as n from part)),
    q as (select distinct lower(p_type) || ' ' || p_name as t from part),
    s as (select t, pos, name, 1 - levenshtein(t, text) / greatest(length(t), length(text)) as score from q, cand),
    b as (select t, name as hcat4_name_auto, 3310000000 + pos as hcat4_code_auto from s qualify row_number() over (partition by t order by score desc, pos) = 1)
    select p_partkey, hcat4_name_auto, hcat4_code_auto from part join b on t = lower(p_type) || ' ' || p_name"""


@query("m1_j10_w3_best_match", BEST_MATCH)
def _(spark, sf):
    out = M.match_crop_names(query_names(spark, sf), materialise(part_hierarchy(spark, sf), "names"), method="levenshtein")
    return out.select("p_partkey", "hcat4_name_auto", "hcat4_code_auto")


@query("j10_best_match_by_index", BEST_MATCH)
def _(spark, sf):
    out = M.match_crop_names(query_names(spark, sf), materialise(part_hierarchy(spark, sf), "names"), method="levenshtein", index_from=0)
    return out.select("p_partkey", "hcat4_name_auto", "hcat4_code_auto")


@query("m1_best_match_weighted")
def _(spark, sf):
    out = M.match_crop_names(query_names(spark, sf), materialise(part_hierarchy(spark, sf), "names"))
    return out.select("p_partkey", "hcat4_name_auto", "hcat4_code_auto")


@query(
    "a13_m2_match_accuracy",
    """select 'n' || cast(p_partkey % 25 as varchar) as nuts,
    round(avg(case when p_size % 3 = 1 then 1 else 0 end) * 100, 4) as accuracy from part group by 1""",
)
def _(spark, sf):
    size = F.col("p_size") % 3
    rows = T.table(spark, sf, "part").select(
        F.concat(F.lit("n"), (F.col("p_partkey") % 25).cast("string")).alias("nuts"),
        F.col("p_name").alias("hcat4_name"),
        F.when(size == 1, F.col("p_name")).when(size == 2, F.lit("other")).alias("hcat4_name_auto"),
    )
    return M.match_accuracy(rows).withColumn("accuracy", F.round("accuracy", 4))


@query(
    "a12_m4_f10_error_rates",
    """with t as (select 'n' || cast(o_custkey % 25 as varchar) as nuts, case o_orderkey % 7 when 0 then null when 5 then 0 when 6 then 0 else 1 end as flag,
      case when o_orderkey % 5 in (1, 2, 3) then o_orderkey % 5 end as kind, nullif(o_orderkey % 6, 0) as cause from orders),
    r as (select nuts, avg(case when flag = 1 then 1.0 when flag is not null then 0 end) * 100 as correct,
      avg(case when kind = 1 then 1.0 when kind is not null then 0 end) * 100 as one_engine_wrong,
      avg(case when kind in (2, 3) then 1.0 when kind is not null then 0 end) * 100 as odd,
      avg(case when cause = 1 then 1.0 when cause is not null then 0 end) as s1, avg(case when cause = 2 then 1.0 when cause is not null then 0 end) as s2,
      avg(case when cause = 3 then 1.0 when cause is not null then 0 end) as s3, avg(case when cause = 4 then 1.0 when cause is not null then 0 end) as s4,
      avg(case when cause = 5 then 1.0 when cause is not null then 0 end) as s5 from t group by nuts)
    select nuts, round(correct, 4) as correct, round(one_engine_wrong, 4) as one_engine_wrong, round(odd, 4) as odd,
      round(s1 * odd, 4) as niche_or_homonym, round(s2 * odd, 4) as colloquial_or_regional, round(s3 * odd, 4) as spelling_error,
      round(s4 * odd, 4) as abbreviation, round(s5 * odd, 4) as separable_prefix from r""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    rows = T.table(spark, sf, "orders").select(
        F.concat(F.lit("n"), (F.col("o_custkey") % 25).cast("string")).alias("nuts"),
        F.when(key % 7 == 0, F.lit(None)).otherwise((key % 7 < 5).cast("int")).alias("translation_flag"),
        F.when((key % 5).between(1, 3), key % 5).alias("type_error"),
        F.nullif(key % 6, F.lit(0)).alias("cause"),
    )
    out = M.error_rates(rows)
    return out.select("nuts", *[F.round(c, 4).alias(c) for c in out.columns if c != "nuts"])


@query(
    "m3_c12_agreement",
    """with t as (select l_returnflag as a, case when l_linenumber % 2 = 0 then l_returnflag else l_linestatus end as b,
      case when l_quantity < 5 then null else l_returnflag end as c from lineitem)
    select case when a = b and b = c then 1 else 0 end as translation_flag, count(*) as n from t group by 1""",
)
def _(spark, sf):
    a = F.col("l_returnflag")
    b = F.when(F.col("l_linenumber") % 2 == 0, a).otherwise(F.col("l_linestatus"))
    c = F.when(F.col("l_quantity") >= 5, a)
    flag = C.agree3(a, b, c).alias("translation_flag")
    return T.table(spark, sf, "lineitem").groupBy(flag).agg(F.count(F.lit(1)).alias("n"))
