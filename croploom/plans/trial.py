"""Parcel layers and code tables derived from the order tables, in Spark and as check SQL.

Every order is a parcel: customers sit on a 970 m raster, the orders of one customer overlap over
the years.  ``kind`` gives the parcel's shape: rectangle, L, rectangle with a hole, two parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.operators.columns import area_ha, hold
from croploom.schema import GEOM


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def parcels_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return (
        orders.join(c, "o_custkey")
        .select(
            F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("nuts"),
            F.year("o_orderdate").alias("year"),
            (key + 1).alias("cropfield"),
            F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")).alias("original_code"),
            (2640000 + (cust % 40) * 970 + (key % 5) * 20).alias("xmin"),
            (1560000 + F.floor(cust / 40) * 970 + (key % 7) * 20).alias("ymin"),
            (100 + (key % 6) * 100).alias("w"),
            (100 + (key % 4) * 100).alias("h"),
            (key % 4).cast("int").alias("kind"),
        )
        .withColumns({"xmax": F.col("xmin") + F.col("w"), "ymax": F.col("ymin") + F.col("h")})
        .withColumn("area_ha", area_ha(F.col("w") * F.col("h")))
    )


def parcels(spark: SparkSession, sf: str) -> DataFrame:
    return parcels_from(table(spark, sf, "orders"), table(spark, sf, "customer"))


PARCELS = """parcels as (
  select 'n' || cast(c_nationkey as varchar) as nuts, cast(year(o_orderdate) as integer) as year,
         o_orderkey + 1 as cropfield, substr(o_orderpriority, 1, 1) || o_orderstatus as original_code,
         2640000 + (o_custkey % 40) * 970 + (o_orderkey % 5) * 20 as xmin,
         1560000 + (o_custkey // 40) * 970 + (o_orderkey % 7) * 20 as ymin,
         100 + (o_orderkey % 6) * 100 as w, 100 + (o_orderkey % 4) * 100 as h,
         2640000 + (o_custkey % 40) * 970 + (o_orderkey % 5) * 20 + 100 + (o_orderkey % 6) * 100 as xmax,
         1560000 + (o_custkey // 40) * 970 + (o_orderkey % 7) * 20 + 100 + (o_orderkey % 4) * 100 as ymax,
         cast(o_orderkey % 4 as integer) as kind,
         cast(round_even((100 + (o_orderkey % 6) * 100) * (100 + (o_orderkey % 4) * 100), 0) / 10000 as float) as area_ha
  from orders join customer on o_custkey = c_custkey)"""


def shape(x0: Column, y0: Column, x1: Column, y1: Column, kind: Column) -> Column:
    """The parcel's geometry from its limits and kind."""
    xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
    xq, yq, xr, yr = x0 + (x1 - x0) / 4, y0 + (y1 - y0) / 4, x1 - (x1 - x0) / 4, y1 - (y1 - y0) / 4
    ell = F.array(*[G.point(a, b) for a, b in ((x0, y0), (x1, y0), (x1, ym), (xm, ym), (xm, y1), (x0, y1), (x0, y0))])
    return (
        F.when(kind == 0, G.envelope(x0, y0, x1, y1))
        .when(kind == 1, F.array(F.array(ell)))
        .when(kind == 2, F.array(F.array(G.box_ring(x0, y0, x1, y1), F.reverse(G.box_ring(xq, yq, xr, yr)))))
        .otherwise(F.array(F.array(G.box_ring(x0, y0, xq, y1)), F.array(G.box_ring(xr, y0, x1, y1))))
        .cast(GEOM)
    )


def dealt(pc: DataFrame) -> DataFrame:
    """The derived parcels over all tasks: a table of one file would be one task's geometry work."""
    return pc.repartition(int(pc.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cropfield")


def shaped(pc: DataFrame) -> DataFrame:
    """Parcels with their polygon instead of the limits, and the polygon's area."""
    g = shape(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax", "kind")])
    return hold(dealt(pc), "geom", g).drop("xmin", "ymin", "xmax", "ymax", "w", "h", "area_ha")


# Signed rectangles whose sum is the polygon, and rectangles that together cover it.
SIGNED = """signed as (
  select nuts, year, cropfield, original_code, kind, 1 as sign, xmin as x0, ymin as y0, xmax as x1, ymax as y1
    from parcels where kind in (0, 1, 2)
  union all select nuts, year, cropfield, original_code, kind, -1, xmin + w / 2, ymin + h / 2, xmax, ymax from parcels where kind = 1
  union all select nuts, year, cropfield, original_code, kind, -1, xmin + w / 4, ymin + h / 4, xmax - w / 4, ymax - h / 4 from parcels where kind = 2
  union all select nuts, year, cropfield, original_code, kind, 1, xmin, ymin, xmin + w / 4, ymax from parcels where kind = 3
  union all select nuts, year, cropfield, original_code, kind, 1, xmax - w / 4, ymin, xmax, ymax from parcels where kind = 3)"""
COVER = """cover as (
  select nuts, year, cropfield, original_code, xmin as x0, ymin as y0, xmax as x1, ymax as y1 from parcels where kind in (0, 2)
  union all select nuts, year, cropfield, original_code, xmin, ymin, xmax, ymin + h / 2 from parcels where kind = 1
  union all select nuts, year, cropfield, original_code, xmin, ymin, xmin + w / 2, ymax from parcels where kind = 1
  union all select nuts, year, cropfield, original_code, xmin, ymin, xmin + w / 4, ymax from parcels where kind = 3
  union all select nuts, year, cropfield, original_code, xmax - w / 4, ymin, xmax, ymax from parcels where kind = 3)"""
CELLS = """cells as (
  select i * 1000 + j as grd_id, 2640000 + i * 10000 as cx0, 1560000 + j * 10000 as cy0,
         2640000 + i * 10000 + 10000 as cx1, 1560000 + j * 10000 + 10000 as cy1
  from range(0, 317) a(i), range(0, 375) b(j)
  where 2640000 + i * 10000 <= (select max(xmax) from parcels) and 1560000 + j * 10000 <= (select max(ymax) from parcels))"""


def crop_map(pc: DataFrame) -> DataFrame:
    """Region and original code to crop code; one code of one region stays unmapped."""
    first, letter = F.substring("original_code", 1, 1), F.substring("original_code", 2, 1)
    grass = F.substring("nuts", 2, 2).cast("int") % 5 == 4
    return (
        pc.select("nuts", "original_code")
        .distinct()
        .where(~((F.col("nuts") == "n7") & (first == "5")))
        .withColumn(
            "hcat4_code",
            F.when(grass, F.lit(3320000000)).otherwise(F.lit(3310000000))
            + 100000 * first.cast("int")
            + 1000
            + F.when(letter == "F", 1).when(letter == "O", 2).otherwise(8),
        )
    )


CROP_MAP = """crop_map as (
  select nuts, original_code,
         cast(case when cast(substr(nuts, 2, 2) as int) % 5 = 4 then 3320000000 else 3310000000 end
         + 100000 * cast(substr(original_code, 1, 1) as int) + 1000
         + case substr(original_code, 2, 1) when 'F' then 1 when 'O' then 2 else 8 end as bigint) as hcat4_code
  from (select distinct nuts, original_code from parcels)
  where not (nuts = 'n7' and substr(original_code, 1, 1) = '5'))"""


def usage_map(pc: DataFrame) -> DataFrame:
    return (
        pc.where(F.col("nuts") != "n3")
        .select("nuts", "original_code")
        .distinct()
        .withColumn("usage_code", (F.substring("original_code", 1, 1).cast("int") % 3 + 1).cast("smallint"))
    )


USAGE_MAP = """usage_map as (
  select distinct nuts, original_code, cast(cast(substr(original_code, 1, 1) as int) % 3 + 1 as smallint) as usage_code
  from parcels where nuts <> 'n3')"""


def hierarchy(crops: DataFrame) -> DataFrame:
    return (
        crops.select("hcat4_code")
        .distinct()
        .withColumn("hcat4_name", F.concat(F.lit("crop_"), F.col("hcat4_code").cast("string")))
        .withColumn("seasonality_code", (F.col("hcat4_code") % 10).cast("int"))
    )


HIERARCHY = """hierarchy as (
  select distinct hcat4_code, 'crop_' || cast(hcat4_code as varchar) as hcat4_name,
         cast(hcat4_code % 10 as integer) as seasonality_code from crop_map)"""

MAPPED = """mapped as (
  select p.nuts, p.year, p.cropfield, m.original_code, m.hcat4_code, u.usage_code, p.area_ha,
         p.xmin, p.ymin, p.xmax, p.ymax, p.kind
  from parcels p
  left join crop_map m on m.nuts = p.nuts and m.original_code = p.original_code
  left join usage_map u on u.nuts = p.nuts and u.original_code = p.original_code)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# Pixel numbers at 50 m, by the centre rule.
PIXEL_SCALE = 50


def px_first(expr: str) -> str:
    return f"cast(ceil(({expr} - 25) / 50.0) as bigint)"


SHAPE_PIXELS = f"""shape_pixels as (
  select nuts, year, cropfield, px, py from (
    select nuts, year, cropfield, sign, px, unnest(range({px_first('y0')}, {px_first('y1')})) as py from (
      select *, unnest(range({px_first('x0')}, {px_first('x1')})) as px from signed))
  group by nuts, year, cropfield, px, py having sum(sign) > 0)"""
