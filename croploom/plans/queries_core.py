"""Registered queries: sources, columns, filters, joins, statistics, sets, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.functions import scalars as C
from croploom.functions.wkb import to_wkb
from croploom.operators import columns as P
from croploom.operators import filters as FL
from croploom.operators import joins as J
from croploom.operators import numbering as N
from croploom.operators import sets as U
from croploom.operators import stats as A
from croploom.plans import trial as T
from croploom.plans.registry import query
from croploom.session import shared_path, stored
from croploom.sources import layers as L
from croploom.sources import sinks
from croploom.sources.catalog import layer_catalog
from croploom.streaming import incremental as I

BASE = T.with_(T.PARCELS)
MAPPED = T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED)


def mapped(spark, sf) -> DataFrame:
    pc = T.parcels(spark, sf)
    codes = stored(pc.select("nuts", "original_code").distinct(), "parcel-codes")
    return J.map_crops(pc, T.crop_map(codes), T.usage_map(codes))


def file_names(pc: DataFrame) -> DataFrame:
    one = pc.select("nuts", F.col("year").cast("string").alias("kind"))
    both = one.unionByName(pc.select("nuts", F.lit("stack").alias("kind")))
    return both.distinct().select(F.concat_ws("_", "nuts", "kind").alias("stem")).select(
        F.concat("stem", F.lit(".parquet")).alias("name")
    )


FILE_NAMES = """names as (
  select distinct nuts || '_' || cast(year as varchar) || '.parquet' as name from parcels
  union all select distinct nuts || '_stack.parquet' from parcels)"""


# --- sources and sinks ---------------------------------------------------------------------------


@query(
    "s1_layer_catalog",
    T.with_(T.PARCELS, FILE_NAMES)
    + """select name from names
    where split_part(name, '_', 1) in ('n1', 'n2', 'n3', 'n7')
      and split_part(split_part(name, '.', 1), '_', 2) in ('1996', '1997', '1998', 'stack')""",
)
def _(spark, sf):
    return layer_catalog(file_names(T.parcels(spark, sf)), ["n1", "n2", "n3", "n7"], [1996, 1997, 1998], True)


@query(
    "s2_layer_scan",
    T.with_(T.PARCELS, T.SIGNED)
    + """select nuts, year, count(distinct cropfield) as n, count(distinct cropfield) filter (where cropfield % 2 = 0) as off_ids,
      sum(sign * (x1 - x0) * (y1 - y0)) :: double as area from signed group by nuts, year""",
)
def _(spark, sf):
    # Written with the layer naming of the data set, one folder per layer, and scanned back.
    root = shared_path(spark, "layers")
    pc = T.shaped(T.parcels(spark, sf)).withColumn("geometry", to_wkb("geom"))
    off_id = F.when(F.col("cropfield") % 2 == 0, F.col("cropfield").cast("string"))
    name = F.concat("nuts", F.lit("_"), "year", F.lit(".parquet"))
    pc.select("cropfield", "original_code", off_id.alias("off_id"), "geometry", name.alias("layer")).write.partitionBy("layer").parquet(root)
    return (
        L.read_layers(spark, f"{root}/*")
        .groupBy("nuts", "year")
        .agg(F.count(F.lit(1)).alias("n"), F.count("off_id").alias("off_ids"), F.sum(G.area(F.col("geom"))).alias("area"))
    )


@query(
    "s2_unreadable_geometry",
    BASE
    + """select nuts, year, count(*) as n, count(*) filter (where cropfield % 10 = 1) as n_missing, count(*) filter (where cropfield % 10 in (0, 2)) as n_unreadable,
      count(*) filter (where cropfield % 10 > 2) as n_kept, sum(cropfield) filter (where cropfield % 10 in (0, 2)) :: bigint as unreadable_ids
    from parcels group by nuts, year""",
)
def _(spark, sf):
    # Some geometries are missing, some are cut off and some are text; they are counted, left out and told.
    root = shared_path(spark, "layers")
    pc = T.shaped(T.parcels(spark, sf)).withColumn("geometry", to_wkb("geom"))
    digit = F.col("cropfield") % 10
    wkb = F.when(digit == 0, F.substring("geometry", 1, 20)).when(digit == 2, F.encode(F.lit("MULTIPOLYGON EMPTY"), "utf-8")).when(digit > 2, F.col("geometry"))
    name = F.concat("nuts", F.lit("_"), "year", F.lit(".parquet"))
    pc.select("cropfield", "original_code", wkb.alias("geometry"), name.alias("layer")).write.partitionBy("layer").parquet(root)
    kept = L.read_layers(spark, f"{root}/*", unreadable="drop").groupBy("nuts", "year").agg(F.count("geom").alias("n_kept"))
    told = L.unreadable_rows(spark, f"{root}/*").where("reason = 'unreadable geometry'")
    told = told.groupBy("nuts", "year").agg(F.sum("cropfield").alias("unreadable_ids"))
    out = L.geometry_counts(spark, f"{root}/*").drop("n_empty").join(kept, ["nuts", "year"], "left").join(told, ["nuts", "year"], "left")
    return out.withColumn("n_kept", F.coalesce("n_kept", F.lit(0)))


@query(
    "s4_mapping_scan",
    T.with_(T.PARCELS, T.CROP_MAP) + "select nuts, original_code, hcat4_code from crop_map",
)
def _(spark, sf):
    # A code table written as CSV with untidy column names and read back.
    path = shared_path(spark, "mapping")
    rough = T.crop_map(T.parcels(spark, sf)).toDF(" NUTS ", "Original_Code", "HCAT4_code ")
    rough.write.option("header", True).csv(path)
    out = L.read_mapping(spark, path)
    return out.select("nuts", "original_code", F.col("hcat4_code").cast("bigint"))


@query(
    "s6_reconcile",
    BASE
    + """, src as (select nuts || '_' || cast(year as varchar) as layer, count(*) as n_original from parcels group by 1),
    dst as (select nuts || '_' || cast(year as varchar) as layer, count(*) as n_final from parcels
            where not (w = 100 and kind = 3) and nuts <> 'n4' group by 1)
    select layer, n_original, n_final, n_final / n_original as ratio, n_original - coalesce(n_final, 0) as n_missing,
           case when n_final is null then 'missing' when n_final = n_original then 'complete' else 'partial' end as status
    from src full join dst using (layer)""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf).withColumn("layer", C.layer_name(F.col("nuts"), F.col("year")))
    loaded = pc.where(~((F.col("w") == 100) & (F.col("kind") == 3)) & (F.col("nuts") != "n4"))
    return A.reconcile(pc, loaded, "layer")


@query(
    "s6_present_layers",
    BASE
    + """, s as (select nuts || '_' || cast(year as varchar) as layer, year, count(*) as n_original, count(*) filter (where w > 100 or year > 1996) as n_good from parcels group by nuts, year)
    select layer, n_original, case when n_good > 0 then n_good end as n_final, case when n_good > 0 then n_good / n_original end as ratio, n_original - n_good as n_missing,
      case when year < 1998 then case when n_good in (0, n_original) then 'present' else 'present partial' end when n_good = n_original then 'complete' when n_good = 0 then 'missing' else 'partial' end as status
    from s""",
)
def _(spark, sf):
    # Layers of the first years are there from an earlier run, some of them in part.
    pc = T.parcels(spark, sf).withColumn("layer", C.layer_name(F.col("nuts"), F.col("year")))
    good = pc.where("w > 100 or year > 1996")
    there = pc.where("year < 1998").select("layer").distinct().join(good.groupBy("layer").agg(F.count(F.lit(1)).alias("n_present")), "layer", "left")
    return A.reconcile(pc, good.where("year >= 1998"), "layer", there)


@query(
    "s7_layers_to_do",
    BASE
    + """select distinct nuts || '_' || cast(year as varchar) as layer from parcels
    where year >= 1998 and nuts not like 'n2%'""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    layer = C.layer_name(F.col("nuts"), F.col("year")).alias("layer")
    everything = pc.select(layer).distinct()
    done = pc.where("year < 1998").select(layer).distinct()
    empty = pc.where(F.col("nuts").like("n2%")).select(layer).distinct()
    return I.layers_to_do(everything, done, empty)


@query(
    "s7_stream_stats",
    "select cast(year(o_orderdate) as integer) as year, o_orderstatus, count(*) as n, sum(o_orderkey) :: bigint as ids from orders group by 1, 2",
)
def _(spark, sf):
    schema = T.table(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    root = shared_path(spark, "stream")

    def sums(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids")
        )

    I.stream_sums(stream, sums, f"{root}/out", f"{root}/state").awaitTermination()
    return (
        spark.read.parquet(f"{root}/out")
        .groupBy("year", "o_orderstatus")
        .agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))
    )


@query(
    "s7_ingest_new",
    T.with_(T.PARCELS, T.SIGNED)
    + """select nuts, year, count(distinct cropfield) as n, sum(sign * (x1 - x0) * (y1 - y0)) :: double as area from signed where year <> 1999 group by nuts, year""",
)
def _(spark, sf):
    # Layers arrive in two lots; each run takes in what is new, and a third run finds nothing.
    root = shared_path(spark, "arriving")
    pc = T.shaped(T.parcels(spark, sf)).withColumn("geometry", to_wkb("geom"))
    files = pc.select("year", "cropfield", "original_code", "geometry", F.concat("nuts", F.lit("_"), "year", F.lit(".parquet")).alias("layer"))
    for lot in ("year < 1998", "year in (1998, 2000, 2001)", "year < 1900"):
        files.where(lot).drop("year").write.mode("append").partitionBy("layer").parquet(f"{root}/in")
        stream = I.layer_stream(spark, f"{root}/in").withColumn("area", G.area(F.col("geom"))).drop("geom")
        I.ingest_new(stream, f"{root}/out", f"{root}/state").awaitTermination()
    back = spark.read.parquet(f"{root}/out")
    return back.groupBy("nuts", F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))


@query(
    "s9_table_sink",
    BASE + "select nuts, count(*) as n, sum(cropfield) :: bigint as ids from parcels group by nuts",
)
def _(spark, sf):
    # A database in the shared folder, so that no session's own warehouse is needed.
    path = shared_path(spark, "tables")
    base = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {base} location '{path}'")
    pc = T.parcels(spark, sf).select(F.col("nuts").alias(" NUTS"), "cropfield")
    sinks.write_table(pc.where("cropfield % 2 = 0"), f"{base}.parcels", "replace")
    sinks.write_table(pc.where("cropfield % 2 = 1"), f"{base}.parcels", "append")
    return spark.table(f"{base}.parcels").groupBy("nuts").agg(F.count(F.lit(1)).alias("n"), F.sum("cropfield").alias("ids"))


@query(
    "s10_stats_by_year",
    MAPPED
    + """select nuts, year, hcat4_code, usage_code, round(sum(cast(area_ha as double)), 4) as area_ha
    from mapped group by nuts, year, hcat4_code, usage_code""",
)
def _(spark, sf):
    # Early years first, then all later ones; the second write leaves the first one's years alone.
    stats = A.area_stats(mapped(spark, sf))
    path = shared_path(spark, "stats")
    sinks.write_by_year(stats.where("year < 1998"), path)
    sinks.write_by_year(stats.where("year >= 1998"), path)
    return spark.read.schema(stats.schema).parquet(path).select(
        "nuts", "year", "hcat4_code", "usage_code", F.round("area_ha", 4).alias("area_ha")
    )


@query(
    "s11_report",
    BASE + "select nuts, cast(count(*) as varchar) as n from parcels group by nuts",
)
def _(spark, sf):
    path = sinks.write_report(A.count_by(T.parcels(spark, sf), ["nuts"]), shared_path(spark, "report"), "counts.csv")
    return spark.read.option("header", True).csv(path)


# --- columns -------------------------------------------------------------------------------------


@query(
    "p1_p2_harmonised_columns",
    BASE + "select cropfield, original_code, w as off_area from parcels",
)
def _(spark, sf):
    source = T.parcels(spark, sf).select(
        F.col("cropfield").alias("PARC_ID"), F.col("original_code").alias("Crop"), F.col("w").alias("Width"), "h"
    )
    manifest = spark.createDataFrame(
        [("N1", 1996, "parc_id", "cropfield", 1), ("N1", 1996, "crop", "original_code", 1),
         ("N1", 1996, "width", "off_area", 1), ("N1", 1996, "h", "height", 0)],
        L.T.StructType.fromDDL("nuts string, year int, column_name string, type string, tokeep int"),
    )
    kept = P.select_by_manifest(source, manifest, "n1", 1996)
    return P.harmonise_columns(kept, dict(P.manifest_columns(manifest, "n1", 1996)))


@query(
    "p3_layer_names",
    BASE
    + """select distinct lower(nuts) || '_' || cast(year as varchar) as name, upper(nuts) as region from parcels""",
)
def _(spark, sf):
    names = T.parcels(spark, sf).select(C.layer_name(F.col("nuts"), F.col("year")).alias("name")).distinct()
    return names.select("name", C.layer_region(F.col("name")).alias("region"))


@query(
    "p4_cropfield_serial",
    BASE
    + """select nuts, year, w, h, xmin, ymin, cropfield as source_id,
    row_number() over (partition by nuts, year order by w desc, cropfield) as cropfield from parcels""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf).select("nuts", "year", "w", "h", "xmin", "ymin", F.col("cropfield").alias("source_id"))
    return P.with_cropfield(pc, [F.col("w").desc(), "source_id"])


@query(
    "p5_area_ha",
    BASE
    + """select cropfield, cast(round_even(w * h / 8 + 0.5, 0) / 10000 as float) as yearly,
    cast((w * h / 8 + 0.5) / 10000 as float) as stack from parcels""",
)
def _(spark, sf):
    m2 = F.col("w") * F.col("h") / 8 + 0.5
    return T.parcels(spark, sf).select("cropfield", P.area_ha(m2).alias("yearly"), P.area_ha(m2, False).alias("stack"))


@query(
    "p6_literal_columns",
    BASE
    + """select cropfield, 'n1' as nuts, 1996 as year, cast(null as integer) as cf1995, cast(null as integer) as cf1997
    from parcels""",
)
def _(spark, sf):
    one = P.lit_layer(T.parcels(spark, sf).select("cropfield"), "n1", 1996)
    return P.with_missing_years(one, [1995, 1997])


@query(
    "p7_zero_to_null",
    BASE + "select cropfield, cast(nullif(cropfield % 3, 0) as integer) as cf1996 from parcels",
)
def _(spark, sf):
    return P.zero_to_null(T.parcels(spark, sf).select("cropfield", (F.col("cropfield") % 3).alias("cf1996")), ["cf1996"])


@query("p8_available_columns", BASE + "select cropfield, original_code, area_ha from parcels")
def _(spark, sf):
    return P.select_available(T.parcels(spark, sf), ["cropfield", "original_code", "off_id", "off_area", "area_ha", "geom"])


@query(
    "p10_region_from_path",
    BASE + """select nuts, cast(year as integer) as year, count(*) as n from parcels group by all
    union all select nuts, null, count(*) from (select distinct nuts from parcels) group by all""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    yearly = pc.select(F.concat(F.lit("/store/"), "nuts", F.lit("_"), "year", F.lit(".parquet/part-0")).alias("path"))
    stacks = pc.select("nuts").distinct().select(F.concat(F.lit("/store/"), "nuts", F.lit("_stack.parquet")).alias("path"))
    paths = yearly.unionByName(stacks)
    return paths.groupBy(L.path_region(F.col("path")).alias("nuts"), L.path_year(F.col("path")).alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("p11_drop_raw_columns", BASE + "select nuts, year, cropfield, original_code, area_ha from parcels")
def _(spark, sf):
    return T.parcels(spark, sf).drop("xmin", "ymin", "xmax", "ymax", "w", "h", "kind")


# --- filters -------------------------------------------------------------------------------------

BRANCH_VALUES = ", ".join(f"({c}, '{n}')" for c, n in FL.BRANCHES.items())


@query(
    "f1_branch_filter",
    MAPPED
    + f""", b(branch, name) as (values {BRANCH_VALUES}),
    f as (select branch, name, power(10, length(regexp_extract(cast(branch as varchar), '0*$'))) as factor from b)
    select cast(branch as bigint) as branch, count(*) as n, sum(cropfield) :: bigint as ids from mapped, f
    where floor(hcat4_code / factor) = branch / factor group by branch""",
)
def _(spark, sf):
    return (
        mapped(spark, sf)
        .withColumn("branch", F.explode(FL.branches_of(F.col("hcat4_code"))))
        .groupBy("branch")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cropfield").alias("ids"))
    )


@query(
    "f2_id_range",
    BASE + """select nuts, year, count(*) as n from parcels
    where cropfield between (select min(cropfield) + (max(cropfield) - min(cropfield)) // 4 from parcels)
      and (select max(cropfield) - (max(cropfield) - min(cropfield)) // 4 from parcels) group by nuts, year""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    low, high = pc.agg(F.min("cropfield"), F.max("cropfield")).first()
    quarter = (high - low) // 4
    return A.count_by(FL.id_range(pc, low + quarter, high - quarter))


@query("f5_min_area", BASE + "select nuts, cropfield, area_ha from parcels where area_ha >= 4.0")
def _(spark, sf):
    return FL.min_area(T.parcels(spark, sf), 4.0).select("nuts", "cropfield", "area_ha")


@query(
    "f7_layers_like",
    BASE
    + """, c as (select distinct nuts || '_' || cast(year as varchar) as table_name, kind from parcels)
    select distinct table_name from c where table_name like '%\\_199_' escape '\\' and kind = 3""",
)
def _(spark, sf):
    catalog = T.parcels(spark, sf).select(
        C.layer_name(F.col("nuts"), F.col("year")).alias("table_name"),
        F.when(F.col("kind") == 3, "original_code").otherwise("other").alias("column_name"),
    )
    return FL.layers_like(catalog, "%\\_199_", "original_code")


@query(
    "f8_exists_by",
    BASE + "select nuts, year, bool_or(w = 600 and h = 400 and original_code like '1%') as found from parcels group by nuts, year",
)
def _(spark, sf):
    cond = (F.col("w") == 600) & (F.col("h") == 400) & F.col("original_code").startswith("1")
    return FL.exists_by(T.parcels(spark, sf), ["nuts", "year"], cond)


@query(
    "f9_m5_blank_to_null",
    """select doc_id, case when trim(left_part) <> '' then left_part end as name from (
      select doc_id, case when doc_id % 5 = 0 then '   ' when doc_id % 7 = 0 then null else lang || ' ' || source end as left_part from documents)""",
)
def _(spark, sf):
    raw = F.when(F.col("doc_id") % 5 == 0, "   ").when(F.col("doc_id") % 7 != 0, F.concat_ws(" ", "lang", "source"))
    return T.table(spark, sf, "documents").select("doc_id", C.blank_to_null(raw).alias("name"))


# --- joins ---------------------------------------------------------------------------------------


@query(
    "j1_j3_map_crops",
    MAPPED + "select nuts, year, cropfield, original_code, hcat4_code, usage_code, area_ha from mapped",
)
def _(spark, sf):
    return mapped(spark, sf).select("nuts", "year", "cropfield", "original_code", "hcat4_code", "usage_code", "area_ha")


@query(
    "j1_map_crops_large_table",
    MAPPED + "select nuts, year, cropfield, original_code, hcat4_code from mapped",
)
def _(spark, sf):
    # The way taken by code tables too large to broadcast: salted shuffle.
    pc = T.parcels(spark, sf)
    return J.map_crops(pc, T.crop_map(pc), max_rows=0).select("nuts", "year", "cropfield", "original_code", "hcat4_code")


def wildcard_codes(pc: DataFrame) -> DataFrame:
    key = F.col("cropfield")
    code = (
        F.when(key % 11 == 0, F.concat(F.substring("original_code", 1, 1), F.lit("_")))
        .when(key % 13 == 0, F.concat(F.lit("%"), F.substring("original_code", 2, 1)))
        .otherwise(F.col("original_code"))
    )
    return pc.withColumn("original_code", code)


@query(
    "j2_pattern_join",
    T.with_(T.PARCELS, T.CROP_MAP)
    + """select p.nuts, p.cropfield, m.original_code, m.hcat4_code from (
      select nuts, cropfield, case when cropfield % 11 = 0 then substr(original_code, 1, 1) || '_'
             when cropfield % 13 = 0 then '%' || substr(original_code, 2, 1) else original_code end as original_code from parcels) p
    left join crop_map m on m.nuts = p.nuts and m.original_code like p.original_code""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    return J.map_crops(wildcard_codes(pc), T.crop_map(pc), pattern=True).select(
        "nuts", "cropfield", "original_code", "hcat4_code"
    )


@query(
    "j7_lookup",
    T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED)
    + """, dim as (select hcat4_code, original_code from crop_map)
    select m.cropfield, m.hcat4_code, d.original_code as first_code from mapped m
    left join (select hcat4_code, min(original_code) as original_code from dim group by hcat4_code) d using (hcat4_code)""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    m = J.map_crops(pc, T.crop_map(pc)).select("cropfield", "hcat4_code")
    dim = T.crop_map(pc).select("hcat4_code", F.col("original_code").alias("first_code"))
    return J.lookup(m, dim, "hcat4_code", "first_code")


@query(
    "j9_regions_with_layer",
    BASE
    + """select 'N' || cast(n_nationkey as varchar) as nuts_id, n_name from nation
    where 'N' || cast(n_nationkey as varchar) in (select upper(nuts) from parcels where year = 1996)""",
)
def _(spark, sf):
    admin = T.table(spark, sf, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("nuts_id"), "n_name")
    catalog = T.parcels(spark, sf).select(C.layer_name(F.col("nuts"), F.col("year")).alias("table_name"))
    return J.regions_with_layer(admin, catalog, 1996)


@query(
    "j11_name_to_code",
    T.with_(T.PARCELS, T.CROP_MAP, T.HIERARCHY)
    + """select p_partkey, h.hcat4_code from (
      select p_partkey, 'crop_' || cast(3310000000 + 100000 * (p_partkey % 9) + 1000 + p_partkey % 3 as varchar) as hcat4_name from part) p
    left join hierarchy h using (hcat4_name)""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    key = F.col("p_partkey")
    name = F.concat(F.lit("crop_"), (3310000000 + 100000 * (key % 9) + 1000 + key % 3).cast("string"))
    names = T.table(spark, sf, "part").select("p_partkey", name.alias("hcat4_name"))
    return J.lookup(names, T.hierarchy(T.crop_map(pc)), "hcat4_name", "hcat4_code").select("p_partkey", "hcat4_code")


@query(
    "j12_tiles_to_do",
    BASE
    + """, t as (select cast(floor(xmin / 5000) as bigint) as tx, cast(floor(ymin / 5000) as bigint) as ty, year, w from parcels)
    select distinct tx, ty from t except (select tx, ty from t where year = 1995 and w = 600)""",
)
def _(spark, sf):
    tiles = A.with_tile(T.parcels(spark, sf), 5000)
    done = tiles.where("year = 1995 and w = 600").select("tx", "ty").distinct()
    return J.todo(tiles.select("tx", "ty").distinct(), done)


CHAIN = """agri as (
  select hcat4_code, 'A' || cast(hcat4_code % 7 as varchar) as agriprod_code, '=' as link from hierarchy where hcat4_code % 5 <> 4
  union all select hcat4_code, 'A' || cast(hcat4_code % 3 as varchar), '<' from hierarchy where hcat4_code % 2 = 0),
  fadn as (
  select distinct agriprod_code, 'F' || cast(substr(agriprod_code, 2) :: int // 2 as varchar) as fadn_code from agri where agriprod_code <> 'A6'
  union all select distinct agriprod_code, 'F9' from agri where agriprod_code in ('A0', 'A1')),
  lucas as (
  select distinct agriprod_code, '=' as link, 'L' || substr(agriprod_code, 2) as lucas_lc_code from agri where agriprod_code <> 'A5'
  union all select distinct agriprod_code, '>', 'L0' from agri)"""


def chain_tables(pc: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Derived code tables with repeated codes and links: to agricultural products, and from these on."""
    h = T.hierarchy(T.crop_map(pc)).select("hcat4_code")
    code = lambda k: F.concat(F.lit("A"), (F.col("hcat4_code") % k).cast("string")).alias("agriprod_code")
    agri = h.where("hcat4_code % 5 <> 4").select("hcat4_code", code(7), F.lit("=").alias("link")).unionByName(
        h.where("hcat4_code % 2 = 0").select("hcat4_code", code(3), F.lit("<").alias("link"))
    )
    codes = agri.select("agriprod_code").distinct()
    number = F.expr("cast(substring(agriprod_code, 2) as int)")
    fadn = codes.where("agriprod_code <> 'A6'").select("agriprod_code", F.concat(F.lit("F"), F.floor(number / 2).cast("string")).alias("fadn_code"))
    fadn = fadn.unionByName(codes.where("agriprod_code in ('A0', 'A1')").select("agriprod_code", F.lit("F9").alias("fadn_code")))
    lucas = codes.where("agriprod_code <> 'A5'").select(
        "agriprod_code", F.lit("=").alias("link"), F.concat(F.lit("L"), F.expr("substring(agriprod_code, 2)")).alias("lucas_lc_code")
    )
    return agri, fadn, lucas.unionByName(codes.select("agriprod_code", F.lit(">").alias("link"), F.lit("L0").alias("lucas_lc_code")))


@query(
    "j14_crosswalk_chain",
    T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED, T.HIERARCHY, CHAIN)
    + """, m as (select hcat4_code, count(*) as parcels from mapped where hcat4_code is not null group by 1),
    a as (select * from m join agri using (hcat4_code)),
    f as (select 'fadn' as step, fadn_code as code, parcels, hcat4_code from a join fadn using (agriprod_code)),
    l as (select 'lucas' as step, lucas_lc_code as code, parcels, hcat4_code from a join lucas using (agriprod_code) where lucas.link = '='),
    u as (select 'no product' as step, cast(hcat4_code as varchar) as code, 0 :: bigint as parcels, hcat4_code from m where hcat4_code not in (select hcat4_code from agri)
      union all select distinct 'no fadn', agriprod_code, 0 :: bigint, null :: bigint from a where agriprod_code not in (select agriprod_code from fadn)
      union all select distinct 'no lucas', agriprod_code, 0 :: bigint, null :: bigint from a where agriprod_code not in (select agriprod_code from lucas where link = '='))
    select step, code, count(*) as links, sum(parcels) :: bigint as parcels, count(distinct hcat4_code) as crops
    from (select * from f union all select * from l union all select * from u) group by step, code""",
)
def _(spark, sf):
    # Crop codes through agricultural products to two further systems; every step fans out.
    pc = T.parcels(spark, sf)
    agri, fadn, lucas = chain_tables(pc)
    lucas = lucas.where("link = '='").drop("link")
    m = mapped(spark, sf).where("hcat4_code is not null").groupBy("hcat4_code").agg(F.count(F.lit(1)).alias("parcels"))
    a = J.crosswalk(m, agri.drop("link"), "hcat4_code")
    nothing = [F.lit(0).cast("bigint").alias("parcels"), F.lit(None).cast("bigint").alias("hcat4_code")]
    f = J.crosswalk(a, fadn, "agriprod_code").select(F.lit("fadn").alias("step"), F.col("fadn_code").alias("code"), "parcels", "hcat4_code")
    lu = J.crosswalk(a, lucas, "agriprod_code").select(F.lit("lucas").alias("step"), F.col("lucas_lc_code").alias("code"), "parcels", "hcat4_code")
    none = J.uncovered(m, agri, "hcat4_code").select(
        F.lit("no product").alias("step"), F.col("hcat4_code").cast("string").alias("code"), nothing[0], "hcat4_code"
    )
    gaps = [
        J.uncovered(a, t, "agriprod_code").select(F.lit(f"no {n}").alias("step"), F.col("agriprod_code").alias("code"), *nothing)
        for n, t in (("fadn", fadn), ("lucas", lucas))
    ]
    return U.union_layers([f, lu, none, *gaps]).groupBy("step", "code").agg(
        F.count(F.lit(1)).alias("links"), F.sum("parcels").alias("parcels"), F.count_distinct("hcat4_code").alias("crops")
    )


CROSSWALK = """cross_map as (
  select hcat4_code, target, link from (
    select hcat4_code, 'T' || cast(hcat4_code % 1000000 // 100000 as varchar) as target, '=' as link from hierarchy where hcat4_code % 10 <> 8
    union all select hcat4_code, 'U' || cast(hcat4_code % 10 as varchar), '<' from hierarchy where hcat4_code % 10 <> 8
    union all select hcat4_code, 'V', '?' from hierarchy where hcat4_code % 10 <> 8))"""


def crosswalk_table(pc: DataFrame) -> DataFrame:
    h = T.hierarchy(T.crop_map(pc)).where("seasonality_code <> 8").select("hcat4_code")
    code = F.col("hcat4_code")
    return h.select(
        code,
        F.inline(
            F.array(
                F.struct(F.concat(F.lit("T"), F.expr("hcat4_code % 1000000 div 100000").cast("string")).alias("target"), F.lit("=").alias("link")),
                F.struct(F.concat(F.lit("U"), (code % 10).cast("string")).alias("target"), F.lit("<").alias("link")),
                F.struct(F.lit("V").alias("target"), F.lit("?").alias("link")),
            )
        ),
    )


@query(
    "j14_crosswalk",
    T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED, T.HIERARCHY, CROSSWALK)
    + """select target, link, count(*) as n, round(sum(cast(area_ha as double)), 4) as area_ha
    from mapped join cross_map using (hcat4_code) where link in ('=', '<') group by target, link""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    m = J.map_crops(pc, T.crop_map(pc))
    return (
        J.crosswalk(m, crosswalk_table(pc), "hcat4_code", ["=", "<"])
        .groupBy("target", "link")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("area_ha").cast("double")), 4).alias("area_ha"))
    )


@query(
    "j14_uncovered_codes",
    T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED, T.HIERARCHY, CROSSWALK)
    + """select distinct hcat4_code from mapped where hcat4_code is not null
    and hcat4_code not in (select hcat4_code from cross_map)""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    return J.uncovered(J.map_crops(pc, T.crop_map(pc)), crosswalk_table(pc), "hcat4_code")


# --- statistics ----------------------------------------------------------------------------------

A1_SQL = (
    MAPPED
    + """select nuts, year, hcat4_code, usage_code, round(sum(cast(area_ha as double)), 4) as area_ha
    from mapped group by nuts, year, hcat4_code, usage_code"""
)


@query("a1_area_stats", A1_SQL)
def _(spark, sf):
    return A.area_stats(mapped(spark, sf)).withColumn("area_ha", F.round("area_ha", 4))


@query(
    "a1_named_stats",
    T.with_(T.PARCELS, T.CROP_MAP, T.USAGE_MAP, T.MAPPED, T.HIERARCHY)
    + """select nuts, year, hcat4_code, usage_code, round(sum(cast(area_ha as double)), 4) as area_ha,
      max(hcat4_name) as hcat4_name, max('use_' || cast(usage_code as varchar)) as usage_name
    from mapped left join hierarchy using (hcat4_code) group by nuts, year, hcat4_code, usage_code""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    usage = T.usage_map(pc).select("usage_code").distinct()
    usage = usage.withColumn("usage_name", F.concat(F.lit("use_"), F.col("usage_code").cast("string")))
    stats = A.area_stats(mapped(spark, sf)).withColumn("area_ha", F.round("area_ha", 4))
    return A.named_stats(stats, T.hierarchy(T.crop_map(pc)), usage)


@query("a8_row_counts", BASE + "select nuts, year, count(*) as n from parcels group by nuts, year")
def _(spark, sf):
    return A.count_by(T.parcels(spark, sf))


@query(
    "a14_id_bounds",
    BASE + "select nuts, year, min(cropfield) as lowest, max(cropfield) as highest from parcels group by nuts, year",
)
def _(spark, sf):
    return A.id_bounds(T.parcels(spark, sf))


@query(
    "a6_median_by_group",
    """select l_suppkey, median(l_partkey * 100000 + l_orderkey) as median from lineitem group by l_suppkey""",
)
def _(spark, sf):
    items = T.table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_partkey") * 100000 + F.col("l_orderkey")).alias("v"))
    return A.median_by(items, ["l_suppkey"], "v")


@query(
    "a15_tile_presence",
    BASE
    + """, t as (select year, xmin, xmax, ymin, ymax,
        unnest(range(cast(ceil((xmin - 50) / 10000) as bigint) - 1, cast(floor((xmax + 50) / 10000) as bigint) + 1)) as tx from parcels),
    u as (select *, unnest(range(cast(ceil((ymin - 50) / 10000) as bigint) - 1, cast(floor((ymax + 50) / 10000) as bigint) + 1)) as ty from t)
    select tx, ty, year, 1 as present from u group by tx, ty, year""",
)
def _(spark, sf):
    return A.tile_presence(T.parcels(spark, sf), 10_000, overlap=100)


@query(
    "c16_ids_as_text",
    BASE
    + """, r as (select nuts, year, cropfield, (row_number() over (partition by nuts, year order by cropfield) - 1) // 40 as part from parcels)
    select nuts, year, cast(part as integer) as part, string_agg(cast(cropfield as varchar), ' ' order by cropfield) as ids
    from r group by nuts, year, part""",
)
def _(spark, sf):
    return A.join_ids(T.parcels(spark, sf), ["nuts", "year"], per_row=40)


@query(
    "r1_tiles",
    BASE
    + """select cast(floor(xmin / 50000) as bigint) as tx, cast(floor(ymin / 50000) as bigint) as ty, count(*) as n
    from parcels group by 1, 2""",
)
def _(spark, sf):
    return A.with_tile(T.parcels(spark, sf), 50_000).groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("n"))


# --- order, first rows, sets ---------------------------------------------------------------------


@query("l1_sorted_names", T.with_(T.PARCELS, FILE_NAMES) + "select distinct name from names")
def _(spark, sf):
    return U.sorted_names(file_names(T.parcels(spark, sf)))


@query("l2_schema_probe", BASE + "select * from parcels order by cropfield desc limit 25")
def _(spark, sf):
    # The first rows in an order, appended to a frame that has only the columns.
    pc = T.parcels(spark, sf)
    return U.union_layers([U.empty_like(pc), U.head_rows(pc.orderBy(F.desc("cropfield")), 25)])


@query(
    "l3_top1",
    BASE
    + """select nuts, year, cropfield, w, h from (
      select *, row_number() over (partition by nuts, year order by w * h desc, cropfield desc) as r from parcels) where r = 1""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf).select("nuts", "year", "cropfield", "w", "h")
    return U.top1(pc, ["nuts", "year"], [F.col("w") * F.col("h"), F.col("cropfield")], desc=True)


@query("l4_first_by", BASE + "select nuts, min(original_code) as original_code from parcels group by nuts")
def _(spark, sf):
    return U.first_by(T.parcels(spark, sf), ["nuts"], "original_code")


@query(
    "u1_union_layers",
    BASE + "select nuts, year, cropfield, case when kind = 0 then w end as off_area from parcels",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    base = ["nuts", "year", "cropfield"]
    return U.union_layers([pc.where("kind = 0").select(*base, F.col("w").alias("off_area")), pc.where("kind <> 0").select(*base)])


@query("u2_union_distinct", BASE + "select distinct nuts, original_code, w, h from parcels")
def _(spark, sf):
    pc = T.parcels(spark, sf).select("nuts", "original_code", "w", "h")
    return U.union_distinct([pc.where("w < 400"), pc.where("w >= 200")])


@query(
    "u3_concatenate_counts",
    BASE + """select 'year' as kind, cast(year as varchar) as name, count(*) as n from parcels group by year
    union all select 'region', nuts, count(*) from parcels group by nuts""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    one = A.count_by(pc, ["year"]).select(F.lit("year").alias("kind"), F.col("year").cast("string").alias("name"), "n")
    two = A.count_by(pc, ["nuts"]).select(F.lit("region").alias("kind"), F.col("nuts").alias("name"), "n")
    return U.union_layers([one, two])


@query(
    "u5_set_difference",
    BASE + "select nuts, original_code from parcels where year = 1996 except select nuts, original_code from parcels where year = 1999 and w > 300",
)
def _(spark, sf):
    pc = T.parcels(spark, sf)
    return U.set_difference(
        pc.where("year = 1996").select("nuts", "original_code"),
        pc.where("year = 1999 and w > 300").select("nuts", "original_code"),
    )


@query("u6_in_list", BASE + "select year, count(*) as n from parcels where original_code in ('1F', '2O', '5P') group by year")
def _(spark, sf):
    pc = T.parcels(spark, sf).where(FL.in_list(F.col("original_code"), ["1F", "2O", "5P"]))
    return A.count_by(pc, ["year"])


@query(
    "w1_dense_label",
    BASE
    + """, v as (select nuts, original_code, w, count(*) as n from parcels group by all having count(*) >= 10)
    select nuts, original_code, w, n, row_number() over (order by nuts, original_code, w) as label from v""",
)
def _(spark, sf):
    return N.dense_label(T.parcels(spark, sf), ["nuts", "original_code", "w"], min_rows=10)


@query(
    "w1_j6_relabel",
    BASE
    + """, v as (select nuts, original_code, w, row_number() over (order by nuts, original_code, w) as label from (
      select nuts, original_code, w from parcels group by all having count(*) >= 10))
    select p.cropfield, coalesce(label, 0) as label from parcels p left join v using (nuts, original_code, w)""",
)
def _(spark, sf):
    pc = T.parcels(spark, sf).select("cropfield", "nuts", "original_code", "w")
    return N.relabel(pc, ["nuts", "original_code", "w"], min_rows=10).select("cropfield", "label")


# --- scalar functions ----------------------------------------------------------------------------


@query(
    "c1_c8_text_functions",
    """select p_partkey, upper(p_name) as up, lower(p_brand) as low, split_part(p_name, ' ', 1) as first_word,
      replace(p_name, ' ', '_') as joined, replace(replace(p_name, ' ', '_'), '_', ' ') as apart,
      length(regexp_extract(cast(p_partkey * 100 as varchar), '0*$')) as zeros,
      p_name like 'r%' as is_r, regexp_replace(p_brand || '.parquet', '\\.parquet$', '') as stem,
      trim(regexp_replace(lower(p_brand), '[^\\p{L}\\p{N}]', ' ', 'g')) as norm, 'f.csv' as base
    from part""",
)
def _(spark, sf):
    name, brand = F.col("p_name"), F.col("p_brand")
    return T.table(spark, sf, "part").select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower(brand).alias("low"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        C.spaces_to_underscores(name).alias("joined"),
        C.underscores_to_spaces(C.spaces_to_underscores(name)).alias("apart"),
        C.trailing_zeros(F.col("p_partkey") * 100).cast("bigint").alias("zeros"),
        name.like("r%").alias("is_r"),
        C.without_suffix(F.concat(brand, F.lit(".parquet")), ".parquet").alias("stem"),
        C.norm_text(brand).alias("norm"),
        C.base_name(F.concat(F.lit("/a/"), brand, F.lit("/f.csv"))).alias("base"),
    )


@query(
    "c9_c15_number_functions",
    """select o_orderkey, round_even(o_orderkey / 2.0, 0) as half_even, floor(o_totalprice / 7) :: bigint as fl,
      ceil(o_totalprice / 7) :: bigint as ce, trunc(o_totalprice / -7) :: bigint as fix, sqrt(o_custkey * 2) as root,
      power(10, o_custkey % 4) as pow10, least(255, cast(round_even(o_totalprice / 1000, 0) as integer)) as capped,
      nullif(o_custkey % 5, 0) as nonzero, strftime(o_orderdate, '%Y%m%d%H%M') as stamp,
      greatest(o_custkey % 2, o_orderkey % 3) as top,
      case when o_orderkey % 2 = o_custkey % 2 and o_custkey % 2 = nullif(o_orderkey % 3, 2) then 1 else 0 end as agree
    from orders""",
)
def _(spark, sf):
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return T.table(spark, sf, "orders").select(
        "o_orderkey",
        C.round_half_even(key / 2).alias("half_even"),
        F.floor(price / 7).alias("fl"),
        F.ceil(price / 7).alias("ce"),
        (price / -7).cast("bigint").alias("fix"),
        F.sqrt(cust * 2).alias("root"),
        F.pow(F.lit(10), cust % 4).alias("pow10"),
        F.least(F.lit(255), F.rint(price / 1000).cast("int")).alias("capped"),
        F.nullif(cust % 5, F.lit(0)).alias("nonzero"),
        C.stamp(F.col("o_orderdate")).alias("stamp"),
        F.greatest(cust % 2, key % 3).alias("top"),
        C.agree3(key % 2, cust % 2, F.nullif(key % 3, F.lit(2))).alias("agree"),
    )
