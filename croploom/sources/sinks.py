"""Writing layers, tables and reports."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.functions.wkb import from_wkb, to_wkb
from croploom.operators.columns import select_available
from croploom.schema import LAYER_SRID
from croploom.sources.geoparquet import ROW_GROUP, write_geoparquet

# The columns of a published yearly layer.
YEARLY_COLUMNS = ("nuts", "year", "cropfield", "original_code", "off_id", "off_area", "area_ha", "geom")

# The column description of the GeoParquet 1.1 metadata.
GEO_METADATA = {
    "version": "1.1.0",
    "primary_column": "geometry",
    "columns": {
        "geometry": {
            "encoding": "WKB",
            "geometry_types": ["MultiPolygon"],
            "crs": {"id": {"authority": "EPSG", "code": LAYER_SRID}},
            "covering": {"bbox": {k: ["bbox", k] for k in ("xmin", "ymin", "xmax", "ymax")}},
        }
    },
}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def _spread(c: Column) -> Column:
    """The lower 31 bits of a number with a gap after each."""
    x = c.bitwiseAND(F.lit(0x7FFFFFFF))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve_key(x: Column, y: Column) -> Column:
    """Place of a point on a Z-shaped curve over whole metres; null first, far values at the ends."""

    def whole(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c, F.lit(0.0)), F.lit(float(0x7FFFFFFF)))).cast("bigint")

    return _spread(whole(x)).bitwiseOR(F.shiftleft(_spread(whole(y)), 1))


ENCODED = ("bbox", "geometry")


def encoded(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The geometry's limits ``bbox`` and its WKB ``geometry``, as files have them, beside it."""
    return df.withColumn("bbox", G.bbox(F.col(geom))).withColumn("geometry", to_wkb(geom))


def _prepared(df: DataFrame, stack: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """What is exported, the same as WKB with limits and in the order of the files, and the folders' columns."""
    if "geom" in df.columns:
        kept = df if stack else select_available(df, YEARLY_COLUMNS)
        out = encoded(kept).drop("geom")
    else:
        out = df if stack else select_available(df, (*YEARLY_COLUMNS, *ENCODED))
        kept = out.withColumn("geom", from_wkb("geometry"))
    parts = [c for c in (("nuts",) if stack else ("nuts", "year")) if c in out.columns]
    # A range of the curve for each task: few files for each layer, several tasks for a large one, and
    # neighbours in the same row group, whose limits a reader compares first.
    key = curve_key((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2)
    out = out.withColumn("_key", key)
    return kept, out.repartitionByRange(*parts, "_key").sortWithinPartitions(*parts, "_key").drop("_key"), parts


def _has_geometry(df: DataFrame) -> bool:
    return "geom" in df.columns or set(ENCODED) <= set(df.columns)


def _types(kept: DataFrame, parts: list[str]) -> DataFrame:
    return kept.groupBy(*parts, G.geom_type(F.col("geom")).alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))


def export_layers(df: DataFrame, path: str, stack: bool = False, mode: str = "overwrite") -> DataFrame | None:
    """Layers as zstd parquet with WKB ``geometry`` and its limits ``bbox``, one folder per region (and year).

    Yearly layers keep their standard columns, stacks all of them.  Rows follow a curve through the plane,
    so that a reader of a window skips row groups.  The coordinate system is described in
    ``_geo_metadata.json`` beside the data; ``export_geoparquet`` has it in the files.  A frame without
    geometry is skipped and gives None; otherwise the count per geometry type is returned.  One that is
    ``encoded`` already, without ``geom``, is written as it is.
    """
    if not _has_geometry(df):
        return None
    kept, out, parts = _prepared(df, stack)
    # Only the folders of the layers at hand are replaced, whatever the session's setting is.
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*parts).parquet(path)
    write_text(df.sparkSession, f"{path.rstrip('/')}/_geo_metadata.json", json.dumps(GEO_METADATA))
    return _types(kept, parts)


def export_geoparquet(df: DataFrame, path: str, stack: bool = False, mode: str = "overwrite", row_group: int = ROW_GROUP) -> DataFrame | None:
    """As ``export_layers``, with the description of the geometry in each file's footer."""
    if not _has_geometry(df):
        return None
    kept, out, parts = _prepared(df, stack)
    write_geoparquet(out, path, GEO_METADATA, tuple(parts), mode, row_group)
    return _types(kept, parts)


MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, name: str, mode: str = "replace", partition_by: tuple[str, ...] = ()) -> None:
    """A catalog table, column names stripped and in lower case; mode replace, append or fail.

    A replacement is loaded aside and renamed into place, and the old table goes only after that.  A
    write that fails leaves the old rows as they were.
    """
    spark = df.sparkSession
    clean = df.toDF(*[c.strip().lower() for c in df.columns])
    if mode != "replace" or not spark.catalog.tableExists(name):
        clean.write.mode(MODES[mode]).partitionBy(*partition_by).saveAsTable(name)
        return
    mark = uuid.uuid4().hex[:12]
    aside, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        clean.write.partitionBy(*partition_by).saveAsTable(aside)
    except Exception:
        spark.sql(f"drop table if exists {aside}")
        raise
    spark.sql(f"alter table {name} rename to {old}")
    try:
        spark.sql(f"alter table {aside} rename to {name}")
    except Exception:
        spark.sql(f"alter table {old} rename to {name}")
        raise
    spark.sql(f"drop table {old}")


def replace_layers(df: DataFrame, path: str, layers: DataFrame) -> None:
    """Rows of some layers (nuts, year), one folder each; those of ``layers`` without rows are emptied.

    Writing the same again changes nothing.  The list of layers, not their rows, is looked at here.
    Rows are dealt by layer first, a large layer's over several tasks: few files for each layer, not one from every task.
    """
    spark = df.sparkSession
    dealt = df.withColumn("_task", F.spark_partition_id()).repartitionByRange("nuts", "year", "_task").drop("_task")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("nuts", "year").parquet(path)
    have = df.select("nuts", "year").distinct()
    jvm = spark.sparkContext._jvm
    for r in layers.select("nuts", "year").distinct().join(have, ["nuts", "year"], "left_anti").collect():
        target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/nuts={r.nuts}/year={r.year}")
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(target):
            fs.delete(target, True)


def write_by_year(stats: DataFrame, path: str) -> None:
    """Statistics by year: the years present are replaced, other years stay."""
    (
        stats.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def write_report(df: DataFrame, folder: str, name: str, ts: datetime | None = None, stamp: str = "%Y%m%d%H%M") -> str:
    """A small aggregated report as one CSV file in a folder stamped with the minute, or by ``stamp``."""
    path = f"{folder.rstrip('/')}/{(ts or datetime.now()).strftime(stamp)}/{name}"
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return path
