"""Reading layers and taking in source layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.functions.crs import geom_to_3035
from croploom.functions.wkb import from_wkb
from croploom.operators.columns import clean_names, hold, manifest_columns, select_by_manifest
from croploom.operators.filters import drop_empty, in_envelope
from croploom.operators.quality import repair_layer
from croploom.schema import LAYER_FILE
from croploom.session import materialise

# A layer is one file or one folder of files named <region>_<year>.parquet.
# (Spark writes such a folder as <column>=<region>_<year>.parquet.)
_LAYER_PATH = r"/(?:[^/=]+=)?([^/_=]+)_([0-9]{4}|stack)\.parquet"


def path_region(path: Column) -> Column:
    return F.regexp_extract(path, _LAYER_PATH, 1)


def path_year(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, _LAYER_PATH, 2), F.lit("stack")).cast("int")


def _scan(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw, path = spark.read.schema(schema).parquet(*paths), F.col("_metadata.file_path")
    return raw.select(path_region(path).alias("nuts"), path_year(path).alias("year"), "*", path.alias("_file"))


def read_layers(
    spark: SparkSession, paths: str | Iterable[str], schema: T.StructType = LAYER_FILE, unreadable: str = "null"
) -> DataFrame:
    """Yearly layers as one frame with ``nuts``, ``year`` from the file names and decoded ``geom``.

    Columns a layer does not have are null.  Only ``geometry`` costs decoding; a job that does not
    use ``geom`` does not read it.  A geometry that is no WKB is null; with ``unreadable="fail"`` it ends
    the job that uses it, naming the file, and with ``"drop"`` rows without a geometry are left out.
    ``unreadable_rows`` has what is left out, ``geometry_counts`` how much there is.
    """
    if unreadable not in ("null", "drop", "fail"):
        raise ValueError("unreadable is null, drop or fail")
    raw = _scan(spark, paths, schema)
    kept = [c for c in raw.columns if c not in ("geometry", "_file")]
    if unreadable == "null":
        return raw.select(*kept, from_wkb("geometry").alias("geom"))
    held = hold(raw, "geom", from_wkb("geometry"))
    if unreadable == "drop":
        return held.where(F.col("geom").isNotNull()).select(*kept, "geom")
    refused = F.raise_error(F.concat(F.lit("unreadable geometry in "), F.col("_file")))
    bad = F.col("geom").isNull() & F.col("geometry").isNotNull()
    return held.select(*kept, F.when(bad, refused).otherwise(F.col("geom")).alias("geom"))


def unreadable_rows(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType = LAYER_FILE) -> DataFrame:
    """Rows of layers without a readable geometry, as they are in the files, with ``file`` and ``reason``."""
    held = hold(_scan(spark, paths, schema), "geom", from_wkb("geometry")).where(F.col("geom").isNull())
    reason = F.when(F.col("geometry").isNull(), "no geometry").otherwise("unreadable geometry")
    return held.withColumnRenamed("_file", "file").withColumn("reason", reason).drop("geom")


def geometry_counts(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType = LAYER_FILE) -> DataFrame:
    """Rows of each layer, and those with no, an unreadable and an empty geometry; sums only are moved."""
    held = hold(_scan(spark, paths, schema), "geom", from_wkb("geometry"))
    unread = F.col("geom").isNull() & F.col("geometry").isNotNull()
    return held.groupBy("nuts", "year").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("geometry").isNull()).alias("n_missing"),
        F.count_if(unread).alias("n_unreadable"),
        F.count_if(F.size("geom") == 0).alias("n_empty"),
    )


def read_window(spark: SparkSession, path: str, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Exported parcels that meet a closed rectangle, with decoded ``geom``.

    The limits that the export has written are compared in the scan, which skips row groups by them.
    """
    near = in_envelope(spark.read.parquet(path), x0, y0, x1, y1, geom=None).drop("bbox")
    decoded = hold(near.withColumnRenamed("geometry", "_wkb"), "geom", from_wkb("_wkb")).drop("_wkb")
    return in_envelope(decoded, x0, y0, x1, y1)


def read_mapping(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A code table from CSV, column names stripped and in lower case.

    With a schema, columns are matched by header name whatever their order and case.
    """
    raw = clean_names(spark.read.option("header", True).option("multiLine", True).csv(path))
    if schema is None:
        return raw
    lower = {f.name.lower(): f for f in schema.fields}
    absent = set(lower) - set(raw.columns)
    if absent:
        raise ValueError(f"{path} lacks columns {sorted(absent)}")
    return raw.select(*[_typed(F.col(n), f.dataType).alias(f.name) for n, f in lower.items()])


def _typed(col: Column, dtype: T.DataType) -> Column:
    # Codes saved by way of floating point read "10001.0".
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return F.regexp_replace(col, r"\.0$", "").try_cast(dtype)
    return col.cast(dtype)


def ingest_layer(
    df: DataFrame,
    manifest: DataFrame,
    nuts: str,
    year: int,
    geometry: str = "geometry",
    source_srid: int = 3035,
) -> tuple[DataFrame, DataFrame]:
    """A source layer as ``(good, quarantine)``.

    Keeps the manifest's columns, decodes the geometry where it is WKB, brings longitude/latitude to
    EPSG:3035, makes geometries valid and multi, in two dimensions.  Rows whose geometry is missing,
    unreadable or beyond repair go to quarantine with a reason, so nothing is silently lost.
    """
    if source_srid not in (3035, 4326):
        raise ValueError("sources must be in EPSG:3035 or EPSG:4326")
    kept = select_by_manifest(df, manifest, nuts, year, always=[geometry])
    names = {a.lower(): b for a, b in manifest_columns(manifest, nuts, year)}
    kept = kept.withColumnsRenamed({c: names[c.lower()] for c in kept.columns if c.lower() in names and c != geometry})
    if isinstance(df.schema[geometry].dataType, T.BinaryType):
        kept = kept.withColumn("geom", from_wkb(geometry)).drop(geometry)
    else:
        kept = kept.withColumnRenamed(geometry, "geom")
    if source_srid == 4326:
        kept = hold(kept.withColumnRenamed("geom", "_lonlat"), "geom", geom_to_3035(F.col("_lonlat"))).drop("_lonlat")
    kept = kept.withColumns({"nuts": F.lit(nuts.lower()), "year": F.lit(year)})
    fixed = repair_layer(kept).withColumn(
        "reason",
        F.when(F.col("geom").isNull(), "no readable geometry")
        .when(F.size("geom") == 0, "empty geometry")
        .when(F.col("method") == 9, "could not be repaired"),
    )
    # Stored once: decoding and repair are dear, and both results read them.
    fixed = materialise(fixed, "ingested")
    good = drop_empty(fixed.where(F.col("reason").isNull())).drop("reason", "method")
    return good, fixed.where(F.col("reason").isNotNull()).drop("method")
