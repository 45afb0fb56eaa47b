"""Explicit schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# A multipolygon: polygons -> rings (the first is the outline, the others are holes) -> points.
GEOM = T.ArrayType(
    T.ArrayType(
        T.ArrayType(
            T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
        )
    )
)

# Coordinates are metres in this system throughout; it is layer metadata, not a column.
LAYER_SRID = 3035

LAYER_FILE = T.StructType(
    [
        T.StructField("cropfield", T.LongType()),
        T.StructField("original_code", T.StringType()),
        T.StructField("off_id", T.StringType()),
        T.StructField("off_area", T.DoubleType()),
        T.StructField("area_ha", T.FloatType()),
        T.StructField("geometry", T.BinaryType()),
    ]
)

CROP_MAP = T.StructType(
    [
        T.StructField("nuts", T.StringType()),
        T.StructField("original_code", T.StringType()),
        T.StructField("original_name", T.StringType()),
        T.StructField("translated_name", T.StringType()),
        T.StructField("hcat4_code", T.LongType()),
        T.StructField("hcat4_name", T.StringType()),
        T.StructField("usage_code", T.ShortType()),
        T.StructField("usage_name", T.StringType()),
    ]
)

CROP_HIERARCHY = T.StructType(
    [
        T.StructField("hcat4_code", T.LongType()),
        T.StructField("hcat4_name", T.StringType()),
        T.StructField("seasonality_code", T.IntegerType()),
        T.StructField("seasonality_name", T.StringType()),
    ]
)

EAGLE_CROSSWALK = T.StructType(
    [
        T.StructField("hcat4_code", T.LongType()),
        T.StructField("hcat4_name", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("eagle_code", T.StringType()),
        T.StructField("eagle_name", T.StringType()),
        T.StructField("eagle_seasonality_code", T.StringType()),
        T.StructField("eagle_seasonality_name", T.StringType()),
    ]
)

HRL_CROSSWALK = T.StructType(
    [
        T.StructField("hcat4_code", T.LongType()),
        T.StructField("hcat4_name", T.StringType()),
        T.StructField("hrl_code", T.IntegerType()),
        T.StructField("hrl_name", T.StringType()),
    ]
)

AGRIPROD_CROSSWALK = T.StructType(
    [
        T.StructField("hcat4_code", T.LongType()),
        T.StructField("hcat4_name", T.StringType()),
        T.StructField("usage_code", T.ShortType()),
        T.StructField("usage_name", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("agriprod_code", T.StringType()),
        T.StructField("agriprod_name", T.StringType()),
    ]
)

FADN_CROSSWALK = T.StructType(
    [
        T.StructField("agriprod_code", T.StringType()),
        T.StructField("agriprod_name", T.StringType()),
        T.StructField("fadn_code", T.StringType()),
        T.StructField("code_name", T.StringType()),
    ]
)

LUCAS_CROSSWALK = T.StructType(
    [
        T.StructField("agriprod_code", T.StringType()),
        T.StructField("agriprod_name", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("lucas_lc_code", T.StringType()),
        T.StructField("lucas_lc_name", T.StringType()),
        T.StructField("lucas_lu_code", T.StringType()),
        T.StructField("lucas_lu_name", T.StringType()),
    ]
)

IMPORT_LIST = T.StructType(
    [
        T.StructField("nuts", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("layer", T.StringType()),
    ]
)

COLUMN_MANIFEST = T.StructType(
    [
        T.StructField("nuts", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("tokeep", T.IntegerType()),
    ]
)
