"""Column selection, renaming, keys and areas of parcel layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.operators.numbering import number_rows


def hold(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A computed column that later filters and projections refer to but never repeat.

    Spark moves a filter on a plain computed column below it and repeats the whole expression there;
    it does not do so across a generated row.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def manifest_columns(manifest: DataFrame, nuts: str, year: int) -> list[tuple[str, str]]:
    """``(source column, standard name)`` pairs to keep for one layer.

    The manifest has a few rows per layer, so one layer's part is read to the driver.
    """
    rows = (
        manifest.where(
            (F.lower("nuts") == nuts.lower()) & (F.col("year") == year) & (F.col("tokeep") == 1)
        )
        .select("column_name", "type")
        .collect()
    )
    return [(r.column_name, r.type) for r in rows]


def _find(df: DataFrame, name: str) -> str:
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"column {name!r} is not among {df.columns}")
    return found[0]


def select_by_manifest(
    df: DataFrame, manifest: DataFrame, nuts: str, year: int, always: Iterable[str] = ()
) -> DataFrame:
    """Only the columns the manifest keeps for this layer, plus ``always``."""
    keep = [c for c, _ in manifest_columns(manifest, nuts, year)]
    names = [_find(df, c) for c in [*keep, *always]]
    return df.select(*dict.fromkeys(names))


def harmonise_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source columns to their standard names; names are matched without regard to case.

    A source name that matches no column is an error.
    """
    renames = {_find(df, src): dst for src, dst in mapping.items()}
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a != b})


def with_cropfield(
    df: DataFrame,
    order_cols: Iterable[str | Column],
    by: Iterable[str] = ("nuts", "year"),
    key: str | None = None,
) -> DataFrame:
    """The existing key as ``cropfield``, else a serial number from 1 within each layer."""
    if key is not None:
        return df.withColumnRenamed(_find(df, key), "cropfield")
    return number_rows(df, "cropfield", order_cols, by)


def area_ha(square_metres: Column, rounded: bool = True) -> Column:
    """Hectares as FLOAT; a yearly layer rounds to whole square metres first, a stack does not."""
    m2 = F.rint(square_metres) if rounded else square_metres
    return (m2 / 10000).cast("float")


def with_area_ha(df: DataFrame, rounded: bool = True, geom: str = "geom") -> DataFrame:
    return df.withColumn("area_ha", area_ha(G.area(F.col(geom)), rounded))


def with_bbox(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Limits ``xmin, ymin, xmax, ymax`` as columns of their own.

    Stored with a layer, they let a scan skip row groups by place.
    """
    held = hold(df, "_b", G.bbox(F.col(geom)))
    return held.withColumns({c: F.col(f"_b.{c}") for c in ("xmin", "ymin", "xmax", "ymax")}).drop("_b")


def lit_layer(df: DataFrame, nuts: str, year: int) -> DataFrame:
    """Region and year as constant columns."""
    return df.withColumns({"nuts": F.lit(nuts), "year": F.lit(year)})


def with_missing_years(df: DataFrame, years: Iterable[int], prefix: str = "cf") -> DataFrame:
    """A typed null column for every year the frame does not have."""
    absent = [f"{prefix}{y}" for y in years if f"{prefix}{y}" not in df.columns]
    return df.withColumns({c: F.lit(None).cast("int") for c in absent}) if absent else df


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Background 0 becomes null, as INT."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)).cast("int") for c in cols})


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def centroid_layer(pc: DataFrame, geom: str = "geom") -> DataFrame:
    """The same rows with the geometry replaced by its centroid as two columns ``cx, cy``."""
    c = G.centroid(F.col(geom))
    return (
        pc.withColumn("_c", c)
        .withColumns({"cx": F.col("_c.x"), "cy": F.col("_c.y")})
        .drop("_c", geom)
    )


def clean_names(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])
