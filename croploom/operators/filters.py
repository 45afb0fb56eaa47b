"""Row filters: crop branches, sizes, envelopes, existence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G

# The crop branches reported on the grid.
BRANCHES = {
    3310000000: "arable_crops",
    3310100000: "cereal",
    3310101000: "common_soft_wheat",
    3310102000: "durum_hard_wheat",
    3310103000: "rye",
    3310104000: "barley",
    3310106000: "maize_corn_popcorn",
    3310107000: "rice",
    3310108000: "triticale",
    3310116000: "sorghum",
    3310200000: "legumes",
    3310202010: "alfalfa_lucerne",
    3310300000: "potatoes",
    3310604000: "oilseed_crops",
    3310604010: "rapeseed_rape",
    3310604020: "sunflower",
    3310700000: "fresh_vegetables",
    3310719010: "sugar_beet",
    3310800000: "flowers_ornamental_plants",
    3320000000: "grassland_grass",
    3320100000: "permanent_grassland",
    3320200000: "temporary_grassland",
    3330000000: "permanent_crops_perennial",
    3330100000: "orchards_fruits",
    3330300000: "nuts",
    3330400000: "citrus",
    3330500000: "olive",
    3330600000: "vineyards_wine_vine_rebland_grapes",
    3350000000: "greenhouse_foil_film",
    3360000000: "tree_wood_forest",
    3370000000: "unmaintained",
    3390000000: "not_known_and_other",
}


def branch_factor(code: int) -> int:
    """The power of ten that cuts the trailing zeros of a branch code."""
    factor = 1
    while code % (factor * 10) == 0:
        factor *= 10
    return factor


def in_branch(col: Column, code: int) -> Column:
    """The code lies under the branch: equal after cutting the branch's trailing zeros.

    As codes are whole numbers this is a plain range, which parquet statistics can prune by.  A
    branch ending in a single zero also takes in its season variants.
    """
    factor = branch_factor(code)
    return (col >= F.lit(code)) & (col < F.lit(code + factor))


def branches_of(col: Column, branches: Iterable[int] = tuple(BRANCHES)) -> Column:
    """Array of every branch the code lies under."""
    return F.array_compact(
        F.array(*[F.when(in_branch(col, b), F.lit(b)) for b in branches])
    )


def id_range(df: DataFrame, low: int, high: int, col: str = "cropfield") -> DataFrame:
    return df.where(F.col(col).between(low, high))


def drop_empty(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Without rows whose geometry is null or empty."""
    return df.where(F.col(geom).isNotNull() & ~G.is_empty(F.col(geom)))


def min_area(df: DataFrame, hectares: float, col: str = "area_ha") -> DataFrame:
    return df.where(F.col(col) >= hectares)


def in_envelope(
    df: DataFrame, x0: float, y0: float, x1: float, y1: float, geom: str | None = "geom"
) -> DataFrame:
    """Rows that meet a closed rectangle.

    Stored limits ``xmin, ymin, xmax, ymax``, or those of a struct ``bbox``, are compared first, so that
    the scan can skip row groups; rows whose ``bbox`` is null are looked at.  ``geom=None`` means the rows
    are rectangles and the limits are all there is.
    """
    if "bbox" in df.columns:
        for limit, value, low in (("xmax", x0, True), ("xmin", x1, False), ("ymax", y0, True), ("ymin", y1, False)):
            c = F.col(f"bbox.{limit}")
            df = df.where(c.isNull() | (c >= float(value) if low else c <= float(value)))
    limits = {"xmin", "ymin", "xmax", "ymax"}
    if limits <= set(df.columns):
        df = df.where(
            (F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1)
        )
    if geom is None:
        return df
    box = [F.lit(float(v)) for v in (x0, y0, x1, y1)]
    b = G.bbox(F.col(geom))
    near = (b.xmax >= x0) & (b.xmin <= x1) & (b.ymax >= y0) & (b.ymin <= y1)
    return df.where(near & G.intersects_cell(F.col(geom), *box))


def exists_by(df: DataFrame, keys: Iterable[str], cond: Column, name: str = "found") -> DataFrame:
    """One row per key: does any of its rows satisfy the condition."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(cond), F.lit(False)).alias(name))


def layers_like(
    catalog: DataFrame, pattern: str, has_column: str | None = None, name: str = "table_name"
) -> DataFrame:
    """Layer names that match a LIKE pattern (``_`` is a wildcard, ``\\_`` a plain underscore).

    With ``has_column`` the catalog holds one row per layer and column, and only layers having that
    column qualify.
    """
    kept = catalog.where(F.col(name).like(pattern))
    if has_column is not None:
        kept = kept.where(F.col("column_name") == has_column)
    return kept.select(name).distinct()


def in_list(col: Column, values: Iterable) -> Column:
    return col.isin(list(values))
