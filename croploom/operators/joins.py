"""Joins of parcels to code tables, lookups and work lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.session import size_in_bytes, stored

# A code table above this many rows, or bytes of its files, is not broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
SALTS = 16


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored frame may be broadcast; where it was not counted yet, counting it reads no columns."""
    if size_in_bytes(df) > BROADCAST_BYTES:
        return False
    n = getattr(df, "n_rows", None)
    return (df.count() if n is None else n) <= max_rows


def _salt(df: DataFrame, salts: int) -> Column:
    plain = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    ]
    return F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")


def dim_join(
    big: DataFrame,
    dim: DataFrame,
    on: Iterable[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    null_safe: bool = False,
) -> DataFrame:
    """Join a large frame to a code table without depending on how the keys are spread.

    Up to ``max_rows`` rows the code table is broadcast and the large side is not moved.  Beyond
    that the large side is shuffled on the keys plus a salt taken from the row's own content, so a
    key that holds a large part of all rows still goes to ``salts`` tasks; the code table is
    repeated once per salt value.  ``dim`` is stored first, so that it is worked out once however it
    came about.  With ``null_safe`` null keys are matched too.
    """
    on, dim = list(on), stored(dim, "codes", counted=True)
    small = is_small(dim, max_rows)
    keys: list = on
    if null_safe:
        dim = dim.withColumnsRenamed({c: f"_on_{c}" for c in on})
        keys = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    if small:
        out = big.join(F.broadcast(dim), keys, how)
    else:
        left = big.withColumn("_salt", _salt(big, salts))
        right = dim.withColumn("_on_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        if null_safe:
            out = left.join(right, [*keys, F.col("_salt") == F.col("_on_salt")], how)
        else:
            out = left.join(right.withColumnRenamed("_on_salt", "_salt"), [*on, "_salt"], how)
        out = out.drop("_salt", "_on_salt")
    return out.drop(*[f"_on_{c}" for c in on]) if null_safe else out


def map_crops(
    pc: DataFrame,
    crop_map: DataFrame,
    usage_map: DataFrame | None = None,
    pattern: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Crop and usage code of every parcel, by region and original code.

    All parcels stay; an unmapped one gets nulls.  ``original_code`` of the result is the mapping's
    code, so it is null where unmapped.  A code mapped twice yields two rows.  With ``pattern`` the
    mapping's code only has to be LIKE the parcel's, whose ``%`` and ``_`` then are wildcards.
    """
    m = crop_map.select("nuts", F.col("original_code").alias("_code"), "hcat4_code")
    if pattern:
        m = _pattern_pairs(pc, m)
    else:
        m = m.withColumn("original_code", F.col("_code"))
    out = dim_join(pc, m, ["nuts", "original_code"], "left", max_rows)
    if usage_map is None:
        out = out.withColumn("usage_code", F.lit(None).cast("smallint"))
    else:
        u = usage_map.select("nuts", "original_code", F.col("usage_code").cast("smallint"))
        out = dim_join(out, u, ["nuts", "original_code"], "left", max_rows)
    return out.withColumn("original_code", F.col("_code")).drop("_code")


def _pattern_pairs(pc: DataFrame, m: DataFrame) -> DataFrame:
    """Parcel code -> matching mapping codes, worked out on the distinct parcel codes only.

    Codes without wildcard are matched by equality.  A pattern meets the mapping codes of its region that
    begin with what stands before its first wildcard, or end with what stands after its last one.
    """
    codes = pc.where(F.col("original_code").isNotNull()).select("nuts", "original_code").distinct()
    wild = F.col("original_code").rlike(r"[%_\\]")
    plain = codes.where(~wild).join(
        m.withColumn("original_code", F.col("_code")), ["nuts", "original_code"]
    )
    patterns = codes.where(wild).withColumn("_like", _spark_pattern(F.col("original_code")))
    matched = pattern_candidates(patterns, m).where(F.like(F.col("_code"), F.col("_like"))).drop("_like")
    return plain.unionByName(matched.select(*plain.columns))


def pattern_candidates(patterns: DataFrame, m: DataFrame) -> DataFrame:
    """Patterns (nuts, ``_like``) with the mapping codes (nuts, ``_code``) that share their longer fixed end.

    Mapping codes are indexed by all their beginnings and endings, so the range of codes with a common
    beginning is one key of the index.  A pattern with wildcards at both ends meets its whole region.
    """
    head, tail = (F.regexp_extract("_like", p, 0) for p in (r"^[^%_\\]*", r"[^%_\\]*$"))
    end = F.when(F.length(head) >= F.length(tail), F.concat(F.lit("^"), head)).otherwise(F.concat(F.lit("$"), tail))
    ends = "concat(transform(sequence(0, length(_code)), k -> concat('^', left(_code, k))), transform(sequence(1, length(_code) + 1), k -> concat('$', right(_code, k))))"
    index = m.where(F.col("_code").isNotNull()).withColumn("_end", F.explode(F.array_distinct(F.expr(ends))))
    return dim_join(patterns.withColumn("_end", end), index, ["nuts", "_end"], "inner").drop("_end")


def _spark_pattern(pattern: Column) -> Column:
    """A LIKE pattern in which a backslash takes the next character as itself, made safe for Spark.

    Spark refuses a backslash before an ordinary character and at the end; the first is dropped,
    the second kept as itself.
    """
    pair, percent, underscore = "\u0001", "\u0002", "\u0003"
    out = F.replace(pattern, F.lit("\\\\"), F.lit(pair))
    out = F.replace(out, F.lit("\\%"), F.lit(percent))
    out = F.replace(out, F.lit("\\_"), F.lit(underscore))
    out = F.regexp_replace(out, r"\\$", pair)
    out = F.replace(out, F.lit("\\"), F.lit(""))
    out = F.replace(out, F.lit(pair), F.lit("\\\\"))
    out = F.replace(out, F.lit(percent), F.lit("\\%"))
    return F.replace(out, F.lit(underscore), F.lit("\\_"))


def lookup(
    df: DataFrame, dim: DataFrame, key: str, col: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``col`` of the code table by ``key``; never multiplies rows.

    Of several values for one key the smallest is taken; rows without match stay, with null.
    """
    first = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(col).alias(col))
    return dim_join(df, first, [key], "left", max_rows)


def crosswalk(
    df: DataFrame,
    mapping: DataFrame,
    key: str,
    links: Iterable[str] | None = None,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Translate codes through a many-to-many table, optionally only over the given link kinds."""
    if links is not None:
        mapping = mapping.where(F.col("link").isin(list(links)))
    return dim_join(df, mapping, [key], how, max_rows)


def uncovered(df: DataFrame, mapping: DataFrame, key: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct codes the crosswalk has no row for."""
    codes = df.select(key).where(F.col(key).isNotNull()).distinct()
    return dim_join(codes, mapping.select(key).distinct(), [key], "left_anti", max_rows)


def regions_with_layer(admin: DataFrame, catalog: DataFrame, year: int) -> DataFrame:
    """Admin areas whose id is the region of some layer of the year."""
    regions = (
        catalog.where(F.col("table_name").like(f"%_{year}"))
        .select(F.upper(F.split_part("table_name", F.lit("_"), F.lit(1))).alias("nuts_id"))
        .distinct()
    )
    return admin.join(regions, "nuts_id", "left_semi")


def todo(all_items: DataFrame, done: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """Work items neither done nor known to be empty."""
    keys = all_items.columns
    left = all_items.join(done.select(*keys), keys, "left_anti")
    return left if empty is None else left.join(empty.select(*keys), keys, "left_anti")
