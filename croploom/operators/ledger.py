"""Serial numbers that stay with their rows, and digests that tell whether a layer has changed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.operators.joins import dim_join
from croploom.operators.numbering import number_rows
from croploom.session import materialise


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def row_digest(*content: str) -> Column:
    """What tells a layer's rows apart in a ledger."""
    return F.md5(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}).cast("binary"))


def keep_numbers(
    rows: DataFrame, path: str, content: Iterable[str], order: Iterable[str] = ("off_id",), by: Iterable[str] = ("nuts", "year"), name: str = "cropfield"
) -> DataFrame:
    """``rows`` with a number that equal rows of a layer get again in every later run.

    The ledger at ``path`` holds the number of each row seen so far, by layer and a digest of its
    ``content``; of equal rows the first, second and so on are told apart.  Rows that are new get the
    numbers after the layer's highest one, in the given order; those of rows that are gone are not used
    again.  The ledger is extended before this returns, so a job that fails later and is repeated finds
    the numbers it had given.
    """
    return number_keyed(materialise(rows.withColumn("_key", row_digest(*content)), "ledger-rows"), path, order, by, name)


def number_keyed(keyed: DataFrame, path: str, order: Iterable[str] = ("off_id",), by: Iterable[str] = ("nuts", "year"), name: str = "cropfield") -> DataFrame:
    """As ``keep_numbers``, for rows of a stored stage that have their ``row_digest`` as ``_key``.

    Numbers are looked up and given on keys and ``order`` alone; whole rows are moved once, to their numbers.
    """
    spark, by, order = keyed.sparkSession, list(by), list(order)
    columns = [*[c for c in keyed.columns if c not in (name, "_key")], name]
    repeated = keyed.groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*by, "_key")
    repeated = materialise(repeated, "ledger-repeated", counted=True)
    single = dim_join(keyed, repeated, [*by, "_key"], "left_anti", null_safe=True) if repeated.n_rows else keyed
    placed = single.drop(name).withColumn("_occ", F.lit(1).cast("long"))
    if repeated.n_rows:
        several = number_rows(dim_join(keyed, repeated, [*by, "_key"], "left_semi", null_safe=True), "_occ", [], [*by, "_key"])
        placed = placed.unionByName(several.drop(name))

    entry = T.StructType([*(keyed.schema[c] for c in by), T.StructField("_key", T.StringType()), T.StructField("_occ", T.LongType()), T.StructField(name, T.LongType())])
    fresh = placed.select(*dict.fromkeys([*by, *order, "_key", "_occ"]))
    known = spark.read.schema(entry).parquet(path) if path_exists(spark, path) else None
    if known is not None:
        found = materialise(fresh.join(known, [*by, "_key", "_occ"], "left"), "ledger-found")
        tops = materialise(known.groupBy(*by).agg(F.max(name).alias("_top")), "ledger-tops")
        fresh = found.where(F.col(name).isNull()).drop(name)
    new = number_rows(fresh, "_n", [*order, "_key", "_occ"], by, unique=True)
    new = new.withColumn("_top", F.lit(0)) if known is None else dim_join(new, tops, by)
    new = new.withColumn(name, F.col("_n") + F.coalesce("_top", F.lit(0))).select(*entry.names)
    new = materialise(new, "ledger-new")
    new.write.mode("append").parquet(path)
    given = new if known is None else new.unionByName(found.where(F.col(name).isNotNull()).select(*entry.names))
    # Rows without layer have a number as well, hence the null-safe comparison.
    given = given.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, "_key", "_occ"]], name)
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) if c in by else F.col(c) == F.col(f"_k_{c}") for c in [*by, "_key", "_occ"]]
    return placed.join(given, cond).select(*columns)


def layer_digests(rows: DataFrame, by: Iterable[str] = ("nuts", "year"), columns: Iterable[str] | None = None) -> DataFrame:
    """``digest`` of each layer's rows, whatever their order: count, sum and exclusive or of row hashes.

    Maps count by their sorted entries.  Two hashes with different seeds make up 128 bits.
    """
    by = list(by)
    used = [c for c in (columns or rows.columns) if c not in by]
    cols = [F.array_sort(F.map_entries(c)) if isinstance(rows.schema[c].dataType, T.MapType) else F.col(c) for c in used]
    # a null counts as such and not as nothing: xxhash64 skips nulls
    cols += [F.concat(*[F.col(c).isNull().cast("string") for c in used])] if used else [F.lit("")]
    total = F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))
    mixed = F.bit_xor(F.xxhash64(F.lit(7), *cols))
    return rows.groupBy(*by).agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), total.cast("string"), F.hex(mixed)).alias("digest"))
