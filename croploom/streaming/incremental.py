"""Taking in only what is new: a done list for batches, a file stream for folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from croploom.functions.wkb import from_wkb
from croploom.operators.joins import todo
from croploom.schema import LAYER_FILE
from croploom.sources.layers import path_region, path_year


def layers_to_do(available: DataFrame, done: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """Layers neither loaded nor known to be empty."""
    return todo(available, done, empty)


def layers_changed(now: DataFrame, done: DataFrame) -> DataFrame:
    """Layers that are new or whose digest is another one than in the done list (see ``layer_digests``)."""
    return now.join(done.select(*now.columns), now.columns, "left_anti")


def layer_stream(spark: SparkSession, folder: str, schema: T.StructType = LAYER_FILE) -> DataFrame:
    """New layer files of a folder as a stream with region, year and decoded geometry."""
    raw = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    path = F.col("_metadata.file_path")
    kept = [c for c in raw.columns if c != "geometry"]
    return raw.select(
        path_region(path).alias("nuts"), path_year(path).alias("year"), *kept, from_wkb("geometry").alias("geom")
    )


def ingest_new(
    stream: DataFrame, dst: str, checkpoint: str, partition_by: tuple[str, ...] = ("nuts", "year")
) -> StreamingQuery:
    """Append everything that arrived since the last run and stop; a second run adds nothing."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", dst)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )


def stream_sums(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    dst: str,
    checkpoint: str,
) -> StreamingQuery:
    """Partial statistics of each batch, kept as one folder per batch.

    A batch that is run again after a failure replaces its own folder, so nothing counts twice;
    readers sum the batches up.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{dst}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
