"""Session settings and the shared-folder helpers that every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_FOLDER: ContextVar[str | None] = ContextVar("folder of the running job", default=None)

# Settings a cluster job should start with.  Nothing here is required for correct results.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", app: str = "croploom", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Noting the Python line of every column operation costs more than the operation itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    if _FOLDER.get():
        return _FOLDER.get()
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="croploom-"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage", counted: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several later steps: it cuts the lineage, survives lost executors,
    keeps later scans columnar and gives the planner a real size to choose joins by.  With ``counted``
    the rows are counted as they are written (repeated tasks may count twice) and kept as ``n_rows``.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    seen = Observation() if counted else None
    (df.observe(seen, F.count(F.lit(1)).alias("n")) if counted else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if counted:
        out.n_rows = seen.get["n"]
    return out


def stored(df: DataFrame, label: str = "stage", counted: bool = False) -> DataFrame:
    """``df`` if it is a stored stage already, else ``materialise(df)``."""
    return df if getattr(df, "stored_at", None) else materialise(df, label, counted)


def size_in_bytes(df: DataFrame) -> int:
    """The planner's size of a frame; for a stored stage that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Removes a stored stage that nothing will read any more; other frames are left alone."""
    if getattr(df, "stored_at", None):
        _remove(df.sparkSession, df.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the stages stored within, removed at the end.

    For jobs that write their results; a frame that is still to be read must not outlive it.
    """
    path = shared_path(spark, "job")
    token = _FOLDER.set(path)
    try:
        yield path
    finally:
        _FOLDER.reset(token)
        _remove(spark, path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` defines, stored; the stages that it stores on its way are removed."""
    path = shared_path(spark, label)
    with scratch(spark):
        df = make()
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out
