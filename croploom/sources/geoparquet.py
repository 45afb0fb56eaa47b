"""A writer of GeoParquet files, whose footers describe the geometry column.

Spark's own Parquet writer cannot set the footer entry.  This one is a Python data source: every task
writes files of its own below a folder aside, and they are moved into place when all tasks are done.  It
reaches the file systems that Arrow knows (local or mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

ROW_GROUP = 20_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path.rstrip("/")
    found, inner = pafs.FileSystem.from_uri(path)
    return found, inner.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    """Folder below the target and file of what a task has written."""

    files: list[tuple[str, str]]


class _File:
    """One open file: rows are gathered to whole row groups."""

    def __init__(self, fs: pafs.FileSystem, path: str, schema: pa.Schema, geo: str, rows: int) -> None:
        self.geo, self.rows, self.held, self.n, self.limits = json.loads(geo), rows, [], 0, None
        self.out = pq.ParquetWriter(path, schema, filesystem=fs, compression="zstd")

    def add(self, table: pa.Table) -> None:
        self.held.append(table)
        self.n += table.num_rows
        if self.n >= self.rows:
            self.flush(self.rows)

    def flush(self, step: int) -> None:
        table = pa.concat_tables(self.held)
        whole = table.num_rows if step == 0 else table.num_rows // step * step
        if whole:
            self.out.write_table(table.slice(0, whole), row_group_size=step or self.rows)
            self._extend(table.slice(0, whole))
        self.held, self.n = [table.slice(whole)], table.num_rows - whole

    def _extend(self, table: pa.Table) -> None:
        if "bbox" in table.column_names:
            box = table.column("bbox").combine_chunks()
            own = [pa.compute.min_max(pa.compute.struct_field(box, k))["min" if "min" in k else "max"].as_py() for k in ("xmin", "ymin", "xmax", "ymax")]
            if None not in own:
                a = self.limits or own
                self.limits = [min(a[0], own[0]), min(a[1], own[1]), max(a[2], own[2]), max(a[3], own[3])]

    def close(self) -> None:
        if self.n:
            self.flush(0)
        if self.limits:
            self.geo["columns"][self.geo["primary_column"]]["bbox"] = self.limits
        self.out.add_key_value_metadata({"geo": json.dumps(self.geo)})
        self.out.close()


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.geo, self.overwrite = options["path"], options["geo"], overwrite
        self.parts = [p for p in options.get("partitions", "").split(",") if p]
        self.rows = int(options.get("rowgroup", ROW_GROUP))
        self.aside = f"_aside-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.compute  # noqa: F401 - pa.compute in the worker

        fs, root = file_system(self.path)
        task, done = uuid.uuid4().hex, []
        now, file = None, None
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            for folder, part in self._by_folder(table):
                if folder != now:
                    if file:
                        file.close()
                    now, name = folder, f"part-{task}-{len(done)}.parquet"
                    target = "/".join(x for x in (root, self.aside, folder) if x)
                    fs.create_dir(target, recursive=True)
                    file = _File(fs, f"{target}/{name}", part.schema, self.geo, self.rows)
                    done.append((folder, name))
                file.add(part)
        if file:
            file.close()
        return Written(done)

    def _by_folder(self, table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
        """Runs of rows of one folder, without the columns that the folder's name holds."""
        if not self.parts:
            yield "", table
            return
        names = list(zip(*(table.column(p).to_pylist() for p in self.parts)))
        plain = table.drop_columns(self.parts)
        lo = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[lo]:
                yield "/".join(f"{p}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for p, v in zip(self.parts, names[lo])), plain.slice(lo, i - lo)
                lo = i

    def commit(self, messages: list[Written | None]) -> None:
        """Moves what the tasks have written into place; folders that are overwritten lose their old files then."""
        fs, root = file_system(self.path)
        files = [f for m in messages if m for f in m.files]
        for folder in {f for f, _ in files}:
            target = "/".join(x for x in (root, folder) if x)
            fs.create_dir(target, recursive=True)
            old = [i.path for i in fs.get_file_info(pafs.FileSelector(target)) if i.is_file] if self.overwrite else []
            for own, name in files:
                if own == folder:
                    fs.move("/".join(x for x in (root, self.aside, own, name) if x), f"{target}/{name}")
            for path in old:
                fs.delete_file(path)
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.aside}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.aside}")


class GeoParquetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "croploom_geoparquet"

    def schema(self):
        raise NotImplementedError("this source writes; read the files as Parquet")

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(dict(self.options), overwrite)


def write_geoparquet(df: DataFrame, path: str, geo: dict, partitions: tuple[str, ...] = (), mode: str = "overwrite", row_group: int = ROW_GROUP) -> None:
    """``df`` as GeoParquet files with ``geo`` in their footers, in folders by ``partitions``.

    Overwriting replaces the folders that the rows belong to and leaves others.  Rows of one folder
    should come together within a task, as each change of folder begins a file.
    """
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(GeoParquetSource)
    out = df.write.format("croploom_geoparquet").mode(mode).option("geo", json.dumps(geo)).option("partitions", ",".join(partitions))
    out.option("rowgroup", str(row_group)).option("path", path).save()


FOOTER = "path string, n_rows bigint, version string, srid int, bbox array<double>"


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("version", pa.string()), ("srid", pa.int32()), ("bbox", pa.list_(pa.float64()))])
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            fs, inner = file_system(path)
            meta = pq.read_metadata(inner, filesystem=fs)
            geo = json.loads((meta.metadata or {}).get(b"geo", b"{}"))
            column = geo.get("columns", {}).get(geo.get("primary_column"), {})
            code = ((column.get("crs") or {}).get("id") or {}).get("code")
            rows.append({"path": path, "n_rows": meta.num_rows, "version": geo.get("version"), "srid": code, "bbox": column.get("bbox")})
        yield pa.RecordBatch.from_pylist(rows, schema=fields)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """Rows, coordinate system and limits of each GeoParquet file below a path, by its footer alone.

    Executors read the footers.  A file without a ``geo`` entry, or whose entry names no system by a
    number, has a null ``srid``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path").mapInArrow(_footers, FOOTER)


def require_srid(spark: SparkSession, path: str, srid: int) -> None:
    """Raises where a file below the path is not described as having the coordinate system ``srid``."""
    other = footers(spark, path).where(~F.col("srid").eqNullSafe(F.lit(srid))).limit(1).collect()
    if other:
        raise ValueError(f"{other[0].path} has the coordinate system {other[0].srid}, not {srid}")
