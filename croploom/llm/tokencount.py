"""Token counts from flat token files that have no index.

A flat file is a sequence of ids of fixed width in which an end-of-document id follows each document.
Blocks of it are searched independently with array comparisons.  A prefix scan over what the blocks
report (ids, separators, place of the last separator) says where each block begins in its file, how many
documents ended before it, and where the document began that is open at its border.  The scan has two
levels, so that a file of any number of blocks is no single task's work.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from croploom.llm.words import slices
from croploom.session import materialise

WIDTH = 2  # bytes of an id
BLOCK = 1 << 16  # ids in a block
GROUP = 1024  # blocks whose sums are scanned together
END = 50256  # free in the ranks file


def _found(end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(p or b"", f"<u{width}") for p in batch.column("payload").to_pylist()]
            ends = [np.flatnonzero(x == end) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([e.tolist() for e in ends], pa.list_(pa.int64())),
                ],
                names=["file", "block", "n", "ends"],
            )

    return run


def count(blocks: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """One row per document: file, ordinal (from 0 in the file), start, n_tokens, terminated.

    blocks: file, block (in the file's order), payload (little-endian ids of ``width`` bytes).
    n_tokens counts the end id; ids after a file's last end id are a document with terminated false.
    Consecutive end ids are documents of one id.  Null or empty payloads are blocks without ids; a
    payload must hold whole ids.  Block numbers must differ within a file.  Other columns are ignored,
    and an empty table gives no rows.
    """
    found = blocks.select("file", "block", "payload").mapInArrow(_found(end, width), "file string, block long, n long, ends array<long>")
    found = materialise(found.withColumn("part", F.floor(F.col("block") / GROUP)), "separators")
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    inner = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = found.withColumns({"at": F.coalesce(F.sum("n").over(inner), zero), "before": F.coalesce(F.sum(F.size("ends")).over(inner), zero)})
    placed = placed.withColumn("open", F.max(F.col("at") + last).over(inner))
    sums = found.groupBy("file", "part").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).alias("seps"))
    tail = placed.groupBy("file", "part").agg(F.max(F.col("at") + last).alias("tail"))
    outer = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.join(tail, ["file", "part"]).withColumns(
        {"base": F.coalesce(F.sum("n").over(outer), zero), "docs": F.coalesce(F.sum("seps").over(outer), zero)}
    )
    bases = bases.withColumn("carried", F.max(F.col("base") + F.col("tail")).over(outer)).select("file", "part", "base", "docs", "carried")
    whole = placed.join(bases, ["file", "part"]).select(
        "file",
        (F.col("base") + F.col("at")).alias("at"),
        (F.col("docs") + F.col("before")).alias("before"),
        F.coalesce(F.col("base") + F.col("open"), "carried", F.lit(-1)).alias("open"),
        "ends",
    )
    one = whole.select("file", "at", "before", "open", "ends", F.posexplode("ends").alias("k", "end"))
    previous = F.expr("if(k = 0, open, at + ends[k - 1])")
    closed = one.select(
        "file", (F.col("before") + F.col("k")).alias("ordinal"), (previous + 1).alias("start"), (F.col("at") + F.col("end") - previous).alias("n_tokens"), F.lit(True).alias("terminated")
    )
    files = sums.join(tail, ["file", "part"]).groupBy("file").agg(F.sum("n").alias("n"), F.sum("seps").alias("seps"))
    stop = closed.groupBy("file").agg(F.max(F.col("start") + F.col("n_tokens")).alias("stop"))
    rest = files.join(stop, "file", "left").withColumn("stop", F.coalesce("stop", zero)).filter("stop < n")
    rest = rest.select("file", F.col("seps").alias("ordinal"), F.col("stop").alias("start"), (F.col("n") - F.col("stop")).alias("n_tokens"), F.lit(False).alias("terminated"))
    return closed.unionByName(rest)


def blocks_of_files(spark: SparkSession, path: str, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Blocks of raw binary files; Spark hands each file over whole, which bounds it to 2 GB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = block * width
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                view = data.as_buffer()
                for k in range(0, max(1, -(-len(view) // step))):
                    part = view[k * step : (k + 1) * step].to_pybytes() if len(view) else b""
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([part], pa.binary())], names=["file", "block", "payload"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, block long, payload binary")


_encoders: dict[str, object] = {}


def encoder(path: str):
    """The byte-level tokenizer of a ranks file."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _write(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, block, ids, ordinal, file = [], 0, 0, [], 0, None
        code = encoder(path)

        def row(flat: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block], pa.int64()), pa.array([flat.astype(f"<u{WIDTH}").tobytes()], pa.binary()), pa.array([ordinal], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
                names=["file", "block", "payload", "ordinal", "doc_ids"],
            )

        for wide in batches:
            for batch in slices(wide, "text"):
                for doc, name, text in zip(batch.column("doc_id").to_pylist(), batch.column("file").to_pylist(), batch.column("text").to_pylist()):
                    file = name
                    own = code.encode_to_numpy(text or "", disallowed_special=())
                    held += [own, np.array([end], own.dtype)]
                    ids.append(doc)
                    n += len(own) + 1
                    if n >= BLOCK:
                        flat = np.concatenate(held)
                        while n >= BLOCK:
                            yield row(flat[:BLOCK])
                            flat, n, block, ordinal, ids = flat[BLOCK:], n - BLOCK, block + 1, ordinal + len(ids), []
                        held = [flat]
        if n or ids:
            yield row(np.concatenate(held) if held else np.zeros(0, np.uint32))

    return run


def write_flat(docs: DataFrame, ranks: str, path: str, end: int = END) -> None:
    """Flat token files of whole texts, one per task in the order it reads them, as blocks at ``path``.

    Beside its ids a block names the documents that were added while it was filled, so that counts can be
    given to documents; where they begin and end is not written.  Null and empty texts are the end id alone.
    """
    named = docs.select("doc_id", "text", F.spark_partition_id().cast("string").alias("file"))
    named.mapInArrow(_write(ranks, end), "file string, block long, payload binary, ordinal long, doc_ids array<long>").write.parquet(path)


def count_documents(stored: DataFrame, end: int = END) -> DataFrame:
    """``count`` of files written by ``write_flat``, with doc_id."""
    names = stored.select("file", F.posexplode("doc_ids").alias("k", "doc_id"), "ordinal").select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "doc_id")
    return count(stored, end).join(names, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
