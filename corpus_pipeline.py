"""A corpus pipeline made of the operators in croploom.llm.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, written as Parquet and read
again as the next stage's input.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from croploom.llm import decontam, dedup, langid, pieces, secrets
from croploom.llm.queries import PIECES, table
from croploom.session import discard, settled

#: Jaccard similarity of word shingles from which documents are near copies.
SIMILAR = 80, 100


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those with a positive cosine to no language; a missing lang is filled in.

    Short texts have small cosines, so any positive one counts.  Where no document is labelled nothing
    can be told, and all documents with letters stay.
    """
    languages, prototypes = langid.learn(docs)
    if not languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    kept = langid.identify(docs, languages, prototypes).filter((F.col("lang_pred") != "und") & (F.col("score") > 0))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of Jaccard similarity 0.8 or more stays, judged by its own text, with or without an id."""
    return dedup.keep_one(docs, *SIMILAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts become a mark, and n_chars follows the text."""
    found = secrets.scan_corpus(docs)
    found = found.withColumn("text", secrets.redacted())
    found = found.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, and whether they decode to the text they came from."""
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), PIECES, check="lossless")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "lossless")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("segment", segment),
]

#: No SQL: the language model of the first stage and the seeded segmentation of the last are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents.

    What a stage stores on its way goes when its result is written, and so does the result of the stage before.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = settled(spark, f"pipeline-{name}", partial(stage, spark, docs, sf_dir))
        discard(docs)
        docs = kept
    return docs
