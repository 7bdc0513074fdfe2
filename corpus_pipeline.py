"""A training corpus from raw documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethazard.llm.bpe import bpe_encode
from fleethazard.llm.decontamination import decontaminate
from fleethazard.llm.line_dedup import line_dedup
from fleethazard.llm.quality_classifier import classify_quality
from fleethazard.llm.queries import tokenizer_path
from fleethazard.llm.simhash import simhash_dedup
from fleethazard.llm.support import table
from fleethazard.session import written

ORACLE_SQL = None  # a trained classifier decides in the first stage


def _columns(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classify_quality(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(line_dedup(docs), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup(docs).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids (little-endian unsigned 32-bit) and their number for each document left."""
    return bpe_encode(docs, tokenizer_path()).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", drop_poor),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
