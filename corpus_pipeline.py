"""A corpus from raw documents to packed sequences: each stage reads what the one before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import language, linededup, mixing, neardup, packing
from spindrift.plans.cut import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; null, letterless and undecided ones go."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without what repeats earlier ones; those of which nothing but blanks is left go."""
    found = linededup.dedup_lines(docs).filter("_removed_lines = 0 OR text RLIKE '\\\\S'")
    changed = F.col("_removed_lines") > 0
    return found.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("_removed_lines")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered shares of sources, languages and topics."""
    return mixing.keep_mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack),
]

ORACLE_SQL = None  # compression, alignment, sketches and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage returns is written and read again by the next."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
