"""A corpus pipeline over ``documents``: stages that each apply one operator to all that the stage before it kept."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import mixing, packing, quality, secret_scan, simhash
from concord.llm.common import ship
from concord.session import ensure_checkpoint_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    ship(spark)
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced in their texts."""
    ship(spark)
    return _counted(secret_scan.redact(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of nine tenths of all tokens at the target weights, each document at most once; the document in
    which a source's prefix ends is cut after the tokens taken."""
    ship(spark)
    rows = mixing.mix(docs, mixing.tree(), mixing.WEIGHTS, mixing.words(F.col("text")), share=0.9, max_epochs=1)
    text = F.when(F.col("_take") < F.col("_tokens"), mixing.first_words(F.col("text"), F.col("_take"))).otherwise(F.col("text"))
    return _counted(rows.withColumn("text", text).select(docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of all documents; the packed pieces with their ids."""
    ship(spark)
    return packing.pack(docs)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", single),
    ("secret scans", clean),
    ("mixing", mixed),
    ("packing", packed),
]

#: Tokenisation is not expressible in SQL, so ``run`` is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet below ``spark.checkpoint.dir`` and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(top, f"{number}-{name.replace(' ', '_')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
