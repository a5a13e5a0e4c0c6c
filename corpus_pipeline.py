"""The corpus pipeline: each stage takes the documents that the one before it kept.

Toxic documents go, one document of each class of near duplicates stays, passages that an earlier document
holds are cut out, documents that hold benchmark items go, and what is left is packed into sequences.
``run`` chains the stages; between two of them the documents are written to the shared folder, so no stage is
computed again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontamination, order_minhash, packing, repeats, toxicity
from feedloom.llm.queries import TOXIC_AT, fit_toxicity, read
from feedloom.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model fitted to the labels."""
    return toxicity.reject(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")), TOXIC_AT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class; shingles of five words, similarity of 0.8 or more."""
    return order_minhash.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of fifty bytes or more that an earlier document holds."""
    cut = repeats.trim(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the sequences they were given."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
