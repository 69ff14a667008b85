"""From raw documents to packed sequences: the stages of a training corpus, each on whole tables.

Every stage gets what the one before has kept, read again from Parquet, and returns a DataFrame; all
but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import corpweave
from corpweave.llm import decontaminate, near_duplicates, packing, quality, repeats
from corpweave.operators import lineage

# Executors may not have the package on their path.
cloudpickle.register_pickle_by_value(corpweave)

#: Passages of over 50 words count as repeated, down to four bytes a word with its space.
REPEATED_BYTES = 200


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts. It is trained on the labelled ones among its input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.distinct(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of ``REPEATED_BYTES`` bytes that occur more than once."""
    return repeats.cleaned(docs, length=REPEATED_BYTES)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicate_documents),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packed_sequences),
]

#: A trained network and tokenisation cannot be stated in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = lineage.cut(stage(spark, docs, sf_dir))
    return docs
