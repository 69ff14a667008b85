"""Files of a folder that a job has not yet taken in, and the list of those it has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.operators import lineage

#: What identifies a file: one that is written again counts as new.
FILE = "path string, length bigint, modified timestamp"


def taken(spark: SparkSession, ledger: str) -> DataFrame:
    if not lineage.exists(spark, f"{ledger.rstrip('/')}/_SUCCESS"):
        return spark.createDataFrame([], FILE)
    return spark.read.schema(FILE).parquet(ledger)


def waiting(spark: SparkSession, folder: str, ledger: str) -> DataFrame:
    """The files of ``folder`` that the ledger does not list. Only their names are read here."""
    listed = spark.read.format("binaryFile").load(folder).select(
        "path", "length", F.col("modificationTime").alias("modified"))
    return lineage.cut(listed.join(taken(spark, ledger), ["path", "length", "modified"], "left_anti"))


def lines(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The lines of these files as one column ``value``; None without any file."""
    paths = sorted(r["path"] for r in files.select("path").collect())
    return spark.read.text(paths) if paths else None


def take(files: DataFrame, ledger: str) -> None:
    """List the files as taken in. To be called when everything made of them is stored."""
    files.write.mode("append").parquet(ledger)
