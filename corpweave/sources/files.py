"""Reading and writing the datasets of the pipeline."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpweave import schemas


def read(spark: SparkSession, source: str, needs: StructType | None = None) -> DataFrame:
    """A parquet folder, or a catalog table when ``source`` holds no slash.

    ``needs`` gives columns the frame must have and their types; one that is missing or of another
    type fails here, by name, instead of somewhere inside a plan.
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if needs is not None:
        missing = [name for name in needs.fieldNames() if name not in df.columns]
        if missing:
            raise ValueError(f"{source} lacks columns: {', '.join(missing)}")
        retyped = [
            f"{field.name} is {df.schema[field.name].dataType.simpleString()}, "
            f"not {field.dataType.simpleString()}"
            for field in needs if df.schema[field.name].dataType != field.dataType
        ]
        if retyped:
            raise ValueError(f"{source} has other types: {', '.join(retyped)}")
    return df


def read_golden_export(spark: SparkSession, path: str) -> DataFrame:
    """Golden rows exported as quoted CSV with a header; empty cells are NULL."""
    return (
        spark.read.option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS z")
        .schema(schemas.GOLDEN)
        .csv(path)
    )


def write(df: DataFrame, path: str) -> None:
    """Replace the dataset. Re-running a stage therefore never doubles its rows."""
    df.write.mode("overwrite").parquet(path)


def run_date(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d")


def dated(base: str, day: str) -> str:
    """The folder of one run under ``base``."""
    return f"{base.rstrip('/')}/{day}/"


def write_report(report: DataFrame, base: str, day: str) -> str:
    path = dated(base, day) + "report.json"
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
