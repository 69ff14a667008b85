"""The golden registry: every tech record next to the registry records of its entity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.operators import components
from corpweave.operators.standardize import run_time
from corpweave.settings import MatchRule

KEY = "corporate_id"


def attach_corporate_id(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Every record with its corporate id. ``ids`` holds each record id once."""
    return records.join(ids, "record_id", "left")


def _prefixed(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
    return df.selectExpr(KEY, *[f"{name} AS {prefix}{name}" for name in names])


def _tech(df: DataFrame) -> DataFrame:
    return _prefixed(df, schemas.SILVER_TECH.fieldNames(), "tech_")


def _registry(df: DataFrame) -> DataFrame:
    return _prefixed(df, schemas.SILVER_COMPANIES.fieldNames(), "reg_")


def _assemble(paired: DataFrame, alone: DataFrame, processing_ts: datetime | None) -> DataFrame:
    rows = paired.unionByName(alone, allowMissingColumns=True)
    return rows.withColumn("processing_ts", run_time(processing_ts)).select(
        *schemas.GOLDEN.fieldNames()
    )


def golden_rows(tech: DataFrame, registry: DataFrame,
                processing_ts: datetime | None = None) -> DataFrame:
    """Left join of the two sources on ``corporate_id``.

    Split into matched and unmatched tech rows: the matched part is an inner join, which may
    broadcast a small tech side, and of which adaptive execution splits a hot id on either side; the
    unmatched part only needs the distinct registry ids.
    """
    known = registry.select(KEY).distinct()
    return _assemble(
        _tech(tech).join(_registry(registry), KEY),
        _tech(tech).join(known, KEY, "left_anti"),
        processing_ts,
    )


def golden_by_name(tech: DataFrame, registry: DataFrame, rule: MatchRule = MatchRule(),
                   processing_ts: datetime | None = None) -> DataFrame:
    """Golden rows straight from the silver sources, without a match table.

    Registry records outside every entity are dropped before the wide join, and unmatched tech
    records are known from the linking, so no anti join is needed.
    """
    tech_linked, registry_linked = components.link_by_name(tech, registry, rule)
    return _assemble(
        _tech(tech_linked.where("linked")).join(_registry(registry_linked.where("linked")), KEY),
        _tech(tech_linked.where(~F.col("linked"))),
        processing_ts,
    )
