"""Stage 2: entities and the golden registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from corpweave import schemas
from corpweave.operators import components, golden
from corpweave.settings import MatchRule
from corpweave.sources import files


def run(spark: SparkSession, silver_companies_path: str, silver_tech_path: str,
        golden_corporate_registry: str, fuzzy_matches_path: str | None = None,
        extra_edges: DataFrame | None = None, rule: MatchRule = MatchRule(),
        processing_ts: datetime | None = None) -> None:
    """With a match table its pairs (and any ``extra_edges``, such as adjudicated ones) define the
    entities. Without one they follow from the names under ``rule``, with equal results."""
    companies = files.read(spark, silver_companies_path, schemas.SILVER_COMPANIES)
    tech = files.read(spark, silver_tech_path, schemas.SILVER_TECH)
    if fuzzy_matches_path is None:
        if extra_edges is not None:
            raise ValueError("extra edges need a match table to extend")
        rows = golden.golden_by_name(tech, companies, rule, processing_ts)
    else:
        links = components.edges(files.read(spark, fuzzy_matches_path, schemas.MATCHES))
        if extra_edges is not None:
            links = links.unionByName(extra_edges.select("src", "dst"))
        ids = components.corporate_ids(components.vertices(companies, tech), links)
        rows = golden.golden_rows(
            golden.attach_corporate_id(tech, ids),
            golden.attach_corporate_id(companies, ids),
            processing_ts,
        )
    files.write(rows, golden_corporate_registry)
