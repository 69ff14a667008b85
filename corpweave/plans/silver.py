"""Stage 1: bronze to silver, and the match table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from corpweave import schemas
from corpweave.operators import matching, standardize
from corpweave.settings import MatchRule
from corpweave.sources import files


def run(spark: SparkSession, bronze_companies_path: str, bronze_tech_path: str,
        silver_companies_path: str, silver_tech_path: str, fuzzy_output_path: str | None = None,
        rule: MatchRule = MatchRule(), processing_ts: datetime | None = None) -> None:
    """Write both silver datasets once and match on what was written.

    Matching reads the stored columns it needs, so the bronze data is standardised only once. The
    match table holds one row per matching record pair; leave its path out when the golden stage
    links by name and nobody else needs the pairs.
    """
    tech = files.read(spark, bronze_tech_path, schemas.BRONZE_TECH)
    companies = files.read(spark, bronze_companies_path, schemas.BRONZE_COMPANIES)
    files.write(standardize.tech_companies(tech, processing_ts), silver_tech_path)
    files.write(standardize.company_registry(companies, processing_ts), silver_companies_path)
    if fuzzy_output_path:
        matches = matching.match_records(
            spark.read.parquet(silver_tech_path), spark.read.parquet(silver_companies_path), rule
        )
        files.write(matches, fuzzy_output_path)
