"""Bronze records to silver records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave import schemas, settings
from corpweave.functions import text


def run_time(processing_ts: datetime | None) -> Column:
    """The given time, or the start of the query."""
    return F.current_timestamp() if processing_ts is None else F.lit(processing_ts)


def tidy_strings(df: DataFrame) -> DataFrame:
    """Lower-case and trim every string column, leave the others alone."""
    return df.selectExpr(
        *[
            f"{text.tidy(f'`{name}`')} AS `{name}`" if kind == "string" else f"`{name}`"
            for name, kind in df.dtypes
        ]
    )


def tech_companies(bronze: DataFrame, processing_ts: datetime | None = None,
                   strict_amounts: bool = False) -> DataFrame:
    """Silver tech companies. Their industry is kept as it is: it is the target wording."""
    tidy = tidy_strings(bronze)
    cap = text.amount_usd("market_cap", strict_amounts)
    silver = tidy.selectExpr(
        f"{text.record_id(settings.TECH_SOURCE, 'company', 'country', 'industry')} AS record_id",
        f"'{settings.TECH_SOURCE}' AS source_system",
        "company",
        f"{text.company_key('company')} AS company_name_normalised",
        "industry AS industry_std",
        f"{text.known_or_na('country')} AS country_std",
        f"{cap} AS market_cap_usd",
        f"{cap} / {settings.REVENUE_DIVISOR} AS estimated_revenue",
    ).withColumn("processing_ts", run_time(processing_ts))
    return silver.select(*schemas.SILVER_TECH.fieldNames())


def company_registry(bronze: DataFrame, processing_ts: datetime | None = None) -> DataFrame:
    """Silver registry companies."""
    tidy = tidy_strings(bronze)
    silver = tidy.selectExpr(
        f"{text.record_id(settings.REGISTRY_SOURCE, 'name', 'country', 'industry')} AS record_id",
        f"'{settings.REGISTRY_SOURCE}' AS source_system",
        "name AS company",
        f"{text.company_key('name')} AS company_name_normalised",
        "domain",
        f"{text.translated('industry')} AS industry_std",
        f"{text.known_or_na('country')} AS country_std",
        "year_founded",
        "current_employee_estimate",
        "total_employee_estimate",
    ).withColumn("processing_ts", run_time(processing_ts))
    return silver.select(*schemas.SILVER_COMPANIES.fieldNames())
