"""Model features of the golden rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.settings import NOT_AVAILABLE

LABEL = "log_tech_estimated_revenue"
NUMERIC = ["log_reg_total_employee_estimate", "log_company_age"]
CATEGORY = "industry_std"


def _given(value: Column) -> Column:
    return F.nullif(value, F.lit(NOT_AVAILABLE))


def with_features(golden: DataFrame, as_of: date | None = None) -> DataFrame:
    """Golden rows plus industry, company age and the three log features.

    The tech industry wins unless it is missing or 'N/A'. ``as_of`` fixes the year the age is
    counted to; by default it is the current one. The logarithm of an age of -1 or less is NULL.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    age = F.year(today) - F.col("reg_year_founded")
    return golden.select(
        "*",
        _given(F.coalesce(_given(F.col("tech_industry_std")), F.col("reg_industry_std")))
        .alias(CATEGORY),
        age.alias("company_age"),
        F.log1p(age).alias("log_company_age"),
        F.log1p("reg_total_employee_estimate").alias("log_reg_total_employee_estimate"),
        F.log1p("tech_estimated_revenue").alias(LABEL),
    )


def is_complete() -> Column:
    """Whether every model input and the label are present, as ``complete`` keeps them."""
    given = F.col(CATEGORY).isNotNull()
    for name in [*NUMERIC, LABEL]:
        given &= F.col(name).isNotNull() & ~F.isnan(name)
    return given


def complete(features: DataFrame) -> DataFrame:
    """Rows with every model input and the label present (neither NULL nor NaN)."""
    return features.dropna(subset=[CATEGORY, *NUMERIC, LABEL])
