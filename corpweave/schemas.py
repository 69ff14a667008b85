"""Column contracts of every stored dataset."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

TEXT, WHOLE, COUNT, NUMBER = StringType(), IntegerType(), LongType(), DoubleType()
FLAG, DAY, TIME = BooleanType(), DateType(), TimestampType()


def columns(*groups: tuple[str, DataType]) -> StructType:
    """Each group is a space-separated list of column names and their common type."""
    return StructType([StructField(n, kind) for names, kind in groups for n in names.split()])


BRONZE_TECH = columns(
    ("ranking", WHOLE), ("company market_cap stock country sector industry", TEXT)
)

BRONZE_COMPANIES = columns(
    ("name domain", TEXT), ("year_founded", NUMBER),
    ("industry size_range locality country linkedin_url", TEXT),
    ("current_employee_estimate total_employee_estimate", COUNT),
)

SILVER_TECH = columns(
    ("record_id source_system company company_name_normalised industry_std country_std", TEXT),
    ("market_cap_usd estimated_revenue", NUMBER),
    ("processing_ts", TIME),
)

SILVER_COMPANIES = columns(
    ("record_id source_system company company_name_normalised domain industry_std country_std",
     TEXT),
    ("year_founded", NUMBER),
    ("current_employee_estimate total_employee_estimate", COUNT),
    ("processing_ts", TIME),
)

MATCHES = columns(
    ("left_source_system right_source_system left_id right_id", TEXT),
    ("name_distance", WHOLE), ("match_confidence", NUMBER), ("match_type", TEXT),
)

GOLDEN = StructType(
    [StructField("corporate_id", TEXT)]
    + [StructField("tech_" + field.name, field.dataType) for field in SILVER_TECH]
    + [StructField("reg_" + field.name, field.dataType) for field in SILVER_COMPANIES]
    + [StructField("processing_ts", TIME)]
)

PAIR_REQUEST = columns(("left_id right_id left_company_name right_company_name", TEXT))

VERDICT = columns(("left_id right_id", TEXT), ("match", FLAG), ("match_confidence", NUMBER))

NEWS_DOCUMENT = columns(
    ("corporate_id company current_date", TEXT),
    ("items", ArrayType(columns(("date title url corporate_id", TEXT)))),
)

NEWS_ITEM = columns(
    ("corporate_id company", TEXT), ("current_date date", DAY), ("title url", TEXT)
)

RUN_REPORT = columns(
    ("model", TEXT), ("train_rows test_rows", COUNT), ("metrics", columns(("mae", NUMBER)))
)
