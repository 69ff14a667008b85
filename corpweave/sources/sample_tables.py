"""The given sample tables in the shape of the bronze datasets.

``part`` plays the company registry and ``customer`` the tech companies, whose names come from
the part with the same key. A word that three neighbouring parts share comes before each part's
name, so that a name occurs a few times at any scale. Of the tech names every third loses its last
letter and some have two letters changed or three added, so that near matches exist next to exact
ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpweave import schemas
from corpweave.functions.text import quoted

REGISTRY_ENDINGS = [" Inc.", " Ltd", ", LLC", " GmbH", " Holdings", ""]
TECH_ENDINGS = [" Inc", " Corporation", "", " Group", ", Co."]
REGISTRY_INDUSTRIES = [
    "Information Technology and Services", "Retail", "Computer Software", "Telecommunications",
    " Internet ", "Construction", None,
]
COUNTRY_TEXTS = [
    "United States", "Taiwan", "South Korea", "Netherlands", "Ireland", "Germany", "Japan",
    "Canada", "India", "France", "Australia", "China", "Switzerland", " United Kingdom ",
    "Brazil", None,
]
CAP_SUFFIXES = ["T", "B", "M", ""]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list[str | None], number: str) -> str:
    """The element of a fixed list at ``number`` modulo its length, as SQL text."""
    cells = ", ".join("NULL" if value is None else quoted(value) for value in values)
    return f"get(array({cells}), cast({number} % {len(values)} AS INT))"


NAMED = "concat(left(sha2(cast(p_partkey div 3 AS STRING), 256), 5), ' ', p_name) AS p_name"


def bronze_companies(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    named = parts.selectExpr(*[c for c in parts.columns if c != "p_name"], NAMED)
    return named.selectExpr(
        f"concat(p_name, {pick(REGISTRY_ENDINGS, 'p_partkey')}) AS name",
        "CASE WHEN p_size % 5 <> 0 THEN concat(replace(p_name, ' ', '-'), '.example.com') END "
        "AS domain",
        "CASE WHEN p_size % 7 <> 0 THEN cast(1950 + p_size AS DOUBLE) END AS year_founded",
        f"{pick(REGISTRY_INDUSTRIES, 'p_partkey')} AS industry",
        "p_type AS size_range",
        "p_brand AS locality",
        f"{pick(COUNTRY_TEXTS, 'p_partkey')} AS country",
        "concat('https://social.example.com/', p_partkey) AS linkedin_url",
        "cast(p_size * 10 AS BIGINT) AS current_employee_estimate",
        "cast(p_size * 25 + p_partkey % 10 AS BIGINT) AS total_employee_estimate",
    ).select(*schemas.BRONZE_COMPANIES.fieldNames())


def bronze_tech(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "part").selectExpr("p_partkey AS c_custkey", NAMED)
    stem = (
        "CASE WHEN c_custkey % 3 = 0 THEN left(p_name, length(p_name) - 1) "
        "WHEN c_custkey % 7 = 1 THEN concat(left(p_name, length(p_name) - 2), '99') "
        "WHEN c_custkey % 11 = 2 THEN concat(p_name, 'xyz') ELSE p_name END"
    )
    return (
        table(spark, folder, "customer")
        .hint("merge")  # its files are far smaller than its rows
        .join(names, "c_custkey")
        .selectExpr(
            "cast(c_custkey AS INT) AS ranking",
            f"concat({stem}, {pick(TECH_ENDINGS, 'c_custkey')}) AS company",
            f"concat('$', cast(c_acctbal AS STRING), {pick(CAP_SUFFIXES, 'c_custkey')}) "
            "AS market_cap",
            "c_name AS stock",
            f"{pick(COUNTRY_TEXTS, 'c_nationkey')} AS country",
            "c_mktsegment AS sector",
            "CASE WHEN c_custkey % 13 = 0 THEN 'N/A' WHEN c_custkey % 11 <> 0 THEN c_mktsegment "
            "END AS industry",
        )
        .select(*schemas.BRONZE_TECH.fieldNames())
    )
