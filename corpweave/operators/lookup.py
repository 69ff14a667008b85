"""Wording tables that are too large for a literal map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.operators import lineage
from corpweave.settings import NOT_AVAILABLE


def translated_by_table(df: DataFrame, column: str, table: DataFrame, old: str, new: str,
                        into: str | None = None, default: str | None = NOT_AVAILABLE) -> DataFrame:
    """``df`` with ``column`` looked up in ``table`` (from ``old`` to ``new``), as ``into``.

    What the table does not hold, and NULL, becomes ``default``; so does a NULL replacement. A wording
    with two different replacements fails the query, repeated equal rows count once, a NULL wording
    is ignored. The table is reduced to one row per wording and stored, so Spark knows its size: it
    broadcasts it when small and otherwise splits a value that a large share of ``df`` holds.
    """
    into = into or column
    known = table.where(F.col(old).isNotNull()).groupBy(F.col(old).alias("_old")).agg(
        F.min(new).alias("_new"), F.max(new).alias("_other"), (F.count(F.lit(1)) > F.count(new)).alias("_null"))
    differ = (F.col("_new") != F.col("_other")) | (F.col("_null") & F.col("_new").isNotNull())
    problem = F.raise_error(F.concat(F.lit("two replacements for "), F.col("_old").cast("string"))).cast("boolean")
    # In a filter, so that no choice of columns optimises the check away.
    one = lineage.cut(known.where(F.when(differ, problem).otherwise(True)).select("_old", "_new"))
    joined = df.join(one, F.col(column) == F.col("_old"), "left")
    names = [c for c in df.columns if c != into]
    return joined.select(*[F.col(f"`{c}`") for c in names], F.coalesce("_new", F.lit(default)).alias(into))
