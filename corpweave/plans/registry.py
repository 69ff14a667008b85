"""Stage 3: golden rows into the registry table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from corpweave import schemas
from corpweave.sources import files, registry_table

# One golden row per tech record and registry record of an entity.
ROW_KEY = ("corporate_id", "tech_record_id", "reg_record_id")


def create(spark: SparkSession, table: str, location: str | None = None) -> None:
    registry_table.create(spark, table, location)


def run(spark: SparkSession, staging_path: str, table: str, keys: Sequence[str] = ("corporate_id",),
        duplicates: str = "error") -> None:
    """Check the contract and upsert. ``table`` is a catalog table name or a folder of buckets.

    Golden rows repeat a corporate id when an entity has several registry records, which a merge on
    that id alone refuses on the second run. Add key columns that tell the rows apart, starting
    with ``ROW_KEY``, to keep them all, or pass ``duplicates="latest"`` to keep one per key. Key
    columns other than the corporate id may be NULL, as they are in unmatched rows.
    """
    staged = files.read(spark, staging_path, schemas.GOLDEN)
    null_safe = [k for k in keys if k != registry_table.KEY]
    if "/" in table:
        registry_table.upsert(spark, table, staged, keys, duplicates, null_safe=null_safe,
                              bucket_by=registry_table.KEY)
    else:
        registry_table.merge_into(spark, table, staged, keys, duplicates, null_safe)
