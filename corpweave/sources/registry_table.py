"""Where upserted rows live: an Iceberg table when a catalog is configured, else parquet.

Without a catalog the table is a folder of hash buckets of one key column, and an upsert overwrites the
buckets it touches, by Spark's dynamic partition overwrite. This serves one writer at a time, and no
reader meanwhile; it is not a multi-writer table format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave import schemas, settings
from corpweave.operators import lineage
from corpweave.operators.contract import check_contract
from corpweave.operators.upsert import latest_per_key, merged

KEY = "corporate_id"
BUCKET = "bucket"


def use_iceberg(spark: SparkSession, catalog: str, warehouse: str, **options: str) -> None:
    """Register an Iceberg catalog for the session and make it the default one.

    ``options`` are further catalog settings by name, with ``_`` for ``-``, such as
    ``catalog_impl`` or ``io_impl``. The Iceberg runtime and its SQL extensions must be on the
    cluster already.
    """
    prefix = f"spark.sql.catalog.{catalog}"
    spark.conf.set(prefix, "org.apache.iceberg.spark.SparkCatalog")
    spark.conf.set(f"{prefix}.warehouse", warehouse)
    for name, value in options.items():
        spark.conf.set(f"{prefix}.{name.replace('_', '-')}", value)
    spark.conf.set("spark.sql.defaultCatalog", catalog)


def create_sql(table: str, location: str | None = None) -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.GOLDEN)
    place = f" LOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE {table} ({columns}) USING iceberg "
        f"PARTITIONED BY (bucket({settings.TABLE_BUCKETS}, {KEY})){place} "
        "TBLPROPERTIES ('format-version'='2', 'write.format.default'='parquet', "
        "'write.parquet.compression-codec'='zstd')"
    )


def create(spark: SparkSession, table: str, location: str | None = None) -> None:
    spark.sql(create_sql(table, location))


def merge_sql(table: str, view: str, keys: Sequence[str] = (KEY,),
              null_safe: Sequence[str] = ()) -> str:
    on = " AND ".join(
        f"target.{k} {'<=>' if k in null_safe else '='} source.{k}" for k in keys
    )
    return (
        f"MERGE INTO {table} AS target USING {view} AS source ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge_into(spark: SparkSession, table: str, staged: DataFrame, keys: Sequence[str] = (KEY,),
               duplicates: str = "error", null_safe: Sequence[str] = ()) -> None:
    """Contract check, then MERGE in the table's own format, which itself refuses several source
    rows for one target row."""
    check_contract(staged, spark.table(table))
    if duplicates == "latest":
        staged = latest_per_key(staged, keys, null_safe=null_safe)
    view = "staged_" + table.replace(".", "_")
    staged.createOrReplaceTempView(view)
    spark.sql(merge_sql(table, view, keys, null_safe))


def in_catalog(table: str) -> bool:
    """A name without a slash is a catalog table, any other a folder of buckets."""
    return "/" not in table


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(settings.TABLE_BUCKETS)).cast("int")


def _pending(root: str) -> str:
    # Spark's readers pass over names that begin like this.
    return f"{root.rstrip('/')}/_pending"


def _replace_buckets(spark: SparkSession, root: str) -> None:
    """Put the finished new buckets in the place of the old ones. May be repeated at will."""
    changed = spark.read.parquet(_pending(root))
    out = changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.option("compression", "zstd").partitionBy(BUCKET).parquet(root)
    lineage.delete(spark, _pending(root))


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of a folder of buckets, None before the first row. Ends a replacement that was cut
    short."""
    if lineage.exists(spark, f"{_pending(root)}/_SUCCESS"):
        _replace_buckets(spark, root)
    if not lineage.exists(spark, f"{root.rstrip('/')}/{BUCKET}=*"):
        return None
    return spark.read.parquet(root).drop(BUCKET)


def stored(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of a catalog table or of a folder of buckets."""
    return spark.table(table) if in_catalog(table) else current(spark, table)


def _touched(staged: DataFrame, bucket_by: str) -> list[int]:
    return sorted(r[0] for r in staged.select(_bucket(bucket_by)).distinct().collect())  # at most TABLE_BUCKETS


def stored_near(spark: SparkSession, table: str, staged: DataFrame, bucket_by: str = KEY) -> DataFrame | None:
    """The stored rows that may share a key with ``staged``: of a folder only the buckets it falls into."""
    rows = stored(spark, table)
    if rows is None or in_catalog(table):
        return rows
    return spark.read.parquet(table).where(F.col(BUCKET).isin(_touched(staged, bucket_by))).select(*rows.columns)


def store(spark: SparkSession, table: str, staged: DataFrame, keys: Sequence[str] = (KEY,)) -> None:
    """Upsert by the table's own MERGE, or into the buckets of a folder."""
    (merge_into if in_catalog(table) else upsert)(spark, table, staged, keys)


def upsert(spark: SparkSession, root: str, staged: DataFrame, keys: Sequence[str] = (KEY,),
           duplicates: str = "error", newest: str = "processing_ts", null_safe: Sequence[str] = (),
           bucket_by: str | None = None) -> list[int]:
    """Contract check and merge in place: only buckets that hold a key of ``staged`` are read and
    written, and these are returned.

    ``bucket_by`` is one of the keys, by default the first, and must be the same at every call. The
    new buckets are stored completely before they replace the old ones, so a run that dies leaves
    either the old table or a replacement that the next reader or writer ends; running the same upsert
    again changes nothing. One writer at a time. The first run merges with an empty table, so it
    follows the same rules. The rebalance hint lets Spark split a bucket that is far larger than the rest.
    """
    bucket_by = bucket_by or keys[0]
    if bucket_by not in keys:
        raise ValueError(f"{bucket_by} is not one of the keys {', '.join(keys)}")
    before = current(spark, root)
    target = spark.createDataFrame([], staged.schema) if before is None else before
    check_contract(staged, target)
    staged = lineage.cut(staged)
    touched = _touched(staged, bucket_by)
    if not touched:
        return []
    if before is not None:
        target = spark.read.parquet(root).where(F.col(BUCKET).isin(touched)).select(*target.columns)
    rows = merged(target, staged, keys, duplicates, newest, null_safe)
    rows = rows.withColumn(BUCKET, _bucket(bucket_by)).hint("rebalance", BUCKET)
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(_pending(root))
    _replace_buckets(spark, root)
    return touched


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], path: str | None = None,
                  buckets: int = settings.TABLE_BUCKETS) -> DataFrame:
    """Store ``df`` as a catalog table bucketed by ``keys``. Tables that are bucketed alike meet on
    these keys without a shuffle."""
    # One task per bucket, so each bucket is one file.
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *keys).option("compression", "zstd")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
