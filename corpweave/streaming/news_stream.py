"""Result files that arrive during the day, merged into the news table as they come.

The stream keeps the newest item of every corporate id and url as keyed state, and only items newer
than that go on to the table. So what arrives late or again costs no read and no write of the table.
The table still has the last word: of what goes on, only what is newer than the stored row is
written, so a progress folder may be lost and other writers may come in between.

State does not expire by the clock: a query with expiry never runs out of batches, and this one ends
when it has read everything. It is as large as the keys and dates of the table and lies on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpweave import schemas
from corpweave.operators import lineage, news
from corpweave.sources import registry_table

#: This store holds keyed state on disk.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def news_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of JSON documents, one per line, from the files of a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def newest_so_far(items: DataFrame) -> DataFrame:
    """Of a stream of items those newer than all items of their corporate id and url before, at most
    one of each key in a batch.

    A streaming aggregate: the state of a key is its newest item and the time of the batch that brought
    it first. An update is passed on if that is this batch. Should the clock give two batches one time,
    an item may be passed on again, but none is kept back.
    """
    since = -F.unix_millis(F.current_timestamp())  # in a stream the time of the batch, also when it is replayed
    newer_by = [F.col(f"`{name}`") for name in [*news.NEWER_BY, "_since"]]
    last = items.withColumn("_since", since).groupBy(*news.ITEM_KEY).agg(F.max(F.struct(*newer_by)).alias("_last"))
    fresh = last.where(F.col("_last._since") == since)
    return fresh.select(*news.ITEM_KEY, "_last.*").select(*[f"`{name}`" for name in items.columns])


def merge_batch(batch: DataFrame, table: str, quarantine: str, batch_id: int) -> None:
    """Upsert the items of one batch, those without ``error``, and store what was refused.

    Both writes give the same result when a batch is replayed after a failure: the upsert is keyed
    and the refused rows replace those of the same batch.
    """
    spark = batch.sparkSession
    batch = lineage.cut(batch)
    items = news.accepted(batch)
    if items.head(1):
        near = registry_table.stored_near(spark, table, items, news.ITEM_KEY[0])
        registry_table.store(spark, table, news.overtaking(items, near), news.ITEM_KEY)
    news.refused(batch).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")


def start(lines: DataFrame, table: str, quarantine: str, progress: str) -> StreamingQuery:
    """Process everything available and stop; run it on a schedule or from a trigger.

    ``progress`` is the stream's checkpoint folder, which holds the state too. No watermark is needed.
    """
    entries = news.read_news(lines)
    items = newest_so_far(news.accepted(entries)).withColumns({c: F.lit(None).cast("string") for c in ("entry", "error")})
    refused = news.refused(entries).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.NEWS_ITEM], "entry", "error")
    spark = lines.sparkSession
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        return (
            items.unionByName(refused).writeStream.outputMode("update").foreachBatch(
                lambda batch, batch_id: merge_batch(batch, table, quarantine, batch_id)
            )
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        # The query has taken its settings with it.
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
