"""Cutting lineage so that long plans survive the loss of executors."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The folder of every stored frame that is still in use, and all folders not yet deleted.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_MADE: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a private one only for a local session without any."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpweave-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else uses; it is deleted when the program ends."""
    folder = f"{shared_folder(spark)}/corpweave-{uuid.uuid4().hex}"
    _MADE[folder] = spark
    return folder


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Whatever runs inside deletes its shuffle files when it is through, instead of leaving them on the
    executors' disks until the driver collects garbage. For jobs whose result is stored; files lost
    while a job runs are made again as ever."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def cut(df: DataFrame, *partition_by: str, **options: int) -> DataFrame:
    """Store ``df`` in the shared folder and read it back.

    Unlike a plain checkpoint the stored copy has a known size, which later joins are planned by.
    """
    folder = new_folder(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        df.write.options(**options).parquet(folder, partitionBy=list(partition_by) or None)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    _FOLDERS[stored] = folder
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete the stored copies of frames made by ``cut`` that nobody will read again."""
    for frame in frames:
        folder = _FOLDERS.pop(frame, None)
        if folder is not None:
            delete(_MADE.pop(folder), folder)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits, in whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return len(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []) > 0


@atexit.register
def clear() -> None:
    """Delete every intermediate result of this program. Runs by itself when the program ends; frames
    built on stored copies can't be read afterwards."""
    _FOLDERS.clear()
    while _MADE:
        folder, spark = _MADE.popitem()
        with contextlib.suppress(Exception):  # the JVM may be gone already
            delete(spark, folder)
