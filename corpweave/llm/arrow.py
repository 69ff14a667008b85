"""Small helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Texts are handled in slices of about this many bytes, so that temporary arrays stay small.
SLICE_BYTES = 1 << 20
# Bytes of texts that a task hands to Python at a time; Spark's own setting is eight times as much.
BATCH_BYTES = "8m"


CACHE = "cache_"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session set to hand its rows to Python in small batches from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def kept_by_worker(key: str, make: Callable):
    """What ``make`` returns, made once per Python worker process and reused by its later tasks.

    For read-only tables and bounded caches only: a lost worker just makes them again. A key that
    starts with ``CACHE`` is given up when the worker turns to an operator that has no use for it.
    """
    store = sys.modules.setdefault("_corpweave_worker", types.ModuleType("_corpweave_worker"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def giving_back(task: Callable, keep: str = "") -> Callable:
    """A task function over batches that returns freed memory to the system when it is through.

    Workers outlive their tasks, and what the allocator keeps of each adds up next to the executor. What
    other operators left is given up first; the cache named ``keep`` is this task's own.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        store = sys.modules.get("_corpweave_worker")
        for key in [k for k in vars(store or types) if k.startswith(CACHE) and k != keep]:
            delattr(store, key)
        if keep:
            _trim()
        try:
            yield from task(batches)
        finally:
            _trim()

    return run


def giving_back_group(task: Callable) -> Callable:
    """The same for a function of one whole group."""

    @functools.wraps(task)
    def run(group):
        try:
            return task(group)
        finally:
            _trim()

    return run


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without copying its texts one by one; null is empty."""
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def groups_of_rows(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``most`` bytes together, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j

