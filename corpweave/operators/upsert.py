"""MERGE semantics as DataFrame code, for tables whose format has no MERGE of its own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.operators import lineage

DUPLICATES = ("error", "latest")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str],
           duplicates: str = "error", newest: str = "processing_ts",
           null_safe: Sequence[str] = (), as_laid_out: bool = False) -> DataFrame:
    """``target`` after an upsert of ``source``.

    A target row whose key occurs in the source takes all source values, NULLs included; source
    rows with a new key are inserted; other target rows stay. A NULL key equals nothing, so such
    source rows are always inserted, except for the key columns named in ``null_safe``.

    ``duplicates`` decides about several source rows of one key: ``error`` fails the query when
    they meet a target row and inserts them all otherwise, as MERGE does; ``latest`` keeps the
    one with the greatest ``newest`` (ties by the other columns, so the choice is stable).

    The target is only looked up against one row per source key. With a small source that is a
    broadcast and the target is not shuffled at all. With a large one a target table bucketed by
    the keys is not shuffled either, and ``as_laid_out`` keeps the source as it is, so that one
    bucketed alike is not: the merge then shuffles nothing. Only leave it off where keys may be hot.
    """
    if duplicates not in DUPLICATES:
        raise ValueError(f"duplicates must be one of {DUPLICATES}")
    names = target.columns
    staged = source.select(*names)
    one = _one_per_key(staged, names, keys, newest, null_safe)
    if not as_laid_out:
        # Stored, so that it has a known size, and so that adaptive execution can split the target
        # rows of a hot or NULL key: it does so only where no aggregate is next to the join.
        one = lineage.cut(one)
    updated = target.join(one, _same_key(target, one, keys, null_safe), "left")
    hit = F.col("_new").isNotNull()
    if duplicates == "error":
        # In a filter, so that no choice of columns optimises the check away.
        message = F.lit("several source rows match one target row")
        alone = F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
        updated = updated.where(alone)
    kept = updated.select(
        *[F.when(hit, F.col(f"_new.`{n}`")).otherwise(F.col(f"`{n}`")).alias(n) for n in names]
    )
    marks = _marks(keys)
    found = target.join(one.select(*marks), _same_key(target, one, keys, null_safe), "left_semi")
    present = found.select(*[F.col(k).alias(m) for k, m in zip(keys, marks)]).distinct()
    if duplicates == "latest":
        unmet = one.join(present, _same_marks(one, present, keys, null_safe), "left_anti")
        fresh = _latest(staged, unmet, names, keys, null_safe)
    else:
        fresh = staged.join(present, _same_key(staged, present, keys, null_safe), "left_anti")
    return kept.unionByName(fresh.select(*names))


def latest_per_key(source: DataFrame, keys: Sequence[str], newest: str = "processing_ts",
                   null_safe: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, and every row with a NULL key."""
    names = source.columns
    return _latest(source, _one_per_key(source, names, keys, newest, null_safe), names, keys, null_safe)


def _marks(keys: Sequence[str]) -> list[str]:
    """The key columns of the source, under names that no table has."""
    return [f"_key{i}" for i in range(len(keys))]


def _same_key(rows: DataFrame, one: DataFrame, keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    # On plain columns, so that tables bucketed by them meet without a shuffle.
    pairs = [(k, rows[k], one[m]) for k, m in zip(keys, _marks(keys))]
    return reduce(and_, [a.eqNullSafe(b) if k in null_safe else a == b for k, a, b in pairs])


def _same_marks(one: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    pairs = [(k, one[m], other[m]) for k, m in zip(keys, _marks(keys))]
    return reduce(and_, [a.eqNullSafe(b) if k in null_safe else a == b for k, a, b in pairs])


def _has_key(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    """Whether the key equals anything: a NULL does not, unless its column is null-safe."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys if k not in null_safe], F.lit(True))


def _one_per_key(staged: DataFrame, names: list[str], keys: Sequence[str], newest: str,
                 null_safe: Sequence[str]) -> DataFrame:
    order = [newest, *[n for n in names if n != newest]] if newest in names else names
    rows = staged.where(_has_key(keys, null_safe)).groupBy(
        *[F.col(k).alias(m) for k, m in zip(keys, _marks(keys))])
    return rows.agg(F.max(F.struct(*order)).alias("_new"), F.count(F.lit(1)).alias("_copies"))


def _latest(staged: DataFrame, one: DataFrame, names: list[str], keys: Sequence[str],
            null_safe: Sequence[str]) -> DataFrame:
    keyless = staged.where(~_has_key(keys, null_safe)).select(*names)
    return one.select("_new.*").select(*names).unionByName(keyless)
