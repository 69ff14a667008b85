"""Names within a few edits, found by running a Levenshtein automaton over a prefix tree.

One side's names are sorted and cut into tiles, ranges of bounded size; a sorted range is a prefix tree
of which each level is an array of nodes. For a group of names of the other side the tree is walked once, all
nodes of a level together: every name that can still be completed waits at its nodes with the band of the
edit-distance table, and a name without edits left looks up the one or two letters it can go on with. A name is sent only to tiles whose common prefix the automaton
survives, which the same walk over the tiles' prefixes tells. Memory follows the longest name and the
size of a group, whatever the reach; nothing is generated from a name.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.operators import lineage
from corpweave.settings import BLOCK_LENGTH

#: Names of a tile, and names that walk its tree together.
TILE_NAMES, WALKING_NAMES = 5_000, 5_000
#: Names waiting at nodes that take a step at a time, some 100 bytes each.
TOGETHER = 250_000


class Tree(NamedTuple):
    """The prefix tree of sorted words, level by level; a word's end counts as a letter, 0."""

    letters: np.ndarray  # all letters, in order
    levels: list[np.ndarray]  # of every level: parent * number of letters + letter of its nodes, in order
    words: list[np.ndarray]  # of every level: the word of a node that is a word's end, else -1


def _codes(names: list[str], spare: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points of every name plus 1 as a row, padded with zeros; lengths)."""
    lengths = np.array([len(n) for n in names], np.int64)
    table = np.zeros((len(names), int(lengths.max(initial=0)) + spare), np.uint32)
    table[np.arange(table.shape[1]) < lengths[:, None]] = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32) + np.uint32(1)
    return table, lengths


def _tree(words: list[str]) -> Tree:
    codes, _ = _codes(words, 1)
    letters = np.unique(np.append(codes.ravel(), 0))
    levels, ends, row, node = [], [], np.arange(len(words)), np.zeros(len(words), np.int64)
    for column in codes.T:
        letter = column[row]
        key = node * len(letters) + np.searchsorted(letters, letter)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[:len(key)]
        levels.append(key[first])
        ends.append(np.where(letter[first] == 0, row[first], -1))
        node = np.cumsum(np.append(True, key[1:] != key[:-1])[:len(key)]) - 1
        row, node = row[letter > 0], node[letter > 0]
        if not len(row):
            break
    return Tree(letters, levels, ends)


def _step(state: np.ndarray, tails: np.ndarray, left: np.ndarray, name: np.ndarray, depth: int, letter: np.ndarray,
          reach: int) -> np.ndarray:
    """The bands one level deeper, at ``depth``, along a letter each. Place t of a band stands for the first
    ``depth + t - reach`` letters of a name."""
    width, over = 2 * reach + 1, np.int8(reach + 1)
    found = np.full(state.shape, over, np.int8)
    for t in range(max(0, reach - depth), width):
        taken = depth + t - reach
        best = np.full(len(name), over, np.int8)
        if taken and taken <= tails.shape[1]:
            best = state[t] + (tails[name, taken - 1] != letter)
        if t + 1 < width:
            best = np.minimum(best, state[t + 1] + np.int8(1))
        if t:
            best = np.minimum(best, found[t - 1] + np.int8(1))
        found[t] = np.where(left[name] >= taken, np.minimum(best, over), over)
    return found


def _looked_up(level: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries of ``at``, child of each) where a child with that key exists."""
    child = np.minimum(np.searchsorted(level, key), len(level) - 1)
    there = level[child] == key
    return at[there], child[there]


def _children(tree: Tree, node: np.ndarray, name: np.ndarray, state: np.ndarray, depth: int, tails: np.ndarray,
              reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, child) of all children, other than ends, that can be within reach below.

    Where a name has edits left all children are. Where it has none, only a letter that the name itself
    goes on with keeps it alive, and these children are looked up.
    """
    count, level = len(tree.letters), tree.levels[depth]
    spent = (state >= reach).all(0)
    free = np.flatnonzero(~spent)
    first = np.searchsorted(level, node[free] * count + 1)
    size = np.searchsorted(level, (node[free] + 1) * count) - first
    entries, children = [np.repeat(free, size)], [np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
    bound = np.flatnonzero(spent)
    before: list[np.ndarray] = []
    for t in range(2 * reach + 1):
        taken = depth + 1 - BLOCK_LENGTH + t - reach
        if taken < 1 or taken > tails.shape[1]:
            continue
        wanted = np.where(state[t, bound] == reach, tails[name[bound], taken - 1], 0)
        new = wanted > 0
        for other in before:
            new &= wanted != other
        before.append(wanted)
        letter = np.minimum(np.searchsorted(tree.letters, wanted[new]), count - 1)
        held = tree.letters[letter] == wanted[new]
        at = bound[new][held]
        entry, child = _looked_up(level, at, node[at] * count + letter[held])
        entries.append(entry)
        children.append(child)
    return np.concatenate(entries), np.concatenate(children)


def meetings(names: list[str], words: list[str], reach: int, prefixes: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows of ``names``, rows of the sorted distinct ``words``, edits): all pairs within ``reach`` edits, each
    once; the first letters, the block, must be equal. With ``prefixes`` a word stands for everything that
    begins with it, and the edits say nothing.

    Names wait at nodes of the tree, all of one level go down together, and no more than ``TOGETHER``.
    """
    if not names or not words:
        return
    codes, lengths = _codes(names, BLOCK_LENGTH)
    # The band belongs to what follows the block.
    tails, left, tree = np.ascontiguousarray(codes[:, BLOCK_LENGTH:]), lengths - BLOCK_LENGTH, _tree(words)
    start = np.full((2 * reach + 1, len(names)), reach + 1, np.int8)
    start[reach:] = np.arange(reach + 1)[:, None]
    start[np.arange(2 * reach + 1)[:, None] - reach > np.maximum(left, 0)] = reach + 1
    count = len(tree.letters)
    waiting = [(0, np.zeros(len(names), np.int64), np.arange(len(names)), start)]
    while waiting:
        depth, node, name, state = waiting.pop()
        if len(name) > TOGETHER:
            half = len(name) // 2
            waiting += [(depth, node[s], name[s], state[:, s]) for s in (slice(half), slice(half, None))]
            continue
        if not len(name):
            continue
        level = tree.levels[depth]
        at, end = _looked_up(level, np.arange(len(name)), node * count)
        edits = np.zeros(len(at), np.int8)
        if not prefixes:  # a name of other length is that many edits away
            place = lengths[name[at]] - depth + reach
            inside = (place >= 0) & (place <= 2 * reach)
            edits = np.where(inside, state[np.where(inside, place, 0), at], reach + 1)
            near = edits <= reach
            at, end, edits = at[near], end[near], edits[near]
        if len(at):
            yield name[at], tree.words[depth][end], edits
        if depth < BLOCK_LENGTH:
            letter = np.minimum(np.searchsorted(tree.letters, codes[name, depth]), count - 1)
            at = np.flatnonzero((tree.letters[letter] == codes[name, depth]) & (letter > 0))
            at, child = _looked_up(level, at, node[at] * count + letter[at])
            waiting.append((depth + 1, child, name[at], state[:, at]))
            continue
        entry, child = _children(tree, node, name, state, depth, tails, reach)
        for i in range(0, len(entry), TOGETHER):
            some, below = entry[i:i + TOGETHER], child[i:i + TOGETHER]
            deeper = _step(state[:, some], tails, left, name[some], depth + 1 - BLOCK_LENGTH,
                           tree.letters[level[below] % count], reach)
            still = np.flatnonzero((deeper <= reach).any(0))
            waiting.append((depth + 1, below[still], name[some[still]], deeper[:, still]))


def walk(names: list[str], words: list[str], reach: int, prefixes: bool = False) -> Iterator[tuple[np.ndarray, int]]:
    """``meetings`` word by word: (rows of ``names``, a row of ``words``)."""
    for rows, ends, _ in meetings(names, words, reach, prefixes):
        order = np.argsort(ends, kind="stable")
        at = np.flatnonzero(np.diff(ends[order], prepend=-1))
        for word, some in zip(ends[order][at].tolist(), np.split(rows[order], at[1:])):
            yield some, word


def _compare(reach: int):
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        shape = pa.schema([("left_name", pa.string()), ("right_name", pa.string()), ("name_distance", pa.int32())])
        names = left["name"].combine_chunks()
        words = pc.take(right["name"], pc.sort_indices(right["name"])).combine_chunks()
        found = [pa.RecordBatch.from_arrays(
                     [names.take(pa.array(rows)), words.take(pa.array(ends)), pa.array(edits, pa.int32())], schema=shape)
                 for rows, ends, edits in meetings(names.to_pylist(), words.to_pylist(), reach)]
        return pa.Table.from_batches(found, shape)

    return compare


def candidates(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """``pairs`` without their distance."""
    return pairs(left, right, reach).select("left_name", "right_name")


def pairs(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """(left_name, right_name, name_distance): every pair within ``reach`` edits that agrees in its block,
    once. Both inputs hold distinct values in ``name``."""
    left, right = (side.select("name").where("name IS NOT NULL") for side in (left, right))
    count = right.count()
    ranged = right.repartitionByRange(-(-count // TILE_NAMES) or 1, "name")
    tiles = lineage.cut(ranged.withColumn("tile", F.spark_partition_id()))
    # One row per TILE_NAMES names.
    bounds = tiles.groupBy("tile").agg(F.min("name"), F.max("name")).orderBy("tile").collect()
    leading: dict[str, list[int]] = {}
    for tile, low, high in bounds:
        leading.setdefault(os.path.commonprefix([low, high]), []).append(tile)
    words = sorted(leading)

    @F.arrow_udf("array<int>")
    def reached(column: pa.Array) -> pa.Array:
        names = column.to_pylist()
        found: list[list[int]] = [[] for _ in names]
        for rows, word in walk(names, words, reach, prefixes=True):
            for i in rows.tolist():
                found[i] += leading[words[word]]
        return pa.array(found, pa.list_(pa.int32()))

    sent = lineage.cut(left.select("name", F.explode(reached("name")).alias("tile")))
    counted = lineage.cut(sent.groupBy("tile").agg(
        F.ceil(F.count(F.lit(1)) / WALKING_NAMES).cast("int").alias("parts")))
    # A group is little data but much work, so each gets a task of its own.
    groups, parts = counted.agg(F.sum("parts")).first()[0] or 1, F.broadcast(counted)
    lefts = sent.join(parts, "tile").select("tile", F.pmod(F.xxhash64("name"), "parts").cast("int").alias("part"), "name")
    rights = tiles.join(parts, "tile").select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "name")
    keys = ["tile", "part"]
    lefts, rights = (side.repartition(groups, *keys) for side in (lefts, rights))
    grouped = lefts.groupBy(*keys).cogroup(rights.groupBy(*keys))
    return grouped.applyInArrow(_compare(reach), "left_name string, right_name string, name_distance int")
