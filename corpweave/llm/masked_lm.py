"""Scoring texts by masked pseudo-likelihood under a small network that sees both sides of a word.

Words are 64-bit hashes. The corpus gives a count per word, by a Spark aggregate over all texts, so
the vocabulary follows the corpus; counts never pass the driver and are joined to the words of texts
by Spark. A word lies in one of ``BUCKETS`` by the first bits of its hash. The words of a bucket, by
falling count, are halved by counts again and again down to single words. So every word has its own
way down a binary tree, and its chance is the product of those of the turns on it. For every word the
network reads the two words before and the two after it, beyond the text's ends a border, and shifts
the log-odds of every turn, which counts alone give before training. The sum of the log-chances of
all words is the text's score.

Every node down to the first turn inside a bucket has weights of its own; deeper ones share
``SHARED`` sets of weights by a hash of the way, and keep their own odds. Words that the corpus does
not hold share a part of their bucket, which counts alone decide: all such parts together are as
large as the words that occur once, but none is larger than one such word. So the chances of all
known words and of these parts sum to one.

A word's vector is the sum of two rows of a table, picked by different bits of its hash. The network
is trained on all texts in ``ROUNDS`` rounds: each part starts from the weights of the round before and
goes once through its words in batches, and the weights are averaged by number of words, summed by
Spark. Each part takes part in one round, however many there are. Parts and rounds
depend on the rows and not on files or partitions. What reaches the driver is one count per bucket and
one set of weights a round.

Texts are dealt to parts of about ``PART_BYTES`` by a hash of the row; small parts share a block of
about that size. Once per block the words of its texts and the ways to them are stored, in one row. Ways
travel to a block with many words to a row, and the blocks of one round are stored before those of the
next, so that the texts and ways of one round are all that is shuffled at a time.
Ways of the most frequent words, at most ``FREQUENT``, are not shuffled but broadcast. A null or
wordless text has no tokens, score 0 and no mean. Rows are scored one by one, repeated rows get equal
scores; other columns than the id and the text are ignored. Without any word in the corpus nothing is
trained.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.llm.arrow import groups_of_rows, in_small_batches, utf8
from corpweave.llm.words import mix, word_hashes
from corpweave.operators import lineage

VOCABULARY = 1 << 14  # rows of the table of vectors, a border's beyond them
LEVELS = 12
BUCKETS = 1 << LEVELS
DENSE = 6  # levels whose nodes are computed for every word
SHARED = 2 * BUCKETS  # sets of weights for nodes below a bucket's first
NEAR_BUCKETS = 16  # buckets whose words are halved by one call
DEPTH = 8
SIDE = 2
HIDDEN = 24
BATCH = 4096  # words scored at a time
TRAIN_BATCH = 4096  # words of a training step
RATE = 0.1
START = 1.0  # of the sums of squared gradients; little evidence moves little
ROUNDS = 4
CHUNK = 1 << 14  # weights of a row when they are averaged
PART_BYTES = 1 << 23
SMALL_PART_BYTES = 1 << 17
FILE_BLOCKS = 1  # so that a round's blocks spread over its tasks
PACKED_WORDS = 1 << 18  # words whose ways a task packs at a time
FREQUENT = 1 << 17  # words whose ways every task holds, some 60 bytes each
SMALL_PARTS = 64  # small corpora have parts below PART_BYTES, up to so many

SHAPES = {"words": (VOCABULARY + 1, DEPTH), "hidden": (2 * SIDE * DEPTH, HIDDEN), "hidden_bias": (HIDDEN,),
          "out": (2 * BUCKETS + SHARED, HIDDEN)}


TEXT_TYPES = {"parts": np.int32, "sizes": np.int64, "rows": np.int32}
WAY_TYPES = {"word": np.int64, "depth": np.int16, "turns": np.int16, "odds": np.float32, "alike": np.int32, "place": np.int32}
PER_TURN = ("turns", "odds")  # the others have one value per word
BLOCK_TYPES = TEXT_TYPES | WAY_TYPES


class Shares(NamedTuple):
    odds: np.ndarray  # log-odds of the second half of every node above the buckets
    seen: np.ndarray  # log share of the known words in every bucket
    new: np.ndarray  # log share of words never seen


class Corpus(NamedTuple):
    shares: Shares
    ways: DataFrame  # as ``halved`` gives them
    source: DataFrame
    blocks: DataFrame  # the source as ``blocks_of`` stores it
    frequent: Broadcast  # ways of frequent words, as ``listed_ways`` gives them


class Ways(NamedTuple):
    """Ways inside the buckets, of the words of some texts."""

    words: np.ndarray  # in order
    known: np.ndarray
    firsts: np.ndarray  # of every word's turns, and their end
    turns: np.ndarray  # 2 * node + way taken
    odds: np.ndarray


class Block(NamedTuple):
    """The words of some texts, and the ways to them."""

    parts: np.ndarray  # of every text, in order
    firsts: np.ndarray  # first word of every text and the end
    rows: np.ndarray  # of every word's way
    ways: Ways


class Branches(NamedTuple):
    """What words take at nodes: at the first levels word by word, from there on level by level.

    Words are taken in an order in which those with more turns come first, so the words that a level
    holds are always the first ones.
    """

    order: np.ndarray
    upper: np.ndarray  # (word, level): nodes
    upper_second: np.ndarray
    upper_odds: np.ndarray
    levels: list[slice]  # of the arrays below
    node: np.ndarray
    second: np.ndarray
    odds: np.ndarray


def hashes_of(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of all words, first word of every text and the end) for some texts at a time."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        raw, offsets = utf8(chunk)
        for i, j in groups_of_rows(offsets):
            part = offsets[i:j + 1]
            yield word_hashes(raw[part[0]:part[-1]], part - part[0])


def in_parts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(doc_id, text, part, block) and the number of parts, of like size whatever the files are.

    Small parts share a block up to ``PART_BYTES``. All parts of a block have one turn in ``ROUNDS``,
    which is the block's, too.
    """
    rows = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = int(max(size // PART_BYTES, min(size // SMALL_PART_BYTES, SMALL_PARTS), 1))
    together = ROUNDS * max(1, PART_BYTES * number // max(size, 1))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)).cast("int")
    block = F.floor(F.col("part") / together) * ROUNDS + F.col("part") % ROUNDS
    return rows.withColumn("part", part).withColumn("block", block.cast("int")), number


def words_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(all words of some texts, words of each text)."""
    return tuple(np.concatenate(x) for x in zip(*((h.view(np.int64), np.diff(f)) for h, f in hashes_of(table["text"]))))


def words_of(parts: DataFrame) -> DataFrame:
    """(home, word, n): the words of every block, stored."""

    def count(table: pa.Table) -> pa.Table:
        word, n = np.unique(words_in(table)[0], return_counts=True)
        return pa.table({"home": np.full(len(word), table["block"][0].as_py(), np.int32), "word": word, "n": n})

    return lineage.cut(parts.groupBy("block").applyInArrow(count, "home int, word bigint, n bigint"), compression="zstd")


def shares(counts: DataFrame) -> Shares:
    bucket = F.shiftrightunsigned("word", 64 - LEVELS).alias("bucket")
    found = counts.groupBy(bucket).agg(F.sum("n"), F.count_if(F.col("n") == 1)).collect()  # bounded by BUCKETS
    whole = np.zeros(BUCKETS)
    for b, n, _ in found:
        whole[b] = n
    new = min(1.0, (sum(once for _, _, once in found) + 1) / BUCKETS)
    sums = np.concatenate([np.zeros(BUCKETS), whole + new])
    for node in range(BUCKETS - 1, 0, -1):
        sums[node] = sums[2 * node] + sums[2 * node + 1]
    odds = np.zeros(BUCKETS)
    odds[1:] = np.log(sums[3::2] / sums[2::2])
    # A bucket without words has no known word to use its first value.
    return Shares(odds, np.log(np.maximum(whole, 1) / (whole + new)), np.log(new / (whole + new)))


def halved(table: pa.Table) -> pa.Table:
    """(word, n, turns, odds, alike, place) of whole buckets' words.

    Words of one count are only told by how many of them are left and the place of the word among them,
    which is all that their further turns depend on.
    """
    word, n = table["word"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.lexsort((word, -n, word >> np.uint64(64 - LEVELS)))
    word, n = word[order], n[order]
    bucket, low = np.unique(word >> np.uint64(64 - LEVELS), return_index=True)
    high, code = np.append(low[1:], len(word)), bucket + np.uint64(BUCKETS)
    sums = np.concatenate([[0], np.cumsum(n)])
    found, node = [], code.astype(np.int64)
    alike, place = np.zeros((2, len(word)), np.int32)
    while True:
        more = high - low > 1
        same = more & (n[low] == n[high - 1])
        size = (high - low)[same]
        at = np.repeat(low[same] - np.cumsum(size) + size, size) + np.arange(size.sum())
        alike[at], place[at] = np.repeat(size, size), at - np.repeat(low[same], size)
        more &= ~same
        if not more.any():
            break
        low, high, code, node = low[more], high[more], code[more], node[more]
        half = (sums[low] + sums[high]) / 2
        middle = np.searchsorted(sums, half)
        middle -= half - sums[middle - 1] < sums[middle] - half
        middle = np.clip(middle, low + 1, high - 1)
        odds = np.log((sums[high] - sums[middle]) / (sums[middle] - sums[low])).astype(np.float32)
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        found.append((at, 2 * np.repeat(node, size) + (at >= np.repeat(middle, size)), np.repeat(odds, size)))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        code = np.concatenate([2 * code, 2 * code + 1])
        node = 2 * BUCKETS + (mix(code) % np.uint64(SHARED)).astype(np.int64)
    at, turns, odds = ([np.concatenate(x) for x in zip(*found)] if found
                       else [np.zeros(0, t) for t in (np.int64, np.int64, np.float32)])
    order = np.argsort(at, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(word)))]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[order])) for x in (turns.astype(np.int16), odds)]
    return pa.table([pa.array(word.view(np.int64)), pa.array(n), *lists, pa.array(alike), pa.array(place)],
                    ["word", "n", "turns", "odds", "alike", "place"])


def ways_of(counts: DataFrame) -> DataFrame:
    near = F.shiftrightunsigned("word", 64 - LEVELS) / NEAR_BUCKETS
    grouped = counts.groupBy(near.cast("int").alias("near"))
    return lineage.cut(grouped.applyInArrow(
        halved, "word bigint, n bigint, turns array<smallint>, odds array<float>, alike int, place int"), compression="zstd")


def frequent_of(ways: DataFrame) -> pa.Table:
    """The ways of the words of highest counts, at most ``FREQUENT``, without those as rare as any left out."""
    first = ways.orderBy(F.desc("n")).limit(FREQUENT + 1)
    least = first.agg(F.count("n"), F.min("n")).first()
    return ways.where(F.col("n") > (least[1] if least[0] > FREQUENT else 0)).drop("n").toArrow()


def entries(words: DataFrame, ways: DataFrame) -> DataFrame:
    """(home, word, turns, odds, alike, place), the last four null for words the corpus does not hold."""
    return words.select("home", "word").join(ways.drop("n"), "word", "left")


def way_columns(listed: pa.Table) -> dict[str, np.ndarray]:
    """What ``as_ways`` takes, of the words as they come; a word that the corpus does not hold has depth -1."""
    turns, odds = (listed[c].combine_chunks() for c in ("turns", "odds"))
    found = {"word": listed["word"], "depth": pc.list_value_length(turns).fill_null(-1), "turns": turns.flatten(),
             "odds": odds.flatten(), **{c: listed[c].fill_null(0) for c in ("alike", "place")}}
    return {c: x.to_numpy().astype(WAY_TYPES[c]) for c, x in found.items()}


def listed_ways(listed: pa.Table) -> dict[str, np.ndarray]:
    """The same of the words in order."""
    return way_columns(listed.sort_by("word"))


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def binaries(x: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``x`` between neighbouring ends."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(home, a binary column for each of ``WAY_TYPES``): ``entries`` with many words of a block in a row."""
    for table in gathered(batches, PACKED_WORDS):
        table = table.sort_by("home")
        home, found = table["home"].to_numpy(), way_columns(table)
        first = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
        ends = np.append(first, len(home))
        turn_ends = np.concatenate([[0], np.cumsum(np.maximum(found["depth"], 0), dtype=np.int64)])[ends]
        yield from pa.table({"home": home[first]} | {
            c: binaries(x, turn_ends if c in PER_TURN else ends) for c, x in found.items()}).to_batches()


def unpacked(rows: pa.Table) -> dict[str, np.ndarray]:
    """What ``listed_ways`` gives, of all words of a block's rows."""
    found = {c: np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in WAY_TYPES.items()}
    order, size = np.argsort(found["word"]), np.maximum(found["depth"], 0).astype(np.int64)
    first = (np.cumsum(size) - size)[order]
    size = size[order]
    at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    return {c: x[at] if c in PER_TURN else x[order] for c, x in found.items()}


def as_ways(word: np.ndarray, depth: np.ndarray, turns: np.ndarray, odds: np.ndarray, alike: np.ndarray,
            place: np.ndarray) -> Ways:
    """Whole ways: the turns given, then those among words of one count."""
    known, depth, alike, place = depth >= 0, np.maximum(depth, 0), alike.copy(), place.copy()
    first = np.cumsum(depth, dtype=np.int64) - depth
    code = (word.view(np.uint64) >> np.uint64(64 - LEVELS)) + np.uint64(BUCKETS)
    for j in range(depth.max(initial=0)):
        row = np.flatnonzero(depth > j)
        code[row] = 2 * code[row] + (turns[first[row] + j] & 1).astype(np.uint64)
    found = [(np.repeat(np.arange(len(word)), depth), turns, odds)]
    row = np.flatnonzero(alike > 1)
    while len(row):
        here, left = code[row], (alike[row] + 1) // 2
        second = place[row] >= left
        node = np.where(here < 2 * BUCKETS, here, 2 * BUCKETS + mix(here) % np.uint64(SHARED)).astype(np.int64)
        found.append((row, (2 * node + second).astype(np.int16), np.log((alike[row] - left) / left).astype(np.float32)))
        code[row] = 2 * here + second
        place[row] -= left * second
        alike[row] = np.where(second, alike[row] - left, left)
        row = row[alike[row] > 1]
    at, turns, odds = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at, kind="stable")
    firsts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(word)))])
    return Ways(word, known, firsts, turns[order], odds[order])


def blocks_of(parts: DataFrame, words: DataFrame, ways: DataFrame, frequent: Broadcast) -> DataFrame:
    """A row per block, stored round by round: the words of its texts and the ways to those that are not
    frequent, so that training and scoring shuffle neither."""

    def join(texts: pa.Table, listed: pa.Table) -> pa.Table:
        # Texts come in any order from a shuffle.
        texts = texts.sort_by([(c, "ascending") for c in ("part", "doc_id", "text")])
        hashes, sizes = words_in(texts)
        word, rows = np.unique(hashes, return_inverse=True)
        ids, found = texts["doc_id"].combine_chunks(), unpacked(listed)
        made = dict(zip(TEXT_TYPES, (texts["part"].to_numpy(), sizes, rows))) | found | {"word": word}
        return pa.table({
            "block": texts["block"].slice(0, 1), "doc_id": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            **{c: [x.astype(BLOCK_TYPES[c]).tobytes()] for c, x in made.items()}})

    often = parts.sparkSession.createDataFrame(pa.table({"word": frequent.value["word"]}))
    rare = words.join(F.broadcast(often), "word", "left_anti")  # bounded by FREQUENT
    few = entries(rare, ways).mapInArrow(packed, "home int, " + ", ".join(f"{c} binary" for c in WAY_TYPES))
    listed = lineage.cut(few.withColumn("turn", F.col("home") % ROUNDS), "turn", compression="zstd")
    lineage.discard(words)
    shape = T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("doc_id", T.ArrayType(parts.schema["doc_id"].dataType)),
        *(T.StructField(c, T.BinaryType()) for c in BLOCK_TYPES)])
    stored = []
    for turn in range(ROUNDS):
        texts, own = parts.where(F.col("block") % ROUNDS == turn), listed.where(F.col("turn") == turn).drop("turn")
        joined = texts.groupBy("block").cogroup(own.groupBy("home")).applyInArrow(join, shape)
        stored.append(lineage.cut(joined, maxRecordsPerFile=FILE_BLOCKS, compression="zstd").withColumn("turn", F.lit(turn)))
    lineage.discard(listed)
    return functools.reduce(DataFrame.unionByName, stored)


def all_ways(word: np.ndarray, frequent: dict[str, np.ndarray], depth: np.ndarray, turns: np.ndarray, odds: np.ndarray,
             alike: np.ndarray, place: np.ndarray) -> Ways:
    """Ways of words in order: frequent ones are looked up, the rest is given."""
    at = np.searchsorted(frequent["word"], word)
    often = np.flatnonzero(np.append(frequent["word"], 0)[at] == word) if len(frequent["word"]) else np.zeros(0, np.int64)
    often = often[at[often] < len(frequent["word"])]
    at, rest = at[often], np.delete(np.arange(len(word)), often)
    size = frequent["depth"][at].astype(np.int64)
    ends = np.cumsum(frequent["depth"], dtype=np.int64)[at]
    picked = np.repeat(ends - np.cumsum(size), size) + np.arange(size.sum())
    merged = {}
    for c, given in (("depth", depth), ("alike", alike), ("place", place)):
        merged[c] = np.empty(len(word), WAY_TYPES[c])
        merged[c][rest], merged[c][often] = given, frequent[c][at]
    order = np.argsort(np.concatenate([np.repeat(rest, np.maximum(depth, 0)), np.repeat(often, size)]), kind="stable")
    turns, odds = (np.concatenate([x, frequent[c][picked]])[order] for c, x in (("turns", turns), ("odds", odds)))
    return as_ways(word, merged["depth"], turns, odds, merged["alike"], merged["place"])


def read_blocks(batches: Iterator[pa.RecordBatch], frequent: dict[str, np.ndarray]) -> Iterator[tuple[pa.Array, Block]]:
    """(ids, words) of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            parts, sizes, rows, word, *ways = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in BLOCK_TYPES.items())
            firsts = np.concatenate([[0], np.cumsum(sizes)])
            yield batch.column("doc_id")[i].values, Block(parts, firsts, rows, all_ways(word, frequent, *ways))


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    """Small random weights; before training every word has its share of the corpus."""
    draw = np.random.default_rng(seed)
    net = {k: (draw.standard_normal(s) * 0.5 / np.sqrt(s[0])).astype(np.float32) for k, s in SHAPES.items()}
    net["words"] = (draw.standard_normal(SHAPES["words"]) * 0.5).astype(np.float32)
    return net | {"hidden_bias": np.zeros(HIDDEN, np.float32), "out": np.zeros(SHAPES["out"], np.float32)}


def contexts(ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Ids of the words around each word, the border's id beyond its text."""
    counts = np.diff(firsts)
    padded = np.full(len(ids) + SIDE * (len(counts) + 1), VOCABULARY, np.int32)
    here = np.arange(len(ids)) + np.repeat(SIDE * np.arange(1, len(counts) + 1), counts)
    padded[here] = ids
    return np.stack([padded[here + s] for s in range(-SIDE, SIDE + 1) if s], axis=1)


def both_contexts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """(token, 2, place): rows of the table of vectors for the words around each word."""
    rows = [(hashes >> np.uint64(k)).astype(np.int64) % VOCABULARY for k in (0, 20)]
    return np.stack([contexts(r, firsts) for r in rows], axis=1)


def branches(row: np.ndarray, known: Shares, ways: Ways) -> tuple[Branches, np.ndarray]:
    """The way from the root to every word, and the part of its log-chance that no branch decides."""
    size = ways.firsts[row + 1] - ways.firsts[row]
    order = np.argsort(-size.astype(np.int16), kind="stable")
    row, size = row[order], size[order]
    bucket = (ways.words[row].view(np.uint64) >> np.uint64(64 - LEVELS)).astype(np.int64)
    level = np.arange(LEVELS)
    node = (1 << level) | (bucket[:, None] >> (LEVELS - level))
    second = (bucket[:, None] >> (LEVELS - 1 - level)) & 1
    counts = np.searchsorted(-size, -np.arange(size[0]))
    at = np.concatenate([np.zeros(0, np.int64), *(ways.firsts[row[:k]] + j for j, k in enumerate(counts))])
    lower, turns = node[:, DENSE:].T.ravel(), ways.turns[at].astype(np.int64)
    ends = np.cumsum([0] + [len(row)] * (LEVELS - DENSE) + counts.tolist())
    upper = node[:, :DENSE]
    taken = Branches(order, upper, second[:, :DENSE], known.odds[upper].astype(np.float32), [slice(*x) for x in zip(ends[:-1], ends[1:])],
                     np.concatenate([lower, turns >> 1]), np.concatenate([second[:, DENSE:].T.ravel(), turns & 1]),
                     np.concatenate([known.odds[lower], ways.odds[at]]).astype(np.float32))
    return taken, np.where(ways.known[row], known.seen[bucket], known.new[bucket])


def predict(net: dict, around: np.ndarray, taken: Branches) -> tuple[np.ndarray, ...]:
    """(inputs, hidden values, weights at the lower branches, log-odds of the second way at the upper
    and at the lower ones)."""
    inputs = (np.take(net["words"], around[:, 0], 0) + np.take(net["words"], around[:, 1], 0)).reshape(len(around), -1)
    hidden = inputs @ net["hidden"]
    hidden += net["hidden_bias"]
    np.maximum(hidden, 0, out=hidden)
    weights, lower = np.take(net["out"], taken.node, 0), taken.odds.copy()
    upper = np.take_along_axis(hidden @ net["out"][:1 << DENSE].T, taken.upper, 1) + taken.upper_odds
    for here in taken.levels:
        lower[here] += np.einsum("ij,ij->i", hidden[:here.stop - here.start], weights[here])
    return inputs, hidden, weights, np.clip(upper, -60, 60), np.clip(lower, -60, 60)


def move(net: dict, sums: dict, name: str, slope: np.ndarray, rows=slice(None)) -> None:
    """A step against the slope, the shorter the more a row has been moved."""
    square = slope * slope
    sums[name][rows] += square.mean(1, keepdims=True) if slope.ndim > 1 else square
    net[name][rows] -= RATE * slope / np.sqrt(sums[name][rows])


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sum of the values of each), row numbers below 2^16."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    # Two numbers at a time: complex ones are added number by number.
    return rows[first], np.add.reduceat(np.take(values, order, 0).view(np.complex64), first, axis=0).view(np.float32)


def learn(net: dict, sums: dict, around: np.ndarray, taken: Branches) -> None:
    """One step down the gradient of a batch, in place."""
    around = around[taken.order]
    inputs, hidden, weights, upper, lower = predict(net, around, taken)
    wrong = np.zeros((len(around), 1 << DENSE), np.float32)
    np.put_along_axis(wrong, taken.upper, (1 / (1 + np.exp(-upper)) - taken.upper_second).astype(np.float32), 1)
    below = (1 / (1 + np.exp(-lower)) - taken.second).astype(np.float32)[:, None]
    to_hidden, slopes = wrong @ net["out"][:1 << DENSE], np.empty_like(weights)
    for here in taken.levels:
        held = here.stop - here.start
        to_hidden[:held] += below[here] * weights[here]
        np.multiply(below[here], hidden[:held], out=slopes[here])
    to_hidden *= hidden > 0
    to_inputs = (to_hidden @ net["hidden"].T).reshape(-1, DEPTH)
    nodes, slope = summed(taken.node, slopes)
    move(net, sums, "out", wrong.T @ hidden, slice(1 << DENSE))
    move(net, sums, "out", slope, nodes)
    move(net, sums, "hidden", inputs.T @ to_hidden)
    move(net, sums, "hidden_bias", to_hidden.sum(0))
    for half in (0, 1):
        rows, slope = summed(around[:, half].ravel(), to_inputs)
        move(net, sums, "words", slope, rows)


def train(blocks: DataFrame, frequent: Broadcast, number: int, known: Shares, net: dict) -> dict[str, np.ndarray]:
    """The weights after all rounds, whatever the number of parts; a round without a part changes nothing."""
    for turn in range(ROUNDS):
        net = one_round(blocks.where(F.col("turn") == turn), frequent, number, known, net)
    return net


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, words, weights): the sums over all rows of a group, one batch in memory at a time."""
    chunk, words, total = 0, 0, np.zeros(0)
    for batch in batches:
        chunk, weights = batch.column("chunk")[0].as_py(), batch.column("weights").flatten().to_numpy()
        total = weights.reshape(batch.num_rows, -1).sum(0, dtype=np.float64) + (total if len(total) else 0)
        words += pc.sum(batch.column("words")).as_py()
    yield pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int32()), pa.array([words], pa.int64()), pa.array([total], pa.list_(pa.float32()))],
        ["chunk", "words", "weights"])


def one_round(blocks: DataFrame, frequent: Broadcast, number: int, known: Shares,
              start: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Weights averaged over one pass of every part through its own words.

    What the parts change, times their words, is added inside a task before anything is shuffled, then
    in chunks by groups of about the square root of all parts, then together, so no task adds more than
    that many.
    """
    # Bounded by the shapes; plain arrays, since workers read broadcasts without this package.
    sent = blocks.sparkSession.sparkContext.broadcast((tuple(known), start))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, words, total = Shares(*sent.value[0]), 0, 0, 0.0
        for _, block in read_blocks(batches, frequent.value):
            for part in np.unique(block.parts):
                i, j = np.searchsorted(block.parts, [part, part + 1])
                firsts = block.firsts[i:j + 1] - block.firsts[i]
                rows = block.rows[block.firsts[i]:block.firsts[j]]
                net = {k: v.copy() for k, v in sent.value[1].items()}
                sums = {k: np.full(v.shape if v.ndim == 1 else (len(v), 1), START, np.float32) for k, v in net.items()}
                around = both_contexts(block.ways.words[rows].view(np.uint64), firsts)
                for at in range(0, len(rows), TRAIN_BATCH):
                    here = slice(at, at + TRAIN_BATCH)
                    learn(net, sums, around[here], branches(rows[here], known, block.ways)[0])
                if len(rows):
                    own, words = own if words else int(part), words + len(rows)
                    total = total + np.concatenate([(net[k] - sent.value[1][k]).ravel() for k in SHAPES]) * float(len(rows))
        if words:
            chunks = [total[i:i + CHUNK].astype(np.float32) for i in range(0, len(total), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own] * len(chunks), pa.int32()), pa.array(range(len(chunks)), pa.int32()),
                 pa.array([words] * len(chunks), pa.int64()), pa.array(chunks, pa.list_(pa.float32()))],
                ["part", "chunk", "words", "weights"])

    sums = "chunk int, words bigint, weights array<float>"
    trained = blocks.mapInArrow(parts, "part int, " + sums)
    some = F.pmod(F.xxhash64("part"), F.lit(max(1, int(number**0.5))))
    partly = trained.groupBy("chunk", some.alias("some")).applyInArrow(added, sums)
    flat, found = np.concatenate([start[k].ravel() for k in SHAPES]), partly.groupBy("chunk").applyInArrow(added, sums).toArrow()
    for chunk, words, weights in zip(found["chunk"].to_pylist(), found["words"].to_pylist(), found["weights"]):
        flat[chunk * CHUNK:chunk * CHUNK + len(weights)] += weights.values.to_numpy() / words
    net, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        net[k], at = flat[at:at + size].reshape(shape), at + size
    return net


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[Corpus, dict[str, np.ndarray]]:
    parts, number = in_parts(docs, id_col, text_col)
    words = words_of(parts)
    counts = lineage.cut(words.groupBy("word").agg(F.sum("n").alias("n")), compression="zstd")
    known = shares(counts)
    ways = ways_of(counts)
    lineage.discard(counts)
    # Bounded by FREQUENT; plain arrays.
    frequent = docs.sparkSession.sparkContext.broadcast(listed_ways(frequent_of(ways)))
    blocks = blocks_of(parts, words, ways, frequent)
    return Corpus(known, ways, docs, blocks, frequent), train(blocks, frequent, number, known, initial())


def chances(rows: np.ndarray, firsts: np.ndarray, known: Shares, ways: Ways, net: dict) -> np.ndarray:
    """Conditional log-probability of every word, given by the row of its way."""
    each = np.empty(len(rows))
    around = both_contexts(ways.words[rows].view(np.uint64), firsts)
    for i in range(0, len(rows), BATCH):
        here = slice(i, i + BATCH)
        taken, chance = branches(rows[here], known, ways)
        upper, lower = predict(net, around[here][taken.order], taken)[-2:]
        turns = -np.log1p(np.exp(np.where(taken.second == 1, -lower, lower)))
        chance = chance - np.log1p(np.exp(np.where(taken.upper_second == 1, -upper, upper))).sum(1)
        for level in taken.levels:
            chance[:level.stop - level.start] += turns[level]
        each[i + taken.order] = chance
    return each


def log_likelihoods(rows: np.ndarray, firsts: np.ndarray, known: Shares, ways: Ways, net: dict) -> np.ndarray:
    """Summed conditional log-probabilities of every text; texts of the same words are scored once."""
    first_of: dict[bytes, int] = {}
    same = np.array([first_of.setdefault(rows[i:j].tobytes(), k) for k, (i, j) in enumerate(zip(firsts[:-1], firsts[1:]))], int)
    texts = np.flatnonzero(same == np.arange(len(same)))
    sizes = np.diff(firsts)[texts]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(firsts[texts] - ends[:-1], sizes) + np.arange(ends[-1])
    scores = np.zeros(len(same))
    scores[texts] = np.bincount(np.repeat(np.arange(len(texts)), sizes), chances(rows[at], ends, known, ways, net), len(texts))
    return scores[same]


def score(docs: DataFrame, corpus: Corpus, net: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every text."""
    blocks, frequent = corpus.blocks, corpus.frequent
    if docs is not corpus.source:
        parts, _ = in_parts(docs, id_col, text_col)
        blocks = blocks_of(parts, words_of(parts), corpus.ways, frequent)
    sent = docs.sparkSession.sparkContext.broadcast((tuple(corpus.shares), net))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = Shares(*sent.value[0]), sent.value[1]
        for ids, block in read_blocks(batches, frequent.value):
            scores = log_likelihoods(block.rows, block.firsts, known, block.ways, weights)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(block.firsts)), pa.array(scores)], ["doc_id", "n", "score"])

    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
                          T.StructField("score", T.DoubleType())])
    mean = F.when(F.col("n") > 0, F.col("score") / F.col("n"))
    return blocks.mapInArrow(find, shape).select("doc_id", F.col("n").alias("n_tokens"),
                                                 F.col("score").alias("log_likelihood"), mean.alias("mean_log_likelihood"))
