"""Benchmark passages in training texts, found through an FM-index of every training shard.

Test items become phrases: every window of ten words, or the whole item where it is shorter. A shard
is a run of documents inside a task. Its words become symbols of the phrases' alphabet; where a word
is foreign to it, or two neighbours follow one another in no phrase, no occurrence can pass, so the
text falls into stretches and only those long enough for a phrase are indexed. The index is the
Burrows-Wheeler transform of the stretches with a wavelet matrix for ranks. All phrases are searched
backwards at once, occurrences are located by walking to sampled suffix positions, and what they
cover is merged into spans of words.

Phrases are taken to the tasks in blocks of at most ``BLOCK_PHRASES``, however large the test set;
each block's hits are stored before the next is made. With one block nothing is shuffled; with several
the texts are stored once with numbers, by which hits are merged and ``clean`` drops rows.

A null or wordless text has no words and no hits, a null or wordless item no phrases. Items that
share an id are one item with the phrases of all; an item with a null id covers words but is not
listed. Without any phrase nothing is hit. Every row of the documents gives a row, repeated or not;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, SLICE_BYTES, groups_of_rows, in_small_batches, utf8
from corpweave.operators import lineage

WINDOW = 10
#: (phrase, item) pairs that are sent to the tasks at a time.
BLOCK_PHRASES = 100_000
ROW = "_row_number"
#: Bytes of text in a shard, unless a single text is longer.
SHARD_BYTES = 4 << 20
#: Every so many positions a suffix position is kept.
SAMPLE = 8

#: Lower case for A-Z, a blank for every byte that belongs to no word.
CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Phrases(NamedTuple):
    """A block of phrases as symbols, with the items that hold them."""

    symbol: dict[bytes, int]
    codes: np.ndarray  # one row per phrase, its last word first, 0 where it is over
    lengths: np.ndarray
    pairs: np.ndarray  # sorted neighbours that occur in a phrase, as one number each
    first_item: np.ndarray  # phrase i has items[first_item[i]:first_item[i + 1]]
    items: list[str | None]


def words(text: bytes) -> list[bytes]:
    return text.translate(CLEAN).split()


def windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id",
            text_col: str = "text") -> DataFrame:
    """Distinct (phrase, item): the words of a phrase joined by blanks, the id as a string."""

    @F.arrow_udf("array<string>")
    @giving_back
    def cut(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = []
            for text in column.to_pylist():
                own = words((text or "").encode())
                last = max(len(own) - window, 0)
                found.append([b" ".join(own[i:i + window]).decode() for i in range(last + 1)] if own else [])
            yield pa.array(found, pa.list_(pa.string()))

    return benchmark.select(
        F.col(id_col).cast("string").alias("item"), F.explode(cut(text_col)).alias("phrase")).distinct()


def blocks(found: DataFrame, most: int = BLOCK_PHRASES) -> Iterator[Phrases]:
    """The phrases in blocks of about ``most`` (phrase, item) pairs."""
    count = -(-found.count() // most)
    for block in range(count):
        part = found.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(count)) == block)
        yield as_symbols([(r["phrase"], r["item"]) for r in part.orderBy("phrase", "item").toLocalIterator()])


def as_symbols(rows: list[tuple[str, str | None]]) -> Phrases:
    """``rows`` are (phrase, item), sorted by phrase."""
    phrases = list(dict.fromkeys(phrase for phrase, _ in rows))
    split = [p.encode().split(b" ") for p in phrases]
    symbol = {w: i for i, w in enumerate(sorted({w for p in split for w in p}), 1)}
    lengths = np.array([len(p) for p in split])
    codes = np.zeros((len(split), lengths.max()), np.int64)
    for i, p in enumerate(split):
        codes[i, :len(p)] = [symbol[w] for w in reversed(p)]
    size = len(symbol) + 1
    pairs = np.unique((codes[:, 1:] * size + codes[:, :-1])[(codes[:, 1:] > 0)])
    number = {p: i for i, p in enumerate(phrases)}
    per_phrase = np.bincount([number[p] for p, _ in rows], minlength=len(phrases))
    return Phrases(symbol, codes, lengths, pairs, np.concatenate([[0], np.cumsum(per_phrase)]),
                   [item for _, item in rows])


class FMIndex:
    """A Burrows-Wheeler transform of stretches of symbols, searched backwards.

    ``text`` has a 0 after every stretch. Suffixes that reach the end of their stretch are told apart
    by where they are, so the order is a full one and walking back from a suffix is exact.
    """

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        order = self.suffixes(text)
        before = text[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.before = before
        stretch_start = np.concatenate([[True], text[:-1] == 0])
        kept = stretch_start | (np.arange(n) % SAMPLE == 0)
        self.kept = kept[order]
        self.kept_before = np.concatenate([[0], np.cumsum(self.kept)])
        self.places = order[self.kept]
        # Wavelet matrix: a level per bit, zeros moved before ones from each level to the next.
        self.levels = []
        row = before
        for bit in reversed(range(int(size - 1).bit_length())):
            ones = (row >> bit) & 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(ones)]).astype(np.int32), n - int(ones.sum())))
            row = np.concatenate([row[ones == 0], row[ones == 1]])

    @staticmethod
    def suffixes(text: np.ndarray) -> np.ndarray:
        """All suffixes in order, by doubling the length they are sorted by."""
        n, ends = len(text), text == 0
        rank = text + ends.sum()
        rank[ends] = np.arange(ends.sum())
        length = 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[:-length] = rank[length:] + 1
            follow[rank < ends.sum()] = 0
            key = rank * (rank.max() + 2) + follow
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                return order
            length *= 2

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before ``end``."""
        begin = np.zeros_like(end)
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit) & 1 == 1
            one_begin, one_end = ones[begin], ones[end]
            begin = np.where(up, zeros + one_begin, begin - one_begin)
            end = np.where(up, zeros + one_end, end - one_end)
        return end - begin

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, row after the last) of every phrase that occurs."""
        phrase = np.arange(len(codes))
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), len(self.before), np.int64)
        for step in range(codes.shape[1]):
            on = lengths[phrase] > step
            symbol = codes[phrase[on], step]
            low[on] = self.starts[symbol] + self.rank(symbol, low[on])
            high[on] = self.starts[symbol] + self.rank(symbol, high[on])
            some = low < high
            phrase, low, high = phrase[some], low[some], high[some]
        return phrase, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        rows, found = rows.copy(), np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            done = self.kept[rows[open_]]
            ready = open_[done]
            found[ready] = self.places[self.kept_before[rows[ready]]] + steps
            open_ = open_[~done]
            symbol = self.before[rows[open_]]
            rows[open_] = self.starts[symbol] + self.rank(symbol, rows[open_])
            steps += 1
        return found


def symbols(raw: np.ndarray, symbol: dict[bytes, int]) -> np.ndarray:
    """The symbol of every word of a text, 0 for foreign ones; long texts go slice by slice."""
    text, found, at = raw.tobytes().translate(CLEAN), [], 0
    while at < len(text):
        end = len(text) if len(text) - at <= SLICE_BYTES else text.find(b" ", at + SLICE_BYTES)
        end = len(text) if end < 0 else end
        get = symbol.get
        found.append(np.array([get(w, 0) for w in text[at:end].split()], np.int64))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def shard_hits(texts: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in some texts, given as symbols: (phrase, first word, text), words numbered on."""
    nothing = np.zeros(0, np.int64)
    ends = np.cumsum([len(t) for t in texts])
    line = np.concatenate(texts) if texts else nothing
    if not len(line):
        return nothing, nothing, nothing
    size, shortest = len(phrases.symbol) + 1, phrases.lengths.min()
    pair = line[:-1] * size + line[1:]
    at = np.minimum(np.searchsorted(phrases.pairs, pair), len(phrases.pairs) - 1)
    joined = phrases.pairs[at] == pair if len(phrases.pairs) else np.zeros(len(pair), bool)
    joined &= (line[:-1] > 0) & (line[1:] > 0)
    joined[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(line))] - 1] = False
    starts = np.flatnonzero(np.concatenate([[True], ~joined]))
    lengths = np.diff(np.append(starts, len(line)))
    useful = (lengths >= shortest) & (line[starts] > 0)
    starts, lengths = starts[useful], lengths[useful]
    if not len(starts):
        return nothing, nothing, nothing
    # Each stretch with a 0 behind it.
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    origin = np.repeat(starts - begins, lengths + 1) + np.arange(int((lengths + 1).sum()))
    text = line[np.minimum(origin, len(line) - 1)]
    text[begins + lengths] = 0
    index = FMIndex(text, size)
    phrase, low, high = index.search(phrases.codes, phrases.lengths)
    count = high - low
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    first = origin[index.locate(rows)]
    return np.repeat(phrase, count), first, np.searchsorted(ends, first, "right")


NO_PHRASES = Phrases({}, np.zeros((0, 1), np.int64), np.ones(1, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), [])


def hits(phrases: Phrases, text: Column | str) -> Column:
    """struct<n_words, n_hit, spans, items> of a text column."""
    span = "array<struct<start:bigint,stop:bigint>>"
    kind = f"struct<n_words:bigint,n_hit:bigint,spans:{span},items:array<string>>"
    sent = phrases

    @F.arrow_udf(kind)
    @giving_back
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            raw, offsets = utf8(column)
            done = [shard(raw, offsets[i:j + 1]) for i, j in groups_of_rows(offsets, SHARD_BYTES)]
            yield pa.concat_arrays(done) if done else shard(raw, offsets)

    def shard(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
        texts = [symbols(raw[a:b], sent.symbol) for a, b in zip(offsets[:-1], offsets[1:])]
        n_words = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(n_words)
        phrase, first, owner = shard_hits(texts, sent)
        cover = np.zeros(int(n_words.sum()) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + sent.lengths[phrase], -1)
        hit = np.cumsum(cover)[:-1] > 0
        counted = np.concatenate([[0], np.cumsum(hit)])
        begins = ends - n_words
        # A span starts or ends where covering changes or a text ends.
        edge = np.zeros(len(hit) + 1, bool)
        edge[begins] = edge[ends] = True
        before, after = np.zeros_like(hit), np.zeros_like(hit)
        before[1:], after[:-1] = hit[:-1], hit[1:]
        start, stop = hit & (~before | edge[:-1]), hit & (~after | edge[1:])
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
        of = np.searchsorted(ends, starts, "right")
        spans = lists_of_spans(starts - begins[of], stops - begins[of], np.bincount(of, minlength=len(texts)))
        seen = np.unique(owner * len(sent.lengths) + phrase)
        names: list[set[str]] = [set() for _ in texts]
        for text, p in zip((seen // len(sent.lengths)).tolist(), (seen % len(sent.lengths)).tolist()):
            names[text].update(x for x in sent.items[sent.first_item[p]:sent.first_item[p + 1]] if x is not None)
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(counted[ends] - counted[begins], pa.int64()), spans,
             pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
            ["n_words", "n_hit", "spans", "items"])

    return find(text)


def lists_of_spans(starts: np.ndarray, stops: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], ["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), spans)


def merged_spans(spans: Column) -> Column:
    """Spans of several blocks of phrases as one sorted list without overlaps."""

    def step(done: Column, new: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], new["stop"]).alias("stop"))
        apart = (F.size(done) == 0) | (new["start"] > F.try_element_at(done, F.lit(-1))["stop"])
        return F.when(apart, F.concat(done, F.array(new))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return F.aggregate(F.array_sort(spans), none, step)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) of every text; spans count words from 0."""
    rows = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    todo = blocks(windows(benchmark, window), block_phrases)
    first, second = next(todo, NO_PHRASES), next(todo, None)
    if second is None:
        return rows.select("doc_id", hits(first, F.col("text")).alias("f")).select(
            "doc_id", "f.n_words", "f.n_hit", "f.spans", "f.items")
    rows = numbered(rows)
    each = [lineage.cut(rows.select(ROW, "doc_id", hits(first, F.col("text")).alias("f")).select(
        ROW, "doc_id", "f.n_words", "f.spans", "f.items"))]
    for hit in stored_hits(rows, "text", second, todo):
        each.append(hit.selectExpr(ROW, "doc_id", "n_words", "spans", "items"))
    merged = reduce(DataFrame.unionByName, each).groupBy(ROW).agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        merged_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return merged.select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items")


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with a number each, stored so that the numbers stand."""
    return lineage.cut(rows.withColumn(ROW, F.monotonically_increasing_id()))


def stored_hits(rows: DataFrame, text_col: str, block: Phrases | None, todo: Iterator[Phrases]) -> Iterator[DataFrame]:
    """Of block after block the rows it hits, stored before the next block is made."""
    while block is not None:
        kept = [c for c in rows.columns if c in (ROW, "doc_id")]
        found = rows.select(*kept, hits(block, F.col(text_col)).alias("f")).where("f.n_hit > 0")
        yield lineage.cut(found.select(*kept, "f.n_words", "f.spans", "f.items"))
        del found
        block = next(todo, None)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans)."""
    return contamination(docs, benchmark, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns kept, in whose text no phrase occurs."""
    docs = in_small_batches(docs)
    todo = blocks(windows(benchmark, window))
    first, second = next(todo, None), next(todo, None)
    if first is None:
        return docs
    kept = docs.where(hits(first, F.col(text_col))["n_hit"] == 0)
    if second is None:
        return kept
    rows = numbered(kept)
    gone = reduce(DataFrame.unionByName, [hit.select(ROW) for hit in stored_hits(rows, text_col, second, todo)])
    return rows.join(gone, ROW, "left_anti").drop(ROW)
