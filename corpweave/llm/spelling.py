"""Spelling variants of a corpus's words, found by one-edit neighbourhoods over a reduced alphabet.

Words are counted over all documents. Each letter is hashed to one of eight symbols, which turns a word
into a reduced word. From every reduced word its full neighbourhood is generated: itself, every symbol
deleted, replaced by every other symbol, and every symbol inserted anywhere. Joined with the reduced
vocabulary this gives the candidates, and the original strings decide.

A join key also holds three original letters: two words of at least six letters that are one edit
apart have equal first three letters, or their first difference lies in these and the last three are
equal. Which of both holds is known from the place of the edit, so every neighbour is generated once, and
words that merely share a reduced form do not meet. A word's neighbourhood is made a piece at a time and
shipped as 64-bit hashes, so a very long word costs time in proportion to its length and bounded memory.

Joins are hinted to be merged: Spark sizes neighbours, over a hundred a word, by the words' compressed files
and would broadcast them, through the driver.

Words come from maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z as a-z. Where 199 divides the unsigned
crc32 h of ``<doc_id>:<run>`` (a null id is empty), the letter at h % length is left out of the run.
What has at least six letters and five occurrences is a word. Its form is the most frequent word one
edit away, the first in code-point order among equals, if that occurs at least five times as often;
following forms leads to the root. Null texts have no words; repeated rows count again; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, in_small_batches
from corpweave.llm.words import mix, powers
from corpweave.operators import lineage

LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
EDITED_ONE_IN = 199
SYMBOLS = 8
SIDE = 3
#: Words a task counts before it hands them on, and letters whose neighbours are made at a time.
HELD = 200_000
PIECE = 1 << 14
#: Beyond this many letters the runs of a text are taken one by one.
LONG = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Symbols 1 to 8, by letter.
_SYMBOL = np.array([zlib.crc32(chr(c).encode()) % SYMBOLS + 1 for c in range(256)], np.uint64)


def runs(key: bytes, text: str) -> Iterator[tuple[str, int]]:
    """(run after lower-casing and the deletion, occurrences) of one document."""
    found = _RUN.findall(text) if len(text) <= LONG else (m[0] for m in _RUN.finditer(text))
    lowered: Counter[str] = Counter()
    for run, n in Counter(found).items():
        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    start = zlib.crc32(key + b":")
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % EDITED_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


@giving_back
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            for run, n in runs((key or "").encode(), text or ""):
                if len(run) >= LEAST_LETTERS:
                    held[run] = held.get(run, 0) + n
            if len(held) >= HELD:
                yield out()
                held = {}
    yield out()


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    texts = in_small_batches(documents).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _times(count: int, first: int = 0) -> np.ndarray:
    """Powers of the base from ``first`` on."""
    return powers(_BASE, count) * np.uint64(pow(_BASE, int(first), 1 << 64))


def _tagged(value: np.ndarray, side: np.ndarray) -> np.ndarray:
    return mix(value ^ side).view(np.int64)


class _Words:
    """Words of one batch as letters, symbols, and hashes of their sides."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        # The tag says which side it is.
        self.head, self.tail = (self._side(at, tag) for at, tag in ((self.starts, 1), (self.ends - SIDE, 2)))

    def _side(self, at: np.ndarray, tag: int) -> np.ndarray:
        code = np.full(len(at), tag, np.uint64)
        for k in range(SIDE):
            code = code * np.uint64(1 << 16) + self.letters[at + k].astype(np.uint64)
        return mix(code)

    def whole(self) -> np.ndarray:
        """Hash of every reduced word."""
        found = np.zeros(len(self.lengths), np.uint64)
        for rows, piece in self.pieces():
            value = np.concatenate([[np.uint64(0)], np.cumsum(piece.symbols * piece.power)])
            np.add.at(found, rows, value[piece.ends] - value[piece.starts])
        return found

    def pieces(self) -> Iterator[tuple[np.ndarray, _Piece]]:
        """(words, their letters): several words at a time, or part of a long one."""
        i = 0
        while i < len(self.lengths):
            j = max(int(np.searchsorted(self.ends, self.starts[i] + PIECE, "right")), i + 1)
            rows = np.arange(i, j)
            if self.lengths[i] <= PIECE:
                yield rows, _Piece(self, rows, self.starts[i], self.ends[j - 1], 0)
            else:
                for at in range(self.starts[i], self.ends[i], PIECE):
                    yield rows, _Piece(self, rows, at, min(at + PIECE, self.ends[i]), at - self.starts[i])
            i = j


class _Piece:
    def __init__(self, words: _Words, rows: np.ndarray, begin: int, end: int, first: int):
        """``first`` is the place of the first letter in its word."""
        self.first = first
        self.starts = np.maximum(words.starts[rows], begin) - begin
        self.ends = np.minimum(words.ends[rows], end) - begin
        self.last = words.ends[rows] <= end
        self.owner = np.repeat(np.arange(len(rows)), self.ends - self.starts)
        self.place = np.arange(end - begin) - self.starts[self.owner] + first
        self.symbols = _SYMBOL[words.letters[begin:end]]
        self.before = np.concatenate([_SYMBOL[words.letters[begin - 1:begin]] if begin else [np.uint64(0)], self.symbols[:-1]])
        self.power = _times(int((self.ends - self.starts).max()), first)[self.place - first]


def neighbours(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(join key of every reduced neighbour, number of its word). None comes twice."""
    batch = _Words(words)
    whole = batch.whole()
    for side in (batch.head, batch.tail):
        yield _tagged(whole, side), np.arange(len(words))
    carried = np.uint64(0)
    base, inverse = np.uint64(_BASE), np.uint64(_INVERSE)
    for rows, p in batch.pieces():
        value = p.symbols * p.power
        total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        # Hash of the part before a letter, of the whole word, and of the part from the letter on.
        carried = carried if p.first else np.uint64(0)
        ahead = total[:-1] - total[p.starts[p.owner]] + carried
        full = whole[rows][p.owner]
        here = full - ahead
        side = np.where(p.place < SIDE, batch.tail[rows][p.owner], batch.head[rows][p.owner])
        # Of equal symbols in a row only the first is deleted, and the first beyond the head.
        fresh = (p.place == 0) | (p.symbols != p.before) | (p.place == SIDE)
        yield _tagged(ahead + (here - value) * inverse, side)[fresh], rows[p.owner[fresh]]
        for s in range(1, SYMBOLS + 1):
            other = np.flatnonzero(p.symbols != s)
            symbol = np.uint64(s) * p.power
            yield _tagged(full - value + symbol, side)[other], rows[p.owner[other]]
            # Before an equal symbol is the same as behind it, which comes later; the head ends here.
            useful = np.flatnonzero((p.symbols != s) | (p.place == SIDE - 1))
            yield _tagged(ahead + symbol + here * base, side)[useful], rows[p.owner[useful]]
        ended = np.flatnonzero(p.last)
        behind = np.array([pow(_BASE, n, 1 << 64) for n in batch.lengths[rows[ended]].tolist()], np.uint64)
        for s in range(1, SYMBOLS + 1):
            yield _tagged(whole[rows[ended]] + np.uint64(s) * behind, batch.head[rows[ended]]), rows[ended]
        carried = carried + total[-1]


def _neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ids = batch.column("id")
            for keys, owner in neighbours(batch.column("word").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids.take(pa.array(owner))], ["key", "id"])


def _vocabulary_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word under its two sides; ``head`` tells them apart."""
    for batch in batches:
        if batch.num_rows:
            found = _Words(batch.column("word").to_pylist())
            whole = found.whole()
            for head, side in ((True, found.head), (False, found.tail)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_tagged(whole, side), pa.int64()), batch.column("id"), batch.column("word"),
                     batch.column("n"), pa.array([head] * batch.num_rows)], ["key", "near_id", "near", "near_n", "head"])


def near_words(words: DataFrame) -> DataFrame:
    """(id, near_id, near, near_n): both directions of every two words one edit apart."""
    made = words.select("id", "word").mapInArrow(giving_back(_neighbour_rows), "key bigint, id bigint")
    there = words.mapInArrow(giving_back(_vocabulary_rows), "key bigint, near_id bigint, near string, near_n bigint, head boolean")
    candidates = made.hint("merge").join(there, "key").where("id <> near_id").drop("key")
    # A pair with equal heads is found by these; it may be found by its tails as well.
    head = f"substring(%s, 1, {SIDE})"
    return candidates.hint("merge").join(words.select("id", "word"), "id").where(
        f"levenshtein(word, near, 1) = 1 AND head = ({head % 'word'} = {head % 'near'})"
    ).select("id", "near_id", "near", "near_n")


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(id, root): where ``form_id`` leads in the end, by doubling the steps.

    A form is at least ``TIMES`` as frequent as its word, so the most frequent word's count ``most``
    bounds the length of a chain.
    """
    steps = max(1, math.ceil(math.log(max(most, 2) / LEAST_COUNT, TIMES)) + 1)
    found = forms.selectExpr("id", "form_id AS up", "form AS root")
    for _ in range(max(1, math.ceil(math.log2(steps)))):
        further = found.selectExpr("id AS up", "up AS next", "root AS next_root")
        found = found.hint("merge").join(further, "up", "left").selectExpr(
            "id", "coalesce(next, up) AS up", "coalesce(next_root, root) AS root")
    return found.select("id", "root")


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word, see the module's text."""
    counted = lineage.cut(vocabulary(documents, id_col, text_col))
    words = lineage.cut(counted.withColumn("id", F.monotonically_increasing_id()))
    near = near_words(words).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near", "near_id")).alias("best"))
    known = lineage.cut(words.hint("merge").join(near, "id", "left").selectExpr(
        "*", f"coalesce(-best.rank >= {TIMES} * n, false) AS follows").selectExpr(
        "id", "word", "n", "coalesce(n_near, 0L) AS n_near", "if(follows, best.near, NULL) AS form",
        "if(follows, -best.rank, NULL) AS form_n", "if(follows, best.near_id, NULL) AS form_id"))
    most = known.agg(F.max("n")).first()[0] or 1
    return known.hint("merge").join(roots(known.where("form_id IS NOT NULL"), most), "id", "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
