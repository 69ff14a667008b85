"""Packing of tokenised documents into training sequences.

Documents are cut into pieces of at most one sequence, pieces are dealt at random into groups of
bounded size, and each group is packed by itself: first-fit decreasing, where a tournament tree over
the free room of all open sequences finds the first one with enough room in logarithmic time. The
number of groups follows the number of tokens, so no task holds more than a group, and every group
leaves about one sequence unfilled.

A null text counts as empty; an empty text still has its closing id. Rows are documents of their
own, so repeated rows and ids are packed as often as they occur; a null id stays null. Ties in
length go by the order of the pieces' numbers. Other columns than the id and the text are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpweave.llm.arrow import CACHE, giving_back, in_small_batches, kept_by_worker
from corpweave.llm.token_counts import byte_letters
from corpweave.operators import lineage

TOKENIZER = "word_bpe_49k.json"
CLOSING_ID = 2
SEQUENCE = 4096
#: Tokens of a group on average; a group is what one task packs at a time.
GROUP_TOKENS = 2_000_000
#: Words and pieces of words whose ids a worker keeps.
MOST_KEPT = 500_000

#: Separators that other string functions take for blanks and the vocabulary does not.
NOT_BLANK = "\x1c\x1d\x1e\x1f"
#: Below this character every text is in composed form and has lower case letter by letter.
PLAIN = "\u0250"
PIECES = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
#: The same for words of ASCII characters in lower case.
ASCII_PIECES = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+").findall


class WordIds(dict):
    """Ids of a blank-separated word, or of a piece of one, as little-endian 32-bit bytes.

    Blanks only separate in this vocabulary, so words are encoded apart from one another. Words of
    plain letters, digits and signs are cut into pieces here and only new pieces are merged by the
    library; words with contractions, special strings or other scripts go to it as they are.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def keep(self, word: str, found: bytes) -> bytes:
        if len(word) < 64:
            if len(self) >= MOST_KEPT:
                self.clear()
            self[word] = found
        return found

    def piece(self, piece: str) -> bytes:
        known = self.get(piece)  # a piece has the ids it has as a word of its own
        if known is None:
            written = piece  # printable ASCII characters are their own letters
            if not (piece.isascii() and piece.isprintable()):
                written = piece.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(written)]
            known = self.keep(piece, struct.pack(f"<{len(ids)}I", *ids))
        return known

    def __missing__(self, word: str) -> bytes:
        plain = word.isascii()
        if "'" in word or "<|" in word or not plain and max(word) >= PLAIN:
            return self.keep(word, self.encode(word))
        parts = (ASCII_PIECES if plain else PIECES)(word.lower())
        if parts == [word]:
            return self.piece(word)
        return self.keep(word, b"".join(map(self.piece, parts)))

    def text(self, text: str) -> bytes:
        if any(c in text for c in NOT_BLANK):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


def word_ids(tokenizer: str) -> WordIds:
    path = public_tokenizers.path(tokenizer)
    return kept_by_worker(CACHE + "ids_" + tokenizer, lambda: WordIds(Tokenizer.from_file(path)))


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = SEQUENCE,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every piece of every text."""
    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,ids:binary>>"
    parts = pa.struct([(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
                      + [("ids", pa.binary())])

    def cut_all(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, closing = word_ids(tokenizer), np.array([CLOSING_ID], "<u4").tobytes()
        step = 4 * length
        for column in columns:
            cells: list[list] = [[] for _ in parts]
            ends = [0]
            for text in column:
                data = ids.text(text.as_py() or "") + closing
                for at in range(0, len(data), step):
                    piece = data[at:at + step]
                    row = (at // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4, piece if with_ids else None)
                    for cell, value in zip(cells, row):
                        cell.append(value)
                ends.append(len(cells[0]))
            flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cells, parts)], fields=list(parts))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    # Type hints tell Spark the kind of function, and wrapping keeps them.
    cut = F.arrow_udf(kind)(giving_back(cut_all, CACHE + "ids_" + tokenizer))
    found = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.explode(cut(text_col)).alias("p"))
    columns = ["doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens"]
    return found.select(*columns, *(["p.ids"] if with_ids else []))


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every length; sequences are numbered as they are opened.

    The tree's leaves are the free room of the sequences, inner nodes the most room below them.
    Walking down to the left wherever there is room enough finds the first sequence that fits.
    """
    n = len(lengths)
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    places, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    sizes = lengths.tolist()
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        places[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= need
        node //= 2
        while node:
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
    return places, offsets


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = SEQUENCE,
         group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """The pieces with (sequence_id, offset), every sequence gapless from offset 0."""
    stored = lineage.cut(pieces(docs, tokenizer, length, id_col, text_col, with_ids))
    total = stored.agg(F.sum("length")).first()[0] or 0
    groups = -(-total // group_tokens) or 1
    # Stored rows keep their place, so a repeated task numbers them the same way.
    row = F.monotonically_increasing_id()
    dealt = stored.withColumn("_row", row).withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "start", "_row"), F.lit(groups)))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_row", ignore_index=True)
        places, offsets = first_fit_decreasing(part["length"].to_numpy(), length)
        part["sequence_id"] = part["_group"].to_numpy() * (1 << 32) + places
        part["offset"] = offsets
        return part[columns]

    columns = [*stored.columns, "sequence_id", "offset"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)
    # An open id would otherwise turn whole numbers into floating ones in the frame of a task.
    named = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
    kinds_in_task = kinds.replace(f"`doc_id` {stored.schema['doc_id'].dataType.simpleString()}", "`doc_id` string")
    packed = named.groupBy("_group").applyInPandas(fit, f"{kinds_in_task}, sequence_id bigint, offset bigint")
    return packed.withColumn("doc_id", F.col("doc_id").cast(stored.schema["doc_id"].dataType))
