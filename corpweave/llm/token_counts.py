"""Exact token counts of every prefix of a text, by dynamic programming.

Byte-level BPE cuts a text into pieces by a pattern and merges bytes inside a piece. Within a piece
the encoding of a prefix is the encoding of a shorter prefix plus one token: of all tokens ending
there exactly one can follow the shorter prefix's last token. Two tokens can follow one another iff
encoding their bytes together gives these two again. So one pass over the ends fills a table with
the last token and the token count of every prefix; truncation points and budget questions are read
from it and nothing is encoded again. Tables are shared between pieces with a common beginning, and
kept within a bounded memo that every task can fill anew.

A null text counts as empty; an empty text has no tokens. Rows are independent, so repeated rows and
repeated ids give repeated results; other columns than the id and the text are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import CACHE, in_small_batches, kept_by_worker, strings

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: Entries a memo may hold before it is emptied.
MOST_KEPT = 400_000


class Unfit(Exception):
    """A blank-separated unit that cannot be counted apart from its neighbours."""


class PrefixCounter:
    """Token counts of all prefixes under one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        self.letter = letters
        self.vocab = frozenset(spec["model"]["vocab"])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {tuple(pair): place for place, pair in enumerate(pairs)}
        self.made = {a + b: (place, (a, b)) for (a, b), place in self.rank.items()}
        self.spines: tuple[dict, dict] = {}, {}
        self.longest = max(map(len, self.vocab))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = special
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.follows: dict[tuple[str, str], bool] = {}
        self.table: dict[str, tuple[str, int]] = {"": ("", 0)}
        self.units = Units(self)
        self.totals: dict[str, int] = {}

    def spine(self, token: str, right: bool) -> list[tuple[str, int]]:
        """The nodes of a token's merge tree along one edge, each with the rank that consumes it."""
        known = self.spines[right].get(token)
        if known is None:
            nodes, until = [], 1 << 60
            while True:
                nodes.append((token, until))
                if token not in self.made:
                    break
                until, halves = self.made[token]
                token = halves[right]
            known = self.spines[right][nodes[0][0]] = nodes
        return known

    def apart(self, first: str, second: str) -> bool:
        """Whether no merge crosses from one token into the next.

        A pair of edge nodes merges iff its rank comes before the ranks that consume either node;
        of equal ranks the one further left comes first.
        """
        rank = self.rank
        for a, until_a in self.spine(first, True):
            for b, until_b in self.spine(second, False):
                if (found := rank.get((a, b))) is not None and found < until_a and found <= until_b:
                    return False
        return True

    def follow(self, first: str, second: str) -> bool:
        known = self.follows.get((first, second))
        if known is None:
            if len(self.follows) >= MOST_KEPT:
                self.follows.clear()
            known = self.follows[first, second] = self.apart(first, second)
        return known

    def extend(self, text: str) -> tuple[str, int]:
        """(last token, count) of ``text``, in byte letters; fills the table for its prefixes."""
        table, vocab, longest = self.table, self.vocab, self.longest
        if (known := table.get(text)) is not None:
            return known
        if len(table) + len(text) > MOST_KEPT:
            table.clear()
            table[""] = ("", 0)
        if len(text) > 1000:
            return self._long(text)[-1]
        start = len(text) - 1
        while text[:start] not in table:
            start -= 1
        last, count = table[text[:start]]
        for end in range(start + 1, len(text) + 1):
            # Only one candidate can follow, so the likely ones are tried first.
            letter = text[end - 1]
            grown = last + letter
            before, used = table[text[:end - 1 - len(last)]]
            if grown in vocab and (not used or self.follow(before, grown)):
                last, count = grown, used + 1
            elif letter in vocab and self.follow(last, letter):
                last, count = letter, count + 1
            else:
                for begin in range(max(0, end - longest), end - 1):
                    token = text[begin:end]
                    if token in vocab:
                        before, used = table[text[:begin]]
                        if not used or self.follow(before, token):
                            last, count = token, used + 1
                            break
            table[text[:end]] = last, count
        return table[text]

    def _long(self, text: str) -> list[tuple[str, int]]:
        """The same for a very long piece, by position instead of by prefix string."""
        table = [("", 0)]
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = text[begin:end]
                if token in self.vocab and (not begin or self.follow(table[begin][0], token)):
                    table.append((token, table[begin][1] + 1))
                    break
        return table

    def piece_prefixes(self, piece: str) -> list[int]:
        """Tokens of every prefix of a piece, by its characters from one to all.

        A prefix that ends inside a character does not occur.
        """
        written = [self.written(c) for c in piece]
        whole = "".join(written)
        ends = list(accumulate(map(len, written)))
        if len(whole) > 1000:
            table = self._long(whole)
            return [table[e][1] for e in ends]
        if len(self.table) + len(whole) > MOST_KEPT:
            self.table.clear()
            self.table[""] = ("", 0)
        self.extend(whole)
        return [self.extend(whole[:e])[1] for e in ends]

    def written(self, text: str) -> str:
        letter = self.letter
        return "".join([letter[b] for b in text.encode("utf-8")])

    def piece_total(self, piece: str) -> int:
        known = self.totals.get(piece)
        if known is None:
            if len(self.totals) >= MOST_KEPT:
                self.totals.clear()
            known = self.totals[piece] = self.extend(self.written(piece))[1]
        return known

    def parts(self, text: str) -> list[str]:
        """Pieces and special strings of a text in order."""
        if self.split is None or not any(s in text for s in self.special):
            return self.pieces(text)
        found = []
        for part in self.split.split(text):
            found += [part] if part in self.special else self.pieces(part)
        return found

    def total(self, text: str) -> int:
        """Tokens of the whole text."""
        first, *rest = text.split(" ")
        try:
            if any(s in text for s in self.special):
                raise Unfit
            if first[-1:].isspace() or not first and rest:
                raise Unfit
            return sum(map(self.units.__getitem__, rest), sum(map(self.piece_total, self.pieces(first))))
        except Unfit:
            return sum(1 if p in self.special else self.piece_total(p) for p in self.parts(text))

    def prefixes(self, text: str) -> list[int]:
        """Tokens used by the first n characters of the text's encoding, n from 0 to all of them.

        Cuts are those of the whole text: pieces are not formed anew when a prefix ends inside one.
        """
        counts = [0]
        for part in self.parts(text):
            before = counts[-1]
            if part in self.special:
                counts += [before + 1] * len(part)
            else:
                counts += [before + n for n in self.piece_prefixes(part)]
        return counts

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix, cut as in ``prefixes``, within ``budget`` tokens."""
        used, chars = 0, 0
        for part in self.parts(text):
            need = 1 if part in self.special else self.piece_total(part)
            if used + need > budget:
                inside = [1] * len(part) if part in self.special else self.piece_prefixes(part)
                # Counts inside a piece may fall again where tokens merge; the last fit counts.
                fits = [n for n, count in enumerate(inside, 1) if used + count <= budget]
                return chars + (fits[-1] if fits else 0)
            used, chars = used + need, chars + len(part)
        return chars


class Units(dict):
    """Tokens of a blank and the text up to the next blank."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter

    def __missing__(self, unit: str) -> int:
        if not unit or unit[0].isspace() or unit[-1].isspace():
            raise Unfit
        if len(self) >= MOST_KEPT:
            self.clear()
        found = sum(map(self.counter.piece_total, self.counter.pieces(" " + unit)))
        if len(unit) < 64:
            self[unit] = found
        return found


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: printable bytes
    for themselves, the others in order from code 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def counter(tokenizer: str) -> PrefixCounter:
    path = public_tokenizers.path(tokenizer)
    return kept_by_worker(CACHE + "prefixes_" + tokenizer, lambda: PrefixCounter(path))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) of every text.

    ``fit_chars`` is the length of the longest prefix that needs at most ``limit`` tokens.
    """
    kind = "struct<n_tokens:bigint,fit_chars:bigint>"

    @F.arrow_udf(kind)
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = counter(tokenizer)
        for column in columns:
            texts = strings(column)
            totals = [counts.total(x) for x in texts]
            fits = [len(x) if n <= limit else counts.fitting(x, limit) for x, n in zip(texts, totals)]
            yield pa.StructArray.from_arrays(
                [pa.array(totals, pa.int64()), pa.array(fits, pa.int64())], ["n_tokens", "fit_chars"])

    found = in_small_batches(docs).select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
        count(text_col).alias("found"),
    )
    return found.select("doc_id", "n_bytes", "found.n_tokens",
                        (F.col("found.n_tokens") > limit).alias("over_limit"), "found.fit_chars")
