"""Words of whole texts as 64-bit hashes, computed on the bytes of many texts at once.

A word is a run of bytes without white space (blank, tab, line feed, vertical tab, form feed,
carriage return); A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

from corpweave.llm.arrow import SLICE_BYTES, kept_by_worker

_SPACES = [9, 10, 11, 12, 13, 32]


class _Tables:
    """A random number per byte, with A-Z as a-z, and powers of an odd base and of its inverse."""

    def __init__(self):
        draw = np.random.default_rng(20)
        self.code = draw.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.code[65:91] = self.code[97:123]
        self.space = np.zeros(256, bool)
        self.space[_SPACES] = True
        base = 0x9E3779B97F4A7C15
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE_BYTES)
            self.up, self.down = (powers(b, size) for b in (self.base, self.inverse))
        return self.up, self.down


def powers(base: int, n: int) -> np.ndarray:
    found = np.ones(1, np.uint64)
    while len(found) < n:
        factor = np.uint64(pow(base, len(found), 1 << 64))
        found = np.concatenate([found, found * factor])
    return found[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the number of all words).

    Words never cross from one text into the next. Long input goes slice by slice, cut at spaces or
    at text ends.
    """
    tables = kept_by_worker("word_tables", _Tables)
    hashes, starts, at, n = [], [], 0, len(raw)
    while at < n:
        end = n
        if n - at > SLICE_BYTES:
            end = _cut(raw, offsets, at + SLICE_BYTES, tables.space)
        part = raw[at:end]
        space = tables.space[part]
        begin, stop = ~space, ~space
        begin[1:] &= space[:-1]
        stop[:-1] &= space[1:]
        # A text's end ends a word and its start begins one.
        inner = offsets[np.searchsorted(offsets, at, "right"):np.searchsorted(offsets, end, "left")] - at
        begin[inner] |= ~space[inner]
        stop[inner - 1] |= ~space[inner - 1]
        first, last = np.flatnonzero(begin), np.flatnonzero(stop)
        up, down = tables.powers(len(part))
        total = np.cumsum(tables.code[part] * up[:len(part)])
        value = total[last]
        value[first > 0] -= total[first[first > 0] - 1]
        hashes.append(mix(value * down[first]))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets, "left")


def _cut(raw: np.ndarray, offsets: np.ndarray, at: int, space: np.ndarray) -> int:
    """The first place from ``at`` on where a slice may end."""
    text_end = int(offsets[np.searchsorted(offsets, at, "left")])
    while at < text_end:
        found = np.flatnonzero(space[raw[at:min(at + 4096, text_end)]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return text_end
