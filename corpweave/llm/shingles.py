"""Distinct word shingles of many texts at once, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from corpweave.llm.arrow import groups_of_rows
from corpweave.llm.words import mix, word_hashes

SIZE = 5


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, ends) for some texts at a time, in order: text i has hashes[ends[i]:ends[i + 1]].

    A text of fewer words than ``SIZE``, but not none, has all of them as its one shingle.
    """
    for i, j in groups_of_rows(offsets):
        part = offsets[i:j + 1]
        yield sets_of(*word_hashes(raw[part[0]:part[-1]], part - part[0]))


def sets_of(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(firsts)
    total = np.zeros(len(words), np.uint64)
    ends = np.repeat(firsts[1:], counts)
    here = np.arange(len(words))
    for k in range(SIZE):
        inside = here + k < ends
        shifted = np.zeros(len(words), np.uint64)
        shifted[:max(len(words) - k, 0)] = words[k:]
        total += np.where(inside, mix(shifted + np.uint64(k + 1)), np.uint64(0))
    n = np.where(counts > 0, np.maximum(counts - SIZE + 1, 1), 0)
    of = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(firsts[:-1], n)
    hashes = mix(total[at])
    order = np.lexsort((hashes, of))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[fresh], np.concatenate([[0], np.cumsum(np.bincount(of[fresh], minlength=len(counts)))])
