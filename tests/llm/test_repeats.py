"""Removed bytes against counting every window."""

import hashlib
import random

import numpy as np
import pytest

from corpweave.llm import repeats as r


def brute(rows, length=400):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    found = []
    for (key, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:-1] if len(t) else gone[:0]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        found.append((key, len(t), int(gone.sum()), len(r.runs(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def cases():
    random.seed(3)
    syllables = ["tha", "ion", "é", "ou", " ", "er ", "x", ". ", "ß"]
    draw = lambda n: "".join(random.choice(syllables) for _ in range(n))
    passage, other, exact = draw(320), draw(200), draw(230).encode()[:400].decode("utf-8", "ignore")
    rows = [(i, draw(random.randint(0, 300)) + passage + draw(random.randint(0, 300))) for i in range(12)]
    rows += [(20 + i, draw(50) + other + chr(97 + i) + passage[:250] + draw(40)) for i in range(8)]
    rows += [(30, "ab" * 900), (31, "z" * 399), (32, "q" * 400), (33, "q" * 401), (34, None), (35, ""), (None, draw(900)),
             (36, exact), (37, draw(9) + exact), (38, exact[:-1] + "!" + draw(300)), (0, rows[0][1]), (39, rows[1][1])]
    rows += [(40, passage + draw(30) + passage), (41, draw(6000) + other + passage)]
    return rows


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "'k' AS spans")
    return sorted((tuple(x) for x in r.report(docs.repartition(3)).collect()), key=repr)


@pytest.mark.parametrize("shard_bytes", [1_500_000, 3000])
def test_report_equals_counting_windows(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(r, "SHARD_BYTES", shard_bytes)
    assert got(spark, cases()) == brute(cases())


def test_empty_table(spark):
    assert got(spark, []) == []


def test_cleaned_keeps_columns(spark):
    rows = [(1, "ä" * 500, "a"), (2, "short", None), (3, None, "c"), (4, "x" + "ä" * 300, "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    kept = r.cleaned(docs)
    assert kept.columns == docs.columns
    assert sorted((x[0], x[1], x[2]) for x in kept.collect()) == [(1, "", "a"), (2, "short", None), (3, None, "c"), (4, "x", "d")]


def test_interval_expansion_equals_counting(monkeypatch):
    monkeypatch.setattr(r, "LENGTH", 6)
    random.seed(8)
    for _ in range(200):
        parts = ["".join(random.choice("ab\0é") for _ in range(random.randint(0, 60))).encode() for _ in range(random.randint(1, 6))]
        want = r.plain_repeats(parts)
        assert all((a == b).all() for a, b in zip(r.repeated_windows(parts), want))


def test_passages_barely_longer_than_a_window(spark):
    """Anchors at a passage's ends differ with what stands around it."""
    random.seed(12)
    draw = lambda n: "".join(random.choice("etaoin shrdlu.") for _ in range(n))
    rows = []
    for i in range(60):
        passage = draw(random.randint(399, 430))
        rows += [(2 * i, draw(random.randint(0, 700)) + passage + draw(random.randint(0, 700))),
                 (2 * i + 1, draw(random.randint(0, 700)) + passage + draw(random.randint(0, 700)))]
    assert got(spark, rows) == brute(rows)
