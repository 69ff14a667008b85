"""Shorter repeated strings, and the order of suffixes that end together."""

import random

import numpy as np

import corpus_pipeline
from corpweave.llm import repeats as r


def test_cleaned_at_a_shorter_length_equals_counting(spark):
    random.seed(4)
    draw = lambda n: "".join(random.choice("etaoin shrdlu.") for _ in range(n))
    texts = [draw(random.randint(0, 500)) for _ in range(30)]
    for _ in range(25):
        passage = draw(random.randint(195, 230))
        texts += [draw(random.randint(0, 300)) + passage + draw(random.randint(0, 300)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = dict(tuple(x) for x in r.cleaned(docs.repartition(3), length=200).collect())
    for i, (text, flags) in enumerate(zip(texts, r.plain_repeats([t.encode() for t in texts], 200))):
        gone = np.zeros(len(text), bool)
        for at in np.flatnonzero(flags):
            gone[at:at + 200] = True
        assert got[i] == "".join(c for c, g in zip(text, gone) if not g)


def test_pipeline_removes_passages_of_over_fifty_words(spark):
    random.seed(6)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(random.randint(3, 7)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages = [say(51) for _ in range(10)]
    assert all(200 <= len(p) < 400 for p in passages)
    rows = [(2 * i + k, f"{say(40)} {p} {say(40)}") for i, p in enumerate(passages) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = dict(tuple(x) for x in corpus_pipeline.repeated_strings(spark, docs, "").collect())
    assert not any(p in t for p in passages for t in kept.values())
    assert all(len(t) > 100 for t in kept.values())


def test_suffix_order_is_the_one_of_the_suffixes():
    random.seed(2)
    for _ in range(50):
        parts = ["".join(random.choice("ab") for _ in range(random.randint(1, 40))) for _ in range(5)]
        text = np.array([ord(c) - 96 if c != "\0" else 0 for c in "\0".join(parts) + "\0"], np.int64)
        ends = iter(range(len(text)))
        symbols = [(1, int(c)) if c else (0, next(ends)) for c in text]
        assert r.suffix_order(text, 64).tolist() == sorted(range(len(text)), key=lambda i: symbols[i:])


def test_next_true_either_way():
    random.seed(3)
    for share in (0.5, 0.01):
        flags = np.array([random.random() < share for _ in range(2000)] + [True])
        wanted = [int(np.flatnonzero(flags[i + 1:])[0]) + i + 1 for i in range(2000)]
        for rows in (np.arange(2000), *(np.arange(i, min(i + 25, 2000)) for i in range(0, 2000, 25))):
            assert r.next_true(flags, rows).tolist() == [wanted[i] for i in rows]
