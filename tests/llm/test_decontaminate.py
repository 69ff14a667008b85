"""Passages found through the index against a plain search for every window."""

import hashlib
import random
import re

import pytest

from corpweave.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(text)


def brute(docs, items, window=10):
    phrases = {}
    for item, text in items:
        own = words(text)
        for i in range(max(len(own) - window, 0) + 1 if own else 0):
            phrases.setdefault(tuple(own[i:i + window]), set()).add(item)
    found = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for i in range(len(own)):
            for n in {len(p) for p in phrases}:
                if i + n <= len(own) and tuple(own[i:i + n]) in phrases:
                    hit |= set(range(i, i + n))
                    names |= {x for x in phrases[tuple(own[i:i + n])] if x is not None}
        listed = sorted(map(str, names))
        found.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def cases():
    random.seed(4)
    vocabulary = ["The", "cat", "é", "on", "a", "MAT", "9", "x1", "Überall"]
    draw = lambda n: ", ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, draw(random.choice([3, 7, 10, 14, 25]))) for i in range(12)]
    items += [(20, None), (21, "  !!"), (22, "cat"), (3, items[4][1]), (None, draw(11)), (23, items[4][1])]
    texts = [t for _, t in items if t]
    docs = [(i, draw(random.choice([0, 1, 9, 40])) + " " + random.choice(texts) + " other. " + draw(3)) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "zzz"), (0, docs[0][1]), (None, texts[0]), (53, "none here " * 50),
             (54, (texts[0] + " stop ") * 300)]
    return docs, items


def got(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    # Other columns are ignored, whatever they are called.
    docs = docs.selectExpr("*", "'x' AS spans", "1 AS item_id", "2 AS n_words").repartition(3)
    found = d.report(docs, items, **options)
    return sorted((tuple(r)[:6] for r in found.collect()), key=repr)


@pytest.mark.parametrize("block_phrases", [100_000, 60])
def test_report_equals_plain_search(spark, block_phrases):
    docs, items = cases()
    assert got(spark, docs, items, block_phrases=block_phrases) == brute(docs, items)


def test_short_windows_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(d, "SHARD_BYTES", 64)
    docs, items = cases()
    assert got(spark, docs, items, window=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = cases()
    assert got(spark, [], items) == []
    assert got(spark, docs, []) == brute(docs, [])


def test_spans_are_merged_and_clean_keeps_columns(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, "x A, b c d e f g h i j K l y", "p"), (2, "a b c", "q"), (3, None, None)], "doc_id bigint, text string, n_hit string")
    spans = {r["doc_id"]: r["spans"] for r in d.contamination(docs, items).collect()}
    assert [tuple(s) for s in spans[1]] == [(1, 13)] and spans[2] == [] and spans[3] == []
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(d, "SLICE_BYTES", 50)
    docs, items = cases()
    assert got(spark, docs, items) == brute(docs, items)
