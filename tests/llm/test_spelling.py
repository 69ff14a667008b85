"""Spelling variants against comparing every two words letter by letter."""

import random
import re
import zlib
from collections import Counter

import pytest

from corpweave.llm import queries
from corpweave.llm import spelling as s


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain(rows):
    n = counted(rows)
    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, found in around.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n)


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n", "'x' AS word", "2 AS id")
    found = s.variants(docs.repartition(3))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect())


def edited(word, letters, draw):
    at, kind = draw.randrange(len(word) + 1), draw.randrange(3)
    new = draw.choice(letters)
    return word[:at] + (new if kind else "") + word[at + (kind != 1):]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aeioé÷ÿ"])
def test_every_pair_of_near_words_is_found(spark, letters):
    draw = random.Random(len(letters))
    words = {"".join(draw.choice(letters) for _ in range(draw.randrange(6, 10))) for _ in range(60)}
    words |= {edited(w, letters, draw) for w in words for _ in range(3)} | {"a" * k for k in range(6, 12)}
    rows = [(i, " ".join(w for w in sorted(words) for _ in range(draw.choice([1, 1, 3, 30])))) for i in range(6)]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "Variant variant VARIANT variant variant"), (5, "ÉCOLES écoles " * 3),
            (6, "Écoles " * 40), (7, "colour color " * 9 + "colouur " * 5), (7, "colour " * 400), (8, "color " * 80)]
    rows += [(9, "naturally1naturally-naturally_naturally.naturally")] * 2
    assert run(spark, rows) == plain(rows)


def test_chains_lead_to_the_root(spark):
    chain = ["abcdef", "abcdeg", "abcdhg", "abckhg", "ablkhg"]
    rows = [(i, " ".join(f"{w} " * (5 * 5**k) for k, w in enumerate(chain))) for i in range(1)]
    found = run(spark, rows)
    assert found == plain(rows)
    assert {r[2] for r in found} == {"ablkhg"}


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(s, "PIECE", 64)
    monkeypatch.setattr(s, "LONG", 100)
    draw = random.Random(4)
    base = "".join(draw.choice("abcd") for _ in range(700))
    words = [base, base[:300] + base[301:], base[:64] + "z" + base[64:], base + "a", base[1:], base[:-1] + "q", "b" * 200, "b" * 201]
    rows = [(1, " ".join(f"{w} " * (5 + k) for k, w in enumerate(words)))]
    assert run(spark, rows) == plain(rows)


def test_neighbourhood_is_full_and_has_no_key_twice():
    for word in ("aabbaa", "abcdefgh", "zzzzzzz", "éééabc"):
        keys = [k for part, _ in s.neighbours([word, word]) for k in part.tolist()]
        assert max(Counter(keys).values()) == 2


def test_empty(spark):
    assert run(spark, [(1, None)]) == []


def test_words_of_the_sample(spark):
    found = queries.op13_reduced_alphabet_variants(spark, "/root/testdata/sf0.001").collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    n = counted(rows)
    assert {r["word"]: r["n"] for r in found} == n
    some = [r for r in found if zlib.crc32(r["word"].encode()) % 8 == 0]
    assert some
    for r in some:
        assert r["n_near"] == sum(near(r["word"], x) for x in n)


def test_no_joined_side_is_broadcast_for_its_small_files(spark, tmp_path):
    """Files say little about the size of what is made of their words."""
    words = [(i, "abcdef" + "ghij"[i % 4] * (i // 4 + 1), 5 * 6 ** (i % 4), (i + 1 if i % 4 < 3 else None)) for i in range(40)]
    spark.createDataFrame(words, "id bigint, word string, n bigint, form_id bigint").write.parquet(f"{tmp_path}/words")
    stored = spark.read.parquet(f"{tmp_path}/words")
    docs = spark.createDataFrame([(i, f"{w} " * n) for i, w, n, _ in words], "doc_id bigint, text string")
    forms = stored.where("form_id IS NOT NULL").selectExpr("id", "form_id", "word AS form")
    for made in (s.near_words(stored.select("id", "word", "n")), s.roots(forms, 1000), s.variants(docs)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
