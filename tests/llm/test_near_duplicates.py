"""Components against comparing every pair of texts and of vectors."""

import random
import re

import numpy as np

from corpweave.llm import embedding_neighbours as e
from corpweave.llm import near_duplicates as n


def groups(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a < b
             and x and y and 100 * len(x & y) >= 75 * len(x | y)]
    group = groups({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), group.get(i), i is None or group[i] == i) for i, s in sets), key=repr)


def cases(copies=60):
    random.seed(2)
    draw = lambda k: [random.choice(["The", "a", "Ä", "of", "x", "run", "b c"]) + str(random.randint(0, 30)) for _ in range(k)]
    rows, number = [], iter(range(100, 10_000))
    for size in (5, 8, 20, 120):
        base = draw(size)
        for _ in range(copies if size == 120 else 12):
            own = list(base)
            for _ in range(random.randint(0, max(1, size // 18))):
                own[random.randrange(len(own))] = draw(1)[0]
            rows.append((next(number), " \t\n"[random.randrange(3)].join(own)))
    rows += [(next(number), " ".join(draw(random.randint(1, 60)))) for _ in range(60)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, rows[-70][1]), (8, rows[-70][1].upper())]
    rows += [(next(number), " ".join(draw(4000)))]
    random.shuffle(rows)
    return rows


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS rep", "'q' AS bands").repartition(3)
    return sorted((tuple(r) for r in n.linked(docs).collect()), key=repr)


def test_components_equal_all_pairs(spark):
    assert run(spark, cases()) == brute(cases())


def test_blocks_of_a_crowded_bucket(spark, monkeypatch):
    monkeypatch.setattr(n, "BLOCK", 7)
    rows = [r for r in cases(80)][:170]
    assert run(spark, rows) == brute(rows)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, None)]
    assert run(spark, rows) == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
                                       (None, 0, None, True)], key=repr)
    assert run(spark, []) == []


def test_distinct_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x y z", 7), (2, "x  y Z", 8), (None, "x y z", 9)], "doc_id bigint, text string, rep int")
    kept = n.distinct(docs)
    assert kept.columns == docs.columns and sorted(r["rep"] for r in kept.collect()) == [7, 9]


def test_registers_estimate_similarity():
    draw = np.random.default_rng(1)
    shared, one, two = draw.integers(0, 1 << 62, 900, np.uint64), draw.integers(0, 1 << 62, 100, np.uint64), draw.integers(0, 1 << 62, 100, np.uint64)
    sets = [np.sort(np.concatenate([shared, one])), np.sort(np.concatenate([shared, two]))]
    found = n.registers(n.least_hashes(np.concatenate(sets), np.array([0, 1000, 2000])))
    assert abs(n.corrected((found[0] == found[1]).mean()) - 900 / 1100) < 0.1


def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for k in range(30):
        base = draw.standard_normal(16)
        for _ in range(int(draw.integers(1, 12))):
            rows.append((base + draw.standard_normal(16) * 0.12 * draw.random()).astype(np.float32).tolist())
    rows += [rows[0]] * 5 + [[2 * x for x in rows[0]], [0.0] * 16, None, [1.0] * 15 + [None], [float("nan")] * 16,
                             [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [], [1e-30] * 16, [1e30] * 16]
    return [(i, v) for i, v in enumerate(rows)]


def brute_vectors(rows):
    def unit(v):
        if not v or None in v or not np.isfinite(v).all() or not any(v):
            return None
        v = np.array(v, np.float64)
        v = v / np.abs(v).max()
        return v / np.sqrt(v @ v)

    units = [(i, unit(np.float32(v).tolist() if v and None not in v else v)) for i, v in rows]
    links = [(a, b) for a, x in units for b, y in units
             if a != b and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95]
    group = groups([i for i, _ in rows], links)
    return sorted((i, sum(a == i for a, _ in links), group[i], group[i] == i) for i, _ in rows)


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", 20)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS rep").repartition(3)
    assert sorted(tuple(r) for r in e.linked(table).collect()) == brute_vectors(rows)


def test_vectors_empty_and_null_id(spark):
    assert e.linked(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.01]), (4, [1.0, 0.0]), (5, None)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted((tuple(r) for r in e.linked(table).collect()), key=repr)
    assert found == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (5, 0, 5, True)], key=repr)
