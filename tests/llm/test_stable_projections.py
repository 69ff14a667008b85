"""Nearest vectors against all inner products."""

import math

import numpy as np
import pytest

from corpweave.llm import queries
from corpweave.llm import stable_projections as p

INF, NAN = float("inf"), float("nan")


def usable(v):
    return bool(v) and None not in v and all(map(math.isfinite, v)) and any(v)


def plain(rows, k=20):
    found = []
    good = [(i, v) for i, v in rows if usable(v)]
    for at, (q, vector) in enumerate(good):
        if q is None or q % 20:
            continue
        others = []
        for other, (i, v) in enumerate(good):
            if other != at and len(v) == len(vector):
                score = 0.0
                for a, b in zip(v, vector):
                    score += a * b
                others.append((-score, i is None, i or 0))
        found += [(q, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(others)[:k])]
    return sorted(found, key=repr)


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return docs.selectExpr("*", "1 AS mark", "'x' AS id", "2 AS score", "true AS asks").repartition(3)


def run(spark, rows, **options):
    found = p.search(frame(spark, rows), **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def drawn(count, dim, seed=1, groups=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dim))
    x = centres[draw.integers(0, groups, count)] + 0.4 * draw.normal(size=(count, dim))
    return [(i, [float(c) for c in row]) for i, row in enumerate(x.astype(np.float32))]


def test_odd_rows_ties_and_copies(spark):
    rows = drawn(90, 6)
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(45)] + [(2000, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0])] * 2
    rows += [(40, rows[3][1]), (None, rows[20][1]), (60, rows[60][1]), (3000, None), (3020, []), (3040, [0.0] * 6),
             (3060, [NAN] * 6), (3080, [INF, 1.0, 0.0, 0.0, 0.0, 0.0]), (3100, [None, 1.0]), (3120, [1.0, 2.0]), (3121, [-1.0, 0.5])]
    assert run(spark, rows) == plain(rows)


def test_fewer_rows_than_neighbours(spark):
    rows = drawn(5, 3) + [(20, [1.0, 0.0, 0.0])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [(20, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, None)]) == []


def test_empty(spark):
    assert p.search(frame(spark, [(1, [1.0])]).where("false")).collect() == []


def test_cells_blocks_and_parts_keep_the_recall(spark, monkeypatch):
    rows = drawn(1500, 10, seed=2, groups=30)
    for name, value in (("CELL_ROWS", 200), ("BLOCK_ROWS", 90), ("ASKING_ROWS", 8), ("LEAF_ROWS", 16), ("SAMPLE_ROWS", 400)):
        monkeypatch.setattr(p, name, value)
    found, expected = run(spark, rows), plain(rows)
    assert len(found) == len(expected)
    exact = {(q, i) for q, _, i, _ in expected}
    hits = sum((q, i) in exact for q, _, i, _ in found)
    assert hits >= 0.95 * len(exact)
    scores = {(q, i): s for q, _, i, s in expected}
    assert all(s == scores[q, i] for q, _, i, s in found if (q, i) in scores)


def test_lengths_of_all_sizes(spark):
    draw = np.random.default_rng(8)
    rows = [(i, [float(c) for c in (draw.normal(size=4) * 10.0 ** draw.integers(-3, 4)).astype(np.float32)]) for i in range(200)]
    found, expected = run(spark, rows), plain(rows)
    assert len({(r[0], r[2]) for r in found} & {(r[0], r[2]) for r in expected}) >= 0.95 * len(expected)


@pytest.mark.parametrize("degrees", [2, 8, 16])
def test_chi_square(degrees):
    draw = np.random.default_rng(degrees)
    squares = (draw.normal(size=(200_000, degrees)) ** 2).sum(1)
    limit = p.quantile(0.9, degrees)
    assert (squares <= limit).mean() == pytest.approx(0.9, abs=0.005)


def test_leaves_come_by_growing_distance_and_only_until_the_test_holds():
    draw = np.random.default_rng(3)
    points = draw.normal(size=(500, 4))
    points[100:200] = points[0]
    tree = p.built(points, 10)
    query = draw.normal(size=4)
    seen, before, rows = set(), 0.0, []
    for bound, leaf in p.by_distance(tree, query.tolist()):
        own = tree.order[tree.ends[leaf]:tree.ends[leaf + 1]]
        assert bound >= before and (((points[own] - query) ** 2).sum(1) >= bound - 1e-9).all()
        assert (p.leaf_of(tree, points[own]) == leaf).all()
        before = bound
        seen.add(leaf)
        rows += own.tolist()
    assert sorted(rows) == list(range(500)) and len(seen) == len(tree.ends) - 1
    # Tight groups: most leaves are never asked for.
    x = np.repeat(draw.normal(size=(40, 12)), 50, axis=0) + 0.01 * draw.normal(size=(2000, 12))
    x /= np.sqrt((x * x).sum(1))[:, None]
    s = p.space(12, float((x * x).sum(1).max()), 20, 8, 0.95)
    tree = p.built(s.points(x), 16)
    asked = []

    class Counting(list):
        def __getitem__(self, i):
            asked.append(i)
            return super().__getitem__(i)

    p.searched(s, tree._replace(ends=Counting(tree.ends)), x[tree.order], tree.order, x[7], s.queries(x[7:8])[0].tolist(), -math.inf)
    assert len(asked) / 2 < 0.3 * (len(tree.ends) - 1)


def test_query(spark):
    found = queries.op12_stable_projections(spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    expected = plain(rows)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert len(got) == len(expected)
    assert len(set(got) & set(expected)) >= 0.9 * len(expected)
