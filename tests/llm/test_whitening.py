"""Whitening against exact fractions and a plain loop over rows."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpweave.llm import queries
from corpweave.llm import whitening as w

INF, NAN = float("inf"), float("nan")


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_bit_planes_give_exact_cross_products(data):
    dims = data.draw(st.integers(1, 4))
    size = data.draw(st.sampled_from([1, 300, 1 << 20, 1 << 62]))
    rows = data.draw(st.lists(st.lists(st.integers(-size, size), min_size=dims, max_size=dims), min_size=1, max_size=140))
    found = w.bit_sliced(np.array(rows, np.int64))
    assert found.n == len(rows)
    assert found.sums.tolist() == [sum(c) for c in zip(*rows)]
    assert found.cross.tolist() == [[sum(r[a] * r[b] for r in rows) for b in range(dims)] for a in range(dims)]


def plain(rows, components=16):
    """One row at a time, with fractions up to the eigenvalues."""
    import math

    whole = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
             if v and None not in v and all(map(math.isfinite, v))]
    result = {}
    for dim in {len(x) for _, x in whole}:
        own = [(i, x) for i, x in whole if len(x) == dim]
        fit = sorted({tuple(x) for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        v = [[float(sum((x[a] - Fraction(sums[a], n)) * (x[b] - Fraction(sums[b], n)) for x in fit) / n)
              for b in range(dim)] for a in range(dim)]
        e, axes = np.linalg.eigh(np.array(v))
        e, axes = e[::-1], axes[:, ::-1]
        for i, x in own:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            for k in range(min(components, dim)):
                value = sum(float(x[a] - Fraction(sums[a], n)) * axes[a, k] for a in range(dim))
                if e[k] > 1e-9:
                    result.setdefault((i, dim, k + 1), []).append((n, deviation, abs(value / e[k] ** 0.5), e[k] / sum(e)))
                else:
                    result.setdefault((i, dim, k + 1), []).append((n, deviation, None, None))
    return result


def check(found, rows):
    expected = plain(rows)
    lengths = {i: len(v) for i, v in rows if v}
    seen = {}
    for r in found:
        seen.setdefault((r["vec_id"], lengths[r["vec_id"]], r["component"]), []).append(r)
    assert seen.keys() == expected.keys()
    for key, cases in expected.items():
        assert len(cases) == len(seen[key])
        for r, (n, deviation, value, share) in zip(
                sorted(seen[key], key=lambda r: (r["deviation"], abs(r["whitened"] or 0))),
                sorted(cases, key=lambda c: (c[1], c[2] or 0))):
            assert (r["n"], r["deviation"]) == (n, deviation)
            if value is None:
                assert r["whitened"] is None
            else:
                assert abs(r["whitened"]) == pytest.approx(value, rel=1e-6, abs=1e-7)
                assert r["explained"] == pytest.approx(share, rel=1e-6)
                assert r["identity_error"] < 1e-6


def frame(spark, rows):
    kind = "vec_id bigint, embedding array<float>"
    return spark.createDataFrame(rows, kind).selectExpr("*", "1 AS n", "'x' AS dim", "2 AS component").repartition(3)


def test_equals_plain_loop_with_odd_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, 0.3, 5)]) for i in range(60)]
    rows += [(100, rows[0][1]), (100, rows[1][1]), (7, rows[7][1]), (200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]),
             (203, [NAN, 0.0, 0.0, 0.0, 0.0]), (204, [0.0, INF, 0.0, 0.0, 0.0]), (205, [-0.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(300 + i, [float(np.float32(x)) for x in draw.normal(0, 40, 3)]) for i in range(9)]
    check(w.whiten(frame(spark, rows)).collect(), rows)


def test_no_variance(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    found = w.whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"])
                  for r in found) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    line = [(i, [float(i), 2.0 * i]) for i in range(5)]
    found = w.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in found if r["whitened"] is None} == {2}
    check(found, line)


def test_huge_entries_and_null_ids(spark):
    rows = [(None, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])]
    found = w.whiten(frame(spark, rows)).collect()
    assert len(found) == 6 and all(r["n"] == 3 for r in found)
    top = 2**62 + 10**6
    sums = [top - 2**62 + 10**6 + 10**6, 3 * 10**6 + 192]
    of = {r["vec_id"]: r["deviation"] for r in found}
    assert int(of[3]) == (3 * 10**6 - sums[0]) ** 2 + (3 * 10**6 - sums[1]) ** 2
    assert of[None] is None and of[2] is None  # beyond 38 digits


def test_empty(spark):
    assert w.whiten(frame(spark, []).limit(0)).collect() == []


def test_few_lengths_at_a_time(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, 1, 2 + i % 3)]) for i in range(40)]
    monkeypatch.setattr(w, "MODEL_BYTES", 1)
    monkeypatch.setattr(w, "HELD", 1)
    check(w.whiten(frame(spark, rows)).collect(), rows)


def test_query(spark):
    found = queries.op11_bit_sliced_whitening(spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                  "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(found.collect(), rows)
