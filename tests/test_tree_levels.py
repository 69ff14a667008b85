"""The prefix tree is walked level by level and tells the distance of each pair once."""

import random

import pytest

from corpweave.operators import prefix_tree
from tests import brute


@pytest.mark.parametrize("reach", [1, 2, 3])
@pytest.mark.parametrize("together", [50, 250_000])
def test_meetings_are_the_near_pairs_with_their_distance(monkeypatch, reach, together):
    monkeypatch.setattr(prefix_tree, "TOGETHER", together)
    random.seed(reach)
    draw = lambda: "".join(random.choice("ab\0é😀") for _ in range(random.randint(0, 8)))
    names, words = sorted({draw() for _ in range(120)}), sorted({draw() for _ in range(120)} | {"", "ab"})
    found = [(names[i], words[w], int(d)) for x in prefix_tree.meetings(names, words, reach) for i, w, d in zip(*x)]
    assert sorted(found) == sorted(brute.name_pairs(names, words, reach))


def test_a_level_takes_one_step_for_all_its_nodes(monkeypatch):
    steps = []
    step = prefix_tree._step
    monkeypatch.setattr(prefix_tree, "_step", lambda *x: steps.append(1) or step(*x))
    names = [f"customer {i:06d}" for i in range(1000)]
    assert sum(len(rows) for rows, _ in prefix_tree.walk(names, names, 2)) > 100_000
    assert len(steps) < 50


def test_pairs_of_several_tiles_come_once(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "TILE_NAMES", 30)
    monkeypatch.setattr(prefix_tree, "WALKING_NAMES", 25)
    left, right = [f"company {i:04d}" for i in range(0, 300, 3)], [f"company {i:04d}" for i in range(0, 300, 4)]
    frames = [spark.createDataFrame([(n,) for n in x], "name string") for x in (left, right)]
    assert sorted(tuple(r) for r in prefix_tree.pairs(*frames, 2).collect()) == sorted(brute.name_pairs(left, right, 2))
