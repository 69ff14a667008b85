import random
from pathlib import Path

import pytest

from corpweave.operators import components, golden, lineage, matching
from corpweave.settings import MatchRule
from tests import brute
from tests.conftest import rows
from tests.test_matching import frame, some_names, some_records

LINKS = "src string, dst string"


def node(i):
    return f"{i * 7919 % 100_003:06d}"


def path(n):
    return [(node(i), node(i + 1)) for i in range(n - 1)]


GRAPHS = {
    "one edge": [("b", "a")],
    "self, double, reversed": [("a", "a"), ("a", "b"), ("b", "a"), ("a", "b"), ("c", "c")],
    "path": path(300),
    "star, centre low": [("000", node(i)) for i in range(1, 400)],
    "star, centre high": [("zzz", node(i)) for i in range(1, 400)],
    "two cliques, one bridge": [
        (x + str(i), x + str(j)) for x in "ab" for i in range(12) for j in range(i)
    ] + [("a3", "b7")],
    "ring": path(50) + [(node(0), node(49))],
}


def check(spark, nodes, links):
    wanted = brute.least_in_component(nodes, links)
    got = components.corporate_ids(
        spark.createDataFrame([(n,) for n in wanted], "id string"),
        spark.createDataFrame(links, LINKS),
    )
    found = got.collect()
    assert len(found) == len(wanted)
    assert {r.record_id: r.corporate_id for r in found} == wanted


@pytest.mark.parametrize("name", GRAPHS)
def test_shapes(spark, name):
    check(spark, ["lonely"], GRAPHS[name])


def test_no_edges(spark):
    check(spark, ["a", "b"], [])


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    draw = random.Random(seed)
    links = [(node(draw.randrange(200)), node(draw.randrange(200))) for _ in range(40 + 70 * seed)]
    check(spark, [node(i) for i in range(200)], links)


def test_hub_with_split_joins(spark, forced_skew):
    check(spark, ["lonely"], GRAPHS["star, centre high"] + path(30))


def test_long_path_ends(spark):
    found = components.components(spark.createDataFrame(path(200), LINKS))
    assert found.select("component").distinct().count() == 1


def test_vertices_are_distinct(spark):
    records = frame(spark, [("1", "x"), ("1", "x"), ("2", "y")], "l")
    assert components.vertices(records, records).count() == 2


RULES = [
    MatchRule(), MatchRule(min_confidence=0.6), MatchRule(min_confidence=0.0),
    MatchRule(id_order=False), MatchRule(min_confidence=0.6, id_order=False),
    MatchRule(min_confidence=0.6, drop_empty=True), MatchRule(min_confidence=1.1),
]


@pytest.mark.parametrize("rule, seed", [(r, 11 + i % 2) for i, r in enumerate(RULES)], ids=str)
def test_linking_by_name_equals_linking_by_pairs(spark, rule, seed):
    names = some_names(seed, 25, "ab", 8) + ["", "abc"]
    left = [("l" + i if seed % 2 else i, n) for i, n in some_records(seed, 40, names)]
    right = [("r" + i if seed % 2 else i, n) for i, n in some_records(seed + 100, 60, names)]
    pairs = [(a, b) for a, b, *_ in brute.record_pairs(left, right, rule)]
    wanted = brute.least_in_component([i for i, _ in left + right], pairs)
    linked = {i for pair in pairs for i in pair}
    for side, records in zip(
        components.link_by_name(frame(spark, left, "l"), frame(spark, right, "r"), rule),
        (left, right),
    ):
        got = side.collect()
        assert sorted((r.record_id, r.company_name_normalised) for r in got) == sorted(records)
        for r in got:
            assert r.corporate_id == wanted[r.record_id]
            assert r.linked == (r.record_id in linked)


def test_attach_keeps_every_row(spark):
    records = frame(spark, [("1", "x"), ("1", "x"), ("2", "y")], "l")
    ids = spark.createDataFrame([("1", "1")], "record_id string, corporate_id string")
    got = golden.attach_corporate_id(records, ids).select("record_id", "corporate_id").collect()
    assert sorted(map(tuple, got), key=repr) == [("1", "1"), ("1", "1"), ("2", None)]


def test_shared_folder_follows_the_session(spark):
    assert lineage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_edges(spark):
    left = frame(spark, [("1", "abc")], "l")
    right = frame(spark, [("2", "abc")], "r")
    links = components.edges(matching.match_records(left, right))
    assert [tuple(r) for r in links.collect()] == [("1", "2")] and links.columns == ["src", "dst"]


def stored_folders(spark):
    root = Path(lineage.shared_folder(spark).removeprefix("file:"))
    return {p.name for p in root.glob("corpweave-*")}


def test_finished_rounds_are_deleted(spark, monkeypatch):
    before, most = stored_folders(spark), [0]
    cut = lineage.cut

    def cut_and_count(df):
        found = cut(df)
        most[0] = max(most[0], len(stored_folders(spark) - before))
        return found

    monkeypatch.setattr(lineage, "cut", cut_and_count)
    found = components.components(spark.createDataFrame(path(60), LINKS))
    # The links of two half rounds and, between them, the least neighbours.
    assert most[0] <= 3 and len(stored_folders(spark) - before) == 1
    assert found.count() == 60


def test_clear_deletes_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(lineage, "_MADE", {})
    stored = lineage.cut(spark.range(3))
    folder = lineage._FOLDERS[stored].rsplit("/", 1)[1]
    assert folder in stored_folders(spark)
    lineage.clear()
    assert folder not in stored_folders(spark)


@pytest.mark.parametrize("seed", range(3))
def test_extended_ids_equal_those_of_all_links(spark, seed):
    draw = random.Random(seed)
    nodes = [node(i) for i in range(120)]
    link = lambda most: (node(draw.randrange(most)), node(draw.randrange(most)))
    old, new = [link(100) for _ in range(50)], [link(130) for _ in range(25)] + [(node(5), node(5))]
    frames = [spark.createDataFrame(x, LINKS) for x in (old, new, old + new)]
    known = spark.createDataFrame([(n,) for n in nodes], "id string")
    ids = components.corporate_ids(known, frames[0])
    everything = {n for n in nodes} | {n for pair in new for n in pair}
    wanted = components.corporate_ids(spark.createDataFrame([(n,) for n in everything], "id string"), frames[2])
    assert rows(components.extended_ids(ids, frames[1])) == rows(wanted)


def test_extended_ids_without_new_links(spark):
    ids = spark.createDataFrame([("a", "a"), ("b", "a")], "record_id string, corporate_id string")
    assert rows(components.extended_ids(ids, spark.createDataFrame([], LINKS))) == [("a", "a"), ("b", "a")]


def test_extended_ids_loop_only_over_touched_entities(spark, monkeypatch):
    ids = spark.createDataFrame([(node(i), node(i - i % 50)) for i in range(1000)], "record_id string, corporate_id string")
    seen, loop = [], components.components
    monkeypatch.setattr(components, "components", lambda links: seen.append(links.count()) or loop(links))
    components.extended_ids(ids, spark.createDataFrame([(node(3), node(77)), (node(60), node(2))], LINKS)).count()
    assert seen == [2]


def test_the_loop_carries_numbers_in_the_order_of_the_ids(spark, monkeypatch):
    kinds = set()
    large_star = components._large_star

    def noted(links, least):
        kinds.update(f.dataType.simpleString() for f in links.schema)
        return large_star(links, least)

    monkeypatch.setattr(components, "_large_star", noted)
    ids = ["", "Z", "a", "aa", "é", "\U0001f600", "～", "10", "9"]
    # The order of UTF-8 bytes, which is that of code points.
    links = [(a, b) for a, b in zip(ids[:5], ids[1:5])] + [("\U0001f600", "～"), ("9", "10"), (None, "a"), ("9", None)]
    found = components.numbered_components(spark.createDataFrame(links, LINKS))
    assert found.columns == ["id", "component"] and kinds == {"bigint"}
    assert rows(found) == rows(spark.createDataFrame(
        [(i, "") for i in ids[:5]] + [("\U0001f600", "～"), ("～", "～"), ("9", "10"), ("10", "10")], "a string, b string"))
    kinds.clear()
    left, right = frame(spark, [("1", "abcde"), ("3", "xyz")], "l"), frame(spark, [("2", "abcdf"), ("4", "abcdef")], "r")
    sides = components.link_by_name(left, right, MatchRule(min_confidence=0.60))
    cells = ["record_id", "corporate_id", "linked"]
    assert kinds == {"bigint"} and [rows(s.select(cells)) for s in sides] == [
        [("1", "1", True), ("3", "3", False)], [("2", "1", True), ("4", "1", True)]]
