import random

import pytest

from corpweave.operators import matching, prefix_tree
from corpweave.settings import AmbiguityBand, MatchRule
from tests import brute
from tests.conftest import rows

RECORDS = "record_id string, source_system string, company string, company_name_normalised string"


def frame(spark, records, source):
    return spark.createDataFrame([(i, source, n.upper(), n) for i, n in records], RECORDS)


def some_names(seed, count, letters="ab", longest=9):
    draw = random.Random(seed)
    return sorted({
        "".join(draw.choice(letters) for _ in range(draw.randint(0, longest))) for _ in range(count)
    })


def some_records(seed, count, names):
    draw = random.Random(seed)
    return [(f"{draw.randrange(16 ** 6):06x}", draw.choice(names)) for _ in range(count)]


@pytest.mark.parametrize("threshold, confidence, reach", [
    (3, 0.8, 0), (3, 0.6, 1), (5, 0.8, 1), (5, 0.6, 2), (10, 0.8, 2), (10, 0.6, 4), (3, 0.0, 3),
    (3, 1.1, None), (1, 0.0, 1),
])
def test_reach(threshold, confidence, reach):
    assert MatchRule(threshold, confidence).reach() == reach


def test_threshold_must_be_positive():
    with pytest.raises(ValueError):
        MatchRule(threshold=0)


@pytest.mark.parametrize("crowded", [10_000, 3])
@pytest.mark.parametrize("reach", [0, 1, 2, 3, 4])
def test_name_pairs(spark, monkeypatch, reach, crowded):
    if reach < 2 and crowded == 3:
        pytest.skip("no pieces below reach 2")
    monkeypatch.setattr(matching, "CROWDED_PAIRS", crowded)
    left, right = (
        sorted({*some_names(seed, 120, "ab", 9), *some_names(seed, 120, "abé ", 14)})
        for seed in (1, 2)
    )
    got = matching.name_pairs(
        spark.createDataFrame([(n,) for n in left], "name string"),
        spark.createDataFrame([(n,) for n in right], "name string"),
        reach,
    )
    assert rows(got) == sorted(brute.name_pairs(left, right, reach), key=repr)


def test_numbered_names_of_one_block(spark):
    """Names that share all pieces but the number; every piece before it is crowded."""
    left = [f"company {i:04d}" for i in range(0, 900, 3)]
    right = [f"company {i:04d}" for i in range(0, 900, 4)]
    for reach in (1, 2):
        got = matching.name_pairs(
            spark.createDataFrame([(n,) for n in left], "name string"),
            spark.createDataFrame([(n,) for n in right], "name string"),
            reach,
        )
        assert rows(got) == sorted(brute.name_pairs(left, right, reach), key=repr)


@pytest.mark.parametrize("reach", [1, 2, 3])
@pytest.mark.parametrize("letters, size, count", [("ab", 8, 90), ("abcdé😀", 7, 150), ("a", 14, 12)])
def test_walk_of_the_prefix_tree_loses_nothing(letters, size, count, reach):
    names, words = sorted(set(some_names(1, count, letters, size))), sorted(set(some_names(2, count, letters, size)) | {"", "ab", "abc"})
    found = [(names[i], words[w]) for rows, w in prefix_tree.walk(names, words, reach) for i in rows.tolist()]
    assert len(found) == len(set(found))
    wanted = {(a, b) for a, b, _ in brute.name_pairs(names, words, reach)}
    assert wanted <= set(found)
    # Where a word is walked to its end only true pairs come out.
    prefix = [(names[i], words[w]) for rows, w in prefix_tree.walk(names, words, reach, prefixes=True) for i in rows.tolist()]
    assert wanted <= set(prefix)


def test_crowded_names_in_several_tiles_and_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "TILE_NAMES", 30)
    monkeypatch.setattr(prefix_tree, "WALKING_NAMES", 25)
    monkeypatch.setattr(matching, "CROWDED_PAIRS", 3)
    left = [f"company {i:04d}" for i in range(0, 400, 3)] + ["", "co", "company"]
    right = [f"company {i:04d}" for i in range(0, 400, 4)] + ["", "co", "comp any 0004"]
    for reach in (2, 3):
        got = matching.name_pairs(*(spark.createDataFrame([(n,) for n in x], "name string") for x in (left, right)), reach)
        assert rows(got) == sorted(brute.name_pairs(left, right, reach), key=repr)


def test_long_names_of_one_block_at_reach_three(spark):
    """Names of 300 letters that differ in a few; deletion variants of one would fill a gigabyte."""
    base = "".join("abcdefghij"[i * i % 10] for i in range(300))
    edit = lambda k: base[:20 + k] + "xyz"[k % 3] + base[21 + k:200] + "q" * (k % 4) + base[200:]
    left, right = [edit(k) for k in range(0, 60, 2)], [edit(k) for k in range(0, 60, 3)]
    left += [base, base[:150] + base[153:], base[:150] + base[154:]]
    frames = [spark.createDataFrame([(n,) for n in x], "name string") for x in (left, right)]
    got = prefix_tree.candidates(*frames, 3).where("levenshtein(left_name, right_name, 3) >= 0")
    wanted = [(a, b) for a, b, _ in brute.name_pairs(left, right, 3)]
    assert rows(got) == sorted(wanted, key=repr) and wanted


RULES = [
    MatchRule(), MatchRule(min_confidence=0.6), MatchRule(min_confidence=0.0),
    MatchRule(id_order=False), MatchRule(min_confidence=0.3, id_order=False, drop_empty=True),
    MatchRule(min_confidence=1.1),
]


def check_matches(spark, rule, seed=3):
    names = some_names(seed, 60, "ab", 7)
    left, right = some_records(seed, 80, names), some_records(seed + 1, 120, names)
    got = matching.match_records(frame(spark, left, "l"), frame(spark, right, "r"), rule)
    wanted = [("l", "r", a, b, d, s, "fuzzy") for a, b, d, s in brute.record_pairs(left, right, rule)]
    assert rows(got) == sorted(wanted, key=repr)


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_match_records(spark, rule):
    check_matches(spark, rule)


@pytest.mark.parametrize("rule", RULES[:3], ids=str)
def test_match_records_on_skew_paths(spark, forced_skew, rule):
    check_matches(spark, rule, seed=5)


def test_large_left_side_is_not_broadcast(spark):
    """Without a broadcastable side the same pairs come out of shuffle joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_matches(spark, MatchRule(min_confidence=0.6), seed=7)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_output_schema(spark):
    from corpweave import schemas

    one = frame(spark, [("a", "x")], "l")
    for rule in (MatchRule(), MatchRule(min_confidence=0.6)):
        got = matching.match_records(one, one, rule).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schemas.MATCHES]


def test_ambiguous_pairs(spark):
    left = [("01", "abcdef"), ("02", "abcxyz")]
    right = [("11", "abcdef"), ("12", "abcdeg"), ("13", "abcdgg"), ("14", "abcxy"), ("00", "abcxy")]
    got = matching.ambiguous_pairs(frame(spark, left, "l"), frame(spark, right, "r"))
    picked = got.select("left_id", "right_id", "left_company", "name_distance", "match_confidence")
    assert rows(picked) == [
        ("01", "12", "ABCDEF", 1, 1 - 1 / 3), ("02", "14", "ABCXYZ", 1, 1 - 1 / 3)
    ]
    wide = matching.ambiguous_pairs(
        frame(spark, left, "l"), frame(spark, right, "r"), band=AmbiguityBand(0.3, 0.6)
    )
    assert rows(wide.select("left_id", "right_id")) == [("01", "13")]


def test_block_load(spark):
    left = [("1", "abcd"), ("2", "abcd"), ("3", "abce"), ("4", "xyz")]
    right = [("5", "abcf"), ("6", "q")]
    got = matching.block_load(frame(spark, left, "l"), frame(spark, right, "r"))
    assert rows(got) == [
        ("abc", 3, 2, 1, 1, "3"), ("q", 0, 0, 1, 1, "0"), ("xyz", 1, 1, 0, 0, "0")
    ]


@pytest.mark.parametrize("rule", [MatchRule(), MatchRule(min_confidence=0.6)])
def test_no_joined_side_is_broadcast_for_its_small_files(spark, tmp_path, rule):
    """Files say little about the size of what is made of their rows."""
    left, right = (frame(spark, some_records(seed, 300, some_names(5, 80, "abc", 9)), s) for seed, s in ((1, "l"), (2, "r")))
    for side, name in ((left, "l"), (right, "r")):
        side.write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{name}") for name in "lr"]
    pairs = matching.match_records(*stored, rule)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all("LeftSemi" in line for line in joins)  # counted to be few
    assert rows(pairs) == rows(matching.match_records(left, right, rule))


def test_one_edit_of_characters_beyond_the_first_plane(spark):
    left = ["abc😀x", "abc😁x", "abcx", "abc", "ab", ""]
    right = ["abc😁x", "abc😀😀x", "abcy", "abc\x00", "abc😀", "a", "ab", ""]
    got = matching.name_pairs(*(spark.createDataFrame([(n,) for n in x], "name string") for x in (left, right)), 1)
    assert rows(got) == sorted(brute.name_pairs(left, right, 1), key=repr)


@pytest.mark.parametrize("few", [100_000, 0])
def test_names_of_the_tree_do_not_meet_on_pieces_as_well(spark, monkeypatch, few):
    """They share many pieces that are not crowded, and the tree tells their pairs already."""
    given, meet = [], matching._meet
    monkeypatch.setattr(matching, "_meet", lambda *keys: given.append([k.count() for k in keys]) or meet(*keys))
    monkeypatch.setattr(matching, "CROWDED_PAIRS", 1000)
    monkeypatch.setattr(matching, "FEW", few)
    left, right = [f"company {i:04d}" for i in range(0, 300, 3)], [f"company {i:04d}" for i in range(0, 300, 4)]
    apart = [["comet ab", "xylophone", "compound 01"], ["xylphone", "comet b", "compund 01", "common"]]
    for more in ([[], []], apart):
        lefts, rights = left + more[0], right + more[1]
        got = matching.name_pairs(*(spark.createDataFrame([(n,) for n in x], "name string") for x in (lefts, rights)), 2)
        assert rows(got) == sorted(brute.name_pairs(lefts, rights, 2), key=repr)
    assert few == 0 or given[0] == [0, 0] and all(0 < n < 100 for n in given[1])
    pairs = meet(*(spark.createDataFrame([(1, n, n != "c") for n in x], "key bigint, name string, in_tree boolean") for x in ("abc", "bc")))
    assert rows(pairs) == [("a", "c"), ("b", "c"), ("c", "b"), ("c", "c")]
