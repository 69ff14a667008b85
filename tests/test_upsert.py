import re

import pytest
from pyspark.errors import PySparkException

from corpweave.operators.contract import check_contract
from corpweave.operators.upsert import latest_per_key, merged
from corpweave.schemas import GOLDEN, columns
from corpweave.sources import registry_table
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
from tests.conftest import rows

SCHEMA = "id string, part string, value int, processing_ts int"
TARGET = [("a", "p", 1, 1), ("b", "p", 2, 1), ("c", None, 3, 1), (None, "p", 4, 1)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def upserted(spark, source, target=TARGET, keys=("id",), **options):
    return rows(merged(frame(spark, target), frame(spark, source), keys, **options))


@pytest.fixture(params=[False, True], ids=["plain", "skew"])
def either_path(request):
    if request.param:
        request.getfixturevalue("forced_skew")


def test_matched_new_kept_and_null(spark, either_path):
    source = [("a", "q", None, 2), ("n", "p", 9, 2), (None, "p", 5, 2)]
    wanted = [("a", "q", None, 2), ("b", "p", 2, 1), ("c", None, 3, 1), (None, "p", 4, 1),
              ("n", "p", 9, 2), (None, "p", 5, 2)]
    assert upserted(spark, source) == sorted(wanted, key=repr)


def test_several_source_rows_on_one_target_row(spark, either_path):
    with pytest.raises(PySparkException, match="several source rows"):
        upserted(spark, [("a", "q", 1, 2), ("a", "r", 2, 3)])
    latest = upserted(spark, [("a", "q", 1, 2), ("a", "r", 2, 3)], duplicates="latest")
    assert ("a", "r", 2, 3) in latest and len(latest) == len(TARGET)


def test_several_source_rows_on_no_target_row(spark):
    source = [("n", "q", 1, 2), ("n", "r", 2, 3)]
    assert len(upserted(spark, source)) == len(TARGET) + 2
    assert len(upserted(spark, source, duplicates="latest")) == len(TARGET) + 1


def test_several_target_rows_take_the_same_source_row(spark):
    got = upserted(spark, [("a", "new", 7, 2)], target=[("a", "x", 1, 1), ("a", "y", 2, 1)])
    assert got == [("a", "new", 7, 2)] * 2


def test_two_keys_one_null_safe(spark):
    source = [("c", None, 30, 2), ("b", None, 20, 2), (None, "p", 40, 2)]
    got = upserted(spark, source, keys=("id", "part"), null_safe=("part",))
    assert ("c", None, 30, 2) in got and ("b", None, 20, 2) in got and ("b", "p", 2, 1) in got
    assert len(got) == len(TARGET) + 2


def test_same_batch_twice_changes_nothing(spark):
    source = [("a", "q", 5, 2), ("n", "p", 9, 2)]
    once = upserted(spark, source)
    assert upserted(spark, source, target=once) == once


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(100_000).selectExpr("string(id) id", "'p' part", "1 value", "1 processing_ts") \
        .write.parquet(str(tmp_path / "t"))
    frame(spark, [("5", "q", 5, 2)]).write.parquet(str(tmp_path / "s"))
    read = spark.read.parquet
    plan = merged(read(str(tmp_path / "t")), read(str(tmp_path / "s")), ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin LeftOuter" not in text and "BroadcastHashJoin" in text


def test_latest_per_key(spark):
    source = frame(spark, [("a", "x", 1, 1), ("a", "y", 2, 3), ("a", "z", 9, 2), (None, "p", 1, 1),
                           (None, "p", 1, 1)])
    assert rows(latest_per_key(source, ["id"])) == sorted(
        [("a", "y", 2, 3), (None, "p", 1, 1), (None, "p", 1, 1)], key=repr)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        upserted(spark, [], duplicates="first")


def test_contract():
    base = columns(("a", StringType()), ("b", DoubleType()))
    reordered = StructType([StructField("b", DoubleType(), False), StructField("a", StringType())])
    assert check_contract(reordered, base) and check_contract(reordered, base, strict=False)
    other = columns(("b", LongType()), ("z", StringType()))
    with pytest.raises(ValueError) as failure:
        check_contract(other, base)
    assert str(failure.value) == (
        "Schema check failed: Missing: {'a'} | Extra: {'z'} | Type mismatch: ['b']"
    )
    mistyped = columns(("a", StringType()), ("b", LongType()))
    assert check_contract(mistyped, base, strict=False)
    with pytest.raises(ValueError, match="Type mismatch"):
        check_contract(mistyped, base)


def bucket_files(root):
    return {p.parent.name: (p.name, p.stat().st_mtime_ns) for p in root.glob("bucket=*/*.parquet")}


def test_only_touched_buckets_are_written_and_read(spark, tmp_path):
    root = tmp_path / "table"
    assert registry_table.current(spark, str(root)) is None
    first = frame(spark, [(f"k{i}", "p", i, 1) for i in range(500)])
    assert len(registry_table.upsert(spark, str(root), first, ["id"])) == 32
    before = bucket_files(root)
    touched = registry_table.upsert(spark, str(root), frame(spark, [("k7", "q", 9, 2)]), ["id"])
    after = bucket_files(root)
    assert len(touched) == 1 and len(before) == 32
    assert {k for k in after if after[k] != before[k]} == {f"bucket={touched[0]}"}
    wanted = rows(first.where("id <> 'k7'").unionByName(frame(spark, [("k7", "q", 9, 2)])))
    assert rows(registry_table.current(spark, str(root))) == wanted
    # A second run of the same changes nothing, a new key is inserted, an empty source is no change.
    for source in ([("k7", "q", 9, 2)], []):
        registry_table.upsert(spark, str(root), frame(spark, source), ["id"])
        assert rows(registry_table.current(spark, str(root))) == wanted
    registry_table.upsert(spark, str(root), frame(spark, [("new", "q", 3, 3)]), ["id"])
    assert rows(registry_table.current(spark, str(root))) == sorted([*wanted, ("new", "q", 3, 3)], key=repr)
    with pytest.raises(ValueError, match="Extra"):
        registry_table.upsert(spark, str(root), first.selectExpr("*", "1 AS more"), ["id"])
    with pytest.raises(ValueError, match="not one of the keys"):
        registry_table.upsert(spark, str(root), first, ["id"], bucket_by="part")


def test_the_scan_of_an_upsert_is_pruned(spark, tmp_path, monkeypatch):
    root, plans = str(tmp_path / "table"), []
    registry_table.upsert(spark, root, frame(spark, [(f"k{i}", "p", i, 1) for i in range(200)]), ["id"])
    merge = registry_table.merged

    def noted(target, *rest):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return merge(target, *rest)

    monkeypatch.setattr(registry_table, "merged", noted)
    (bucket,) = registry_table.upsert(spark, root, frame(spark, [("k7", "q", 9, 2)]), ["id"])
    assert f"bucket#" in plans[0] and f"= {bucket})" in plans[0].split("PartitionFilters")[1].split("]")[0]


def test_a_replacement_that_was_cut_short_is_ended(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    first = frame(spark, [(f"k{i}", "p", i, 1) for i in range(100)])
    registry_table.upsert(spark, root, first, ["id"])
    replace = registry_table._replace_buckets

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(registry_table, "_replace_buckets", dies)
    source = frame(spark, [("k3", "q", 30, 2), ("k4", "q", 40, 2)])
    with pytest.raises(RuntimeError):
        registry_table.upsert(spark, root, source, ["id"])
    monkeypatch.setattr(registry_table, "_replace_buckets", replace)
    # One bucket is gone, as when the driver died between deleting the old and moving in the new one.
    pending = next((tmp_path / "table" / "_pending").glob("bucket=*"))
    for file in (tmp_path / "table" / pending.name).iterdir():
        file.unlink()
    wanted = rows(first.where("id NOT IN ('k3', 'k4')").unionByName(source))
    assert rows(registry_table.current(spark, root)) == wanted
    assert not (tmp_path / "table" / "_pending").exists()


def test_null_keys_and_null_safe_keys_in_buckets(spark, tmp_path):
    root = str(tmp_path / "table")
    registry_table.upsert(spark, root, frame(spark, TARGET), ["id", "part"], null_safe=["part"])
    registry_table.upsert(spark, root, frame(spark, [("c", None, 30, 2), (None, "p", 40, 2)]), ["id", "part"], null_safe=["part"])
    wanted = [("a", "p", 1, 1), ("b", "p", 2, 1), ("c", None, 30, 2), (None, "p", 4, 1), (None, "p", 40, 2)]
    assert rows(registry_table.current(spark, root)) == sorted(wanted, key=repr)


def test_empty_first_upsert(spark, tmp_path):
    root = str(tmp_path / "table")
    assert registry_table.upsert(spark, root, frame(spark, []), ["id"]) == []
    assert registry_table.current(spark, root) is None
    assert registry_table.upsert(spark, root, frame(spark, [("a", "p", 1, 1)]), ["id"])
    assert rows(registry_table.current(spark, root)) == [("a", "p", 1, 1)]


@pytest.mark.parametrize("keys", [["id"], ["id", "part"]])
def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path, forced_skew, keys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # for the plan as it is made
    try:
        target = frame(spark, [(f"k{i % 90}", f"p{i // 90}", i, 1) for i in range(120)])
        source = frame(spark, [(f"k{i}", "p0", -i, 2) for i in range(80, 120)])
        stored = [registry_table.save_bucketed(df, name, keys, str(tmp_path / name)) for df, name in (
            (target, f"target{len(keys)}"), (source, f"source{len(keys)}"))]
        found = merged(*stored, keys, as_laid_out=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(found) == rows(merged(target, source, keys))
        # A source that is not bucketed is shuffled to the target's buckets, the target is not.
        plan = merged(stored[0], source, keys)._jdf.queryExecution().executedPlan().toString()
        on_target = [j for j in plan.split("SortMergeJoin")[1:] if re.match(r".*Left(Outer|Semi)", j)]
        assert plan.count("Exchange") > 0 and len(on_target) == 2
        assert all("Exchange" not in join.split("FileScan")[0] for join in on_target)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for name in (f"target{len(keys)}", f"source{len(keys)}"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")

def test_catalog_statements_parse(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    create = registry_table.create_sql("lake.db.registry", "s3://somewhere/registry/")
    merge = registry_table.merge_sql("lake.db.registry", "staged")
    by_row = registry_table.merge_sql("t", "staged", ["corporate_id", "reg_record_id"],
                                      ["reg_record_id"])
    assert "target.reg_record_id <=> source.reg_record_id" in by_row
    for statement in (create, merge, by_row):
        parser.parsePlan(statement)
    assert all(f"{f.name} " in create for f in GOLDEN) and "bucket(32, corporate_id)" in create
