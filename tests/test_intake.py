"""Incremental intake of news files, lookups by table, and counts that come with the writes."""

import json

import pytest
from pyspark.errors import PySparkException

from corpweave.operators import features, lookup, model, news
from corpweave.plans import enrichment
from corpweave.sources import intake, registry_table
from tests.conftest import rows


def document(company, day, items):
    return json.dumps({
        "corporate_id": company, "company": "Acme", "current_date": day,
        "items": [{"corporate_id": company, "date": d, "title": t, "url": u} for d, t, u in items]})


def merged(spark, root, **options):
    return enrichment.merge_news(spark, f"{root}/docs", f"{root}/table", f"{root}/refused", **options)


def titles(spark, root):
    return sorted(r["title"] for r in registry_table.current(spark, f"{root}/table").collect())


@pytest.fixture
def docs(tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(document("c1", "2026-01-01", [
        ("2026-01-02", "one", "u1"), ("2025-01-01", "too old", "u2")]))
    return tmp_path


def test_files_are_read_once(spark, docs, monkeypatch):
    listed = f"{docs}/processed"
    assert merged(spark, docs, processed_path=listed) == {"accepted": 1, "refused": 1}
    assert intake.taken(spark, listed).count() == 1
    reads, lines = [], intake.lines
    monkeypatch.setattr(intake, "lines", lambda s, files: reads.append(files.count()) or lines(s, files))
    assert merged(spark, docs, processed_path=listed) == {"accepted": 0, "refused": 0}
    (docs / "docs" / "b.json").write_text(document("c2", "2026-01-01", [("2026-01-03", "two", "u1")]))
    assert merged(spark, docs, processed_path=listed) == {"accepted": 1, "refused": 0}
    assert reads == [0, 1] and titles(spark, docs) == ["one", "two"]
    assert spark.read.parquet(f"{docs}/refused").count() == 1


def test_a_run_that_dies_before_its_end_is_repeated(spark, docs, monkeypatch):
    listed, take = f"{docs}/processed", intake.take

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(intake, "take", dies)
    with pytest.raises(RuntimeError):
        merged(spark, docs, processed_path=listed)
    monkeypatch.setattr(intake, "take", take)
    assert merged(spark, docs, processed_path=listed)["accepted"] == 1 and titles(spark, docs) == ["one"]


def test_latest_items_of_a_request(spark, docs):
    many = [(f"2026-01-{d:02d}", f"t{d:02d}", f"u{d}") for d in range(2, 20)]
    (docs / "docs" / "a.json").write_text(document("c1", "2026-01-01", many))
    assert merged(spark, docs)["accepted"] == 18
    assert titles(spark, docs) == [f"t{d:02d}" for d in range(10, 20)]
    merged(spark, docs, most_items=None)
    assert len(titles(spark, docs)) == 18


def test_counts_come_with_the_write(spark, tmp_path):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    data = [(str(i), "t", None if i % 9 == 0 else "r", "it" if i % 4 else None, float("nan") if i % 10 == 3 else 1.0, 2.0, 3.0)
            for i in range(300)]
    names = [*model.SPLIT_KEY, features.CATEGORY, *features.NUMERIC, features.LABEL]
    frame = spark.createDataFrame(data, ", ".join(f"{n} {'double' if 'log' in n else 'string'}" for n in names))
    seen = Observation("split")
    frame.observe(seen, *model.split_counts()).write.parquet(str(tmp_path / "f"))
    train, test = model.split(features.complete(frame))
    assert seen.get == {"train_rows": train.count(), "test_rows": test.count()}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("with counts", "")
    report = model.train(spark.read.parquet(str(tmp_path / "f")), counts=seen.get)
    first = len(jobs.getJobIdsForGroup("with counts"))
    spark.sparkContext.setJobGroup("without", "")
    again = model.train(spark.read.parquet(str(tmp_path / "f")))
    second = len(jobs.getJobIdsForGroup("without"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (report.train_rows, report.test_rows) == (again.train_rows, again.test_rows)
    assert first < second


TABLE = "old string, new string"


def looked_up(spark, values, table, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, old string")
    return rows(lookup.translated_by_table(df, "old", spark.createDataFrame(table, TABLE), "old", "new", **options).select("id", "old"))


def test_lookup_by_table(spark, forced_skew):
    table = [("a", "A"), ("a", "A"), ("b", None), (None, "never")]
    assert looked_up(spark, ["a", "b", "c", None, "a"], table) == [(0, "A"), (1, "N/A"), (2, "N/A"), (3, "N/A"), (4, "A")]
    assert looked_up(spark, ["a", "c"], [], default=None) == [(0, None), (1, None)]


@pytest.mark.parametrize("table", [[("a", "A"), ("a", "B")], [("a", "A"), ("a", None)]])
def test_lookup_with_two_replacements_fails(spark, table):
    with pytest.raises(PySparkException, match="two replacements for a"):
        looked_up(spark, ["x"], table)
