"""Bronze to table, features and report through the command line, run twice."""

import json

import pytest
from pyspark.sql.types import StructType

from corpweave import __main__ as cli
from corpweave import schemas
from corpweave.operators import adjudicate
from corpweave.plans import enrichment, golden, registry, silver
from corpweave.settings import MatchRule
from corpweave.sources import files, registry_table
from corpweave.sources import sample_tables as sample
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
from tests.brute import letter_pair_scorer


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    sample.bronze_tech(spark, FOLDER).write.parquet(f"{root}/bronze/tech")
    sample.bronze_companies(spark, FOLDER).write.parquet(f"{root}/bronze/companies")
    return root


def golden_ids(spark, path):
    return rows(spark.read.parquet(path).select("corporate_id", "tech_record_id", "reg_record_id"))


def run_cli(lake, stage, **options):
    words = [stage]
    for name, value in options.items():
        words += [f"--{name.replace('_', '-')}", value.replace("@", lake)]
    cli.main(words)


def test_all_stages_twice(spark, lake):
    counts = []
    for _ in range(2):
        run_cli(lake, "silver", bronze_companies_path="@/bronze/companies",
                bronze_tech_path="@/bronze/tech", silver_companies_path="@/silver/companies",
                silver_tech_path="@/silver/tech", fuzzy_output_path="@/silver/matches",
                min_confidence="0.6")
        run_cli(lake, "golden", silver_companies_path="@/silver/companies",
                silver_tech_path="@/silver/tech", golden_corporate_registry="@/golden/by_pairs",
                fuzzy_matches_path="@/silver/matches")
        run_cli(lake, "golden", silver_companies_path="@/silver/companies",
                silver_tech_path="@/silver/tech", golden_corporate_registry="@/golden/by_name",
                min_confidence="0.6")
        run_cli(lake, "upsert", staging_path="@/golden/by_name", table="@/table",
                duplicates="latest")
        table = registry_table.current(spark, f"{lake}/table")
        counts.append((spark.read.parquet(f"{lake}/silver/matches").count(),
                       spark.read.parquet(f"{lake}/golden/by_name").count(), table.count()))
    assert counts[0] == counts[1] and min(counts[0]) > 0
    assert golden_ids(spark, f"{lake}/golden/by_pairs") == golden_ids(spark, f"{lake}/golden/by_name")
    assert table.count() == table.select("corporate_id").distinct().count()
    for name, schema in [("silver/tech", schemas.SILVER_TECH), ("silver/matches", schemas.MATCHES),
                         ("silver/companies", schemas.SILVER_COMPANIES),
                         ("golden/by_name", schemas.GOLDEN)]:
        stored = spark.read.parquet(f"{lake}/{name}").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema]

    run_cli(lake, "train", golden_corporate_registry="@/golden/by_name",
            output_dataset_path="@/ml/features", model_output_path="@/ml/models/",
            model_report_path="@/ml/reports")
    day = files.run_date()
    report = spark.read.schema(schemas.RUN_REPORT).json(f"{lake}/ml/reports/{day}/report.json")
    assert report.first().model == "LinearRegression" and report.first().train_rows > 0
    features = spark.read.parquet(f"{lake}/ml/features/{day}/")
    assert features.count() == counts[0][1]


def test_second_merge_on_a_repeated_id_is_refused(spark, lake):
    """Golden rows repeat the corporate id: the first merge inserts them all, the second fails."""
    silver.run(spark, f"{lake}/bronze/companies", f"{lake}/bronze/tech", f"{lake}/s2/companies",
               f"{lake}/s2/tech")
    golden.run(spark, f"{lake}/s2/companies", f"{lake}/s2/tech", f"{lake}/g2")
    registry.run(spark, f"{lake}/g2", f"{lake}/t2")
    assert registry_table.current(spark, f"{lake}/t2").count() == spark.read.parquet(
        f"{lake}/g2").count()
    with pytest.raises(Exception, match="several source rows"):
        registry.run(spark, f"{lake}/g2", f"{lake}/t2")


def test_adjudicated_edges_join_entities(spark, lake):
    s = f"{lake}/s3"
    silver.run(spark, f"{lake}/bronze/companies", f"{lake}/bronze/tech", f"{s}/companies",
               f"{s}/tech", f"{s}/matches")
    enrichment.adjudicate_matches(spark, f"{s}/companies", f"{s}/tech", f"{s}/verdicts",
                                  letter_pair_scorer(0.0))
    extra = adjudicate.adjudicated_edges(spark.read.parquet(f"{s}/verdicts"))
    assert extra.count() > 0
    golden.run(spark, f"{s}/companies", f"{s}/tech", f"{s}/golden", f"{s}/matches", extra)
    golden.run(spark, f"{s}/companies", f"{s}/tech", f"{s}/near",
               rule=MatchRule(min_confidence=0.6))
    assert golden_ids(spark, f"{s}/golden") == golden_ids(spark, f"{s}/near")
    with pytest.raises(ValueError):
        golden.run(spark, f"{s}/companies", f"{s}/tech", f"{s}/x", None, extra)


def test_news_stages(spark, lake, tmp_path):
    requests = tmp_path / "requests.json"
    good = {"corporate_id": "C", "company": "x", "current_date": "2026-01-01"}
    requests.write_text("\n".join(json.dumps(r) for r in [good, {**good, "company": ""}]))
    run_cli(lake, "news-requests", requests_path=str(requests), accepted_path="@/news/ok",
            rejected_path="@/news/bad")
    assert spark.read.parquet(f"{lake}/news/ok").count() == 1
    assert spark.read.parquet(f"{lake}/news/bad").first().error.endswith("company")
    entry = {"date": "2026-01-02", "title": "t", "url": "u", "corporate_id": "C"}
    documents = tmp_path / "documents.json"
    documents.write_text(json.dumps({**good, "items": [entry, entry, {}]}))
    for _ in range(2):
        run_cli(lake, "news-merge", documents_path=str(documents), table="@/news/table",
                quarantine_path="@/news/refused")
    assert registry_table.current(spark, f"{lake}/news/table").count() == 1
    assert spark.read.parquet(f"{lake}/news/refused").count() == 1


def test_reading(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="market_cap"):
        files.read(spark, f"{lake}/bronze/companies", schemas.BRONZE_TECH)
    spark.read.parquet(f"{lake}/bronze/tech").createOrReplaceTempView("some_table")
    assert files.read(spark, "some_table", schemas.BRONZE_TECH).count() == 150
    assert files.dated("s3://x/y/", "20260126") == "s3://x/y/20260126/"
    export = tmp_path / "export.csv"
    header = ",".join(f'"{n}"' for n in schemas.GOLDEN.fieldNames())
    cells = ['"c"', '"t"', '"tech_companies"', '"a, inc."', '"a"', '"x—y"', '"N/A"', '"1.31E9"',
             '"1.6375E8"', '"2026-01-20 22:37:43.301629 UTC"', *[""] * 11,
             '"2026-01-23 17:52:17.376188 UTC"']
    export.write_text(header + "\n" + ",".join(cells) + "\n")
    row = files.read_golden_export(spark, str(export)).first()
    assert row.tech_company == "a, inc." and row.tech_market_cap_usd == 1.31e9
    assert row.reg_record_id is None and row.tech_processing_ts.microsecond == 301629


def test_read_refuses_other_types(spark, tmp_path):
    path = f"{tmp_path}/amounts"
    spark.range(3).selectExpr("id", "double(id) AS amount").write.parquet(path)
    assert files.read(spark, path, StructType().add("amount", "double")).count() == 3
    with pytest.raises(ValueError, match="amount is double, not string"):
        files.read(spark, path, StructType().add("amount", "string"))
