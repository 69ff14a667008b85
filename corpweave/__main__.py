"""Run one stage: ``spark-submit -m``-style entry, ``python -m corpweave STAGE --option value``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from corpweave import schemas, settings
from corpweave.operators import adjudicate
from corpweave.plans import enrichment, golden, registry, silver, training
from corpweave.settings import MatchRule
from corpweave.sources import files, registry_table
from corpweave.streaming import news_stream


def _silver(spark, a):
    rule = MatchRule(a.threshold, a.min_confidence, not a.any_id_order, a.drop_empty)
    silver.run(spark, a.bronze_companies_path, a.bronze_tech_path, a.silver_companies_path,
               a.silver_tech_path, a.fuzzy_output_path, rule)


def _golden(spark, a):
    rule = MatchRule(a.threshold, a.min_confidence, not a.any_id_order, a.drop_empty)
    golden.run(spark, a.silver_companies_path, a.silver_tech_path, a.golden_corporate_registry,
               a.fuzzy_matches_path, _verdict_edges(spark, a.verdicts_path), rule)


def _verdict_edges(spark, path):
    if path is None:
        return None
    return adjudicate.adjudicated_edges(files.read(spark, path, schemas.VERDICT))


def _catalog(spark, a):
    if a.catalog_name:
        registry_table.use_iceberg(spark, a.catalog_name, a.warehouse_path,
                                   **dict(o.split("=", 1) for o in a.catalog_option))


def _create(spark, a):
    _catalog(spark, a)
    registry.create(spark, a.table, a.location)


def _upsert(spark, a):
    _catalog(spark, a)
    registry.run(spark, a.staging_path, a.table, a.key or ["corporate_id"], a.duplicates)


def _train(spark, a):
    _catalog(spark, a)
    trained = training.run(spark, a.golden_corporate_registry, a.output_dataset_path,
                           a.model_output_path, a.model_report_path,
                           stable_split=not a.random_split)
    print(trained.report(spark).toJSON().first())


def _news_requests(spark, a):
    enrichment.check_news_requests(spark, a.requests_path, a.accepted_path, a.rejected_path)


def _news_merge(spark, a):
    _catalog(spark, a)
    counts = enrichment.merge_news(spark, a.documents_path, a.table, a.quarantine_path, a.processed_path,
                                   None if a.all_items else settings.NEWS_ITEMS_PER_REQUEST)
    print(json.dumps(counts))


def _news_stream(spark, a):
    _catalog(spark, a)
    lines = news_stream.news_lines(spark, a.documents_path)
    news_stream.start(lines, a.table, a.quarantine_path, a.progress_path).awaitTermination()


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpweave")
    stages = parser.add_subparsers(required=True)

    def stage(name, action, required, optional=()):
        sub = stages.add_parser(name)
        sub.set_defaults(action=action)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        return sub

    def matching_options(sub):
        defaults = MatchRule()
        sub.add_argument("--threshold", type=int, default=defaults.threshold)
        sub.add_argument("--min-confidence", type=float, default=defaults.min_confidence)
        sub.add_argument("--any-id-order", action="store_true")
        sub.add_argument("--drop-empty", action="store_true")

    def catalog_options(sub):
        sub.add_argument("--catalog-name")
        sub.add_argument("--warehouse-path")
        sub.add_argument("--catalog-option", action="append", default=[])

    matching_options(stage(
        "silver", _silver,
        ["bronze-companies-path", "bronze-tech-path", "silver-companies-path", "silver-tech-path"],
        ["fuzzy-output-path"],
    ))
    matching_options(stage(
        "golden", _golden,
        ["silver-companies-path", "silver-tech-path", "golden-corporate-registry"],
        ["fuzzy-matches-path", "verdicts-path"],
    ))
    catalog_options(stage("create-table", _create, ["table"], ["location"]))
    upsert = stage("upsert", _upsert, ["staging-path", "table"])
    upsert.add_argument("--key", action="append")
    upsert.add_argument("--duplicates", default="error", choices=["error", "latest"])
    catalog_options(upsert)
    train = stage("train", _train, ["golden-corporate-registry", "output-dataset-path",
                                    "model-output-path", "model-report-path"])
    train.add_argument("--random-split", action="store_true")
    catalog_options(train)
    stage("news-requests", _news_requests, ["requests-path", "accepted-path", "rejected-path"])
    merge = stage("news-merge", _news_merge, ["documents-path", "table", "quarantine-path"], ["processed-path"])
    merge.add_argument("--all-items", action="store_true")
    catalog_options(merge)
    catalog_options(stage("news-stream", _news_stream,
                          ["documents-path", "table", "quarantine-path", "progress-path"]))
    return parser


def main(argv: list[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    options.action(SparkSession.builder.appName("corpweave").getOrCreate(), options)


if __name__ == "__main__":
    main()
