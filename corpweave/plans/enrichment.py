"""Side stages: adjudication of ambiguous pairs and the daily news merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from corpweave import schemas, settings
from corpweave.operators import adjudicate, lineage, matching, news
from corpweave.settings import AmbiguityBand, MatchRule
from corpweave.sources import files, intake, registry_table


def adjudicate_matches(spark: SparkSession, silver_companies_path: str, silver_tech_path: str,
                       verdict_path: str, scorer: Callable[[str], str],
                       rule: MatchRule = MatchRule(), band: AmbiguityBand = AmbiguityBand(),
                       ledger_path: str | None = None) -> None:
    """Store a verdict for every record pair of the band. Accepted ones are edges for stage 2.

    With a ledger a run that was broken off, or a later one, asks only for what the ledger lacks.
    """
    tech = files.read(spark, silver_tech_path, schemas.SILVER_TECH)
    companies = files.read(spark, silver_companies_path, schemas.SILVER_COMPANIES)
    pairs = matching.ambiguous_pairs(tech, companies, rule, band).withColumnsRenamed(
        {"left_company": "left_company_name", "right_company": "right_company_name"}
    )
    files.write(adjudicate.adjudicate_names(pairs, scorer, ledger=ledger_path), verdict_path)


def merge_news(spark: SparkSession, documents_path: str, table: str, quarantine_path: str,
               processed_path: str | None = None,
               most_items: int | None = settings.NEWS_ITEMS_PER_REQUEST) -> dict[str, int]:
    """Validate, deduplicate, limit and upsert the result documents of a folder.

    Of each request (company and day) the ``most_items`` latest items count. With a processed list,
    only files that are not on it are read, and they are listed once their items are stored: a run that
    dies in between merges them again, which changes nothing. Without one all files are read. The
    returned counts of accepted and refused entries are observed during the writes.
    """
    counts = {"accepted": 0, "refused": 0}
    fresh = None
    if processed_path is None:
        documents = spark.read.text(documents_path)
    else:
        fresh = intake.waiting(spark, documents_path, processed_path)
        documents = intake.lines(spark, fresh)
        if documents is None:
            return counts
    entries = news.read_news(documents)
    seen = {name: Observation(name) for name in counts}
    items = lineage.cut(news.accepted(entries).observe(seen["accepted"], F.count(F.lit(1)).alias("n")))
    if most_items is not None:
        items = news.top_items(news.newest_per_url(items), most_items).drop("item_rank")
    items = news.newer_items(items, registry_table.stored(spark, table))
    registry_table.store(spark, table, items, news.ITEM_KEY)
    refused = news.refused(entries).observe(seen["refused"], F.count(F.lit(1)).alias("n"))
    # With a list every run sees other files, so what earlier runs refused stays.
    refused.write.mode("overwrite" if fresh is None else "append").parquet(quarantine_path)
    if fresh is not None:
        intake.take(fresh, processed_path)
    return {name: seen[name].get["n"] for name in counts}


def check_news_requests(spark: SparkSession, requests_path: str, accepted_path: str,
                        rejected_path: str) -> None:
    """Sort request events into usable ones and ones with a problem."""
    checked = news.checked_requests(news.read_requests(spark.read.text(requests_path)))
    files.write(checked.where("error IS NULL").drop("error"), accepted_path)
    files.write(checked.where("error IS NOT NULL"), rejected_path)
