"""Ambiguous pairs: reading requests, scoring them in batches, and completing the verdicts.

The scorer itself (in production a language-model service) is passed in as a function from one
request text to one response text, both JSON:

    {"pairs": [{"left_id", "right_id", "left_company_name", "right_company_name"}, ...]}
    {"results": [{"left_id", "right_id", "match", "match_confidence"}, ...]}
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.operators import lineage

PAIR = schemas.PAIR_REQUEST.fieldNames()
LEDGER = "tags array<string>, response string"
IDS = ["left_id", "right_id"]


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def member(value: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def unwrapped(event: Column) -> Column:
    """The payload of an event given as JSON text: its ``body`` when that is a non-blank text,
    otherwise the event itself. Unreadable JSON is NULL."""
    whole = F.try_parse_json(event)
    body = member(whole, "body")
    is_text = F.schema_of_variant(body) == "STRING"
    text = body.try_cast("string")
    return F.when(
        F.coalesce(is_text & text.rlike(r"\S"), F.lit(False)), F.try_parse_json(text)
    ).otherwise(whole)


def read_pairs(requests: DataFrame, column: str = "value") -> DataFrame:
    """Pairs asked for in request lines: a list, ``{"pairs": list}`` or either as a text ``body``.

    Elements that are not objects are skipped and absent names become ''. Other columns are
    carried along.
    """
    others = [c for c in requests.columns if c != column]
    payload = requests.select(*others, unwrapped(F.col(column)).alias("_payload"))
    listed = F.coalesce(
        F.try_variant_get("_payload", "$", "array<variant>"),
        F.try_variant_get("_payload", "$.pairs", "array<variant>"),
    )
    entry = F.col("_entry")

    def name(field: str) -> Column:
        absent = member(entry, field).isNull()
        return F.when(absent, F.lit("")).otherwise(member(entry, field, "string")).alias(field)

    return (
        payload.select(*others, F.explode(listed).alias("_entry"))
        .where(is_object(entry))
        .select(
            *others,
            *[member(entry, field, "string").alias(field) for field in IDS],
            name("left_company_name"),
            name("right_company_name"),
        )
    )


def ask(pairs: DataFrame, scorer: Callable[[str], str], batch: int = 200) -> DataFrame:
    """One response text per ``batch`` pairs. A scorer that fails, fails the job: an outage must not
    look like a verdict."""

    def respond(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                records = frame.iloc[start:start + batch].to_dict("records")
                response = scorer(json.dumps({"pairs": records}))
                yield pd.DataFrame({"response": [response]}, dtype="object")

    return pairs.select(*PAIR).mapInPandas(respond, "response string")


def read_verdicts(responses: DataFrame, column: str = "response") -> DataFrame:
    """Verdicts in response texts. Unreadable responses hold none; a verdict that is not complete
    and within 0..1 counts as not given."""
    results = F.try_variant_get(
        F.try_parse_json(F.col(column)), "$.results", "array<variant>"
    )
    entry = F.col("_entry")
    answered = responses.select(F.explode(results).alias("_entry")).where(is_object(entry)).select(
        *[member(entry, field, "string").alias(field) for field in IDS],
        F.when(F.schema_of_variant(member(entry, "match")) == "BOOLEAN",
               member(entry, "match", "boolean")).alias("match"),
        F.when(F.schema_of_variant(member(entry, "match_confidence")).rlike("^(BIGINT|DOUBLE|DECIMAL)"),
               member(entry, "match_confidence", "double")).alias("match_confidence"),
    )
    return answered.where(
        F.col("match").isNotNull() & F.col("match_confidence").between(0.0, 1.0)
    )


def _same_pair(left: str, right: str) -> Column:
    return F.expr(f"{left}.left_id <=> {right}.left_id AND {left}.right_id <=> {right}.right_id")


def complete_verdicts(pairs: DataFrame, verdicts: DataFrame, keep_unasked: bool = False) -> DataFrame:
    """Every verdict on a pair that was asked for, and ``false, 0.0`` for each unanswered pair."""
    asked, given = pairs.select(*IDS), verdicts.select(*schemas.VERDICT.fieldNames())
    kept = given
    if not keep_unasked:
        kept = given.alias("v").join(asked.distinct().alias("p"), _same_pair("v", "p"), "left_semi")
    missing = asked.alias("p").join(
        given.select(*IDS).distinct().alias("v"), _same_pair("p", "v"), "left_anti"
    )
    defaults = missing.withColumns({"match": F.lit(False), "match_confidence": F.lit(0.0)})
    return kept.unionByName(defaults)


def unasked(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts on pairs nobody asked for."""
    asked = pairs.select(*IDS).distinct()
    return verdicts.alias("v").join(asked.alias("p"), _same_pair("v", "p"), "left_anti")


NAMES = ["left_company_name", "right_company_name"]
#: Name pairs that are asked about by one job, and lost at most when it fails; more where it would take
#: more than ``ROUNDS`` jobs.
PORTION = 20_000
#: Jobs that ask, at most. Each leaves the driver its plan and costs a start, so that their number may not
#: grow with the pairs.
ROUNDS = 50


def name_tag() -> Column:
    """The hash of two names, which serves as their id in requests and in the ledger."""
    return F.sha2(F.to_json(F.struct(*NAMES), {"ignoreNullFields": "false"}), 256)


def ledger_of(spark: SparkSession, ledger: str) -> DataFrame:
    """What was asked so far: the tags of a request next to its response."""
    if not lineage.exists(spark, f"{ledger.rstrip('/')}/_SUCCESS"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def ask_once(pairs: DataFrame, scorer: Callable[[str], str], ledger: str, batch: int = 200,
             portion: int = PORTION) -> DataFrame:
    """The ledger after every distinct pair of names in ``pairs`` has been asked about, in this run or
    an earlier one.

    Pairs that the ledger holds are not asked again. The rest is asked in portions of about
    ``portion`` pairs, or of a share of 1 in ``ROUNDS`` where that is more, and each portion's responses
    are appended to the ledger before the next one begins, so a run that dies loses one portion at most and
    a restart asks only for the rest. A request that was answered counts as asked, whatever the answer
    holds. One run at a time.
    """
    spark = pairs.sparkSession
    tagged = pairs.select(*NAMES).distinct().select(name_tag().alias("tag"), *NAMES)
    asked = ledger_of(spark, ledger).select(F.explode("tags").alias("tag"))
    rest = lineage.cut(tagged.join(asked, "tag", "left_anti"))
    count = rest.count()
    portions = min(-(-count // portion), ROUNDS)
    # Dealt into folders, so that a portion reads its own pairs only.
    folder = lineage.new_folder(spark)
    dealt = rest.withColumn("portion", F.pmod(F.xxhash64("tag"), F.lit(max(portions, 1))).cast("int"))
    dealt.repartition("portion").write.partitionBy("portion").parquet(folder)

    def respond(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start:start + batch]
                records = [dict(zip(PAIR, (r.tag, r.tag, r.left_company_name, r.right_company_name))) for r in part.itertuples()]
                response = scorer(json.dumps({"pairs": records}))
                yield pd.DataFrame({"tags": [part["tag"].tolist()], "response": [response]}, dtype="object")

    stored = spark.read.schema(dealt.schema).parquet(folder)  # its files are listed once
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-count // max(portions * batch, 1))))
    for number in range(portions):
        part = stored.where(F.col("portion") == number).drop("portion").repartition(tasks)
        part.mapInPandas(respond, LEDGER).write.mode("append").parquet(ledger)
    return ledger_of(spark, ledger)


def adjudicate_names(pairs: DataFrame, scorer: Callable[[str], str], batch: int = 200,
                     ledger: str | None = None) -> DataFrame:
    """Verdict per record pair, asking once per distinct pair of names.

    The scorer sees names only, so equal names get equal verdicts and are not paid for twice. The
    name pair's hash serves as its id in the request. Of several verdicts on a pair the most
    confident counts, a match before none. Answers are paid for: they go to the ``ledger``, a folder
    that later runs may go on with (by default one of this program's own).
    """
    pairs = lineage.cut(pairs.select(*PAIR))
    answers = ask_once(pairs, scorer, ledger or lineage.new_folder(pairs.sparkSession), batch)
    by_name = lineage.cut(read_verdicts(answers).groupBy(F.col("left_id").alias("_tag")).agg(
        F.max(F.struct("match_confidence", "match")).alias("_v")
    ))
    return pairs.withColumn("_tag", name_tag()).join(by_name, "_tag", "left").select(
        *IDS,
        F.coalesce("_v.match", F.lit(False)).alias("match"),
        F.coalesce("_v.match_confidence", F.lit(0.0)).alias("match_confidence"),
    )


def adjudicated_edges(verdicts: DataFrame) -> DataFrame:
    """Accepted verdicts as extra edges of the entity graph."""
    return verdicts.where("match").select(
        F.col("left_id").alias("src"),
        F.col("right_id").alias("dst"),
        "match_confidence",
        F.lit("adjudicated").alias("match_type"),
    )


def letter_pair_share(left: str, right: str) -> Column:
    """The share of two-letter sequences two names have in common, from 0 to 1."""

    def sequences(name: str) -> str:
        name = f"coalesce({name}, '')"
        return (f"IF(length({name}) > 1, transform(sequence(1, length({name}) - 1), "
                f"i -> substring({name}, i, 2)), array())")

    one, two = sequences(left), sequences(right)
    return F.expr(f"coalesce(try_divide(cast(size(array_intersect({one}, {two})) AS DOUBLE), "
                  f"size(array_union({one}, {two}))), 0D)")


def adjudicate_by_share(pairs: DataFrame, least: float = 0.85) -> DataFrame:
    """Verdict per record pair without a service: a match from ``least`` shared sequences on."""
    share = letter_pair_share("left_company_name", "right_company_name")
    scored = pairs.select(*IDS, share.alias("match_confidence"))
    return scored.select(*IDS, (F.col("match_confidence") >= least).alias("match"), "match_confidence")
