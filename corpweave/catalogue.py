"""Every operator as a query over the given sample tables, next to the same thing in plain SQL.

The SQL is written for DuckDB and works from the definitions: matches are formed by comparing all
names of a block, entities by a transitive closure over record pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave import schemas, settings
from corpweave.functions import text
from corpweave.operators import (
    adjudicate, components, features, golden, lineage, lookup, matching, model, news, standardize, upsert,
)
from corpweave.operators.contract import check_contract, differences
from corpweave.settings import MatchRule
from corpweave.sources import registry_table
from corpweave.sources import sample_tables as sample
from corpweave.streaming import news_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

EXACT = MatchRule()
NEAR = MatchRule(min_confidence=0.60)
WIDE = MatchRule(min_confidence=0.0)
ANY_ORDER = MatchRule(min_confidence=0.60, id_order=False)
RUN_TS = datetime(2026, 1, 1)
AS_OF = date(2026, 1, 1)
ROW_KEY = ["corporate_id", "tech_record_id", "reg_record_id"]
LEAST_SHARE = 0.85


def query(sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


# --- SQL building blocks -----------------------------------------------------------------------

def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v + "'" for v in values) + "]"


def _pick(values, number: str) -> str:
    return f"list_extract({_list(values)}, CAST({number} % {len(values)} AS INTEGER) + 1)"


def _key_sql(name: str) -> str:
    words = rf"string_split(regexp_replace(lower(coalesce({name}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' ')"
    dropped = _list(["", *settings.LEGAL_FORMS])
    return f"array_to_string(list_filter({words}, lambda w: NOT list_contains({dropped}, w)), ' ')"


def _id_sql(source: str, *parts: str) -> str:
    cells = ", ".join(f"trim(lower(coalesce({p}, '')))" for p in parts)
    return f"sha256(concat_ws('||', '{source}', {cells}))"


def _amount_sql(column: str) -> str:
    scale = " ".join(
        f"WHEN ends_with({column}, '{s}') THEN {f:.0f}::DOUBLE"
        for s, f in settings.MONEY_SCALES.items()
    )
    digits = f"TRY_CAST(regexp_replace({column}, '[^0-9.]', '', 'g') AS DOUBLE)"
    return f"({digits} * CASE {scale} ELSE 1.0::DOUBLE END)"


BRONZE = f"""
named_part AS (
  SELECT * EXCLUDE (p_name), substr(sha256(CAST(p_partkey // 3 AS VARCHAR)), 1, 5) || ' ' || p_name AS p_name
  FROM part),
bronze_companies AS (
  SELECT p_name || {_pick(sample.REGISTRY_ENDINGS, 'p_partkey')} AS name,
         CASE WHEN p_size % 5 <> 0 THEN replace(p_name, ' ', '-') || '.example.com' END AS domain,
         CASE WHEN p_size % 7 <> 0 THEN CAST(1950 + p_size AS DOUBLE) END AS year_founded,
         {_pick(sample.REGISTRY_INDUSTRIES, 'p_partkey')} AS industry,
         p_type AS size_range, p_brand AS locality,
         {_pick(sample.COUNTRY_TEXTS, 'p_partkey')} AS country,
         'https://social.example.com/' || CAST(p_partkey AS VARCHAR) AS linkedin_url,
         CAST(p_size * 10 AS BIGINT) AS current_employee_estimate,
         CAST(p_size * 25 + p_partkey % 10 AS BIGINT) AS total_employee_estimate
  FROM named_part),
bronze_tech AS (
  SELECT CAST(c_custkey AS INTEGER) AS ranking,
         CASE WHEN c_custkey % 3 = 0 THEN substr(p_name, 1, length(p_name) - 1)
              WHEN c_custkey % 7 = 1 THEN substr(p_name, 1, length(p_name) - 2) || '99'
              WHEN c_custkey % 11 = 2 THEN p_name || 'xyz' ELSE p_name END
           || {_pick(sample.TECH_ENDINGS, 'c_custkey')} AS company,
         '$' || CAST(c_acctbal AS VARCHAR) || {_pick(sample.CAP_SUFFIXES, 'c_custkey')} AS market_cap,
         c_name AS stock, {_pick(sample.COUNTRY_TEXTS, 'c_nationkey')} AS country,
         c_mktsegment AS sector,
         CASE WHEN c_custkey % 13 = 0 THEN 'N/A' WHEN c_custkey % 11 <> 0 THEN c_mktsegment END
           AS industry
  FROM customer JOIN named_part ON p_partkey = c_custkey)"""

_KNOWN = "(" + ", ".join(f"'{c}'" for c in settings.COUNTRIES) + ")"
_INDUSTRY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in settings.INDUSTRIES.items())

SILVER = BRONZE + f""",
tech AS (
  SELECT {_id_sql(settings.TECH_SOURCE, 'company', 'country', 'industry')} AS record_id,
         '{settings.TECH_SOURCE}' AS source_system, trim(lower(company)) AS company,
         {_key_sql('trim(lower(company))')} AS company_name_normalised,
         trim(lower(industry)) AS industry_std,
         CASE WHEN trim(lower(country)) IN {_KNOWN} THEN trim(lower(country)) ELSE 'N/A' END
           AS country_std,
         {_amount_sql('trim(lower(market_cap))')} AS market_cap_usd,
         {_amount_sql('trim(lower(market_cap))')} / {settings.REVENUE_DIVISOR} AS estimated_revenue
  FROM bronze_tech),
registry AS (
  SELECT {_id_sql(settings.REGISTRY_SOURCE, 'name', 'country', 'industry')} AS record_id,
         '{settings.REGISTRY_SOURCE}' AS source_system, trim(lower(name)) AS company,
         {_key_sql('trim(lower(name))')} AS company_name_normalised,
         trim(lower(domain)) AS domain,
         CASE trim(lower(industry)) {_INDUSTRY} ELSE 'N/A' END AS industry_std,
         CASE WHEN trim(lower(country)) IN {_KNOWN} THEN trim(lower(country)) ELSE 'N/A' END
           AS country_std,
         year_founded, current_employee_estimate, total_employee_estimate
  FROM bronze_companies)"""


def _pairs_sql(rule: MatchRule, name: str = "pairs", floor: float | None = None) -> str:
    """Record pairs of a rule, straight from its definition."""
    floor = rule.min_confidence if floor is None else floor
    order = "AND l.record_id < r.record_id" if rule.id_order else ""
    return f"""
{name}_names AS (
  SELECT l.n AS left_name, r.n AS right_name, levenshtein(l.n, r.n) AS d
  FROM (SELECT DISTINCT company_name_normalised AS n FROM tech) l
  JOIN (SELECT DISTINCT company_name_normalised AS n FROM registry) r
    ON substr(l.n, 1, {settings.BLOCK_LENGTH}) = substr(r.n, 1, {settings.BLOCK_LENGTH})),
{name} AS (
  SELECT l.source_system AS left_source_system, r.source_system AS right_source_system,
         l.record_id AS left_id, r.record_id AS right_id, CAST(d AS INTEGER) AS name_distance,
         1.0::DOUBLE - CAST(d AS DOUBLE) / {rule.threshold} AS match_confidence,
         'fuzzy' AS match_type, left_name, right_name
  FROM {name}_names
  JOIN tech l ON l.company_name_normalised = left_name
  JOIN registry r ON r.company_name_normalised = right_name
  WHERE d <= {rule.threshold} AND 1.0::DOUBLE - CAST(d AS DOUBLE) / {rule.threshold} >= {floor}
  {order})"""


def _ids_sql(rule: MatchRule, name: str = "ids") -> str:
    """Record id to the least id of all records reachable over pairs."""
    return _pairs_sql(rule, f"{name}_pairs") + f""",
{name}_links AS (
  SELECT left_id AS a, right_id AS b FROM {name}_pairs
  UNION SELECT right_id, left_id FROM {name}_pairs),
{name}_reach AS (
  SELECT a AS id, a AS other FROM {name}_links
  UNION SELECT id, b FROM {name}_reach JOIN {name}_links ON a = other),
{name} AS (
  SELECT v.record_id, coalesce(min(other), v.record_id) AS corporate_id
  FROM (SELECT record_id FROM tech UNION SELECT record_id FROM registry) v
  LEFT JOIN {name}_reach ON id = v.record_id GROUP BY v.record_id)"""


_TECH_COLUMNS = [c for c in schemas.SILVER_TECH.fieldNames() if c != "processing_ts"]
_REG_COLUMNS = [c for c in schemas.SILVER_COMPANIES.fieldNames() if c != "processing_ts"]
_GOLDEN_COLUMNS = [c for c in schemas.GOLDEN.fieldNames() if not c.endswith("processing_ts")]


def _golden_sql(rule: MatchRule, name: str = "golden") -> str:
    cells = ", ".join(
        [f"t.{c} AS tech_{c}" for c in _TECH_COLUMNS] + [f"r.{c} AS reg_{c}" for c in _REG_COLUMNS]
    )
    return _ids_sql(rule, f"{name}_ids") + f""",
{name} AS (
  SELECT ti.corporate_id, {cells}
  FROM tech t JOIN {name}_ids ti ON ti.record_id = t.record_id
  LEFT JOIN (SELECT x.*, corporate_id FROM registry x JOIN {name}_ids USING (record_id)) r
    ON r.corporate_id = ti.corporate_id)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n"


_MATCH_COLUMNS = ", ".join(schemas.MATCHES.fieldNames())


# --- Frames shared by the queries --------------------------------------------------------------

def _tech(spark, folder):
    return standardize.tech_companies(sample.bronze_tech(spark, folder), RUN_TS)


def _registry(spark, folder):
    return standardize.company_registry(sample.bronze_companies(spark, folder), RUN_TS)


def _matches(spark, folder, rule):
    return matching.match_records(_tech(spark, folder), _registry(spark, folder), rule)


def _golden(spark, folder, rule):
    rows = golden.golden_by_name(_tech(spark, folder), _registry(spark, folder), rule, RUN_TS)
    check_contract(rows, schemas.GOLDEN)
    return rows


def _graph_ids(spark, folder, rule):
    tech, registry = _tech(spark, folder), _registry(spark, folder)
    links = components.edges(matching.match_records(tech, registry, rule))
    return components.corporate_ids(components.vertices(registry, tech), links)


# --- Standardising -----------------------------------------------------------------------------

@query(_with(BRONZE) + """
SELECT trim(lower(name)) AS name, trim(lower(domain)) AS domain, year_founded,
       trim(lower(industry)) AS industry, trim(lower(size_range)) AS size_range,
       trim(lower(locality)) AS locality, trim(lower(country)) AS country,
       trim(lower(linkedin_url)) AS linkedin_url, current_employee_estimate,
       total_employee_estimate
FROM bronze_companies""")
def lower_trim_all(spark, folder):
    return standardize.tidy_strings(sample.bronze_companies(spark, folder))


@query("""
SELECT doc_id, trim(lower(text)) AS text, trim(lower(lang)) AS lang, trim(lower(source)) AS source,
       n_chars FROM documents""")
def lower_trim_documents(spark, folder):
    return standardize.tidy_strings(sample.table(spark, folder, "documents"))


@query(_with(SILVER) + """
SELECT record_id, source_system, company FROM tech
UNION ALL SELECT record_id, source_system, company FROM registry""")
def record_ids(spark, folder):
    cells = ["record_id", "source_system", "company"]
    return _tech(spark, folder).select(cells).unionByName(_registry(spark, folder).select(cells))


@query(_with(BRONZE) + f"""
SELECT ranking, market_cap, {_amount_sql('trim(lower(market_cap))')} AS market_cap_usd,
       CASE WHEN regexp_full_match(trim(lower(market_cap)), '\\$?[0-9,.]+\\s*[tbm]?')
            THEN {_amount_sql('trim(lower(market_cap))')} END AS strict_usd
FROM bronze_tech""")
def market_cap_usd(spark, folder):
    cap = text.tidy("market_cap")
    return sample.bronze_tech(spark, folder).selectExpr(
        "ranking", "market_cap", f"{text.amount_usd(cap)} AS market_cap_usd",
        f"{text.amount_usd(cap, strict=True)} AS strict_usd",
    )


@query(_with(SILVER) + "SELECT record_id, market_cap_usd, estimated_revenue FROM tech")
def estimated_revenue(spark, folder):
    return _tech(spark, folder).select("record_id", "market_cap_usd", "estimated_revenue")


@query(_with(BRONZE) + f"""
SELECT name, {_key_sql('name')} AS company_name_normalised FROM (
  SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier
  UNION ALL SELECT name FROM bronze_companies)""")
def normalised_names(spark, folder):
    part = sample.bronze_companies(spark, folder).select("name")
    customer = sample.table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    supplier = sample.table(spark, folder, "supplier").select(F.col("s_name").alias("name"))
    names = part.unionByName(customer).unionByName(supplier)
    return names.selectExpr("name", f"{text.company_key('name')} AS company_name_normalised")


@query(f"SELECT doc_id, {_key_sql('text')} AS words FROM documents")
def normalised_texts(spark, folder):
    return sample.table(spark, folder, "documents").selectExpr(
        "doc_id", f"{text.company_key('text')} AS words"
    )


@query(_with(SILVER) + "SELECT record_id, industry_std FROM registry")
def industry_std(spark, folder):
    return _registry(spark, folder).select("record_id", "industry_std")


@query(_with(SILVER) + """
SELECT record_id, country_std FROM registry UNION ALL SELECT record_id, country_std FROM tech""")
def country_std(spark, folder):
    cells = ["record_id", "country_std"]
    return _registry(spark, folder).select(cells).unionByName(_tech(spark, folder).select(cells))


# The time of the run as text, since engines differ in time zones.
_RUN_TEXT = RUN_TS.strftime("%Y-%m-%d %H:%M:%S")


def _with_times(df: DataFrame, cells: list[str]) -> DataFrame:
    times = [c for c in df.columns if c.endswith("processing_ts")]
    return df.select(*cells, *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in times])


@query("""
SELECT o_orderkey, coalesce(c_mktsegment, 'N/A') AS segment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = o_custkey""")
def translated_by_table(spark, folder):
    """A lookup in a wording table as large as a table, which repeats some rows."""
    orders = sample.table(spark, folder, "orders").selectExpr("o_orderkey", "concat('customer ', o_custkey) AS buyer")
    known = sample.table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").selectExpr(
        "concat('customer ', c_custkey) AS buyer", "c_mktsegment AS segment")
    known = known.unionByName(known.where("endswith(buyer, '7')"))
    return lookup.translated_by_table(orders, "buyer", known, "buyer", "segment", "segment").drop("buyer")


@query(_with(SILVER) + f"SELECT {', '.join(_TECH_COLUMNS)}, '{_RUN_TEXT}' AS processing_ts FROM tech")
def silver_tech(spark, folder):
    return _with_times(_tech(spark, folder), _TECH_COLUMNS)


@query(_with(SILVER) + f"SELECT {', '.join(_REG_COLUMNS)}, '{_RUN_TEXT}' AS processing_ts FROM registry")
def silver_companies(spark, folder):
    return _with_times(_registry(spark, folder), _REG_COLUMNS)


# --- Matching ----------------------------------------------------------------------------------

@query(_with(SILVER) + f"""
SELECT coalesce(l.b, r.b) AS blocking_key, coalesce(l.n, 0) AS left_records,
       coalesce(l.u, 0) AS left_names, coalesce(r.n, 0) AS right_records,
       coalesce(r.u, 0) AS right_names,
       CAST(coalesce(l.n, 0) * coalesce(r.n, 0) AS VARCHAR) AS record_comparisons
FROM (SELECT substr(company_name_normalised, 1, {settings.BLOCK_LENGTH}) AS b, count(*) AS n,
             count(DISTINCT company_name_normalised) AS u FROM tech GROUP BY 1) l
FULL JOIN (SELECT substr(company_name_normalised, 1, {settings.BLOCK_LENGTH}) AS b, count(*) AS n,
             count(DISTINCT company_name_normalised) AS u FROM registry GROUP BY 1) r
ON l.b = r.b""")
def block_sizes(spark, folder):
    return matching.block_load(_tech(spark, folder), _registry(spark, folder))


@query(_with(SILVER, _pairs_sql(EXACT)) + f"SELECT {_MATCH_COLUMNS} FROM pairs")
def exact_matches(spark, folder):
    return _matches(spark, folder, EXACT)


@query(_with(SILVER, _pairs_sql(NEAR)) + f"SELECT {_MATCH_COLUMNS} FROM pairs")
def fuzzy_matches_t1(spark, folder):
    return _matches(spark, folder, NEAR)


@query(_with(SILVER, _pairs_sql(WIDE)) + f"SELECT {_MATCH_COLUMNS} FROM pairs")
def fuzzy_matches_t3(spark, folder):
    return _matches(spark, folder, WIDE)


@query(_with(SILVER, _pairs_sql(ANY_ORDER)) + f"SELECT {_MATCH_COLUMNS} FROM pairs")
def fuzzy_matches_any_order(spark, folder):
    return _matches(spark, folder, ANY_ORDER)


_BAND_SQL = _with(SILVER, _pairs_sql(EXACT, floor=0.60)) + """
SELECT left_id, right_id, left_name AS left_company_name, right_name AS right_company_name,
       name_distance, match_confidence
FROM pairs WHERE match_confidence < 0.80"""


def _band(spark, folder):
    pairs = matching.ambiguous_pairs(
        _tech(spark, folder), _registry(spark, folder), EXACT, carried=(matching.NAME,)
    )
    return pairs.select(
        "left_id", "right_id", F.col(f"left_{matching.NAME}").alias("left_company_name"),
        F.col(f"right_{matching.NAME}").alias("right_company_name"),
        "name_distance", "match_confidence",
    )


@query(_BAND_SQL)
def ambiguity_band(spark, folder):
    return _band(spark, folder)


_NUMBERED_SQL = """
SELECT l.n AS left_name, r.n AS right_name, CAST(levenshtein(l.n, r.n) AS INTEGER) AS name_distance
FROM (SELECT DISTINCT %s AS n FROM customer) l
JOIN (SELECT DISTINCT 'customer ' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS n FROM orders) r
  ON substr(l.n, 1, %d) = substr(r.n, 1, %d)
WHERE levenshtein(l.n, r.n) <= %d"""


def _numbered_sql(reach: int) -> str:
    return _NUMBERED_SQL % (_key_sql("c_name"), settings.BLOCK_LENGTH, settings.BLOCK_LENGTH, reach)


def _numbered_pairs(spark, folder, reach):
    """All names fall into one block and differ in a digit or two: the worst case of blocking."""
    customers = sample.table(spark, folder, "customer").selectExpr(
        f"{text.company_key('c_name')} AS name"
    )
    buyers = sample.table(spark, folder, "orders").selectExpr(
        "concat('customer ', lpad(string(o_custkey), 9, '0')) AS name"
    )
    return matching.name_pairs(customers.distinct(), buyers.distinct(), reach)


@query(_numbered_sql(1))
def one_block_name_pairs(spark, folder):
    return _numbered_pairs(spark, folder, 1)


@query(_numbered_sql(2))
def one_block_name_pairs_t2(spark, folder):
    return _numbered_pairs(spark, folder, 2)


# --- Entities and golden rows ------------------------------------------------------------------

@query(_with(SILVER) + "SELECT record_id AS id FROM tech UNION SELECT record_id FROM registry")
def vertices(spark, folder):
    return components.vertices(_registry(spark, folder), _tech(spark, folder))


@query(_with(SILVER, _pairs_sql(EXACT)) + "SELECT left_id AS src, right_id AS dst FROM pairs")
def edges(spark, folder):
    return components.edges(_matches(spark, folder, EXACT))


@query(_with(SILVER, _ids_sql(EXACT)) + "SELECT record_id, corporate_id FROM ids")
def corporate_ids(spark, folder):
    return _graph_ids(spark, folder, EXACT)


@query(_with(SILVER, _ids_sql(NEAR)) + "SELECT record_id, corporate_id FROM ids")
def corporate_ids_t1(spark, folder):
    return _graph_ids(spark, folder, NEAR)


@query(_with(SILVER, _ids_sql(NEAR)) + "SELECT record_id, corporate_id FROM ids")
def corporate_ids_extended(spark, folder):
    """Entities of the exact matches, to which the links of the near ones are added."""
    tech, registry = _tech(spark, folder), _registry(spark, folder)
    pairs = lineage.cut(matching.match_records(tech, registry, NEAR))
    exact, near = (components.edges(pairs.where(c)) for c in ("name_distance = 0", "name_distance > 0"))
    stored = lineage.cut(components.corporate_ids(components.vertices(registry, tech), exact))
    return components.extended_ids(stored, near)


def _by_name(spark, folder, rule):
    sides = components.link_by_name(_tech(spark, folder), _registry(spark, folder), rule)
    cells = ["record_id", "corporate_id"]
    return sides[0].select(cells).unionByName(sides[1].select(cells)).distinct()


@query(_with(SILVER, _ids_sql(EXACT)) + "SELECT record_id, corporate_id FROM ids")
def corporate_ids_by_name(spark, folder):
    return _by_name(spark, folder, EXACT)


@query(_with(SILVER, _ids_sql(ANY_ORDER)) + "SELECT record_id, corporate_id FROM ids")
def corporate_ids_by_name_any_order(spark, folder):
    return _by_name(spark, folder, ANY_ORDER)


@query(_with(SILVER, _ids_sql(EXACT)) + f"""
SELECT {', '.join('x.' + c for c in _REG_COLUMNS)}, corporate_id
FROM registry x LEFT JOIN ids USING (record_id)""")
def attach_ids(spark, folder):
    ids = _graph_ids(spark, folder, EXACT)
    return golden.attach_corporate_id(_registry(spark, folder), ids).drop("processing_ts")


_GOLDEN_TIMES = "".join(
    f", CASE WHEN {'reg_record_id' if c.startswith('reg_') else 'tech_record_id'} IS NOT NULL THEN '{_RUN_TEXT}' END AS {c}"
    for c in schemas.GOLDEN.fieldNames() if c.endswith("processing_ts"))


@query(_with(SILVER, _golden_sql(EXACT)) + f"SELECT {', '.join(_GOLDEN_COLUMNS)}{_GOLDEN_TIMES} FROM golden")
def golden_registry(spark, folder):
    return _with_times(_golden(spark, folder, EXACT), _GOLDEN_COLUMNS)


@query(_with(SILVER, _golden_sql(NEAR)) + f"SELECT {', '.join(_GOLDEN_COLUMNS)} FROM golden")
def golden_registry_t1(spark, folder):
    return _golden(spark, folder, NEAR).select(_GOLDEN_COLUMNS)


@query(_with(SILVER, _golden_sql(EXACT)) + f"SELECT {', '.join(_GOLDEN_COLUMNS)} FROM golden")
def golden_registry_from_matches(spark, folder):
    tech, registry = _tech(spark, folder), _registry(spark, folder)
    ids = _graph_ids(spark, folder, EXACT)
    return golden.golden_rows(
        golden.attach_corporate_id(tech, ids), golden.attach_corporate_id(registry, ids), RUN_TS
    ).select(_GOLDEN_COLUMNS)


# --- Upsert ------------------------------------------------------------------------------------

@query("""
WITH source AS (
  SELECT CASE WHEN c_custkey % 17 <> 0 THEN c_custkey * 2 END AS c_custkey, c_name || ' new' AS c_name,
         c_acctbal + 1 AS c_acctbal, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer)
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
       CASE WHEN s.c_name IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_name IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_name IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM customer t FULL JOIN source s ON s.c_custkey = t.c_custkey""")
def upsert_customers(spark, folder):
    target = sample.table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    key = F.col("c_custkey")
    source = target.select(
        F.when(key % 17 != 0, key * 2).alias("c_custkey"),
        F.concat("c_name", F.lit(" new")).alias("c_name"),
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    check_contract(source, target)
    return upsert.merged(target, source, ["c_custkey"])


@query("""
WITH newest AS (
  SELECT user_id, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
  FROM events)
SELECT coalesce(s.user_id, c_custkey) AS user_id, s.event_id AS event_id,
       CASE WHEN s.user_id IS NULL THEN c_mktsegment ELSE event_type END AS event_type,
       CASE WHEN s.user_id IS NULL THEN c_acctbal ELSE value END AS value
FROM customer FULL JOIN (SELECT * FROM newest WHERE n = 1) s ON s.user_id = c_custkey""")
def upsert_latest_wins(spark, folder):
    target = sample.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(None).cast("long").alias("event_id"),
        F.lit(None).cast("timestamp_ntz").alias("ts"), F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    source = sample.table(spark, folder, "events").select(*target.columns)
    check_contract(source, target)
    return upsert.merged(target, source, ["user_id"], "latest", newest="ts").drop("ts")


def _one_per_key(rows: DataFrame) -> DataFrame:
    """Record ids repeat within a source, so golden rows do too; a merge needs one per key."""
    return rows.groupBy(*ROW_KEY).agg(
        F.max("tech_company").alias("tech_company"), F.min("reg_domain").alias("reg_domain"),
        F.count(F.lit(1)).alias("copies"),
    )


def _one_per_key_sql(name: str) -> str:
    return f"""(SELECT {', '.join(ROW_KEY)}, max(tech_company) AS tech_company,
        min(reg_domain) AS reg_domain, count(*) AS copies FROM {name} GROUP BY ALL)"""


@query(_with(SILVER, _golden_sql(EXACT, "old"), _golden_sql(NEAR, "fresh")) + f"""
SELECT {', '.join(f'coalesce(s.{c}, t.{c}) AS {c}' for c in ROW_KEY)},
       {', '.join(f'CASE WHEN s.corporate_id IS NULL THEN t.{c} ELSE s.{c} END AS {c}'
                  for c in ('tech_company', 'reg_domain', 'copies'))}
FROM {_one_per_key_sql('old')} t FULL JOIN {_one_per_key_sql('fresh')} s
  ON s.corporate_id = t.corporate_id
 AND s.tech_record_id IS NOT DISTINCT FROM t.tech_record_id
 AND s.reg_record_id IS NOT DISTINCT FROM t.reg_record_id""")
def upsert_golden(spark, folder):
    target = _one_per_key(_golden(spark, folder, EXACT))
    source = _one_per_key(_golden(spark, folder, NEAR))
    check_contract(source, target)
    return upsert.merged(target, source, ROW_KEY, null_safe=ROW_KEY[1:])


def _changed_orders_sql(condition: str) -> str:
    return f"""
WITH source AS (
  SELECT o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 100000000 ELSE 0 END AS o_orderkey,
         o_totalprice + 1 AS o_totalprice, CASE WHEN o_orderkey % 5 <> 0 THEN 'new' END AS o_orderstatus
  FROM orders WHERE {condition})
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus
FROM orders t FULL JOIN source s ON s.o_orderkey = t.o_orderkey"""


def _changed_orders(spark, folder, condition: str) -> tuple[DataFrame, DataFrame]:
    orders = sample.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    changed = orders.where(condition).selectExpr(
        "o_orderkey + IF(o_orderkey % 7 = 0, 100000000, 0) AS o_orderkey", "o_totalprice + 1 AS o_totalprice",
        "CASE WHEN o_orderkey % 5 <> 0 THEN 'new' END AS o_orderstatus")
    return orders, changed


@query(_changed_orders_sql("o_orderkey % 3 = 0"))
def upsert_in_place(spark, folder):
    """Changed orders replace and extend the stored ones, in the buckets of a folder."""
    orders, changed = _changed_orders(spark, folder, "o_orderkey % 3 = 0")
    place = f"{lineage.new_folder(spark)}/orders"
    for staged in (orders, changed):
        registry_table.upsert(spark, place, staged, ["o_orderkey"])
    return registry_table.current(spark, place)


@query(_changed_orders_sql("o_orderkey % 2 = 0"))
def upsert_bucketed(spark, folder):
    """The same between two tables that are bucketed alike, which meet without a shuffle."""
    place = lineage.new_folder(spark)
    tables = [registry_table.save_bucketed(df, f"{name}_{place[-32:]}", ["o_orderkey"], f"{place}/{name}")
              for df, name in zip(_changed_orders(spark, folder, "o_orderkey % 2 = 0"), ("target", "source"))]
    return upsert.merged(*tables, ["o_orderkey"], as_laid_out=True)


# --- Features and model ------------------------------------------------------------------------

_FEATURES_SQL = _golden_sql(EXACT) + f""",
aged AS (
  SELECT *, nullif(coalesce(nullif(tech_industry_std, 'N/A'), reg_industry_std), 'N/A')
              AS industry_std,
         {AS_OF.year} - reg_year_founded AS company_age
  FROM golden),
features AS (
  SELECT *, CASE WHEN company_age > -1 THEN ln(1 + company_age) END AS log_company_age,
         ln(1 + reg_total_employee_estimate) AS log_reg_total_employee_estimate,
         ln(1 + tech_estimated_revenue) AS log_tech_estimated_revenue
  FROM aged)"""

_COMPLETE_SQL = """industry_std IS NOT NULL AND log_company_age IS NOT NULL
  AND log_reg_total_employee_estimate IS NOT NULL AND log_tech_estimated_revenue IS NOT NULL"""

_LOGS = ["log_company_age", "log_reg_total_employee_estimate", "log_tech_estimated_revenue"]


def _features(spark, folder):
    return features.with_features(_golden(spark, folder, EXACT), AS_OF)


@query(_with(SILVER, _FEATURES_SQL) + f"""
SELECT {', '.join(ROW_KEY)}, industry_std, company_age,
       {', '.join(f'round({c}, 6) AS {c}' for c in _LOGS)} FROM features""")
def model_features(spark, folder):
    return _features(spark, folder).select(
        *ROW_KEY, "industry_std", "company_age", *[F.round(c, 6).alias(c) for c in _LOGS]
    )


@query(_with(SILVER, _FEATURES_SQL) + f"""
, usable AS (SELECT * FROM features WHERE {_COMPLETE_SQL}),
labels_by_rank AS (
  SELECT industry_std, row_number() OVER (ORDER BY count(*) DESC, industry_std) - 1 AS idx
  FROM usable GROUP BY industry_std)
SELECT {', '.join(ROW_KEY)}, industry_std, CAST(idx AS DOUBLE) AS industry_idx,
       CAST((SELECT count(*) FROM labels_by_rank) AS INTEGER) AS slots, CAST(idx AS INTEGER) AS hot_slot
FROM usable JOIN labels_by_rank USING (industry_std)""")
def industry_encoding(spark, folder):
    usable = features.complete(_features(spark, folder)).select(*ROW_KEY, "industry_std")
    slots = vector_to_array("industry_ohe")
    encoded = model.industry_encoding().fit(usable).transform(usable)
    return encoded.select(
        *ROW_KEY, "industry_std", "industry_idx", F.size(slots).alias("slots"),
        (F.array_position(slots, 1.0) - 1).cast("int").alias("hot_slot"),
    )


@query(_with(SILVER, _FEATURES_SQL) + f"""
SELECT {', '.join(ROW_KEY)},
       CAST(('0x' || substr(sha256(concat_ws('|', '{model.SEED}',
         {', '.join(f"coalesce({c}, '')" for c in ROW_KEY)})), 1, 8)) AS BIGINT) % 100
         < {model.TRAIN_PERCENT} AS in_train
FROM features WHERE {_COMPLETE_SQL}""")
def stable_split(spark, folder):
    train, test = model.split(features.complete(_features(spark, folder)).select(*ROW_KEY))
    return train.withColumn("in_train", F.lit(True)).unionByName(
        test.withColumn("in_train", F.lit(False))
    )


@query(_with(SILVER, _FEATURES_SQL) + f"""
, drawn AS (
  SELECT {features.LABEL} AS label,
         CAST(('0x' || substr(sha256(concat_ws('|', '{model.SEED}',
           {', '.join(f"coalesce({c}, '')" for c in ROW_KEY)})), 1, 8)) AS BIGINT) % 100
           < {model.TRAIN_PERCENT} AS in_train
  FROM features WHERE {_COMPLETE_SQL}),
plain AS (SELECT avg(label) AS guess FROM drawn WHERE in_train)
SELECT 'LinearRegression' AS model, count(*) FILTER (in_train) AS train_rows,
       count(*) FILTER (NOT in_train) AS test_rows,
       round(avg(abs(label - guess)) FILTER (NOT in_train), 6) AS mean_guess_error,
       TRUE AS mae_is_mean_error, TRUE AS centred_on_train, TRUE AS fits_train
FROM drawn, plain""")
def model_mae(spark, folder):
    """The report of a training run, the error of always guessing the train rows' mean, and what must
    hold for every optimum: the reported error is the mean absolute error of the predictions, the
    intercept is free, so train residuals average 0, and their square is at most the variance."""
    rows = lineage.cut(_features(spark, folder))
    trained = model.train(rows)
    train_rows, test_rows = model.split(features.complete(rows))
    label, prediction = F.col(features.LABEL), F.col("prediction")
    on_train = trained.model.transform(train_rows).agg(
        F.avg(label).alias("guess"), F.var_pop(label).alias("variance"),
        F.avg(label - prediction).alias("residual"),
        F.avg((label - prediction) * (label - prediction)).alias("square"),
    ).first()
    return trained.model.transform(test_rows).agg(
        F.avg(F.abs(label - prediction)).alias("error"),
        F.round(F.avg(F.abs(label - F.lit(on_train.guess))), 6).alias("mean_guess_error"),
    ).select(
        F.lit("LinearRegression").alias("model"), F.lit(trained.train_rows).cast("long").alias("train_rows"),
        F.lit(trained.test_rows).cast("long").alias("test_rows"), "mean_guess_error",
        (F.abs(F.lit(trained.mae) - F.col("error")) < 1e-9).alias("mae_is_mean_error"),
        F.lit(abs(on_train.residual) < 1e-6).alias("centred_on_train"),
        F.lit(on_train.square <= on_train.variance + 1e-9).alias("fits_train"),
    )


# --- Adjudication ------------------------------------------------------------------------------

def _pair_requests(spark, folder):
    """One request line per customer, in every shape requests come in."""
    def pair(suffix: str) -> str:
        return (
            f"""concat('{{"left_id":"L', c_custkey, '{suffix}","right_id":"R', c_custkey,
            '{suffix}","left_company_name":"', c_name, '","right_company_name":"', c_mktsegment,
            '"}}')"""
        )

    line = f"""CASE c_custkey % 6
      WHEN 0 THEN concat('[', {pair('')}, ',17]')
      WHEN 1 THEN concat('{{"pairs":[', {pair('')}, ',{{"left_id":"L', c_custkey,
                         'b","right_id":"R', c_custkey, 'b"}}]}}')
      WHEN 2 THEN concat(r'{{"body":"{{\\"pairs\\":[', replace({pair('')}, '"', r'\\"'), ']}}"}}')
      WHEN 3 THEN concat('[', left({pair('')}, 20))
      WHEN 4 THEN concat('{{"body":{{"pairs":[', {pair('x')}, ']}},"pairs":[', {pair('')}, ']}}')
      ELSE concat('{{"body":"  ","pairs":[{{"left_id":', c_custkey, ',"left_company_name":null}}]}}')
      END AS value"""
    return sample.table(spark, folder, "customer").selectExpr("c_custkey", line)


_PAIRS_SQL = """
asked AS (
  SELECT c_custkey, 'L' || c_custkey AS left_id, 'R' || c_custkey AS right_id,
         c_name AS left_company_name, c_mktsegment AS right_company_name
  FROM customer WHERE c_custkey % 6 IN (0, 1, 2, 4)
  UNION ALL SELECT c_custkey, 'L' || c_custkey || 'b', 'R' || c_custkey || 'b', '', ''
  FROM customer WHERE c_custkey % 6 = 1
  UNION ALL SELECT c_custkey, CAST(c_custkey AS VARCHAR), NULL, NULL, ''
  FROM customer WHERE c_custkey % 6 = 5)"""


@query(_with(_PAIRS_SQL) + "SELECT * FROM asked")
def parsed_pairs(spark, folder):
    return adjudicate.read_pairs(_pair_requests(spark, folder))


@query(_with(_PAIRS_SQL) + """
SELECT left_id, right_id, coalesce(r.c_custkey % 2 = 0, FALSE) AS match,
       coalesce((r.c_custkey % 101) / 100.0::DOUBLE, 0.0) AS match_confidence
FROM asked LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 4 IN (0, 1)) r
  ON left_id = 'L' || r.c_custkey AND right_id = 'R' || r.c_custkey""")
def default_verdicts(spark, folder):
    """Of four answers two are usable, one is out of range and one cannot be read."""
    answer = """concat('{"results":[{"left_id":"L', c_custkey, '","right_id":"R', c_custkey,
      '","match":', c_custkey % 2 = 0, ',"match_confidence":',
      IF(c_custkey % 4 = 2, 1.5D, (c_custkey % 101) / 100D),
      IF(c_custkey % 4 = 3, '}]', '}]}')) AS response"""
    responses = sample.table(spark, folder, "customer").selectExpr(answer)
    pairs = adjudicate.read_pairs(_pair_requests(spark, folder))
    return adjudicate.complete_verdicts(pairs, adjudicate.read_verdicts(responses))


def _grams_sql(name: str) -> str:
    return f"list_distinct([substr({name}, i, 2) for i in range(1, length({name}))])"


_VERDICT_SQL = _with(SILVER, _pairs_sql(EXACT, floor=0.60)) + f""",
shares AS (
  SELECT left_id, right_id,
         len(list_intersect({_grams_sql('left_name')}, {_grams_sql('right_name')}))::DOUBLE
         / len(list_distinct(list_concat({_grams_sql('left_name')}, {_grams_sql('right_name')})))
           AS share
  FROM pairs WHERE match_confidence < 0.80)
"""


def _verdicts(spark, folder):
    return adjudicate.adjudicate_by_share(_band(spark, folder), LEAST_SHARE)


@query(_VERDICT_SQL + f"""
SELECT left_id, right_id, share >= {LEAST_SHARE} AS match, share AS match_confidence FROM shares""")
def adjudicated_verdicts(spark, folder):
    return _verdicts(spark, folder)


def _length_scorer(request: str) -> str:
    """A scorer in the shape of the service: names of like length match, other requests go unanswered."""
    import json

    results = []
    for pair in json.loads(request)["pairs"]:
        left, right = (len(pair[f"{side}_company_name"]) for side in ("left", "right"))
        if (left + right) % 11:
            results.append({"left_id": pair["left_id"], "right_id": pair["right_id"], "match": left == right,
                            "match_confidence": min(left, right) / max(left, right, 1)})
    return json.dumps({"results": results})


@query(_BAND_SQL.replace("SELECT left_id, right_id, left_name AS left_company_name, right_name AS right_company_name,\n"
                         "       name_distance, match_confidence\n", """
SELECT left_id, right_id, (length(left_name) + length(right_name)) % 11 <> 0 AND length(left_name) = length(right_name) AS match,
       CASE WHEN (length(left_name) + length(right_name)) % 11 = 0 THEN 0.0::DOUBLE
            ELSE least(length(left_name), length(right_name))::DOUBLE / greatest(length(left_name), length(right_name), 1) END
         AS match_confidence
"""))
def asked_verdicts(spark, folder):
    """Verdicts of a scorer that is asked in batches, half of them by a run before this one."""
    ledger = f"{lineage.new_folder(spark)}/ledger"
    pairs = lineage.cut(_band(spark, folder))
    adjudicate.ask_once(pairs.where("length(left_company_name) % 2 = 0"), _length_scorer, ledger, 50, 100)
    return adjudicate.adjudicate_names(pairs, _length_scorer, 50, ledger)


@query(_VERDICT_SQL + f"""
SELECT left_id AS src, right_id AS dst, share AS match_confidence, 'adjudicated' AS match_type
FROM shares WHERE share >= {LEAST_SHARE}""")
def adjudicated_edges(spark, folder):
    return adjudicate.adjudicated_edges(_verdicts(spark, folder))


# --- News --------------------------------------------------------------------------------------

def _news_requests(spark, folder):
    """One request event per row of the events table, in every shape and with every defect."""
    day = "date_format(ts, 'yyyy-MM-dd')"
    full = (
        """concat('{"corporate_id":"C-', user_id, '","company":" ', event_type,"""
        f"""' ","current_date":"', {day}, '"}}')"""
    )
    line = f"""CASE event_id % 8
      WHEN 0 THEN {full}
      WHEN 1 THEN concat('{{"body":"', replace({full}, '"', r'\\"'), '"}}')
      WHEN 2 THEN concat('{{"body":', {full}, '}}')
      WHEN 3 THEN concat('{{"company":"x","current_date":"', {day}, '"}}')
      WHEN 4 THEN concat('{{"corporate_id":"C-', user_id,
                         '","company":null,"current_date":"2024-01-05"}}')
      WHEN 5 THEN concat('{{"corporate_id":', user_id,
                         ',"company":"x","current_date":"2024-02-30"}}')
      WHEN 6 THEN concat('{{"body":"{{","queryStringParameters":{{"corporate_id":"C-', user_id,
                         '","company":"q","current_date":"2024-1-5"}}}}')
      ELSE '{{' END AS value"""
    return sample.table(spark, folder, "events").selectExpr("event_id", line)


@query(f"""
WITH parsed AS (
  SELECT event_id, event_id % 8 AS s,
         CASE WHEN event_id % 8 IN (0, 1, 2, 4, 6) THEN 'C-' || user_id
              WHEN event_id % 8 = 5 THEN CAST(user_id AS VARCHAR) ELSE '' END AS corporate_id,
         CASE WHEN event_id % 8 IN (0, 1, 2) THEN event_type WHEN event_id % 8 IN (3, 5) THEN 'x'
              WHEN event_id % 8 = 6 THEN 'q' ELSE '' END AS company,
         CASE WHEN event_id % 8 <= 3 THEN strftime(ts, '%Y-%m-%d')
              WHEN event_id % 8 = 4 THEN '2024-01-05' WHEN event_id % 8 = 5 THEN '2024-02-30'
              WHEN event_id % 8 = 6 THEN '2024-1-5' ELSE '' END AS "current_date"
  FROM events)
SELECT event_id, corporate_id, company, "current_date",
       CASE WHEN s IN (3, 7) THEN '{news.MISSING_ID}' WHEN s = 4 THEN '{news.MISSING_COMPANY}'
            WHEN s = 5 THEN '{news.BAD_DATE}' END AS error
FROM parsed""")
def news_requests(spark, folder):
    return news.checked_requests(news.read_requests(_news_requests(spark, folder)))


def _news_documents(spark, folder):
    """One result document per event, some of them defective in one way or another."""
    head = """concat('{"date":"', date_format(ts, 'yyyy-MM-dd'), '"')"""
    impossible = """'{"date":"2024-02-30"'"""
    title = """concat(',"title":"', event_type, '"')"""
    tail = """concat(',"url":"https://news.example.com/', event_type, '/',
      get_json_object(props, '$.k'), '","corporate_id":"C-', user_id, '"}')"""
    items = f"""CASE event_id % 10
      WHEN 4 THEN concat({head}, {tail})
      WHEN 5 THEN concat({head}, {title}, ',"extra":1', {tail})
      WHEN 6 THEN ''
      WHEN 7 THEN concat({head}, {title}, {tail}, ',', {impossible}, {title}, {tail})
      WHEN 8 THEN concat({head}, {title}, {tail}, ',', {head}, ',"title":5', {tail}, ',"{{}}"')
      ELSE concat({head}, {title}, {tail}) END"""
    line = f"""concat('{{"corporate_id":"C-', user_id, '","company":"Company ', user_id,
      '","current_date":"2024-1-', user_id % 20 + 1, '","items":[', {items},
      IF(event_id % 10 = 3, ']', ']}}')) AS value"""
    return sample.table(spark, folder, "events").selectExpr(line)


_NEWS_SQL = """
feed AS (
  SELECT event_id % 10 AS kind, 'C-' || user_id AS corporate_id, 'Company ' || user_id AS company,
         make_date(2024, 1, CAST(user_id % 20 + 1 AS INTEGER)) AS asked, CAST(ts AS DATE) AS date,
         event_type AS title,
         'https://news.example.com/' || event_type || '/' || json_extract_string(props, '$.k') AS url
  FROM events),
good AS (SELECT * FROM feed WHERE kind NOT IN (3, 4, 5, 6) AND date >= asked),
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY corporate_id, url ORDER BY date DESC) AS n FROM good)
  WHERE n = 1)"""

_NEWS_CELLS = """corporate_id, company, CAST(asked AS VARCHAR) AS "current_date",
       CAST(date AS VARCHAR) AS date, title, url"""


def _as_text(items):
    return items.withColumns({
        "current_date": F.col("`current_date`").cast("string"), "date": F.col("date").cast("string"),
    })


def _accepted(spark, folder):
    return news.accepted(news.read_news(_news_documents(spark, folder)))


@query(_with(_NEWS_SQL) + f"SELECT {_NEWS_CELLS} FROM newest")
def news_items(spark, folder):
    return _as_text(news.newest_per_url(_accepted(spark, folder)))


@query(_with(_NEWS_SQL) + f"""
SELECT * FROM (
  SELECT {_NEWS_CELLS}, CAST(row_number() OVER (
           PARTITION BY corporate_id, asked ORDER BY newest.date DESC, url) AS INTEGER) AS item_rank
  FROM newest) WHERE item_rank <= {settings.NEWS_ITEMS_PER_REQUEST}""")
def news_top_items(spark, folder):
    return _as_text(news.top_items(news.newest_per_url(_accepted(spark, folder))))


@query(_with(_NEWS_SQL) + """
SELECT error, count(*) AS entries FROM (
  SELECT CASE kind WHEN 3 THEN 'unreadable document' WHEN 4 THEN 'item: missing field'
                   WHEN 5 THEN 'item: unknown field' ELSE 'item: older than requested' END AS error
  FROM feed WHERE kind IN (3, 4, 5) OR (kind <> 6 AND date < asked)
  UNION ALL SELECT 'item: unreadable date' FROM feed WHERE kind = 7
  UNION ALL SELECT 'item: wrong type' FROM feed WHERE kind = 8
  UNION ALL SELECT 'item: not an object' FROM feed WHERE kind = 8)
GROUP BY error""")
def news_refused(spark, folder):
    refused = news.refused(news.read_news(_news_documents(spark, folder)))
    return refused.groupBy("error").agg(F.count(F.lit(1)).alias("entries"))


@query(_with(_NEWS_SQL) + f"SELECT {_NEWS_CELLS} FROM newest")
def news_stream_upsert(spark, folder):
    """The same items, arriving as files of a stream that is merged batch by batch."""
    place = lineage.new_folder(spark)
    documents = _news_documents(spark, folder)
    documents.write.text(f"{place}/in")
    lines = news_stream.news_lines(spark, f"{place}/in", files_per_batch=2)
    news_stream.start(
        lines, f"{place}/table", f"{place}/quarantine", f"{place}/progress"
    ).awaitTermination()
    return _as_text(registry_table.current(spark, f"{place}/table"))


@query("""
SELECT column_name, kind, count(c_custkey) AS rows_concerned
FROM customer JOIN (VALUES ('c_mktsegment', 'missing'), ('c_flag', 'extra'), ('c_name', 'retyped')) d(column_name, kind)
  ON c_custkey IS NOT NULL
GROUP BY column_name, kind""")
def schema_contract_report(spark, folder):
    """How a changed copy of a table departs from it, and how many of its rows that concerns."""
    customer = sample.table(spark, folder, "customer")
    staged = customer.drop("c_mktsegment").withColumns({"c_flag": F.lit(1), "c_name": F.length("c_name")})
    concerned = [F.struct(F.lit(d.column).alias("column_name"), F.lit(d.kind).alias("kind"))
                 for d in differences(staged, customer)]
    counted = staged.agg(F.count("c_custkey").alias("rows_concerned"))
    return counted.select(F.inline(F.array(*concerned)), "rows_concerned")
