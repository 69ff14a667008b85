"""Adverse news: checking requests, and turning result documents into deduplicated items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave import schemas, settings
from corpweave.functions.dates import calendar_date
from corpweave.operators.adjudicate import member

FIELDS = ["corporate_id", "company", "current_date"]
ITEM_FIELDS = ["date", "title", "url", "corporate_id"]
ITEM_KEY = ["corporate_id", "url"]
#: Of items with one key the greatest by these is the newest.
NEWER_BY = ["current_date", "date", "title", "company"]

# The messages a rejected request gets, in the order they are checked.
MISSING_ID = "Missing required parameter: corporate_id"
MISSING_COMPANY = "Missing required parameter: company"
BAD_DATE = "Missing or invalid required parameter: current_date (YYYY-MM-DD)"


def _as_python_text(value: Column) -> Column:
    """A scalar variant the way ``str`` writes it; an explicit null counts as absent."""
    text = value.try_cast("string")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text)


def _blank(value: Column) -> Column:
    """Whether a query-string value may take the place of this one."""
    text, kind = value.try_cast("string"), F.schema_of_variant(value)
    nothing = (text == "") | ((kind != "STRING") & text.isin("0", "false"))
    return F.coalesce(nothing, F.lit(True))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def read_requests(requests: DataFrame, column: str = "value") -> DataFrame:
    """corporate_id, company and current_date of request events given as JSON text.

    They come from the event itself or, when there is one, from its ``body`` (an object or JSON
    text); ``queryStringParameters`` fill what is left blank. Absent values are ''.
    """
    others = [c for c in requests.columns if c != column]
    # One step per level, so that no text is parsed again for each value taken from it.
    events = requests.select(*others, F.try_parse_json(F.col(column)).alias("_event"))
    bodies = events.select(
        *others, "_event", member(F.col("_event"), "body").alias("_body"),
        member(F.col("_event"), "queryStringParameters").alias("_query"),
    )
    event, body = F.col("_event"), F.col("_body")
    body_kind = F.coalesce(F.schema_of_variant(body), F.lit("VOID"))
    body_text = body.try_cast("string")
    source = (
        F.when((body_kind == "STRING") & (body_text != ""), F.try_parse_json(body_text))
        .when(body_kind.startswith("OBJECT") & (body_text != "{}"), body)
        .otherwise(event)
    )
    parsed = bodies.select(*others, source.alias("_source"), "_query")
    members = parsed.select(
        *others,
        *[member(F.col("_source"), field).alias(f"_own_{field}") for field in FIELDS],
        *[member(F.col("_query"), field).alias(f"_spare_{field}") for field in FIELDS],
    )

    def value(field: str) -> Column:
        own, spare = F.col(f"_own_{field}"), F.col(f"_spare_{field}")
        chosen = F.when(_blank(own) & ~_blank(spare), _as_python_text(spare)).otherwise(
            _as_python_text(own)
        )
        return _stripped(F.coalesce(chosen, F.lit(""))).alias(field)

    return members.select(*others, *[value(field) for field in FIELDS])


def checked_requests(requests: DataFrame) -> DataFrame:
    """Requests with the first problem of each in ``error``, NULL when there is none."""
    return requests.withColumn(
        "error",
        F.when(F.col("corporate_id") == "", F.lit(MISSING_ID))
        .when(F.col("company") == "", F.lit(MISSING_COMPANY))
        .when(calendar_date(F.col("`current_date`")).isNull(), F.lit(BAD_DATE)),
    )


def _members(value: str) -> str:
    """The members of a variant object by name, NULL for any other value."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def _field_problem(members: str, wanted: list[str]) -> str:
    """What is wrong with the members of an object that should be exactly the texts ``wanted``."""
    listed = "array(" + ", ".join(f"'{name}'" for name in wanted) + ")"
    kinds = f"transform({listed}, name -> schema_of_variant({members}[name]))"
    return (
        f"CASE WHEN exists({kinds}, kind -> kind IS NULL) THEN 'missing field' "
        f"WHEN size({members}) > {len(wanted)} THEN 'unknown field' "
        f"WHEN exists({kinds}, kind -> kind = 'VOID') THEN 'missing field' "
        f"WHEN exists({kinds}, kind -> kind <> 'STRING') THEN 'wrong type' END"
    )


def read_news(documents: DataFrame, column: str = "value") -> DataFrame:
    """Items of result documents, one JSON document per row, with the problem of each in ``error``.

    Accepted items have ``error`` NULL. A document that cannot be used gives one row that holds
    its text in ``entry``; one without items gives none. All members but ``items`` must be texts.
    Items dated before the document's ``current_date`` are refused, as are items whose date cannot
    be read. An item keeps its own ``corporate_id``, which may differ from its document's. Each
    document is parsed once; its items are taken from the parsed value.
    """
    parsed = documents.selectExpr(f"`{column}` AS entry", f"try_parse_json(`{column}`) AS doc")
    opened = parsed.selectExpr("entry", f"{_members('doc')} AS members")
    heads = opened.selectExpr(
        "entry",
        "map_filter(members, (name, value) -> name <> 'items') AS head",
        "schema_of_variant(members['items']) AS kind",
        "try_variant_get(members['items'], '$', 'array<variant>') AS items",
        *[f"try_variant_get(members['{name}'], '$', 'string') AS `{name}`" for name in FIELDS[1:]],
    )
    read = heads.select(
        "*", calendar_date(F.col("`current_date`")).alias("asked")
    ).selectExpr(
        "entry", "company", "asked",
        f"""CASE WHEN head IS NULL OR (items IS NULL AND kind <> 'VOID') THEN 'unreadable document'
            ELSE concat('document: ', coalesce(
              IF(items IS NULL, 'missing field', NULL), {_field_problem('head', FIELDS)},
              IF(asked IS NULL, 'unreadable current_date', NULL))) END AS problem""",
        "items",
    )
    # The outer form, since the plain one would have Spark test the array for emptiness ahead and
    # parse the document again for that.
    entries = read.selectExpr(
        "entry", "company", "asked", "problem",
        """explode_outer(IF(problem IS NULL, transform(items, item -> struct(item)),
             array(struct(CAST(NULL AS VARIANT) AS item)))) AS found""",
    ).where("found IS NOT NULL")
    opened_items = entries.selectExpr(
        "entry", "company", "asked", "problem", "found.item", f"{_members('found.item')} AS members"
    )
    return opened_items.selectExpr(
        "entry", "asked", "problem", "item", "members", "company",
        *[f"try_variant_get(members['{name}'], '$', 'string') AS `{name}`" for name in ITEM_FIELDS],
    ).withColumn("date", calendar_date(F.col("date"))).selectExpr(
        "corporate_id", "IF(problem IS NULL, company, NULL) AS company",
        "IF(problem IS NULL, asked, NULL) AS `current_date`", "date", "title", "url",
        "IF(problem IS NULL, coalesce(to_json(item), 'null'), entry) AS entry",
        f"""CASE WHEN problem IS NOT NULL THEN problem
            ELSE concat('item: ', coalesce(
              IF(members IS NULL, 'not an object', NULL), {_field_problem('members', ITEM_FIELDS)},
              IF(date IS NULL, 'unreadable date', NULL),
              IF(date < asked, 'older than requested', NULL))) END AS error""",
    )


def accepted(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("error").isNull()).select(*schemas.NEWS_ITEM.fieldNames())


def refused(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("error").isNotNull()).select("entry", "error")


def _age() -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in NEWER_BY])


def newest_per_url(items: DataFrame) -> DataFrame:
    """One row per corporate id and url: the one asked for last, then dated last."""
    return (
        items.groupBy(*ITEM_KEY)
        .agg(F.max(_age()).alias("_last"))
        .select(*ITEM_KEY, "_last.*")
        .select(*[f"`{name}`" for name in schemas.NEWS_ITEM.fieldNames()])
    )


def newer_items(items: DataFrame, table: DataFrame | None) -> DataFrame:
    """What an upsert of ``items`` should write, so that rows already stored only ever give way to
    newer ones and the order in which files arrive does not matter."""
    if table is None:
        return newest_per_url(items)
    rivals = table.join(items.select(*ITEM_KEY).distinct(), ITEM_KEY, "left_semi")
    return newest_per_url(items.unionByName(rivals))


def overtaking(items: DataFrame, table: DataFrame | None) -> DataFrame:
    """The newest of ``items`` per corporate id and url where the table holds none or an older one.
    What the table has already is left out, so a repeated merge has nothing to write."""
    newest = newest_per_url(items)
    if table is None:
        return newest
    rivals = newest_per_url(table.join(items.select(*ITEM_KEY).distinct(), ITEM_KEY, "left_semi"))
    beaten = rivals.select(*ITEM_KEY, _age().alias("_stored"))
    met = newest.join(beaten, ITEM_KEY, "left")
    return met.where(F.col("_stored").isNull() | (_age() > F.col("_stored"))).drop("_stored").select(newest.columns)


def top_items(items: DataFrame, most: int = settings.NEWS_ITEMS_PER_REQUEST) -> DataFrame:
    """The latest items of each request. Spark limits every group before it shuffles."""
    per_request = Window.partitionBy("corporate_id", F.col("`current_date`")).orderBy(
        F.desc("date"), "url"
    )
    ranked = items.withColumn("item_rank", F.row_number().over(per_request))
    return ranked.where(F.col("item_rank") <= most)
