import pytest
from pyspark.sql import functions as F

from corpweave.functions import dates, text
from corpweave.operators import standardize

NAMES = [
    ("Apple", "apple"), ("Apple, Inc.", "apple"), ("Microsoft Corporation", "microsoft"),
    ("Google LLC", "google"), ("Amazon Ltd", "amazon"), ("netflix", "netflix"), ("", ""),
    ("Inc", ""), (None, ""), ("BizLink Holding, Inc.", "bizlink"),
    ("Société Générale S.A.", "société générale s a"), ("inc_a co-op", "inc_a op"),
    ("coupa software incorporated", "coupa software"), ("vertex group", "vertex"),
    ("life360, inc.", "life360"), ("Company Co Group", ""), ("  many   spaces\tand tabs ", "many spaces and tabs"),
    ("株式会社 ソニー", "株式会社 ソニー"), ("corporate co2", "corporate co2"),
]


def evaluate(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").selectExpr(expression).first()[0]


def test_company_key(spark):
    df = spark.createDataFrame(NAMES, "name string, wanted string")
    got = df.selectExpr("wanted", f"{text.company_key('name')} AS got").collect()
    assert [r.got for r in got] == [r.wanted for r in got]


@pytest.mark.parametrize("company, country, industry, wanted", [
    ("sansan, inc.", "japan", "software—application",
     "bd83dd8e967f5882a878133cf6e064e58c8c43be6e201c3aa32b2c54a94ec428"),
    ("Coupa Software Incorporated ", "united states", "software—application",
     "0f49f63b983c7b61b544566cd823eba18acf8a2f9eba15fd90684b4263e93562"),
    ("bizlink holding, inc.", "taiwan", "computer hardware",
     "47987a262e36184c15e320fede5955d0a0755b63e581bd650bdbde3aa67fc675"),
    ("vertex, inc.", "united states", "software—application",
     "11e89cffa591e4886b3e3efd45d35ada6ccf485c9a34d516ebede4fa2dc9d606"),
])
def test_record_id(spark, company, country, industry, wanted):
    df = spark.createDataFrame([(company, country, industry)], "a string, b string, c string")
    assert df.selectExpr(text.record_id("tech_companies", "a", "b", "c")).first()[0] == wanted


def test_record_id_keeps_separators_of_missing_parts(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    ids = df.selectExpr(text.record_id("s", "a", "b"), "sha2('s||||x', 256)").first()
    assert ids[0] == ids[1]


@pytest.mark.parametrize("value, plain, strict", [
    ("3t", 3e12, 3e12), ("1.31b", 1.31e9, 1.31e9), ("$2,000m", 2e9, 2e9), ("1500", 1500.0, 1500.0),
    ("1.31e9", 1.319, None), ("n/a", None, None), ("", None, None), ("1.2.3", None, None),
    (None, None, None), ("2T", 2.0, None),
])
def test_amount(spark, value, plain, strict):
    assert evaluate(spark, value, text.amount_usd("v")) == plain
    assert evaluate(spark, value, text.amount_usd("v", strict=True)) == strict


@pytest.mark.parametrize("value, wanted", [
    ("internet", "software—infrastructure"), ("construction", "N/A"), (None, "N/A"),
])
def test_industry(spark, value, wanted):
    assert evaluate(spark, value, text.translated("v")) == wanted


@pytest.mark.parametrize("value, wanted", [("japan", "japan"), ("brazil", "N/A"), (None, "N/A")])
def test_country(spark, value, wanted):
    assert evaluate(spark, value, text.known_or_na("v")) == wanted


@pytest.mark.parametrize("value, wanted", [("abcd", "abc"), ("ab", "ab"), ("", ""), ("éüß1", "éüß")])
def test_block(spark, value, wanted):
    assert evaluate(spark, value, text.name_block("v")) == wanted


def test_tidy_strings_only(spark):
    df = spark.createDataFrame([("  A\t ", 7, None)], "a string, `b c` int, d string")
    assert tuple(standardize.tidy_strings(df).first()) == ("a\t", 7, None)


def test_quoting(spark):
    assert evaluate(spark, "it's", text.translated("v", {"it's": "o'k \\ "})) == "o'k \\ "


@pytest.mark.parametrize("value, wanted", [
    ("2026-01-05", "2026-01-05"), ("2026-1-5", "2026-01-05"), ("2026-02-30", None), ("", None),
    ("0000-01-01", None), ("26-1-5", None), ("2026-01-05x", None), (None, None),
])
def test_calendar_date(spark, value, wanted):
    df = spark.createDataFrame([(value,)], "v string")
    got = df.select(dates.calendar_date(F.col("v")).cast("string")).first()[0]
    assert got == wanted
