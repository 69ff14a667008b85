from datetime import datetime

import pytest

from corpweave import schemas
from corpweave.operators import golden
from corpweave.operators.contract import check_contract
from corpweave.settings import MatchRule
from tests.conftest import rows

TS = datetime(2026, 1, 1)


def tech(spark, records):
    cells = [(i, "t", n.upper(), n, "ind", "N/A", 1.0, 0.125, TS, *rest) for i, n, *rest in records]
    return spark.createDataFrame(cells, _with_id(schemas.SILVER_TECH, records))


def registry(spark, records):
    cells = [
        (i, "r", n.upper(), n, "d.com", "N/A", "N/A", 2000.0, 1, 2, TS, *rest)
        for i, n, *rest in records
    ]
    return spark.createDataFrame(cells, _with_id(schemas.SILVER_COMPANIES, records))


def _with_id(schema, records):
    extra = len(records[0]) > 2
    return schemas.columns(
        *[(f.name, f.dataType) for f in schema], *([("corporate_id", schemas.TEXT)] if extra else [])
    )


def three(df):
    return rows(df.select("corporate_id", "tech_record_id", "reg_record_id"))


def check_left_join(spark):
    t = tech(spark, [("t1", "a", "t1"), ("t2", "a", "t1"), ("t3", "b", "t3"), ("t1", "a", "t1")])
    r = registry(spark, [("x1", "a", "t1"), ("x2", "a", "t1"), ("x2", "a", "t1"), ("x9", "z", "x9")])
    out = golden.golden_rows(t, r, TS)
    wanted = t.join(r.withColumnRenamed("record_id", "reg"), "corporate_id", "left")
    assert three(out) == rows(wanted.select("corporate_id", "record_id", "reg"))
    assert out.count() == 3 * 3 + 1
    assert check_contract(out, schemas.GOLDEN)
    alone = out.where("tech_record_id = 't3'").first().asDict()
    assert alone["tech_company"] == "B" and alone["processing_ts"] == TS
    assert all(v is None for c, v in alone.items() if c.startswith("reg_"))


def test_left_join(spark):
    check_left_join(spark)


def test_left_join_on_skew_path(spark, forced_skew):
    check_left_join(spark)


@pytest.mark.parametrize("forced", [False, True])
def test_by_name(spark, request, forced):
    if forced:
        request.getfixturevalue("forced_skew")
    t = tech(spark, [("05", "acme"), ("01", "acme"), ("09", "acme"), ("02", "other")])
    r = registry(spark, [("03", "acme"), ("07", "acme"), ("07", "acme"), ("00", "acme"), ("08", "zzz")])
    out = golden.golden_by_name(t, r, MatchRule(), TS)
    linked = [("01", a, b) for a in ("01", "05") for b in ("03", "07", "07")]
    assert three(out) == sorted([*linked, ("09", "09", None), ("02", "02", None)], key=repr)
    assert out.columns == schemas.GOLDEN.fieldNames()


def test_nothing_matches(spark):
    out = golden.golden_by_name(
        tech(spark, [("1", "a")]), registry(spark, [("2", "b")]), MatchRule(min_confidence=0.6), TS
    )
    assert three(out) == [("1", "1", None)]
