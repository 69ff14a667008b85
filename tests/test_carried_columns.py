"""Columns that are carried along with record pairs."""

from corpweave.operators import matching
from corpweave.settings import MatchRule
from tests.test_golden import registry, tech


def test_name_can_be_carried(spark):
    t, r = tech(spark, [("05", "acme")]), registry(spark, [("07", "acmf")])
    pairs = matching.ambiguous_pairs(t, r, MatchRule(), carried=(matching.NAME,))
    found = pairs.select("left_company_name_normalised", "right_company_name_normalised").collect()
    assert [tuple(x) for x in found] == [("acme", "acmf")]
