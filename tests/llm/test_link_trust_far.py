"""Trust on long ways, and hosts with ports and user names."""

import pytest

from corpweave.llm import link_trust

RULES = [link_trust.Rule("allow", "good.com", "/"), link_trust.Rule("block", "bad.net", "/")]


def judged(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r["page_id"]: r for r in link_trust.judge(pages, RULES).collect()}


def test_a_long_chain_is_followed_to_its_end(spark):
    """Host k links to host k + 1, the last one to a blocked host; distrust flows back along the chain."""
    rows = [(k, f"http://h{k}.org/", f"<a href='http://h{k + 1}.org/'>x</a>") for k in range(30)]
    rows += [(30, "http://h30.org/", "<a href='http://bad.net/'>x</a>"), (31, "http://bad.net/", "")]
    found = judged(spark, rows)
    for k in range(31):
        assert found[k]["distrust"] == pytest.approx(0.15 * 0.85 ** (31 - k), rel=1e-6) and found[k]["verdict"] == "block"


def test_ports_and_users_are_part_of_a_host_but_not_of_its_place_in_the_graph(spark):
    rows = [(1, "http://me:pw@bad.net:8080/", ""), (2, "http://fan.org:81/", "<a href='http://you@bad.net:8080/x'>x</a>"),
            (3, "http://[::1]:8/x", ""), (4, "http://bad.net/y", ""), (5, "http://Foo.GOOD.com:8080/en/x?q", "")]
    found = judged(spark, rows)
    assert [found[i]["host"] for i in (1, 2, 3, 4, 5)] == [
        "me:pw@bad.net:8080", "fan.org:81", "[::1]:8", "bad.net", "foo.good.com:8080"]
    assert [found[i]["rule"] for i in (1, 2, 3, 4, 5)] == [None, None, None, "bad.net/", None]
    assert found[5]["path"] == "/en/x" and found[5]["verdict"] == "allow"
    # Page 1 has no rule of its own but the distrust of its name.
    assert found[1]["verdict"] == "block" and found[2]["distrust"] > 0 and found[2]["verdict"] == "block"


def test_ties_are_blocked(spark):
    rows = [(1, "http://good.com/", "".join(f"<a href='http://m{k}.org/'>x</a>" for k in range(7))), (2, "http://bad.net/", "")]
    rows += [(10 + k, f"http://m{k}.org/", "<a href='http://bad.net/'>x</a>" if k else "") for k in range(7)]
    found = judged(spark, rows)
    even = [(10, "http://a.org/", "<a href='http://bad.net/'>x</a>"), (1, "http://good.com/", "<a href='http://a.org/'>x</a>"),
            (2, "http://bad.net/", "")]
    assert {found[10 + k]["verdict"] for k in range(1, 7)} == {"block"} and found[10]["verdict"] == "allow"
    tied = judged(spark, even)[10]
    assert tied["trust"] == pytest.approx(tied["distrust"]) and tied["verdict"] == "block"
