"""Judging pages by rules and by trust that flows along links between hosts, in DataFrame operations.

Rules come first: the longest one that fits a url decides. Hosts of pages that rules allow are
trusted seeds, hosts of pages that rules block are distrusted ones, each by its number of such pages.
Trust flows along host edges by personalised PageRank from the trusted seeds, distrust against them
from the distrusted seeds. A host whose distrust reaches ``threshold`` of its trust and distrust
together is blocked for all pages without a rule; a host that neither reaches is allowed.

Rounds go on until no host's trust or distrust moves by more than ``TOLERANCE`` of itself, so far hosts
are reached however long the way is.

A page's host is all between ``://`` and the path, and rules fit that. In the graph a host is its name
without user and port, on both ends of a link. Edges are links between different
hosts in the pages' HTML, weighted by their number. A host is also tied to the domain directly above it, both ways, when pages of both are in the table.

A null url or one without ``://`` has an empty host and path, fits no rule and takes no part in the
graph; a null page has no links. Repeated pages count as often as they occur and give a row each;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.operators import lineage


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


DAMPING = 0.85
TOLERANCE = 1e-8
ROUNDS = 200  # after the last host is reached; 0.85 to this power is 8e-15, so it only guards the loop
ROUNDS_PER_CUT = 4
THRESHOLD = 0.5
TIE = 1e-6  # relative; above TOLERANCE
SITE_WEIGHT = 1.0

# Only A to Z are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NAME = r"^(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.when(url.contains("://"), F.substring_index(url, "://", 1))
    rest = F.coalesce(url.substr(F.length(found) + 4, F.length(url)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null without any."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.host + r.path).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def with_rule(pages: DataFrame, rules: Sequence[Rule], id_col: str, url_col: str, *more: str) -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    placed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                          F.regexp_extract(host, NAME, 1).alias("name"), *[F.col(c).alias("html") for c in more])
    rule, verdict = fitting_rule(rules, F.col("host"), F.col("path"))
    return placed.select("*", rule.alias("rule"), verdict.alias("ruled"))


def host_edges(pages: DataFrame, hosts: DataFrame, site_weight: float = SITE_WEIGHT) -> DataFrame:
    """(src, dst, weight) between different hosts: links, and a host with the domain above it."""
    linked = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = pages.select(F.col("name").alias("src"), linked.alias("dst"))
    name = F.regexp_extract(F.translate("dst", UPPER, LOWER), NAME, 1)
    links = links.select("src", name.alias("dst")).where("src <> dst AND src <> '' AND dst <> ''")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    above = hosts.select("host", F.expr("substring(host, locate('.', host) + 1)").alias("above"))
    ties = above.where("locate('.', above) > 0").join(
        hosts.select(F.col("host").alias("above")), "above", "left_semi")
    both = F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("above").alias("dst")),
                             F.struct(F.col("above").alias("src"), F.col("host").alias("dst"))))
    ties = ties.select(both.alias("e")).select("e.src", "e.dst", F.lit(float(site_weight)).alias("weight"))
    return links.unionByName(ties).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust): two personalised PageRanks, the second against the edges.

    ``seeds`` has (host, trust, distrust) as non-negative weights of any sum. Mass that reaches a
    host without a way on is lost; both ranks are compared host by host, so no more is needed.
    """
    total = seeds.agg(F.sum("trust"), F.sum("distrust")).first()
    start = [F.col("host")] + [
        (F.col(c) / F.lit(float(total[i] or 1) or 1.0)).alias(c) for i, c in enumerate(("trust", "distrust"))]
    seeds = seeds.select(*start)
    # Every edge once in each direction, with the share of its weight at the end it leaves from.
    ways = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("next"), "weight"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("next"), "weight"),
    )).alias("w")).select("w.*")
    out = ways.groupBy("kind", "host").agg(F.sum("weight").alias("out"))
    ways = lineage.cut(ways.join(out, ["kind", "host"]).selectExpr("kind", "host", "next", "weight / out AS share"))
    ranks = ("trust", "distrust")
    rank, quiet = seeds, 0
    while True:
        for number in range(1, ROUNDS_PER_CUT + 1):
            before = rank
            mass = F.when(F.col("kind") == "trust", F.col("trust")).otherwise(F.col("distrust"))
            moved = ways.join(rank, "host").where(mass > 0).select(
                F.col("next").alias("host"),
                *[F.when(F.col("kind") == c, F.col("share") * F.col(c) * damping).otherwise(0.0).alias(c) for c in ranks])
            own = seeds.selectExpr("host", f"trust * {1 - damping} AS trust", f"distrust * {1 - damping} AS distrust")
            both = own.unionByName(moved)
            if number == ROUNDS_PER_CUT:
                both = both.withColumns({f"was_{c}": F.lit(0.0) for c in ranks}).unionByName(before.select(
                    "host", *[F.lit(0.0).alias(c) for c in ranks], *[F.col(c).alias(f"was_{c}") for c in ranks]))
            rank = both.groupBy("host").agg(*[F.sum(c).alias(c) for c in both.columns[1:]])
        stored = lineage.cut(rank)
        rank = stored.select("host", *ranks)
        new = F.lit(False)
        still = F.lit(True)
        for c in ranks:
            new |= (F.col(c) > 0) & (F.col(f"was_{c}") == 0)
            still &= F.abs(F.col(c) - F.col(f"was_{c}")) <= TOLERANCE * F.col(c)
        reached, moving = stored.agg(F.count_if(new), F.count_if(~still)).first()
        quiet = 0 if reached else quiet + ROUNDS_PER_CUT
        if not moving or quiet >= rounds:
            return rank


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    placed = with_rule(pages, rules, id_col, url_col)
    hosts = lineage.cut(placed.where("name <> ''").groupBy(F.col("name").alias("host")).agg(
        F.count_if(F.col("ruled") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("ruled") == "block").cast("double").alias("distrust")))
    linking = with_rule(pages, rules, id_col, url_col, html_col)
    rank = propagate(hosts, host_edges(linking, hosts), rounds=rounds)
    judged = placed.join(rank.withColumnRenamed("host", "name"), "name", "left").select(
        "page_id", "host", "path", "rule", "ruled",
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    # Sums arrive in any order; a tie must not depend on their last digits.
    least = threshold * (1 - TIE) * (F.col("trust") + F.col("distrust"))
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= least)
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                         "trust", "distrust")
