"""Entities: which records belong together, and the id that stands for them.

The corporate id is the least record id of a connected component. Two ways lead to it, with
equal results:

* ``corporate_ids`` takes any edges, for instance a stored match table with adjudicated pairs;
* ``link_by_name`` takes the two sources and never forms a record pair, so a name shared by a
  third of all records costs no more than its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.operators import lineage, matching
from corpweave.settings import MatchRule


def vertices(*sources: DataFrame) -> DataFrame:
    """All record ids of all sources, once each."""
    ids = [df.select(F.col("record_id").alias("id")) for df in sources]
    together = ids[0]
    for more in ids[1:]:
        together = together.unionByName(more)
    return together.distinct()


def edges(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("left_id").alias("src"), F.col("right_id").alias("dst"))


def components(links: DataFrame, merge: bool = False) -> DataFrame:
    """(id, component) of every node with a link, component being the least id reached.

    With ``merge`` no side of a round is broadcast, for ids whose stored files are small for their rows.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014). A link is kept as greater id -> lesser id. Every half round is
    stored and the one before it deleted, so no more than two are there at a time; the loop ends when a round changes nothing, after a number of rounds that grows with the
    logarithm of the longest path.
    """
    ordered = links.where(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    stars = lineage.cut(ordered.distinct())
    state = _fingerprint(stars)
    while True:
        for star in (_large_star, _small_star):
            # Stored, so that it joins as it is: adaptive execution splits the links of a hot node
            # only where no aggregate stands between the shuffle and the join.
            least = lineage.cut(stars.groupBy("src").agg(F.min("dst").alias("least")))
            moved = lineage.cut(star(stars.hint("merge") if merge else stars, least))
            lineage.discard(stars, least)
            stars = moved
        previous, state = state, _fingerprint(stars)
        if state == previous:
            roots = stars.select(F.col("dst").alias("id")).distinct()
            return stars.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
                roots.withColumn("component", F.col("id"))
            )


def numbered_components(links: DataFrame) -> DataFrame:
    """``components`` of long ids: these are numbered in their order, and the loop sends and stores the
    numbers only. ``links`` is read several times."""
    ids = links.where(F.col("src") != F.col("dst")).select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    # Partitions are in order, too, and the numbers of one are above those of all before it.
    ranged = ids.repartitionByRange("id").sortWithinPartitions("id")
    numbers = lineage.cut(ranged.withColumn("number", F.monotonically_increasing_id()))

    def known(number: str, name: str) -> DataFrame:
        return numbers.select(F.col("number").alias(number), F.col("id").alias(name))

    ends = links.hint("merge").join(known("from", "src"), "src").hint("merge").join(known("to", "dst"), "dst")
    found = components(ends.select(F.col("from").alias("src"), F.col("to").alias("dst")), merge=True)
    named = found.withColumnsRenamed({"id": "from", "component": "to"}).hint("merge").join(known("from", "id"), "from")
    return named.hint("merge").join(known("to", "component"), "to").select("id", "component")


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
    )


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """Point every node above a neighbour at that neighbour's own least neighbour."""
    moved = links.join(least.withColumnRenamed("src", "dst"), "dst", "left")
    return moved.select("src", F.coalesce("least", "dst").alias("dst"))


def _small_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """Point every node and all its lesser neighbours at the least of these."""
    joined = links.join(least, "src")
    ends = F.explode(F.array("src", "dst")).alias("src")
    return (
        joined.select(ends, F.col("least").alias("dst"))
        .where(F.col("src") != F.col("dst"))
        .distinct()
    )


def corporate_ids(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(record_id, corporate_id) for every node; one without links stands for itself."""
    found = components(links)
    return nodes.join(found, "id", "left").select(
        F.col("id").alias("record_id"), F.coalesce("component", "id").alias("corporate_id")
    )


def extended_ids(ids: DataFrame, links: DataFrame) -> DataFrame:
    """``ids`` (record_id, corporate_id) after ``links`` between its records, or new ones, are added.

    The result equals that of all links together, old and new. Every end of a new link counts as
    the entity it already belongs to, an unknown record as itself, and only these entities go
    through the component loop: its rounds and their size follow the new links, not the registry. The
    stored map is read twice, without being shuffled as long as the new links are few enough to be
    broadcast. Its corporate ids must be the least record ids of their entities, which also makes the
    least of them the id of a joined one.
    """
    links = lineage.cut(links.select("src", "dst").distinct())
    ends = lineage.cut(links.select(F.explode(F.array("src", "dst")).alias("record_id")).distinct())
    known = lineage.cut(ids.join(ends, "record_id", "left_semi"))
    fresh = lineage.cut(ends.join(known, "record_id", "left_anti").withColumn("corporate_id", F.col("record_id")))
    placed = known.unionByName(fresh)

    def entity(end: str, name: str) -> DataFrame:
        return placed.select(F.col("record_id").alias(end), F.col("corporate_id").alias(name))

    between = links.join(entity("src", "from"), "src").join(entity("dst", "to"), "dst")
    moved = lineage.cut(components(between.select(F.col("from").alias("src"), F.col("to").alias("dst")))
                        .withColumnsRenamed({"id": "corporate_id", "component": "joined"}))
    return ids.unionByName(fresh).join(moved, "corporate_id", "left").select(
        "record_id", F.coalesce("joined", "corporate_id").alias("corporate_id"))


def name_labels(left: DataFrame, right: DataFrame, rule: MatchRule) -> tuple[DataFrame, DataFrame]:
    """Per side, (name, component, bound) of the names that take part in a match.

    Without the id order every record of a matched name is linked to every record of its partner
    names, so linking the least ids is enough. With the id order an edge needs left id < right
    id. Take matched names a and b, with l0 the least id of a and r1 the greatest of b. Any edge
    between them implies l0 < r1; then l0 is linked to every right id above it and r1 to every
    left id below it. So the link (l0, r1) connects all there is to connect, a left record is in
    iff it is below the greatest r1 of its partners, and a right record iff it is above the least
    l0 of its partners: the ``bound``. Each linked right id has a lesser left neighbour, so the
    least id of the component is among the l0.

    A record id must stand for one name within its source, which holds for content-derived ids.
    """
    reach = rule.reach()
    left, right = matching.usable_names(left, rule), matching.usable_names(right, rule)
    left_names = matching.distinct_names(left)
    right_names = matching.distinct_names(matching.comparable(right, left, reach))
    if reach:  # read twice below, so do not aggregate the records twice
        left_names, right_names = lineage.cut(left_names), lineage.cut(right_names)
    right_end = "greatest_id" if rule.id_order else "least_id"
    lefts = left_names.selectExpr("name AS left_name", "least_id AS left_end")
    rights = right_names.selectExpr("name AS right_name", f"{right_end} AS right_end")
    if reach:
        found = matching.name_pairs(left_names, right_names, reach)
        pairs = found.join(lefts, "left_name").join(rights, "right_name")
    else:
        pairs = lefts.join(rights, F.col("left_name") == F.col("right_name"))
    if rule.id_order:
        pairs = pairs.where("left_end < right_end")
    if reach is None:
        pairs = pairs.where("false")
    pairs = lineage.cut(pairs.select("left_name", "right_name", "left_end", "right_end"))
    if reach:
        ends = pairs.selectExpr("left_end AS src", "right_end AS dst")
        found = numbered_components(ends).withColumnRenamed("id", "left_end")
        pairs = pairs.join(found, "left_end")
    else:
        pairs = pairs.selectExpr("*", "least(left_end, right_end) AS component")

    def labels(side: str, bound: str) -> DataFrame:
        grouped = pairs.groupBy(F.col(side).alias("name"))
        return grouped.agg(F.min("component").alias("component"), F.expr(f"{bound} AS bound"))

    return labels("left_name", "max(right_end)"), labels("right_name", "min(left_end)")


def link_by_name(left: DataFrame, right: DataFrame,
                 rule: MatchRule = MatchRule()) -> tuple[DataFrame, DataFrame]:
    """Both sources with ``corporate_id`` and ``linked`` (has at least one match) added."""
    left_labels, right_labels = name_labels(left, right, rule)

    def attach(df: DataFrame, labels: DataFrame, inside: str) -> DataFrame:
        labels = labels.withColumnRenamed("name", matching.NAME)
        joined = df.join(lineage.cut(labels), matching.NAME, "left")
        linked = f"coalesce({inside if rule.id_order else 'component IS NOT NULL'}, false)"
        return joined.selectExpr(
            *[f"`{c}`" for c in df.columns],
            f"IF({linked}, component, record_id) AS corporate_id",
            f"{linked} AS linked",
        )

    return (
        attach(left, left_labels, "record_id < bound"),
        attach(right, right_labels, "record_id > bound"),
    )
