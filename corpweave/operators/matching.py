"""Blocked edit-distance join between two record sources.

Records are compared by normalised name, and only when the first characters (the block) agree.
The work is done on distinct names, never on records, and never on all pairs of a block:

* reach 0 is an equi-join on the name;
* reach 1 joins on the text around the one differing character, which only true pairs share, so
  even a block holding every name costs no more than its names and its result;
* a larger reach cuts each left name into ``reach + 1`` pieces, one of which must occur intact
  in the right name, and joins on the pieces. Names with a piece that is too common meet in a
  prefix tree instead, which loses nothing: both names of such a pair hold that piece.

Keys are 64-bit hashes; a collision only adds a candidate, which the exact check removes.

Joins of records, and of keys made from names, are hinted to be merged: Spark estimates these sides by
the size of compressed files and does not count what a name explodes to, so it would broadcast a
side, through the driver, that is many times its limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.functions import text
from corpweave.operators import lineage, prefix_tree
from corpweave.settings import BLOCK_LENGTH, AmbiguityBand, MatchRule

NAME = "company_name_normalised"

# A piece shared by more than this many (left, right) name pairs is left to the prefix tree.
CROWDED_PAIRS = 10_000

# Up to this many names or blocks of one side are broadcast to prune the other.
FEW = 100_000

# What follows the block. Names of one block differ only here.
TAIL = f"substring(name, {BLOCK_LENGTH + 1})"


def _key(*cells: str) -> str:
    return f"xxhash64({', '.join([text.name_block('name'), *cells])}) AS key"


def usable_names(df: DataFrame, rule: MatchRule) -> DataFrame:
    return df.where(F.col(NAME) != "") if rule.drop_empty else df


def distinct_names(df: DataFrame) -> DataFrame:
    """One row per name with the number of its records and their least and greatest id."""
    return df.groupBy(F.col(NAME).alias("name")).agg(
        F.expr("count(1) AS records"),
        F.expr("min(record_id) AS least_id"),
        F.expr("max(record_id) AS greatest_id"),
    )


def comparable(df: DataFrame, other: DataFrame, reach: int | None) -> DataFrame:
    """The records of ``df`` that can have a partner in ``other`` at all, when that is cheap to
    tell: if the names (or, with a reach, the blocks) of ``other`` are counted to be at most ``FEW``."""
    test = NAME if not reach else text.name_block(NAME)
    present = lineage.cut(other.selectExpr(f"{test} AS _present").distinct().limit(FEW + 1))
    if present.count() > FEW:
        return df
    return df.join(F.broadcast(present), F.expr(test) == F.col("_present"), "left_semi")


def _placed(pieces: DataFrame, length: str, reach: int) -> DataFrame:
    """Adds ``width`` and ``start`` of each ``piece`` when a text of ``length`` is cut into
    ``reach + 1`` pieces, the shorter ones first."""
    count = reach + 1
    longer = f"greatest(0, piece - {count} + {length} % {count})"
    width = f"({length} div {count} + IF(piece >= {count} - {length} % {count}, 1, 0))"
    return pieces.selectExpr(
        "*", f"int({width}) AS width", f"int(piece * ({length} div {count}) + {longer}) AS start"
    )


def _left_pieces(names: DataFrame, reach: int) -> DataFrame:
    """Every left tail cut into ``reach + 1`` pieces."""
    pieces = names.selectExpr("name", f"{TAIL} AS tail").selectExpr(
        "*", f"explode(sequence(0, {reach})) AS piece"
    )
    return _placed(pieces, "length(tail)", reach).selectExpr(
        "name",
        "width = 0 AS empty",
        _key("length(tail)", "piece", "substring(tail, start + 1, width)"),
    )


def _right_pieces(names: DataFrame, reach: int) -> DataFrame:
    """Every part of a right tail that can equal a piece of a left tail within reach.

    For a left tail ``extra`` characters shorter, a piece can only have moved as far as the
    edits before it and after it together allow.
    """
    lengths = (
        names.selectExpr("name", f"{TAIL} AS tail")
        .selectExpr("*", f"explode(sequence({-reach}, {reach})) AS extra")
        .selectExpr("*", "length(tail) - extra AS left_length")
        .where("left_length >= 0")
        .selectExpr("*", f"explode(sequence(0, {reach})) AS piece")
    )
    moves = _placed(lengths, "left_length", reach).selectExpr(
        "*",
        f"int(greatest(0, start - floor(({reach} - extra) / 2))) AS first",
        f"int(least(length(tail) - width, start + floor(({reach} + extra) / 2))) AS last",
    )
    return (
        moves.where("first <= last")
        .selectExpr("*", "explode(sequence(first, last)) AS at")
        .selectExpr(
            "name",
            "width = 0 AS empty",
            _key("left_length", "piece", "substring(tail, at + 1, width)"),
        )
    )


KINDS = ("E", "S", "R", "L")


def _one_edit_keys(names: DataFrame, whole: str, shorter: str, side: str) -> DataFrame:
    """One key per way a name can take part in a pair at distance 0 or 1.

    ``at`` 0 stands for the whole tail, any other for the tail without the character at that place.
    Kind E (equal) pairs whole tails; S (substitution) pairs tails lacking the same place; a whole
    tail also meets, under kind ``whole``, the other side's longer tails less one character, and
    under kind ``shorter`` this side's tails less one character meet the other side's whole ones.
    Of a run of equal characters only the first is left out there, so a pair meets just once.

    There are many keys to a name, so a key comes with the name's hash only, and with its place, the
    character there and its kind in one number, from the highest bits to the lowest.
    """
    spots = names.selectExpr(f"xxhash64(name) AS {side}_hash", "name", f"{TAIL} AS tail").selectExpr(
        "*", "explode(sequence(0, length(tail))) AS at"
    )
    kinds = spots.selectExpr(
        "*",
        "IF(at = 0, tail, concat(left(tail, at - 1), substring(tail, at + 1))) AS rest",
        "IF(at = 0, 0, ascii(substring(tail, at, 1))) AS letter",
        f"""explode(CASE WHEN at = 0 THEN array('E', '{whole}')
              WHEN at > 1 AND substring(tail, at, 1) = substring(tail, at - 1, 1) THEN array('S')
              ELSE array('S', '{shorter}') END) AS kind""",
    )
    number = " ".join(f"WHEN '{kind}' THEN {i}L" for i, kind in enumerate(KINDS))
    return kinds.selectExpr(
        f"{side}_hash",
        f"shiftleft(bigint(at), 24) + letter * 4L + CASE kind {number} END AS {side}_spot",
        _key("kind", "IF(kind = 'S', at, 0)", "rest"),
    )


def _one_edit_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    lefts = _one_edit_keys(left, "R", "L", "left")
    rights = _one_edit_keys(right, "L", "R", "right")

    def named(names: DataFrame, side: str) -> DataFrame:
        return names.selectExpr(f"xxhash64(name) AS {side}_hash", f"name AS {side}_name")

    def rest(side: str) -> str:
        name, at = f"{side}_name", f"int({BLOCK_LENGTH} + shiftright({side}_spot, 24))"
        whole = f"shiftright({side}_spot, 24) = 0"
        return f"IF({whole}, {name}, concat(left({name}, {at} - 1), substring({name}, {at} + 1)))"

    # Of kind S the same place with another character there.
    met = lefts.hint("merge").join(rights, "key").where(
        f"(left_spot & 3) = (right_spot & 3) AND ((left_spot & 3) <> {KINDS.index('S')} OR "
        "shiftright(left_spot, 24) = shiftright(right_spot, 24) AND left_spot <> right_spot)"
    ).drop("key")
    met = met.hint("merge").join(named(left, "left"), "left_hash")
    met = met.hint("merge").join(named(right, "right"), "right_hash")
    return met.where(f"{rest('left')} = {rest('right')}").selectExpr(
        "left_name", "right_name", "IF((left_spot & 3) = 0, 0, 1) AS name_distance"
    )


def _few_keys(keys: DataFrame, names: DataFrame) -> DataFrame | None:
    """The distinct keys, which are made of ``names``, if these are counted to be at most ``FEW``."""
    if names.count() > FEW:
        return None
    few = lineage.cut(keys.select("key").distinct().limit(FEW + 1))
    return few if few.count() <= FEW else None


def _among(keys: DataFrame, few: DataFrame | None) -> DataFrame:
    return keys if few is None else keys.join(F.broadcast(few), "key", "left_semi")


def _meet(left_keys: DataFrame, right_keys: DataFrame) -> DataFrame:
    """Names that share a key, but for two names of the tree."""
    left = left_keys.selectExpr("key", "name AS left_name", "in_tree AS left_in_tree")
    right = right_keys.selectExpr("key", "name AS right_name", "in_tree AS right_in_tree")
    met = left.hint("merge").join(right, "key").where("NOT (left_in_tree AND right_in_tree)")
    return met.select("left_name", "right_name")


def _piecewise(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    left, right = lineage.cut(left), lineage.cut(right)  # each is read several times
    left_keys = _left_pieces(left, reach)
    few = _few_keys(left_keys, left)
    right_keys = _among(_right_pieces(right, reach), few)
    load = (
        left_keys.groupBy("key").agg(F.expr("count(1) AS lefts"), F.expr("max(empty) AS empty"))
        .join(right_keys.groupBy("key").agg(F.expr("count(1) AS rights")), "key")
    )
    crowded = lineage.cut(load.where(f"empty OR lefts * rights > {CROWDED_PAIRS}").select("key"))

    def crowded_names(keys: DataFrame) -> DataFrame:
        return lineage.cut(keys.join(crowded, "key", "left_semi").select("name").distinct())

    # Names with a crowded piece meet one another in the tree, once each, and here only the rest. All keys
    # of a name of the rest are usual; of the tree's names only keys that the other side's rest has are made to meet.
    lefts, rights = crowded_names(left_keys), crowded_names(right_keys)
    left_rest, right_rest = (
        lineage.cut(names.hint("merge").join(some, "name", "left_anti")) for names, some in ((left, lefts), (right, rights))
    )
    left_rest_keys = _left_pieces(left_rest, reach)
    right_rest_keys = _among(_right_pieces(right_rest, reach), few)
    left_tree_keys = _among(_left_pieces(lefts, reach), _few_keys(right_rest_keys, right_rest))
    right_tree_keys = _among(_right_pieces(rights, reach), _few_keys(left_rest_keys, left_rest))

    def usual_keys(tree: DataFrame, rest: DataFrame) -> DataFrame:
        both = tree.withColumn("in_tree", F.lit(True)).unionByName(rest.withColumn("in_tree", F.lit(False)))
        return both.join(crowded, "key", "left_anti")

    usual = (
        _meet(usual_keys(left_tree_keys, left_rest_keys), usual_keys(right_tree_keys, right_rest_keys))
        .where(f"{text.name_block('left_name')} = {text.name_block('right_name')}")
        .selectExpr(
            "left_name", "right_name",
            f"levenshtein(left_name, right_name, {reach}) AS name_distance",
        )
        .where("name_distance >= 0")
        .distinct()
    )
    rest = prefix_tree.pairs(lefts, rights, reach)
    return usual.select(rest.columns).unionByName(rest)


def name_pairs(left: DataFrame, right: DataFrame, reach: int | None) -> DataFrame:
    """All (left_name, right_name, name_distance) within ``reach`` edits and of one block.

    Both inputs hold distinct values in their column ``name``.
    """
    left, right = left.select("name"), right.select("name")
    if reach is None:
        return _exact(left, right).where(F.lit(False))
    if reach == 0:
        return _exact(left, right)
    if reach == 1:
        return _one_edit_pairs(left, right)
    return _piecewise(left, right, reach)


def _exact(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, "name").selectExpr(
        "name AS left_name", "name AS right_name", "0 AS name_distance"
    )


def record_pairs(left: DataFrame, right: DataFrame, rule: MatchRule,
                 reach: int | None, carried: tuple[str, ...] = ()) -> DataFrame:
    """All record pairs whose names are within ``reach`` edits, with both sides' columns.

    Columns come out as ``left_*`` and ``right_*``, plus ``name_distance``.
    """
    kept = ["record_id", "source_system", *carried]
    left, right = usable_names(left, rule), usable_names(right, rule)
    right = comparable(right, left, reach)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.selectExpr(f"{NAME} AS {prefix}_name", *[f"{c} AS {prefix}_{c}" for c in kept])

    lefts, rights = side(left, "left"), side(right, "right")
    if not reach:
        lefts = lefts.withColumnRenamed("left_name", "name")
        rights = rights.withColumnRenamed("right_name", "name")
        pairs = lefts.hint("merge").join(rights, "name").drop("name")
        pairs = pairs.withColumn("name_distance", F.lit(0))
        if reach is None:
            pairs = pairs.where("false")
    else:
        found = name_pairs(
            left.selectExpr(f"{NAME} AS name").distinct(),
            right.selectExpr(f"{NAME} AS name").distinct(),
            reach,
        )
        pairs = found.hint("merge").join(lefts, "left_name").hint("merge").join(rights, "right_name")
        pairs = pairs.drop("left_name", "right_name")
    return pairs.where("left_record_id < right_record_id") if rule.id_order else pairs


def match_records(left: DataFrame, right: DataFrame, rule: MatchRule = MatchRule()) -> DataFrame:
    """The match table: every accepted record pair of the two sources."""
    pairs = record_pairs(left, right, rule, rule.reach())
    return pairs.selectExpr(
        "left_source_system",
        "right_source_system",
        "left_record_id AS left_id",
        "right_record_id AS right_id",
        "name_distance",
        f"{text.confidence('name_distance', rule.threshold)} AS match_confidence",
        "'fuzzy' AS match_type",
    )


def ambiguous_pairs(left: DataFrame, right: DataFrame, rule: MatchRule = MatchRule(),
                    band: AmbiguityBand = AmbiguityBand(),
                    carried: tuple[str, ...] = ("company",)) -> DataFrame:
    """Record pairs whose confidence falls into the band that goes to adjudication."""
    score = F.expr(text.confidence("name_distance", rule.threshold))
    pairs = record_pairs(left, right, rule, rule.reach(band.low), carried)
    return (
        pairs.withColumn("match_confidence", score)
        .where(F.col("match_confidence") < band.high)
        .withColumnsRenamed({"left_record_id": "left_id", "right_record_id": "right_id"})
    )


def block_load(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per block: records and distinct names of each side and the comparisons a plain blocked
    join would make. Computed from counts, without forming a pair."""

    def profile(df: DataFrame, side: str) -> DataFrame:
        blocks = distinct_names(df).groupBy(F.expr(text.name_block("name")).alias("blocking_key"))
        return blocks.agg(
            F.expr(f"sum(records) AS {side}_records"), F.expr(f"count(1) AS {side}_names")
        )

    both = profile(left, "left").join(profile(right, "right"), "blocking_key", "full")
    counts = [c for c in both.columns if c != "blocking_key"]
    product = "cast(left_records AS DECIMAL(19, 0)) * cast(right_records AS DECIMAL(19, 0))"
    return both.fillna(0, counts).selectExpr("*", f"string({product}) AS record_comparisons")
