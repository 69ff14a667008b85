"""Near-duplicate vectors by product quantisation over coarse inverted lists, confirmed exactly.

Vectors are scaled to length one; a cosine of at least c then is a distance of at most
r = sqrt(2 - 2c). Coarse centres and codes of the residuals' subspaces are learned on a bounded
sample. Every vector is stored in the list of its nearest centre and asks every list that may hold a
neighbour. A list whose dividing plane towards the own list is further away than r cannot. A step of
length r in any direction goes r / sqrt(dimensions) towards a plane on average (root mean square), so lists
whose plane is further away than ``SPREAD`` times that are not asked either: with the default of 4 a
link in a random direction is lost in one of 30,000 cases a plane, up to 16 dimensions none is, and
``spread=None`` asks all lists within r, so that none is lost in any dimension. In a list
the asking residual's table of distances to all codewords gives the asymmetric distance to each
stored code; a stored vector is at most its quantisation error away from its code, so a pair is
dropped only when the distance exceeds r by more than that. What remains is confirmed by the exact
cosine in double precision. No other step loses a pair, whatever the quality of the sample.

Equal vectors are one class from the start, so common ones are stored and asked once. Lists are
compared in blocks of bounded size. A block returns counts of links and a spanning set of links per
vector, never all pairs.

Vectors that are null, zero or hold null or non-finite components link with nothing, as do vectors of
different dimension. Rows with equal ids are vectors of their own that share an id. A null id links
like any other but does not name a component unless nothing else is in it. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back
from corpweave.operators import lineage
from corpweave.operators.components import components

COSINE = 0.95
#: Bound of the training sample.
SAMPLE_ROWS = 8000
MOST_LISTS = 256
SUBSPACES = 8
CODEWORDS = 64
ROUNDS = 8
BLOCK = 2000
#: How many times its root mean square a step across a plane may be.
SPREAD = 4.0
SLACK = 1e-6


class Quantiser(NamedTuple):
    centres: np.ndarray
    bounds: list[tuple[int, int]]  # columns of every subspace
    words: list[np.ndarray]


def usable(vector: Column | str) -> Column:
    """struct<dim, mark, unit>: the vector at length one as bytes and a fingerprint; null otherwise."""

    @F.arrow_udf("struct<dim:int,mark:binary,unit:binary>")
    @giving_back
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([one(x) for x in column.to_pylist()], pa.struct(
                [("dim", pa.int32()), ("mark", pa.binary()), ("unit", pa.binary())]))

    def one(values: list | None) -> dict:
        found = {"dim": None, "mark": None, "unit": None}
        if values and None not in values:
            vector = np.array(values, np.float64)
            most = np.abs(vector).max()
            if np.isfinite(vector).all() and most > 0:
                unit = vector / most
                unit = unit / np.sqrt(unit @ unit) + 0.0
                data = unit.tobytes()
                found = {"dim": len(vector), "mark": hashlib.blake2b(data, digest_size=16).digest(), "unit": data}
        return found

    return find(vector)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (-2 * points @ centres.T + (centres * centres).sum(1)).argmin(1)


def means(points: np.ndarray, count: int, draw: np.random.Generator) -> np.ndarray:
    """k-means; a centre that loses its points moves to a random one."""
    centres = points[np.sort(draw.choice(len(points), min(count, len(points)), replace=False))].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)
        sizes = np.bincount(own, minlength=len(centres))
        for d in range(points.shape[1]):
            centres[:, d] = np.bincount(own, points[:, d], len(centres)) / np.maximum(sizes, 1)
        centres[sizes == 0] = points[draw.integers(0, len(points), int((sizes == 0).sum()))]
    return centres


def learned(sample: np.ndarray, lists: int) -> Quantiser:
    draw = np.random.default_rng(9)
    centres = means(sample, lists, draw)
    rest = sample - centres[nearest(sample, centres)]
    edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
    bounds = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    return Quantiser(centres, bounds, [means(rest[:, a:b], CODEWORDS, draw) for a, b in bounds])


def codes(rest: np.ndarray, q: Quantiser) -> tuple[np.ndarray, np.ndarray]:
    """(codeword of every subspace, distance to what the codes stand for)."""
    found = np.empty((len(rest), len(q.bounds)), np.uint8)
    error = np.zeros(len(rest))
    for k, (a, b) in enumerate(q.bounds):
        found[:, k] = nearest(rest[:, a:b], q.words[k])
        error += ((rest[:, a:b] - q.words[k][found[:, k]]) ** 2).sum(1)
    return found, np.sqrt(error)


def across(radius: float, dim: int, spread: float | None) -> float:
    """How far behind a dividing plane neighbours are looked for."""
    return radius if spread is None else radius * min(1.0, spread / dim**0.5)


def asked_lists(points: np.ndarray, own: np.ndarray, q: Quantiser, reach: float) -> list[np.ndarray]:
    """Lists that may hold a neighbour: those whose dividing plane is within ``reach``."""
    squares = -2 * points @ q.centres.T + (q.centres * q.centres).sum(1)
    gap = squares - squares[np.arange(len(points)), own][:, None]
    between = np.sqrt(np.maximum(
        (q.centres**2).sum(1)[own][:, None] + (q.centres**2).sum(1) - 2 * q.centres[own] @ q.centres.T, 0))
    near = gap <= 2 * between * (reach + SLACK) + SLACK
    near[np.arange(len(points)), own] = True
    return [np.flatnonzero(row) for row in near]


def dealt(vectors: DataFrame, q: Quantiser, reach: float, blocks: int) -> DataFrame:
    """Stored and asking copies of the vectors by list and block of the list."""

    @giving_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.frombuffer(b"".join(batch.column("unit").to_pylist())).reshape(batch.num_rows, -1)
            own = nearest(points, q.centres)
            rest = points - q.centres[own]
            words, error = codes(rest, q)
            lists = asked_lists(points, own, q, reach)
            count = np.array([len(x) for x in lists])
            ask = np.repeat(np.arange(len(points)), count)
            rows = np.concatenate([np.arange(len(points)), ask])
            asking = np.arange(len(rows)) >= len(points)
            columns = {c: batch.column(c).take(pa.array(rows)) for c in ("rep", "n", "unit")}
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(np.concatenate([own, *lists]), pa.int32()), pa.array(asking),
                 pa.array([words[i].tobytes() for i in rows.tolist()], pa.binary()), pa.array(error[rows])],
                ["rep", "n", "unit", "list", "asks", "code", "error"])

    kind = "rep bigint, n bigint, unit binary, list int, asks boolean, code binary, error double"
    copies = vectors.select("rep", "n", "unit").mapInArrow(deal, kind)
    block = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    # A stored vector is in one block of its list, an asking one in all blocks but only once per
    # group of askers, so both sides of a group are bounded.
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    return copies.withColumn("block", F.when(~F.col("asks"), block)).withColumn(
        "other", F.when(F.col("asks"), block)).withColumn(
        "block", F.explode(F.when(F.col("asks"), every).otherwise(F.array("block")))).withColumn(
        "other", F.explode(F.when(~F.col("asks"), every).otherwise(F.array("other"))))


def in_lists(copies: DataFrame, q: Quantiser, cosine: float) -> DataFrame:
    """(rep, n, other): links a vector has in a block, and a vector it is connected to."""
    radius = float(np.sqrt(2 - 2 * cosine))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        stored, asking = rows[~rows["asks"]], rows[rows["asks"]]
        nothing = pd.DataFrame({"rep": [], "n": [], "other": []}).astype("int64")
        if not len(stored) or not len(asking):
            return nothing
        points, queries = (np.frombuffer(b"".join(x["unit"])).reshape(len(x), -1) for x in (stored, asking))
        code = np.frombuffer(b"".join(stored["code"]), np.uint8).reshape(len(stored), -1)
        limit = (radius + stored["error"].to_numpy() + SLACK) ** 2
        ids, names, weight = stored["rep"].to_numpy(), asking["rep"].to_numpy(), stored["n"].to_numpy()
        rest = queries - q.centres[key[0]]
        table = [((rest[:, a:b] ** 2).sum(1)[:, None] - 2 * rest[:, a:b] @ w.T + (w * w).sum(1)).astype(np.float32)
                 for (a, b), w in zip(q.bounds, q.words)]
        left, right, links = [], [], np.zeros(len(asking), np.int64)
        for i in range(len(asking)):
            far = table[0][i][code[:, 0]]
            for k in range(1, len(table)):
                far = far + table[k][i][code[:, k]]
            near = np.flatnonzero(far <= limit + 1e-5)
            near = near[points[near] @ queries[i] >= cosine]
            near = near[ids[near] != names[i]]
            if len(near):
                links[i] = weight[near].sum()
                left.append(np.full(len(near), i))
                right.append(near)
        if not left:
            return nothing
        a, b = np.concatenate(left), np.concatenate(right)
        # Least label that reaches every vector over the links of this block.
        label = np.concatenate([names, ids])
        b = b + len(names)
        same = {}
        for place, name in enumerate(label.tolist()):
            same.setdefault(name, []).append(place)
        twins = np.array([(p[0], x) for p in same.values() for x in p[1:]], np.int64).reshape(-1, 2)
        a, b = np.concatenate([a, twins[:, 0]]), np.concatenate([b, twins[:, 1]])
        while True:
            old = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if (label == old).all():
                break
        found = pd.DataFrame({"rep": np.concatenate([names, ids]),
                              "n": np.concatenate([links, np.zeros(len(ids), np.int64)]), "other": label})
        return found[(found["n"] > 0) | (found["rep"] != found["other"])]

    grouped = copies.groupBy("list", "block", "other")
    return grouped.applyInPandas(compare, "rep bigint, n bigint, other bigint")


def linked(embeddings: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
           vector_col: str = "embedding", spread: float | None = SPREAD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = lineage.cut(embeddings.select(F.col(id_col).alias("vec_id"), usable(vector_col).alias("u")).select("vec_id", "u.*"))
    good = rows.where("dim IS NOT NULL")
    classes = lineage.cut(good.groupBy("mark").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("unit").alias("unit")))
    # Classes are numbered by what is stored, so that equal ids with different vectors stay apart.
    classes = lineage.cut(classes.withColumn("rep", F.monotonically_increasing_id()))
    found = None
    for dim, count in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().collect()):
        own = classes.where(F.col("dim") == dim)
        picked = own.orderBy(F.xxhash64("mark"), "mark").limit(SAMPLE_ROWS).collect()
        sample = np.array([np.frombuffer(r["unit"]) for r in picked])
        q = learned(sample, max(1, min(MOST_LISTS, int(count**0.5 / 2))))
        # The largest list decides on the blocks; its size is counted, not guessed.
        blocks = -(-largest_list(own, q) // BLOCK)
        reach = across(float(np.sqrt(2 - 2 * cosine)), dim, spread)
        part = in_lists(dealt(own, q, reach, blocks), q, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        joined = good.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    else:
        found = lineage.cut(found)
        links = found.groupBy("rep").agg(F.sum("n").alias("links"))
        reached = components(found.where("rep <> other").selectExpr("rep AS src", "other AS dst"))
        each = classes.select("mark", "rep", "n", "least").join(links, "rep", "left").join(
            reached.withColumnRenamed("id", "rep"), "rep", "left")
        each = lineage.cut(each.withColumn("group", F.coalesce("component", "rep")))
        least = each.groupBy("group").agg(F.min("least").alias("component"))
        named = each.drop("component").join(least, "group").select(
            "mark", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component")
        joined = good.select("vec_id", "mark").join(named, "mark").select("vec_id", "n_links", "component")
    alone = rows.where("dim IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    every = joined.unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False))
    return every.select("vec_id", "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


def largest_list(vectors: DataFrame, q: Quantiser) -> int:
    @F.arrow_udf("int")
    def place(column: pa.Array) -> pa.Array:
        points = np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)
        return pa.array(nearest(points, q.centres), pa.int32())

    sizes = vectors.select(place("unit").alias("list")).groupBy("list").count()
    return sizes.agg(F.max("count")).first()[0] or 1
