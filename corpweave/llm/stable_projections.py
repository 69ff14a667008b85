"""Nearest vectors by inner product, searched in a few stable projections of the space.

A vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the greatest length, and a query a zero.
The squared distance of both then is |q|^2 + M^2 - 2 qx, so the nearest ones have the largest inner
product. Projected on ``PROJECTIONS`` Gaussian directions, a point at distance d from the query lies at
projected distance p with p^2 / d^2 following the chi-square law of that many degrees. A kd-tree over
projected points hands out leaves by growing distance; their points are verified by the true inner
product until the next projected distance is so large that a point as near as the worst kept one would,
with probability ``SURE``, have come before. There is no other limit on what is verified.

The top of the tree, learned on a bounded sample, deals all points into cells. A query searches its own
cell first, then, with the distance found there, all cells its stopping test does not rule out. Large
cells are dealt over blocks and many queries of a cell over parts, so every group is bounded. Equal
vectors are searched, and stored, once; of each only the ``k + 1`` least ids can be among the ``k``
nearest of anything.

Vectors that are null, empty, zero or hold null or non-finite entries take no part; vectors of
different length are not compared. Ties go to the smaller id, then to the vector itself. A query does
not find its own row, but a repeated row with its id. Null ids are found last among ties and never
ask. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, in_small_batches
from corpweave.llm.vectors import finite_matrices, packed
from corpweave.operators import lineage

#: Even, so that the chi-square law has a closed form.
PROJECTIONS = 8
SURE = 0.95
LEAF_ROWS = 128
CELL_ROWS = 8192
MOST_CELLS = 4096
#: Points, and queries, of one group.
BLOCK_ROWS, ASKING_ROWS = 16384, 2048
#: Bound of the sample that the cells are learned on.
SAMPLE_ROWS = 100_000


def chi_square(x: float, degrees: int) -> float:
    """Probability of at most ``x``, for an even number of degrees."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


@functools.cache
def quantile(sure: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < sure else (low, middle)
    return high


class Tree(NamedTuple):
    """A kd-tree. Node i splits ``axis[i]`` at ``value[i]``; an axis of -1 marks leaf ``left[i]``."""

    axis: list[int]
    value: list[float]
    left: list[int]
    right: list[int]
    order: np.ndarray  # points by leaf
    ends: list[int]  # where each leaf begins in it, and the end


def built(points: np.ndarray, leaf_rows: int) -> Tree:
    """Split at the median of the widest axis until a node has few points, or only equal ones."""
    tree = Tree([], [], [], [], np.zeros(0, np.int64), [0])
    order: list[np.ndarray] = []

    def grow(rows: np.ndarray) -> int:
        node = len(tree.axis)
        for column in tree[:4]:
            column.append(-1)
        own = points[rows]
        width = own.max(0) - own.min(0) if len(own) else np.zeros(1)
        axis = int(width.argmax())
        if len(rows) <= leaf_rows or not width[axis] > 0:
            tree.left[node] = len(order)
            tree.ends.append(tree.ends[-1] + len(rows))
            order.append(rows)
            return node
        along = own[:, axis]
        value = float(np.partition(along, (len(along) - 1) // 2)[(len(along) - 1) // 2])
        if value == along.max():
            value = float(along[along < value].max())
        low = along <= value
        tree.axis[node], tree.value[node] = axis, value
        tree.left[node], tree.right[node] = grow(rows[low]), grow(rows[~low])
        return node

    grow(np.arange(len(points)))
    return tree._replace(order=np.concatenate(order))


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    found = np.zeros(len(points), np.int64)
    waiting = [(0, np.arange(len(points)))]
    while waiting:
        node, rows = waiting.pop()
        if tree.axis[node] < 0:
            found[rows] = tree.left[node]
        elif len(rows):
            low = points[rows, tree.axis[node]] <= tree.value[node]
            waiting += [(tree.left[node], rows[low]), (tree.right[node], rows[~low])]
    return found


def by_distance(tree: Tree, point: list[float]) -> Iterator[tuple[float, int]]:
    """(least squared distance, leaf) of all leaves, by growing distance, found as they are asked for."""
    heap: list = [(0.0, 0, (0.0,) * len(point))]
    while heap:
        bound, node, apart = heapq.heappop(heap)
        while (axis := tree.axis[node]) >= 0:
            gap = point[axis] - tree.value[node]
            near, far = (tree.left[node], tree.right[node]) if gap <= 0 else (tree.right[node], tree.left[node])
            square = gap * gap
            if square > apart[axis]:
                heapq.heappush(heap, (bound - apart[axis] + square, far, (*apart[:axis], square, *apart[axis + 1:])))
            else:
                heapq.heappush(heap, (bound, far, apart))
            node = near
        yield bound, tree.left[node]


class Space(NamedTuple):
    """The projections of vectors of one length."""

    axes: np.ndarray  # the last row belongs to the added coordinate
    longest: float  # greatest squared length
    limit: float  # of the stopping test
    k: int

    def points(self, vectors: np.ndarray) -> np.ndarray:
        added = np.sqrt(np.maximum(self.longest - (vectors * vectors).sum(1), 0))
        return vectors @ self.axes[:-1] + added[:, None] * self.axes[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.axes[:-1]

    def radius(self, square: float, worst: float) -> float:
        """Squared projected distance at which the stopping test holds, when the worst kept inner product is ``worst``."""
        return self.limit * max(square + self.longest - 2 * worst, 0.0) if worst > -math.inf else math.inf


def space(dim: int, longest: float, k: int, projections: int, sure: float) -> Space:
    axes = np.random.default_rng(12).standard_normal((dim + 1, projections))
    return Space(axes, longest, quantile(sure, projections), k)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed entry by entry, so that they don't depend on the batch."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def searched(s: Space, tree: Tree, vectors: np.ndarray, least: np.ndarray, query: np.ndarray,
             point: list[float], floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``vectors``, inner products) of the ``k + 1`` best found that reach ``floor``.

    ``vectors`` are in the tree's order.
    """
    square = float(query @ query)
    slack = 1e-12 * math.sqrt(square * s.longest)  # the quick products may differ in the last digits
    rows, scores = np.zeros(0, np.int64), np.zeros(0)
    worst = floor
    for bound, leaf in by_distance(tree, point):
        if bound > s.radius(square, worst):
            break
        begin, end = tree.ends[leaf], tree.ends[leaf + 1]
        found = vectors[begin:end] @ query
        good = np.flatnonzero(found >= worst - slack)
        if not len(good):
            continue
        rows, scores = np.concatenate([rows, good + begin]), np.concatenate([scores, found[good]])
        if len(rows) > s.k:
            if len(rows) > 4 * s.k + LEAF_ROWS:
                keep = scores >= np.partition(scores, -s.k - 1)[-s.k - 1] - slack
                rows, scores = rows[keep], scores[keep]
            worst = max(floor, float(np.partition(scores, -s.k - 1)[-s.k - 1]))
    scores = products(vectors[rows], query)
    best = np.lexsort((least[rows], -scores))[:s.k + 1]
    best = best[scores[best] >= floor]
    return rows[best], scores[best]


FOUND = "asking binary, mark binary, score double"


def _search(s: Space):
    def search(stored: pa.Table, asking: pa.Table) -> pa.Table:
        columns: dict[str, list] = {"asking": [], "mark": [], "score": []}
        if stored.num_rows and asking.num_rows:
            vectors = packed(stored["vector"], float)
            tree = built(s.points(vectors), LEAF_ROWS)
            vectors = np.ascontiguousarray(vectors[tree.order])
            marks = stored["mark"].take(pa.array(tree.order)).to_pylist()
            # Null ids come last among ties.
            least = stored["least"].take(pa.array(tree.order)).to_pandas().rank(method="dense").fillna(np.inf).to_numpy()
            queries = packed(asking["vector"], float)
            points = s.queries(queries).tolist()
            floors = [-math.inf if x is None else x for x in asking["floor"].to_pylist()]
            for name, query, point, floor in zip(asking["mark"].to_pylist(), queries, points, floors):
                rows, scores = searched(s, tree, vectors, least, query, point, floor)
                columns["asking"] += [name] * len(rows)
                columns["mark"] += [marks[i] for i in rows.tolist()]
                columns["score"] += scores.tolist()
        return pa.table(columns, pa.schema([("asking", pa.binary()), ("mark", pa.binary()), ("score", pa.float64())]))

    return search


def _placed(s: Space, cells: Tree) -> Column:
    @F.arrow_udf("int")
    @giving_back
    def place(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = leaf_of(cells, s.points(packed(column, float))) if len(column) else []
            yield pa.array(found, pa.int32())

    return place("vector")


def _open_cells(s: Space, cells: Tree) -> Column:
    """Cells other than the own one that the stopping test does not rule out."""

    @F.arrow_udf("array<int>")
    @giving_back
    def reach(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, own, floors in columns:
            vectors = packed(column, float) if len(column) else np.zeros((0, 1))
            points = s.queries(vectors).tolist() if len(column) else []
            result = []
            for query, point, cell, floor in zip(vectors, points, own.to_pylist(), floors.to_pylist()):
                radius = s.radius(float(query @ query), -math.inf if floor is None else floor)
                found = []
                for bound, leaf in by_distance(cells, point):
                    if bound > radius:
                        break
                    if leaf != cell:
                        found.append(leaf)
                result.append(found)
            yield pa.array(result, pa.list_(pa.int32()))

    return reach("vector", "home", "floor")


def _compared(stored: DataFrame, asking: DataFrame, s: Space) -> DataFrame:
    """(asking, mark, score) for all queries and all points of their cell, in bounded groups."""
    # At most MOST_CELLS rows of numbers.
    blocks = stored.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    parts = asking.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ASKING_ROWS).cast("int").alias("parts"))
    sizes = F.broadcast(lineage.cut(blocks.join(parts, "cell")))
    dealt = F.xxhash64("mark")
    left = stored.join(sizes, "cell").select(
        "cell", F.pmod(dealt, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "mark", "least", "vector")
    # Both sides may come from one stored frame; new names keep their columns apart.
    right = asking.join(sizes, "cell").select(
        F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(dealt, "parts").cast("int").alias("part"),
        *[F.col(c).alias(c) for c in ("mark", "floor", "vector")])
    keys = ["cell", "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(s), FOUND)


def prepared(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, square, mark, vector): usable rows, their squared length, a fingerprint and 8 bytes an entry."""

    @F.arrow_udf("struct<dim:int,square:double,mark:binary,vector:binary>")
    @giving_back
    def convert(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            cells = [None] * len(column), [None] * len(column), [None] * len(column), [None] * len(column)
            for rows, vectors in finite_matrices(column):
                vectors = vectors + 0.0
                squares = (vectors * vectors).sum(1)
                for i, x, square in zip(rows.tolist(), vectors, squares.tolist()):
                    if x.any():
                        data = x.tobytes()
                        for place, cell in zip(cells, (len(x), square, hashlib.blake2b(data, digest_size=16).digest(), data)):
                            place[i] = cell
            kinds = pa.int32(), pa.float64(), pa.binary(), pa.binary()
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["dim", "square", "mark", "vector"])

    found = embeddings.select(F.col(id_col).alias("id"), convert(vector_col).alias("u"))
    return found.select("id", "u.*").where("dim IS NOT NULL")


def _classes_found(classes: DataFrame, dim: int, k: int, projections: int, sure: float) -> DataFrame:
    """(asking, mark, score): best vectors of one length for each asking one."""
    own = classes.where(F.col("dim") == dim)
    n, longest = own.agg(F.count(F.lit(1)), F.max("square")).first()
    s = space(dim, longest, k, projections, sure)
    every = -(-n // SAMPLE_ROWS)
    sample = own.where(F.pmod(F.xxhash64("mark"), F.lit(every)) == 0).select("vector")

    @giving_back
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = s.points(packed(batch.column("vector"), float))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in points], pa.binary())], ["point"])

    points = packed(sample.mapInArrow(project, "point binary").orderBy("point").toArrow()["point"], float)
    wanted = min(MOST_CELLS, -(-n // CELL_ROWS))
    cells = built(points.reshape(-1, projections), max(-(-len(points) // wanted), 1))
    stored = lineage.cut(own.select("mark", "least", "vector", "asks", _placed(s, cells).alias("cell")))
    asking = stored.where("asks").selectExpr("mark", "vector", "cell", "CAST(NULL AS DOUBLE) AS floor")
    first = lineage.cut(_compared(stored, asking, s))
    # The worst inner product of k + 1; with fewer in its own cell a query asks all others.
    worst = first.groupBy("asking").agg(F.sort_array(F.collect_list("score"), False).alias("scores")).select(
        F.col("asking").alias("mark"), F.expr(f"try_element_at(scores, {k + 1})").alias("floor"))
    further = stored.where("asks").selectExpr("mark", "vector", "cell AS home").join(worst, "mark", "left")
    further = lineage.cut(further.withColumn("cells", _open_cells(s, cells)).select(
        "mark", "vector", "floor", F.explode("cells").alias("cell")))
    return first.unionByName(_compared(stored, further, s))


def search(embeddings: DataFrame, asks: Column | None = None, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", projections: int = PROJECTIONS, sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for every row that ``asks``, a
    condition on the id column, which is named ``id`` there; by default ids divisible by 20."""
    asks = F.expr("id % 20 = 0") if asks is None else asks
    rows = lineage.cut(prepared(in_small_batches(embeddings), id_col, vector_col).withColumn("asks", F.coalesce(asks & F.col("id").isNotNull(), F.lit(False))))
    classes = lineage.cut(rows.groupBy("mark").agg(
        F.first("dim").alias("dim"), F.first("square").alias("square"), F.first("vector").alias("vector"),
        F.min("id").alias("least"), F.bool_or("asks").alias("asks")))
    found = None
    for (dim,) in classes.where("asks").select("dim").distinct().orderBy("dim").collect():
        part = _classes_found(classes, dim, k, projections, sure)
        found = part if found is None else found.unionByName(part)
    kind = rows.schema["id"].dataType.simpleString()
    if found is None:
        return rows.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    by_id = [F.col("id").isNull(), "id"]
    place = F.row_number().over(Window.partitionBy("mark").orderBy(*by_id))
    members = rows.select("mark", "id").withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    ordered = Window.partitionBy("asking").orderBy(F.desc("score"), *by_id, "mark")
    best = found.join(members, "mark").withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k + 1)
    lists = best.groupBy("asking").agg(F.sort_array(F.collect_list(F.struct("place", "id", "mark", "score"))).alias("near"))
    queries = rows.where("asks").selectExpr("id AS query_id", "mark AS asking")
    return queries.join(lists, "asking").withColumn(
        "own", F.expr("array_position(transform(near, x -> x.mark = asking AND x.id <=> query_id), true)")
    ).select("query_id", F.posexplode(F.expr(f"slice(filter(near, (x, i) -> i + 1 <> own), 1, {k})"))).selectExpr(
        "query_id", "pos + 1 AS rank", "col.id AS vec_id", "col.score AS score")
