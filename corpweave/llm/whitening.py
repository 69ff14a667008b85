"""Whitening of vectors: exact integer cross-products from bit planes, then an eigendecomposition.

An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list holds each distinct vector
of whole numbers once. A block of its rows is shifted to its least value per dimension; bit p of a
dimension over all rows of the block is one plane, packed 64 rows to a word. The ones in the AND of two
planes, counted word by word and weighted by both bits' values, add up to the exact cross-product of
two dimensions. Counts, sums and cross-products are whole numbers of any size: added up within a task,
then over two levels of groups, so neither rows nor all partial sums meet in one place. They are centred
as whole numbers, n times the cross-product less the product of sums, before anything is divided.

Results, per row and component: the row's id, ``component`` from 1, ``n`` (size of the fit list),
``deviation`` (sum of (n x - S)^2, exact, null beyond 38 digits), ``whitened``, ``explained`` and
``identity_error``, measured on the whitened fit list.

Rows whose vector is null or empty, or holds null or non-finite entries, are dropped. Numbers outside
a long stop at 2^62. Vectors of each length are a population of their own. A component without variance
(an eigenvalue of 0 up to rounding) has a null ``whitened``; without any variance ``explained`` is null
as well, and ``identity_error`` covers the components that have some (null without any). Repeated rows
and ids are kept, ids may be null, other columns are ignored; an empty table gives an empty result. The
sign of a component makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, in_small_batches
from corpweave.llm.vectors import finite_matrices, packed
from corpweave.operators import lineage

SCALE, SHIFT = 64, 1_000_000
MOST = 1 << 62
COMPONENTS = 16
#: Rows of a block of bit planes.
BLOCK = 4096
#: Cross-products a task holds before it hands them on.
HELD = 1 << 20
#: Groups that partial sums meet in before they meet per length.
FAN = 64
#: Bytes of models that go to the tasks at a time.
MODEL_BYTES = 64 << 20
#: Bytes of a whole number in a partial sum: rows times 2^126 fit up to 2^65 rows.
WIDE = 24


class Sums(NamedTuple):
    """Count, sums and cross-products of whole-number vectors, as Python's own numbers."""

    n: int
    sums: np.ndarray
    cross: np.ndarray

    def plus(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.sums + other.sums, self.cross + other.cross)


class Model(NamedTuple):
    n: int
    base: np.ndarray  # whole number next to every dimension's mean
    rest: np.ndarray  # n times what the mean is above it, as Python numbers
    axes: np.ndarray  # unit eigenvectors as columns
    spread: np.ndarray  # their eigenvalues, 0 without variance
    trace: float


def whole_numbers(vector: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vector * SCALE), -MOST, MOST).astype(np.int64) + SHIFT


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits packed over rows, dimension, power) of every plane that holds a one."""
    rows = -len(values) % 64
    values = np.pad(values, ((0, rows), (0, 0)))
    found, dims, powers = [], [], []
    for p in range(int(values.max()).bit_length()):
        bits = (values >> np.uint64(p)) & np.uint64(1)
        some = np.flatnonzero(bits.any(0))
        found.append(np.packbits(bits[:, some].T.astype(bool), axis=1).view(np.uint64))
        dims.append(some)
        powers.append(np.full(len(some), p))
    if not found:
        return np.zeros((0, 1), np.uint64), np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(found), np.concatenate(dims), np.concatenate(powers)


def bit_sliced(x: np.ndarray) -> Sums:
    """Exact sums and cross-products of the rows of ``x``."""
    low = x.min(0)
    words, dims, powers = planes((x - low).astype(np.uint64))
    ones = np.zeros((len(words), len(words)), np.int64)
    for i in range(len(words)):
        ones[i, i:] = np.bitwise_count(words[i:] & words[i]).sum(1, dtype=np.int64)
    ones = np.maximum(ones, ones.T)
    # Weighted counts stay in a long where they fit.
    fits = not len(powers) or 2 * (int(powers.max()) + 1) + len(x).bit_length() < 63
    cross = np.zeros((x.shape[1], x.shape[1]), np.int64 if fits else object)
    sums = np.zeros(x.shape[1], object)
    groups = [(p, np.flatnonzero(powers == p)) for p in np.unique(powers).tolist()]
    for p, own in groups:
        sums[dims[own]] += ones[own, own].astype(object) << p
        for q, others in groups:
            counts = ones[np.ix_(own, others)]
            cross[np.ix_(dims[own], dims[others])] += (counts if fits else counts.astype(object)) << (p + q)
    # Undo the shift.
    low, n = low.astype(object), len(x)
    crossed = np.multiply.outer(low, sums)
    cross = cross.astype(object) + crossed + crossed.T + n * np.multiply.outer(low, low)
    return Sums(n, sums + n * low, cross)


def _bytes(numbers: np.ndarray) -> bytes:
    return b"".join(int(x).to_bytes(WIDE, "little", signed=True) for x in numbers)


def _numbers(data: bytes) -> np.ndarray:
    return np.array([int.from_bytes(data[i:i + WIDE], "little", signed=True) for i in range(0, len(data), WIDE)], object)


PARTIAL = "dim int, bucket int, n bigint, sums binary, crossed binary"


def _partial(dim: int, bucket: int, s: Sums) -> pa.RecordBatch:
    upper = s.cross[np.triu_indices(dim)]
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([bucket], pa.int32()), pa.array([s.n], pa.int64()),
         pa.array([_bytes(s.sums)], pa.binary()), pa.array([_bytes(upper)], pa.binary())],
        ["dim", "bucket", "n", "sums", "crossed"])


def _added(batches: Iterator[pa.RecordBatch]) -> tuple[int, Sums]:
    dim, total = 0, None
    for batch in batches:
        for row in batch.to_pylist():
            dim = row["dim"]
            cross = np.zeros((dim, dim), object)
            cross[np.triu_indices(dim)] = _numbers(row["crossed"])
            one = Sums(row["n"], _numbers(row["sums"]), cross)
            total = one if total is None else total.plus(one)
    return dim, total


@giving_back
def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial sum per task and length; more only where many lengths occur."""
    context = TaskContext.get()
    bucket = context.partitionId() % FAN if context else 0
    held: dict[int, Sums] = {}
    for batch in batches:
        lengths = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths).tolist():
            rows = packed(batch.column("x").filter(pa.array(lengths == dim)), np.int64)
            for at in range(0, len(rows), BLOCK):
                one = bit_sliced(rows[at:at + BLOCK])
                held[dim] = held[dim].plus(one) if dim in held else one
            if sum(d * d for d in held) > HELD:
                yield from (_partial(d, bucket, s) for d, s in held.items())
                held = {}
    yield from (_partial(d, bucket, s) for d, s in held.items())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield _partial(*(lambda dim, s: (dim, 0, s))(*_added(batches)))


def decomposed(s: Sums, components: int) -> Model:
    centred = s.n * s.cross - np.multiply.outer(s.sums, s.sums)
    covariance = (centred / (s.n * s.n)).astype(float)
    covariance = np.triu(covariance) + np.triu(covariance, 1).T
    spread, axes = np.linalg.eigh(covariance)
    spread, axes = spread[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1, 1)
    floor = len(covariance) * np.finfo(float).eps * max(spread[0], 0)
    base = np.array([(2 * int(x) + s.n) // (2 * s.n) for x in s.sums], np.int64)
    trace = int(centred.trace()) / (s.n * s.n)
    return Model(s.n, base, s.sums - s.n * base.astype(object), np.ascontiguousarray(axes),
                 np.where(spread > floor, spread, 0), trace)


MODEL = "dim int, n bigint, base binary, rest binary, axes binary, spread binary, trace double"


def _models(components: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, total = _added(batches)
        m = decomposed(total, components)
        cells = [dim, m.n, m.base.tobytes(), _bytes(m.rest), m.axes.tobytes(), m.spread.tobytes(), m.trace]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)],
                                         ["dim", "n", "base", "rest", "axes", "spread", "trace"])

    return fit


def _model(row) -> Model:
    dim = row["dim"]
    return Model(row["n"], np.frombuffer(row["base"], np.int64), _numbers(row["rest"]),
                 np.frombuffer(row["axes"]).reshape(dim, -1), np.frombuffer(row["spread"]), row["trace"])


def whitened(x: np.ndarray, m: Model) -> np.ndarray:
    """Centred rows on the components at unit variance; NaN without variance."""
    centred = (x - m.base) - (m.rest / m.n).astype(float)
    # einsum sums every row alike, wherever it stands in its batch.
    found = np.einsum("ij,jk->ik", centred, m.axes)
    return np.divide(found, np.sqrt(m.spread), out=np.full(found.shape, np.nan), where=m.spread > 0)


def deviations(x: np.ndarray, m: Model) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact."""
    apart = x - m.base
    most = m.n * int(np.abs(apart).max()) + int(np.abs(m.rest).max())
    kind = np.int64 if x.shape[1] * most * most < 1 << 63 else object
    scaled = m.n * apart.astype(kind) - m.rest.astype(kind)
    found = (scaled * scaled).sum(1)
    if kind is np.int64:
        return pa.array(found, pa.int64()).cast(pa.decimal128(38, 0), safe=False)
    import decimal

    return pa.array([decimal.Decimal(v) if v < 10**38 else None for v in found.tolist()], pa.decimal128(38, 0))


def _by_length(batch: pa.RecordBatch, models: dict[int, Model]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Model]]:
    lengths = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths).tolist():
        part = batch.filter(pa.array(lengths == dim))
        yield part, packed(part.column("x"), np.int64), models[dim]


def _covariances(models: dict[int, Model]):
    """Partial sums of products of whitened values of the fit list, one per task and length."""

    @giving_back
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x, m in _by_length(batch, models):
                y = np.nan_to_num(whitened(x, m), nan=0.0)
                held[x.shape[1]] = held.get(x.shape[1], 0) + y.T @ y
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())],
                ["dim", "products"])

    return add


def _errors(models: dict[int, Model]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, dim = 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                total = total + np.frombuffer(row["products"])
        m = models[dim]
        some = np.flatnonzero(m.spread > 0)
        apart = total.reshape(len(m.spread), -1)[np.ix_(some, some)] / m.n - np.eye(len(some))
        error = float(np.abs(apart).max()) if len(some) else None
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([error], pa.float64())], ["dim", "error"])

    return measure


def _applied(models: dict[int, Model], errors: dict[int, float | None]):
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    @giving_back
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x, m in _by_length(batch, models):
                found = whitened(x, m)
                rows, k = found.shape
                each = pa.array(np.repeat(np.arange(rows), k))
                flat, dim = found.ravel(), x.shape[1]
                share = np.tile(m.spread / m.trace, rows) if m.trace > 0 else None
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                     pa.array(np.full(rows * k, m.n), pa.int64()), deviations(x, m).take(each),
                     pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                     pa.nulls(rows * k, pa.float64()) if share is None else pa.array(share, pa.float64()),
                     pa.array([errors[dim]] * (rows * k), pa.float64())], names)

    return apply


def prepared(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, x): usable rows as whole numbers, 8 bytes an entry."""

    @F.arrow_udf("struct<dim:int,x:binary>")
    @giving_back
    def convert(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            dims, data = [None] * len(column), [None] * len(column)
            for rows, vectors in finite_matrices(column):
                for i, x in zip(rows.tolist(), whole_numbers(vectors)):
                    dims[i], data[i] = len(x), x.tobytes()
            yield pa.StructArray.from_arrays([pa.array(dims, pa.int32()), pa.array(data, pa.binary())], ["dim", "x"])

    found = embeddings.select(F.col(id_col).alias("id"), convert(vector_col).alias("u"))
    return found.select("id", "u.dim", "u.x").where("dim IS NOT NULL")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), see the module's text."""
    rows = lineage.cut(prepared(in_small_batches(embeddings), id_col, vector_col))
    fit_list = lineage.cut(rows.select("dim", "x").distinct())
    partial = fit_list.mapInArrow(_scatter, PARTIAL)
    merged = partial.groupBy("dim", "bucket").applyInArrow(_merge, PARTIAL)
    models = lineage.cut(merged.groupBy("dim").applyInArrow(_models(components), MODEL))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    found = None
    for lengths in _portions([r["dim"] for r in models.select("dim").orderBy("dim").collect()], components):
        here = F.col("dim").isin(lengths)
        known = {r["dim"]: _model(r) for r in models.where(here).collect()}
        products = fit_list.where(here).mapInArrow(_covariances(known), "dim int, products binary")
        measured = products.groupBy("dim").applyInArrow(_errors(known), "dim int, error double").collect()
        part = rows.where(here).mapInArrow(_applied(known, {r["dim"]: r["error"] for r in measured}), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("id", id_col)


def _portions(lengths: list[int], components: int) -> Iterator[list[int]]:
    """Lengths whose models take at most ``MODEL_BYTES`` together; usually there is just one."""
    held, size = [], 0
    for dim in lengths:
        own = 8 * dim * (components + 5)
        if held and size + own > MODEL_BYTES:
            yield held
            held, size = [], 0
        held.append(dim)
        size += own
    if held:
        yield held
