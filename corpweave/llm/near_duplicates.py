"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

A document's distinct five-word shingles are hashed into ``REGISTERS`` buckets. Of each bucket's least
hash the register keeps the number of leading zeros and the next mantissa bits, 16 bits in all; an
empty bucket borrows by a fixed random probing that both documents of a pair follow alike. Bands of
``ROWS`` registers make candidates: at a similarity of 0.75 a pair shares none of the bands with
probability 2e-6. The share of equal registers, corrected for chance collisions of registers,
estimates the similarity; pairs more than five standard errors below the threshold go, the rest is
confirmed on the exact sets.

Documents with equal sets are one class from the start. Inside a bucket of classes pairs with its
leader come first, so a bucket of many near copies is mostly one component after one pair per member.
Only buckets with members still apart are compared further: each member outside the largest component
with all others, in blocks, on registers. First each such member is confirmed against its most similar
partner alone, which joins most of them; then, of those still apart, all pairs of different components
that pass the estimate and a closer one on their least hashes and have not met in an earlier band come
out. No link between different texts is lost to a
cap, and pairs inside a component are not listed.

Words are runs without white space, A-Z counts as a-z. A text of one to four words is one shingle; a
null or wordless text is linked with nothing and kept. Rows with equal ids are one document: it is
linked by the shingles of any of them, and its component goes by its id. A row with a null id stands
alone, has a null component and is kept. ``distinct`` takes rows of one id with different texts as
different documents. Other columns are ignored, in ``distinct`` kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, in_small_batches, kept_by_worker, utf8
from corpweave.llm.shingles import shingle_sets
from corpweave.llm.words import mix
from corpweave.operators import lineage
from corpweave.operators.components import components

BANDS = 48
ROWS = 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
PROBES = 64
THRESHOLD = 75  # percent
#: Two registers of unlike buckets are equal about this often.
COLLISION = 1 / (3 << MANTISSA)
#: Estimates below are at least five standard errors under the threshold.
LEAST_ESTIMATE = THRESHOLD / 100 - 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
#: Least shingle hashes of a set that go along where buckets are compared as a whole.
BOTTOM = 512
#: Members of a bucket that are compared with as many others at a time.
BLOCK = 1000

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def probing() -> np.ndarray:
    return np.random.default_rng(5).integers(0, REGISTERS, (REGISTERS, PROBES))


def least_hashes(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least hash of every bucket of every set; empty buckets borrow."""
    n = len(ends) - 1
    of = np.repeat(np.arange(n), np.diff(ends))
    bucket = ((hashes >> np.uint64(40)) % np.uint64(REGISTERS)).astype(np.int64)
    least = np.full(n * REGISTERS, EMPTY)
    np.minimum.at(least, of * REGISTERS + bucket, mix(hashes ^ np.uint64(0x243F6A8885A308D3)))
    least = least.reshape(n, REGISTERS)
    own, probe = least.copy(), kept_by_worker("hyperminhash_probing", probing)
    some = np.flatnonzero(np.diff(ends) > 0)
    rows, columns = np.nonzero(own[some] == EMPTY)
    rows = some[rows]
    for k in range(PROBES):
        if not len(rows):
            return least
        found = own[rows, probe[columns, k]]
        least[rows, columns] = found
        still = found == EMPTY
        rows, columns = rows[still], columns[still]
    # Very small sets: the bucket's own draw among the few hashes there are.
    for row, column in zip(rows.tolist(), columns.tolist()):
        mine = hashes[ends[row]:ends[row + 1]]
        least[row, column] = mix(mine ^ mix(np.array([column + 1], np.uint64))).min()
    return least


def registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros and the ``MANTISSA`` bits behind the first one, as 16 bits."""
    part, power = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - power, 0, 63)
    mantissa = np.minimum(((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    return (zeros.astype(np.int64) << MANTISSA | np.maximum(mantissa, 0)).astype(np.uint16)


def band_hashes(found: np.ndarray) -> np.ndarray:
    parts = found.astype(np.uint64).reshape(len(found), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32), parts.shape[:2]).copy()
    for k in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return total.view(np.int64)


def sketch(text: Column | str) -> Column:
    """struct<n, a, b, bands, registers>; (a, b) fingerprints the whole set."""

    @F.arrow_udf("struct<n:bigint,a:bigint,b:bigint,bands:array<bigint>,registers:binary>")
    @giving_back
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            done = [one(*sets) for sets in shingle_sets(*utf8(column))]
            yield pa.concat_arrays(done) if done else one(np.zeros(0, np.uint64), np.zeros(1, np.int64))

    def one(hashes: np.ndarray, ends: np.ndarray) -> pa.Array:
        n = np.diff(ends)
        marks = []
        for salt in (1, 2):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(salt)))])
            marks.append(pa.array((total[ends[1:]] - total[ends[:-1]]).view(np.int64)))
        found = registers(least_hashes(hashes, ends))
        some = n > 0
        bands = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(band_hashes(found)[some].ravel()))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), *marks, bands, pa.array([r.tobytes() for r in found], pa.binary())],
            ["n", "a", "b", "bands", "registers"])

    return find(text)


def shingle_lists(text: Column | str) -> Column:
    """The distinct shingles of a text as hashes."""

    @F.arrow_udf("array<bigint>")
    @giving_back
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            done = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                    for hashes, ends in shingle_sets(*utf8(column))]
            yield pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int64()))

    return find(text)


def least_of_set(shingles: str) -> Column:
    """The upper halves of a set's least hashes; sets are sorted as unsigned numbers."""
    return F.transform(F.slice(shingles, 1, BOTTOM), lambda h: F.shiftrightunsigned(h, 32))


def corrected(equal: np.ndarray) -> np.ndarray:
    """Estimated similarity from the share of equal registers."""
    return (equal - COLLISION) / (1 - COLLISION)


def estimate(left: Column | str, right: Column | str) -> Column:
    @F.arrow_udf("double")
    def find(one: pa.Array, other: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, REGISTERS) for x in (one, other))
        return pa.array(corrected((a == b).mean(axis=1)) if len(a) else [], pa.float64())

    return find(left, right)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (src, dst) whose full sets are similar enough."""
    one = sets.select(F.col("rep").alias("src"), F.col("shingles").alias("one"))
    two = sets.select(F.col("rep").alias("dst"), F.col("shingles").alias("two"))
    both = F.size(F.array_intersect("one", "two"))
    enough = both * 100 >= (F.size("one") + F.size("two") - both) * THRESHOLD
    return pairs.join(one, "src").join(two, "dst").where(enough).select("src", "dst")


def alike(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sets may be similar enough, by their least hashes: all of them in small sets, else
    as many as estimate the similarity five standard errors away from the threshold."""
    if max(len(one), len(two)) < BOTTOM:
        both = len(np.intersect1d(one, two))
        return both >= (THRESHOLD / 100 - 0.01) * (len(one) + len(two) - both)
    union = np.union1d(one, two)[:BOTTOM]
    both = np.isin(union, one) & np.isin(union, two)
    return both.mean() >= THRESHOLD / 100 - 5 * (0.75 * 0.25 / len(union)) ** 0.5


def apart(members: DataFrame, known: DataFrame, best: bool) -> DataFrame:
    """(src, dst) inside a bucket that may be similar, lie in different components and have not met
    the leader; ``members`` has (band, place, rep, leader, component), ``known`` what is compared, by rep.
    With ``best`` only the most similar partner of each member outside the largest component."""
    size = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    main = size.groupBy("band").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("n"))
    main = main.where("n > 2 AND m.n < n").select(
        "band", F.col("m.component").alias("main"),
        F.ceil((F.col("n") - F.col("m.n")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("n") / BLOCK).cast("int").alias("all"))
    # Only what lies in such buckets takes its registers along.
    rows = lineage.cut(members.join(main, "band"))
    needed = lineage.cut(rows.select("rep").distinct())
    rows = lineage.cut(rows.join(known.join(needed, "rep"), "rep"))
    deal = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    columns = ["band", "place", "rep", "leader", "component", "registers", "bottom"]
    few = rows.where("component <> main").withColumn("i", deal("few")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("all") - 1))).select(*columns, "i", "j", F.lit(True).alias("outside"))
    whole = rows.withColumn("j", deal("all")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("few") - 1))).select(*columns, "i", "j", F.lit(False).alias("outside"))

    def meet(batch: pa.Table) -> pa.Table:
        outside = batch.column("outside").to_numpy()
        parts = [batch.filter(pa.array(m)) for m in (outside, ~outside)]
        regs, component = ([np.frombuffer(b"".join(p.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                            for p in parts], [p.column("component").to_numpy() for p in parts])
        reps = [p.column("rep").to_numpy() for p in parts]
        bottom = [[x.values.to_numpy() for x in p.column("bottom")] for p in parts]
        place = batch.column("place")[0].as_py()
        leader = batch.column("leader")[0].as_py()
        found: list[tuple[int, int]] = []
        for i in range(len(regs[0])):
            equal = regs[1] == regs[0][i]
            near = corrected(equal.mean(axis=1)) >= LEAST_ESTIMATE
            near &= (component[1] != component[0][i]) & (reps[1] != leader) & (reps[0][i] != leader)
            rows_ = np.flatnonzero(near)
            if len(rows_) and best:
                found.append((int(reps[0][i]), int(reps[1][rows_[equal[rows_].sum(axis=1).argmax()]])))
            elif len(rows_):  # only in the first band the two share
                first = equal[rows_].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
                found += [(int(reps[0][i]), int(reps[1][x])) for x in rows_[first == place].tolist()
                          if alike(bottom[0][i], bottom[1][x])]
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"src": ends.min(axis=1), "dst": ends.max(axis=1)})

    return few.unionByName(whole).groupBy("band", "i", "j").applyInArrow(meet, "src bigint, dst bigint").distinct()


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = lineage.cut(in_small_batches(docs).select(F.col(id_col).alias("doc_id"), sketch(text_col).alias("s")).select("doc_id", "s.*"))
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = lineage.cut(usable.groupBy("a", "b").agg(F.min("doc_id").alias("rep")))
    reps = usable.join(classes, ["a", "b"]).where("doc_id = rep")
    reps = reps.dropDuplicates(["a", "b", "rep"]).select("rep", "bands", "registers")
    # An id may stand for several sets, so links are between ids and those of one id count together.
    reps = lineage.cut(reps)
    bands = reps.select("rep", F.posexplode("bands").alias("place", "band"))
    crowded = bands.groupBy("band").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n"))
    members = lineage.cut(bands.join(crowded.where("n > 1").drop("n"), "band"))
    known = reps.select("rep", "registers")
    first = members.where("rep <> leader").select("leader", "rep").distinct()
    first = first.join(known, "rep").withColumnRenamed("registers", "one").join(
        known.select(F.col("rep").alias("leader"), F.col("registers").alias("two")), "leader")
    first = first.where(estimate("one", "two") >= LEAST_ESTIMATE).select(
        F.col("leader").alias("src"), F.col("rep").alias("dst"))
    ids = lineage.cut(members.select("rep").distinct())
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).join(ids, "rep")
    sets = lineage.cut(texts.select("rep", shingle_lists("text").alias("shingles")).where(F.size("shingles") > 0))
    links = lineage.cut(confirmed(first, sets))
    so_far = components(links).withColumnRenamed("id", "rep")
    closer = sets.select("rep", least_of_set("shingles").alias("bottom"))
    known = known.join(closer, "rep")
    for best in (True, False):
        placed = members.join(so_far, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        more = lineage.cut(confirmed(apart(placed, known, best), sets))
        if more.head(1):
            links = links.unionByName(more)
            so_far = components(links).withColumnRenamed("id", "rep")
    named = classes.join(so_far, "rep", "left").select(
        "a", "b", F.coalesce("component", "rep").alias("component"))
    inside = usable.select("doc_id", "n", "a", "b").join(named, ["a", "b"])
    alone = rows.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component"))
    every = inside.select("doc_id", "n", "component").unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
    return every.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, but for those that are not kept.

    Where ids repeat, every row is judged by its own text, and one row stays of each id and text.
    """
    counted = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if not counted.where("n > 1").head(1):
        gone = linked(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
        gone = lineage.cut(gone)
        return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    # Null for rows that are linked with nothing.
    linkable = F.col(id_col).isNotNull() & F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.withColumn("_print", F.when(linkable, F.sha2(text_col, 256)))
    rows = marked.where("_print IS NOT NULL").dropDuplicates([id_col, "_print"])
    # Numbered in the order of ids, so that the row of the least id stays as elsewhere; stored, so that numbers stand.
    rows = lineage.cut(rows.orderBy(id_col, "_print").withColumn("_key", F.monotonically_increasing_id()))
    gone = lineage.cut(linked(rows, "_key", text_col).where("NOT kept").select(F.col("doc_id").alias("_key")).distinct())
    left = rows.join(gone, "_key", "left_anti").select(docs.columns)
    return left.unionByName(marked.where("_print IS NULL").select(docs.columns))
