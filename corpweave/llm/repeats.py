"""Removing every byte that lies in a long string occurring more than once in the corpus.

Texts are bytes; a *window* is a string of ``length`` bytes, ``LENGTH`` by default, and is repeated when it also starts
anywhere else, in the same text or another. The work narrows down in steps that lose no window:

1. Every text yields anchors, the least hashes of 32-byte strings within some distance. Those that a
   repeated window's own bytes decide are anchors wherever it occurs, so a window with such an anchor
   that occurs only once is out.
2. The remaining windows are cut into segments: neighbours with the same least 32-byte hash. Equal
   windows share that hash, so they meet in the group of segments under it. Equal segments are
   counted, not carried along: all windows of a segment that occurs twice are repeated.
3. Groups with different segments are packed into shards. Of a shard's segments the Burrows-Wheeler
   transform is built, and common prefixes are derived breadth first: boundaries between suffixes
   that differ in their first l bytes are extended backwards over the transform to those that differ
   in their first l + 1 bytes. At ``length`` it stops; neighbours without a boundary share a window.
4. A group beyond the size of a shard is dealt over several. What repeats inside one is settled
   there; of the other windows, and one of each repeated kind, a 128-bit fingerprint is counted
   across the group's shards.

A null text counts as empty, texts shorter than a window have none, an empty table gives an empty
result. Rows are told apart by id and text together (64-bit hash); equal rows are repeats of one
another and each gives a row. Other columns than the id and the text are ignored or, in ``cleaned``,
kept. Where removal cuts into a character, the character's other bytes stay in the byte result;
``cleaned`` drops them since its text has to be valid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, giving_back_group, in_small_batches, utf8
from corpweave.llm.words import mix
from corpweave.operators import lineage

LENGTH = 400
GRAM = 32
SPACING = 192
#: Bytes of a shard, about; a task holds some hundred times this while it works on one.
SHARD_BYTES = 500_000

SPANS = "array<struct<start:bigint,stop:bigint>>"


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every place on."""
    if len(raw) < GRAM:
        return np.zeros(0, np.uint64)
    x = raw.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    for step in (8, 16):
        x = x[:-step] * np.uint64(0xBF58476D1CE4E5B9) + x[step:]
        x ^= x >> np.uint64(32)
    return x * np.uint64(0x94D049BB133111EB)


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[:done - width], x[width - done:]) if done < width else x


def anchor_places(hashes: np.ndarray, spacing: int) -> np.ndarray:
    """Places whose hash is the least among some ``spacing`` neighbours."""
    if len(hashes) < spacing:
        return np.zeros(0, np.int64)
    least = np.zeros(len(hashes) + spacing - 1, np.uint64)
    least[spacing - 1:len(hashes)] = sliding(hashes, spacing, np.minimum)
    return np.flatnonzero(sliding(least, spacing, np.maximum) == hashes)


def as_long(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def spacing_of(length: int) -> int:
    """Places an anchor stands for, so that a window of ``length`` bytes decides some."""
    return SPACING * length // LENGTH


def anchors(text: Column | str, length: int) -> Column:
    """array<struct<hash, n>>: the distinct anchors of a text and how often each occurs in it."""
    spacing = spacing_of(length)

    @F.arrow_udf("array<struct<hash:bigint,n:int>>")
    @giving_back
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            raw, offsets = utf8(column)
            hashes, counts, sizes = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                size = 0
                if b - a >= length:
                    own = gram_hashes(raw[a:b])
                    own, n = np.unique(own[anchor_places(own, spacing)], return_counts=True)
                    hashes.append(own)
                    counts.append(n)
                    size = len(own)
                sizes.append(size)
            flat = pa.StructArray.from_arrays(
                [pa.array(as_long(np.concatenate(hashes or [np.zeros(0)]).astype(np.uint64))),
                 pa.array(np.concatenate(counts or [np.zeros(0)]), pa.int32())], ["hash", "n"])
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)

    return find(text)


def open_windows(raw: np.ndarray, hashes: np.ndarray, repeated: np.ndarray, length: int, spacing: int) -> np.ndarray:
    """For every window start whether all anchors that the window's own bytes decide are repeated.

    An anchor near the window's end may owe its place to bytes outside and be none where the window
    starts elsewhere. So what counts is the least hash of each stretch of ``spacing`` inside.
    """
    least = sliding(hashes, spacing, np.minimum)
    change = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
    values = least[change]
    at = np.minimum(np.searchsorted(repeated, values), max(len(repeated) - 1, 0))
    known = repeated[at] == values if len(repeated) else np.zeros(len(values), bool)
    alone = np.repeat(~known, np.diff(np.append(change, len(least))))
    before = np.append(0, np.cumsum(alone))
    windows, stretches = len(raw) - length + 1, length - GRAM - spacing + 2
    return before[stretches:stretches + windows] == before[:windows]


def segments(text: Column | str, repeated: Column | str, length: int) -> Column:
    """array<struct<key, a, b, start, size, many, bytes>> of a text and its repeated anchors.

    (a, b) fingerprints the bytes; these come along only once for equal segments of a batch. ``many``
    tells that the least hash occurs more than once, so the segment may repeat itself.
    """
    spacing = spacing_of(length)
    names = ["key", "a", "b", "start", "size", "many", "bytes"]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]

    @F.arrow_udf("array<struct<key:bigint,a:bigint,b:bigint,start:bigint,size:bigint,many:boolean,bytes:binary>>")
    @giving_back
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in columns:
            raw, offsets = utf8(texts)
            columns_, sizes, seen = [[] for _ in names], [], set()
            for a, b, own in zip(offsets[:-1].tolist(), offsets[1:].tolist(), lists):
                found = one(raw[a:b], own.values.to_numpy(zero_copy_only=False), seen) if b - a >= length else []
                sizes.append(len(found))
                for row in found:
                    for c, v in zip(columns_, row):
                        c.append(v)
            flat = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns_, kinds)], names)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)

    def one(raw: np.ndarray, repeated: np.ndarray, seen: set) -> list[tuple]:
        hashes = gram_hashes(raw)
        is_open = open_windows(raw, hashes, np.sort(repeated.astype(np.int64).view(np.uint64)), length, spacing)
        if not is_open.any():
            return []
        least = sliding(hashes, length - GRAM + 1, np.minimum)
        change = np.flatnonzero((least[1:] != least[:-1]) | (is_open[1:] != is_open[:-1])) + 1
        starts, stops = np.append(0, change), np.append(change, len(least))
        kept = is_open[starts]
        data, found = raw.tobytes(), []
        for start, stop in zip(starts[kept].tolist(), stops[kept].tolist()):
            part = data[start:stop - 1 + length]
            mark = xxhash.xxh3_128_digest(part)
            key = least[start]
            many = bool((hashes[start:stop + length - GRAM] == key).sum() > 1)
            first, second = np.frombuffer(mark, np.int64).tolist()
            new = mark not in seen
            seen.add(mark)
            found.append((int(key.view(np.int64)), first, second, start, len(part), many, part if new else None))
        return found

    return cut(text, repeated)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols or more, by doubling.

    The text is int64 with a 0 after every segment; each 0 is a symbol of its own. Ranks are first
    rows, so a suffix that stands alone is settled and only the others are sorted again.
    """
    n, ends = len(text), np.flatnonzero(text == 0)
    # Seven symbols at first. Behind a segment's end only zeros count, and ends differ by place.
    until = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(7):
        here = np.zeros(n, np.uint64)
        here[:max(n - k, 0)] = text[k:]
        here[until < k] = 0
        key = (key << np.uint64(8)) | here
    place = np.zeros(n, np.int64)
    close = until < 7
    place[close] = np.arange(n)[close] + 1  # unique among those that reach an end
    order = np.argsort(key)
    # Only those that reach an end tie by place; the order of others that tie is settled below.
    at_end = np.flatnonzero(close[order])
    ended = order[at_end]
    order[at_end] = ended[np.lexsort((ended, key[ended]))]
    fresh = np.concatenate([[True], (key[order[1:]] != key[order[:-1]]) | (place[order[1:]] != place[order[:-1]])])
    first_row = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first_row
    length = 7
    while length < depth:
        alone = fresh & np.append(fresh[1:], True)
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        those = order[rows]
        follow = rank[np.minimum(those + length, n - 1)]
        sort = np.argsort(rank[those] * n + follow)
        those, follow = those[sort], follow[sort]
        order[rows] = those
        own = rank[those]
        fresh[rows] = np.concatenate([[True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])])
        first_row = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order] = first_row
        length *= 2
    return order


def next_true(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For every row the next place behind it that is true; the last flag is."""
    if len(rows) > len(flags) // 64:
        places = np.flatnonzero(flags)
        return places[np.searchsorted(places, rows, "right")]
    stop, open_, width = rows + 1, np.arange(len(rows)), 4
    while len(open_):
        ahead = flags[np.minimum(stop[open_][:, None] + np.arange(width), len(flags) - 1)]
        first = ahead.argmax(1)
        found = ahead[np.arange(len(open_)), first]
        stop[open_] += np.where(found, first, width)
        open_ = open_[~found]
        width = max(1, min(2 * width, len(flags) // max(len(open_), 1)))
    return stop


def shared_rows(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Per row whether its suffix shares its first ``length`` symbols with the row before.

    Breadth-first over the Burrows-Wheeler transform. A boundary of level l between two rows says
    that they differ in their first l symbols. An interval between boundaries holds the suffixes
    that begin with one string w; the first row of each symbol c in it leads, one step back, to the
    first suffix that begins with cw, which is a boundary of level l + 1 unless it has been one
    already. Only intervals at boundaries of the last level are extended.
    """
    n = len(text)
    before = text[order - 1]
    by_symbol = np.argsort(before, kind="stable")  # row in the transform of each row's symbol
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)
    grouped = before[by_symbol]
    earlier = np.full(n, -1, np.int64)  # the row before with the same symbol
    same = grouped[1:] == grouped[:-1]
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    first = text[order]
    boundary = np.concatenate([[True], first[1:] != first[:-1], [True]])  # the last one is the end
    boundary[:n] |= first == 0
    newest = np.flatnonzero(boundary[:n])
    for _ in range(1, length):
        if not len(newest):
            break
        size = next_true(boundary, newest) - newest
        rows = np.repeat(newest - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        led = rows[(earlier[rows] < np.repeat(newest, size)) & (before[rows] != 0)]
        to = back[led]
        newest = np.sort(to[~boundary[to]])
        boundary[newest] = True
    return ~boundary[:n]


def repeated_windows(parts: list[bytes], length: int | None = None) -> list[np.ndarray]:
    """For every part a flag per window start: the window starts elsewhere in the parts, too."""
    length = length or LENGTH
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64)
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    if any(b"\0" in p for p in parts):
        text += 1  # bytes of value 0 must not look like ends
        text[begins + sizes] = 0
    # Symbols from 1 on; the first key of the order has eight bits for each.
    used = np.unique(text[text > 0])
    if len(used) > 255:
        return plain_repeats(parts, length)
    text = np.where(text > 0, np.searchsorted(used, text) + 1, 0)
    order = suffix_order(text, length)
    shared = shared_rows(text, order, length)
    shared |= np.append(shared[1:], False)
    flags = np.empty(len(text), bool)
    flags[order] = shared
    return [flags[a:a + max(n - length + 1, 0)] for a, n in zip(begins.tolist(), sizes.tolist())]


def plain_repeats(parts: list[bytes], length: int | None = None) -> list[np.ndarray]:
    """The same by counting windows, for the one case of all 256 byte values in a shard; valid UTF-8
    never gets here."""
    length = length or LENGTH
    seen: dict[bytes, int] = {}
    for p in parts:
        for i in range(len(p) - length + 1):
            seen[p[i:i + length]] = seen.get(p[i:i + length], 0) + 1
    return [np.array([seen[p[i:i + length]] > 1 for i in range(max(len(p) - length + 1, 0))], bool) for p in parts]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges [start, stop) of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(row, spans): sorted byte spans to remove, by row hash, for the texts that have any."""
    texts = in_small_batches(docs).select(row_hash(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    texts = texts.where(F.octet_length("text") >= length)
    found = lineage.cut(texts.select("row", anchors("text", length).alias("anchors")))
    each = found.select("row", F.explode("anchors").alias("x")).select("row", "x.hash", "x.n")
    often = each.groupBy("hash").agg(F.sum("n").alias("total")).where("total > 1").select("hash")
    repeated = each.join(often, "hash").groupBy("row").agg(F.collect_set("hash").alias("hashes"))
    cut = texts.join(repeated, "row").select("row", F.explode(segments("text", "hashes", length)).alias("s"))
    placed = lineage.cut(cut.select("row", "s.*"))
    settled = settle(placed, length)
    spans = placed.select("row", "key", "a", "b", "start").join(settled, ["key", "a", "b"])
    shifted = F.transform("ranges", lambda r: F.struct(
        (r["start"] + F.col("start")).alias("start"), (r["stop"] + F.col("start") + length - 1).alias("stop")))
    per_row = spans.select("row", shifted.alias("spans")).groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    return lineage.cut(per_row)


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def settle(placed: DataFrame, length: int) -> DataFrame:
    """(key, a, b, ranges): repeated window starts of every distinct segment that has any."""
    kinds = placed.groupBy("key", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.max("many").alias("many"))
    kinds = lineage.cut(kinds)
    groups = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("bytes"),
                                      F.max("many").alias("many"), F.max("n").alias("n"))
    # One kind that occurs once and cannot repeat itself is unique; one kind that occurs twice is
    # all repeated. The rest is compared.
    compared = lineage.cut(groups.where("kinds > 1 OR (many AND n = 1)").selectExpr(
        "key", f"CAST(ceil(bytes / {SHARD_BYTES}) AS bigint) AS parts", "bytes"))
    total = compared.agg(F.sum("bytes")).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    all_of = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), (F.col("size") - length + 1).alias("stop")))
    twice = kinds.where("n > 1").select("key", "a", "b", all_of.alias("ranges"))
    parts = placed.where("bytes IS NOT NULL").select("key", "a", "b", "bytes").join(
        compared.select("key", "parts"), "key").dropDuplicates(["key", "a", "b"])
    dealt = parts.select(
        "key", "a", "b", "bytes", (F.col("parts") > 1).alias("split"),
        F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), F.pmod("a", F.greatest("parts", F.lit(1))).alias("part"))
    dealt = dealt.withColumn("shard", F.when(F.col("split"), F.col("key")).otherwise(F.col("shard")))
    kind = ("key bigint, a bigint, b bigint, ranges array<struct<start:bigint,stop:bigint>>, "
            "marks array<struct<x:bigint,y:bigint,at:bigint>>")
    compared_ = lineage.cut(dealt.groupBy("split", "shard", "part").applyInPandas(giving_back_group(compare(length)), kind))
    inside = compared_.where(F.size("ranges") > 0).select("key", "a", "b", "ranges")
    return twice.unionByName(inside).unionByName(across(compared_))


def compare(length: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Repeated ranges inside a shard; for a group dealt over several also fingerprints of the
    windows not settled here (at >= 0) and of one of each repeated kind (at = -1)."""

    def in_shard(shard: pd.DataFrame) -> pd.DataFrame:
        parts = [bytes(b) for b in shard["bytes"]]
        flags = repeated_windows(parts, length)
        marks: list[list[dict] | None] = [None] * len(parts)
        if len(shard) and shard["split"].iloc[0]:
            seen: set[bytes] = set()
            for i, (part, flag) in enumerate(zip(parts, flags)):
                own = []
                for at, repeated in enumerate(flag.tolist()):
                    mark = xxhash.xxh3_128_digest(part[at:at + length])
                    if repeated and mark in seen:
                        continue
                    seen.add(mark)
                    x, y = np.frombuffer(mark, np.int64).tolist()
                    own.append({"x": x, "y": y, "at": -1 if repeated else at})
                marks[i] = own
        ranges = [[{"start": s, "stop": e} for s, e in runs(f)] for f in flags]
        return pd.DataFrame({"key": shard["key"], "a": shard["a"], "b": shard["b"], "ranges": ranges, "marks": marks})

    return in_shard


def across(compared: DataFrame) -> DataFrame:
    """Windows of divided groups that repeat between their shards."""
    marks = compared.where("marks IS NOT NULL").select("key", "a", "b", F.explode("marks").alias("m")).select(
        "key", "a", "b", "m.*")
    twice = marks.groupBy("key", "x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "x", "y")
    found = marks.where("at >= 0").join(twice, ["key", "x", "y"]).groupBy("key", "a", "b")
    one = F.transform(F.array_sort(F.collect_list("at")),
                      lambda at: F.struct(at.alias("start"), (at + 1).alias("stop")))
    return found.agg(one.alias("ranges"))


def without(data: bytes, spans: list) -> tuple[bytes, int]:
    """(remaining bytes, maximal removed runs); spans are sorted by their start."""
    kept, at, count = [], 0, 0
    for start, stop in spans:
        if start > at or not count:
            count += 1
            kept.append(data[at:start])
        at = max(at, stop)
    kept.append(data[at:])
    return b"".join(kept), count


def removal(text: Column | str, spans: Column | str) -> Column:
    """struct<n_bytes, n_removed, n_spans, kept_sha256, kept>; kept is null where nothing goes."""

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64()] * 3 + [pa.string()] * 2

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,kept:string>")
    @giving_back
    def remove(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in columns:
            found = []
            for text, own in zip(texts, lists):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                kept, count = data, 0
                if own.is_valid:
                    flat = own.values
                    starts, stops = (flat.field(i).to_numpy(zero_copy_only=False).tolist() for i in (0, 1))
                    kept, count = without(data, zip(starts, stops))
                found.append((len(data), len(data) - len(kept), count, hashlib.sha256(kept).hexdigest(),
                              kept.decode("utf-8", "ignore") if count else None))
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*found) if found else [[]] * 5, kinds)], names)

    return remove(text, spans)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       row_hash(id_col, text_col).alias("row"))
    joined = rows.join(repeated_spans(docs, id_col, text_col), "row", "left")
    out = joined.select("doc_id", removal("text", "spans").alias("r"))
    return out.select("doc_id", "r.n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256")


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows and columns of ``docs`` with repeated strings of ``length`` bytes removed from the text."""
    # The whole row travels in one column, so that no name of its own can clash.
    rows = docs.select(F.struct("*").alias("doc"), row_hash(id_col, text_col).alias("row"))
    joined = rows.join(repeated_spans(docs, id_col, text_col, length), "row", "left")
    text = F.col("doc").getField(text_col)
    kept = F.when(F.col("spans").isNull(), text).otherwise(removal(text, F.col("spans"))["kept"])
    return joined.select(F.col("doc").withField(f"`{text_col}`", kept).alias("doc")).select("doc.*")
