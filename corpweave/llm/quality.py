"""A byte-level convolutional network that scores the quality of whole texts, in numpy.

A text's bytes are cut into overlapping chunks that together cover all of it. Every byte becomes a
small vector, learned filters slide over each chunk, and each filter keeps its greatest response in
the chunk. A hidden layer turns a chunk's responses into features. A document pools its chunks twice,
by greatest value and by mean, and a last layer makes one probability of both. Only bytes go in.

Training takes a bounded sample of labelled rows to the driver (``TRAIN_ROWS`` of them by a hash of
the id, of each at most ``TRAIN_CHUNKS`` chunks spread over its text); scoring covers every byte of
every text and runs in tasks.

A null text counts as empty; an empty text is one chunk of padding and gets the score learned for
such a chunk. Rows are scored one by one, so repeated rows get equal scores. Without any labelled
row of both classes the network stays untrained and every score is 0.5. Labels on null ids and
labels other than 0 and 1 are left out; a repeated id counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, groups_of_rows, in_small_batches, utf8

CHUNK = 512
STRIDE = 448
DEPTH = 4  # numbers per byte
STEP = 4  # bytes between positions of a filter
FILTERS = 32
HIDDEN = 16
PAD = 256

#: Bound of the training sample: rows, and chunks of each row.
TRAIN_ROWS = 3000
TRAIN_CHUNKS = 12
EPOCHS = 12
LEAST_STEPS = 500  # a small sample is gone through more often
BATCH = 48
RATE = 4e-3
ACCEPT = 0.3


def chunk_starts(length: int) -> np.ndarray:
    """Chunk starts that cover ``length`` bytes, each chunk overlapping the one before it."""
    return np.arange(0, max(length - (CHUNK - STRIDE), 1), STRIDE)


def chunks(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunk bytes with PAD beyond a text's end, first chunk of every text)."""
    starts = [chunk_starts(b - a) for a, b in zip(offsets[:-1], offsets[1:])]
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in starts])])
    begins = np.concatenate([s + a for s, a in zip(starts, offsets[:-1])]).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(firsts))
    places = begins[:, None] + np.arange(CHUNK)
    padded = np.append(raw, np.uint8(0))
    found = padded[np.minimum(places, len(raw))].astype(np.int16)
    found[places >= ends[:, None]] = PAD
    return found, firsts[:-1]


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    scale = lambda *shape, fan: (draw.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)
    return {
        "bytes": scale(PAD + 1, DEPTH, fan=1),
        "filters": scale(2, STEP * DEPTH, FILTERS, fan=2 * STEP * DEPTH),
        "filter_bias": np.zeros(FILTERS, np.float32),
        "hidden": scale(FILTERS, HIDDEN, fan=FILTERS),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "last": scale(2 * HIDDEN, fan=2 * HIDDEN),
        "last_bias": np.zeros(1, np.float32),
    }


def forward(net: dict, pieces: np.ndarray, firsts: np.ndarray) -> dict:
    """All values of a pass over the chunks of some texts. A filter spans two steps of bytes."""
    vectors = net["bytes"][pieces].reshape(len(pieces), CHUNK // STEP, STEP * DEPTH)
    near, far = vectors @ net["filters"][0], vectors @ net["filters"][1]
    response = near[:, :-1] + far[:, 1:]
    at = response.argmax(axis=1)
    pooled = np.take_along_axis(response, at[:, None, :], 1)[:, 0] + net["filter_bias"]
    active = np.maximum(pooled, 0)
    feature = np.tanh(active @ net["hidden"] + net["hidden_bias"])
    most = np.maximum.reduceat(feature, firsts)
    counts = np.diff(np.append(firsts, len(feature)))
    mean = np.add.reduceat(feature, firsts) / counts[:, None]
    both = np.concatenate([most, mean], axis=1)
    score = 1 / (1 + np.exp(-(both @ net["last"] + net["last_bias"]).astype(np.float64)))
    return {"vectors": vectors, "at": at, "pooled": pooled, "active": active, "feature": feature,
            "most": most, "counts": counts, "both": both, "score": score}


def gradients(net: dict, pieces: np.ndarray, firsts: np.ndarray, wanted: np.ndarray) -> dict:
    seen = forward(net, pieces, firsts)
    owner = np.repeat(np.arange(len(firsts)), seen["counts"])
    wrong = ((seen["score"] - wanted) / len(wanted)).astype(np.float32)
    grad = {"last": seen["both"].T @ wrong, "last_bias": wrong.sum(keepdims=True)}
    to_both = wrong[:, None] * net["last"]
    to_most, to_mean = to_both[:, :HIDDEN], to_both[:, HIDDEN:]
    is_most = seen["feature"] == seen["most"][owner]
    to_feature = is_most * to_most[owner] + (to_mean / seen["counts"][:, None])[owner]
    to_hidden = (to_feature * (1 - seen["feature"] ** 2)).astype(np.float32)
    grad["hidden"] = seen["active"].T @ to_hidden
    grad["hidden_bias"] = to_hidden.sum(0)
    to_pooled = (to_hidden @ net["hidden"].T) * (seen["pooled"] > 0)
    grad["filter_bias"] = to_pooled.sum(0)
    rows = np.arange(len(pieces))[:, None]
    grad["filters"] = np.empty_like(net["filters"])
    grad["bytes"] = np.zeros_like(net["bytes"])
    grouped = pieces.reshape(len(pieces), CHUNK // STEP, STEP)
    for half in (0, 1):
        at = seen["at"] + half
        grad["filters"][half] = np.einsum("cfk,cf->kf", seen["vectors"][rows, at], to_pooled)
        back = np.einsum("cf,kf->cfk", to_pooled, net["filters"][half]).reshape(*at.shape, STEP, DEPTH)
        which = grouped[rows, at].ravel()
        for d in range(DEPTH):
            grad["bytes"][:, d] += np.bincount(which, back[..., d].ravel(), PAD + 1)
    return grad


def train(texts: list[tuple[np.ndarray, int]], seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on (chunks of a text, label) examples."""
    net, draw = initial(seed), np.random.default_rng(seed)
    if len({label for _, label in texts}) < 2:
        net["last"][:] = 0
        return net
    mean, square = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    batches = -(-len(texts) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    step, total = 0, epochs * batches
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            part = [texts[j] for j in order[i:i + BATCH]]
            pieces = np.concatenate([p for p, _ in part])
            firsts = np.concatenate([[0], np.cumsum([len(p) for p, _ in part])[:-1]])
            grad = gradients(net, pieces, firsts, np.array([y for _, y in part]))
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in grad.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                moved = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                net[k] = (net[k] - rate * moved).astype(np.float32)
    return net


def spread_chunks(raw: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """At most ``most`` chunks of every text, evenly spread over it."""
    for i, j in groups_of_rows(offsets):
        part = offsets[i:j + 1]
        pieces, firsts = chunks(raw[part[0]:part[-1]], part - part[0])
        for a, b in zip(firsts, [*firsts[1:], len(pieces)]):
            yield pieces[np.unique(np.linspace(a, b - 1, min(most, b - a)).astype(int))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = TRAIN_ROWS, most: int = TRAIN_CHUNKS) -> dict:
    """A network trained on a bounded sample of the labelled rows that are not held out."""

    @F.arrow_udf("binary")
    @giving_back
    def cut(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            raw, offsets = utf8(column)
            yield pa.array([p.tobytes() for p in spread_chunks(raw, offsets, most)], pa.binary())

    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    # Which rows is settled on the small table; the order also mixes the classes.
    chosen = known.orderBy(F.xxhash64("id", F.lit(1)), "id", "label").limit(rows)
    texts = in_small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cuts = texts.join(F.broadcast(chosen), "id").select("id", "label", cut("text").alias("pieces"))
    sample = cuts.groupBy("id", "label").agg(F.min("pieces").alias("pieces"))  # repeated ids count once
    found = sorted(sample.collect(), key=lambda r: (r["id"], r["label"], r["pieces"]))
    return train([(np.frombuffer(r["pieces"], np.int16).reshape(-1, CHUNK), r["label"]) for r in found])


def held_out(id_col: Column) -> Column:
    """Every fifth id by its checksum is kept for testing."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scores(raw: np.ndarray, offsets: np.ndarray, net: dict) -> np.ndarray:
    """Scores of all texts. Long texts are pooled part by part."""
    found = []
    for i, j in groups_of_rows(offsets, 256 * CHUNK):
        part = offsets[i:j + 1]
        if j == i + 1 and part[1] - part[0] > 512 * CHUNK:
            found.append([long_score(raw[part[0]:part[1]], net)])
        else:
            pieces, firsts = chunks(raw[part[0]:part[-1]], part - part[0])
            found.append(forward(net, pieces, firsts)["score"])
    return np.concatenate(found) if found else np.zeros(0)


def long_score(raw: np.ndarray, net: dict) -> float:
    """The score of one text of any length, over all its chunks, some at a time."""
    starts, most, total = chunk_starts(len(raw)), -np.inf, 0.0
    for i in range(0, len(starts), 256):
        a, last = starts[i], starts[min(i + 256, len(starts)) - 1]
        part = raw[a:last + CHUNK]
        padded = np.full(last + CHUNK - a, PAD, np.int16)
        padded[:len(part)] = part
        pieces = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[starts[i:i + 256] - a]
        feature = forward(net, pieces, np.array([0]))["feature"]
        most, total = np.maximum(most, feature.max(0)), total + feature.sum(0)
    both = np.concatenate([most, total / len(starts)])
    return float(1 / (1 + np.exp(-float(both @ net["last"] + net["last_bias"][0]))))


def score_column(net: dict, text: Column | str) -> Column:
    """The score of a text column as a column."""

    @F.arrow_udf("double")
    @giving_back
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(scores(*utf8(column), net), pa.float64())

    return score(text)


def judge(docs: DataFrame, net: dict, id_col: str = "doc_id", text_col: str = "text",
          accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    scored = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), score_column(net, F.col(text_col)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted(docs: DataFrame, net: dict, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text the network accepts."""
    return in_small_batches(docs).where(score_column(net, F.col(text_col)) >= accept)
