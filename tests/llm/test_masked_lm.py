"""The masked model's vocabulary, chances and training against plain versions."""

import pickle
import random

import numpy as np
import pyarrow as pa
import pytest

from corpweave.llm import masked_lm
from corpweave.llm.words import mix, word_hashes


def frame(spark, texts, parts=2):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)


def hashed(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0]


def test_every_word_has_its_own_count(spark):
    """More words than any fixed table has rows; a word never seen is no likelier than one seen once."""
    texts = [" ".join(f"w{i}" for i in range(k, k + 500)) for k in range(0, 40_000, 500)] + ["w7 " * 90]
    corpus, net = masked_lm.fit(frame(spark, texts))
    counts = {r["word"]: r["n"] for r in corpus.ways.collect()}
    assert len(counts) == 40_000 and counts[hashed("w7").view(np.int64)[0]] == 91
    net["out"][:] = 0  # as before training: shares of the counts
    found = masked_lm.score(frame(spark, ["w7", "w8", "never", "again"]), corpus, net).collect()
    seven, once, never, again = (r["log_likelihood"] for r in sorted(found))
    all_words = 40_000 + 90 + 4096 * min(1, 40_000 / 4096)
    assert np.allclose([seven, once, never, again], np.log(np.array([91, 1, 1, 1]) / all_words))


def test_broadcasts_can_be_read_without_the_package(spark, monkeypatch):
    sent, send = [], type(spark.sparkContext).broadcast

    def noted(self, value):
        sent.append(pickle.dumps(value))
        return send(self, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    docs = frame(spark, ["red fox sees blue", "old hen eats corn"])
    assert masked_lm.score(docs, *masked_lm.fit(docs)).count() == 2
    assert len(sent) == masked_lm.ROUNDS + 2 and not any(b"corpweave" in x for x in sent)


def test_sums_of_a_group_come_from_all_its_batches():
    batch = lambda rows: pa.RecordBatch.from_pylist([{"chunk": 3, "words": n, "weights": w} for n, w in rows])
    (found,) = masked_lm.added(iter([batch([(1, [1.0, 2.0]), (2, [3.0, 4.0])]), batch([(5, [0.5, 0.5])])]))
    assert found.to_pylist() == [{"chunk": 3, "words": 8, "weights": [4.5, 6.5]}]


def ways_in(listed):
    return masked_lm.as_ways(**masked_lm.listed_ways(listed))


def rows_of(hashes, ways):
    return np.searchsorted(ways.words, hashes.view(np.int64))


def same_bucket():
    """Two words that fall into one bucket."""
    seen = {}
    for i in range(10_000):
        b = int(hashed(f"x{i}")[0]) >> (64 - masked_lm.LEVELS)
        if b in seen:
            return seen[b], f"x{i}"
        seen[b] = f"x{i}"


def test_every_word_is_judged_from_both_sides(spark):
    """Two words of one bucket and one count: each is likelier where it has been seen."""
    x, y = same_bucket()
    docs = frame(spark, [f"red fox {x} sees blue " * 60, f"old hen {y} eats corn " * 60] * 100)
    corpus, net = masked_lm.fit(docs)
    tries = [f"red fox {x} sees blue", f"red fox {y} sees blue", f"old hen {x} eats corn", f"old hen {y} eats corn"]
    words = masked_lm.words_of(masked_lm.in_parts(frame(spark, [" ".join(tries)]), "doc_id", "text")[0])
    ways = ways_in(masked_lm.entries(words, corpus.ways).toArrow())
    xx, xy, yx, yy = (masked_lm.chances(rows_of(hashed(t), ways), np.array([0, 5]), corpus.shares, ways, net)[2] for t in tries)
    assert xx > xy + 0.3 and yy > yx + 0.3


def test_scores_do_not_depend_on_partitions(spark):
    random.seed(8)
    texts = [" ".join(random.choices(["red", "fox", "sees", "blue", "hen", "corn"], k=300)) for _ in range(300)]
    texts += [f"old hen eats {i}" for i in range(50)]
    found = []
    for parts in (1, 40):
        docs = frame(spark, texts, parts)
        found.append([r["log_likelihood"] for r in masked_lm.score(docs, *masked_lm.fit(docs)).orderBy("doc_id").collect()])
    assert np.allclose(*found, rtol=1e-4)


def plain(text, counts, net):
    """Log-chance of every word of a text, turn by turn."""
    words, levels, buckets = hashed(text), masked_lm.LEVELS, masked_lm.BUCKETS
    new = min(1, (sum(n == 1 for n in counts.values()) + 1) / buckets)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    bucket_of = lambda w: int(w) >> (64 - levels)
    inside = {}
    for w, n in counts.items():
        inside.setdefault(bucket_of(w), []).append((-n, int(w)))
    whole = [new - sum(n for n, _ in inside.get(b, [])) for b in range(buckets)]
    found = []
    for k, w in enumerate(words):
        vectors = []
        for j in (k - 2, k - 1, k + 1, k + 2):
            rows = [(int(words[j]) >> s) % masked_lm.VOCABULARY for s in (0, 20)] if 0 <= j < len(words) else [masked_lm.VOCABULARY] * 2
            vectors.append(net["words"][rows[0]] + net["words"][rows[1]])
        h = np.maximum(np.concatenate(vectors) @ net["hidden"] + net["hidden_bias"], 0)
        b, total = bucket_of(w), 0.0
        for level in range(levels):
            size = buckets >> level
            low = b // size * size
            left, right = sum(whole[low:low + size // 2]), sum(whole[low + size // 2:low + size])
            p = sigmoid(np.log(right / left) + h @ net["out"][(1 << level) + (b >> (levels - level))])
            total += np.log(p if b % size >= size // 2 else 1 - p)
        if int(w) not in counts:
            found.append(total + np.log(new / whole[b]))
            continue
        total += np.log(1 - new / whole[b])
        here, code, node = sorted(inside[b]), buckets + b, buckets + b
        while len(here) > 1:
            sums = np.cumsum([-n for n, _ in here])
            cut = min(range(1, len(here)), key=lambda c: (abs(sums[c - 1] - sums[-1] / 2), -c))
            p = sigmoid(np.log((sums[-1] - sums[cut - 1]) / sums[cut - 1]) + h @ net["out"][node])
            second = int(w) in {v for _, v in here[cut:]}
            total += np.log(p if second else 1 - p)
            here, code = (here[cut:] if second else here[:cut]), 2 * code + second
            node = 2 * buckets + int(mix(np.array([code], np.uint64))[0]) % masked_lm.SHARED
        found.append(total)
    return found


@pytest.mark.parametrize("frequent", [100, masked_lm.FREQUENT])
def test_scores_equal_a_plain_loop_and_chances_sum_to_one(spark, monkeypatch, frequent):
    monkeypatch.setattr(masked_lm, "FREQUENT", frequent)
    random.seed(4)
    names = [f"n{i}" for i in range(9000)]
    texts = [" ".join(random.choices(names, [1 / (i + 1) for i in range(9000)], k=400)) for _ in range(60)]
    corpus, net = masked_lm.fit(frame(spark, texts))
    counts = {int(h): n for h, n in zip(*np.unique(np.concatenate([hashed(t) for t in texts]), return_counts=True))}
    asked = [texts[0][:200], "n1 never n2 seen n3", "n0"]
    found = {r["doc_id"]: r["log_likelihood"] for r in masked_lm.score(frame(spark, asked), corpus, net).collect()}
    for i, t in enumerate(asked):
        assert np.isclose(found[i], sum(plain(t, counts, net)), rtol=1e-4)
    # In one place: every known word, and of every bucket a word never seen.
    ways = ways_in(corpus.ways.toArrow())
    never = np.arange(masked_lm.BUCKETS, dtype=np.uint64) << np.uint64(64 - masked_lm.LEVELS)
    every = np.concatenate([np.array(list(counts), np.uint64), never])
    ways = masked_lm.Ways(*with_unknown(ways, never))
    a, b, c, d = (hashed(w)[0] for w in ("n0", "n1", "n2", "n3"))
    words = np.array([[a, b, w, c, d] for w in every], np.uint64).ravel()
    each = masked_lm.chances(rows_of(words, ways), np.arange(0, len(words) + 1, 5), corpus.shares, ways, net).reshape(-1, 5)[:, 2]
    assert np.isclose(np.exp(each).sum(), 1, atol=1e-4)


def with_unknown(ways, never):
    words = np.concatenate([ways.words, never.view(np.int64)])
    sizes = np.concatenate([np.diff(ways.firsts), np.zeros(len(never), np.int64)])
    known = np.concatenate([ways.known, np.zeros(len(never), bool)])
    order, starts = np.argsort(words), np.concatenate([ways.firsts[:-1], np.full(len(never), ways.firsts[-1])])
    at = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in order])
    return words[order], known[order], np.concatenate([[0], np.cumsum(sizes[order])]), ways.turns[at], ways.odds[at]


def test_repeated_rows_get_equal_scores(spark):
    """Also next to texts that move them to other places of a batch, without words and without an id."""
    random.seed(5)
    names = [f"n{i}" for i in range(3000)]
    texts = [" ".join(random.choices(names, k=random.randint(1, 900))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] * 3 + [(None, texts[0])] * 2 + [(None, None), (None, ""), (50, " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = masked_lm.score(docs, *masked_lm.fit(docs)).collect()
    assert len(found) == len(rows) and len(set(found)) == len(texts) + 3
    assert all(r["log_likelihood"] < 0 or r["n_tokens"] == 0 for r in found)


def test_frequent_words_leave_out_ties_with_the_rest(spark, monkeypatch):
    ways = masked_lm.fit(frame(spark, ["a a a b b c c d"]))[0].ways
    for most, kept in ((0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (9, 4)):
        monkeypatch.setattr(masked_lm, "FREQUENT", most)
        assert masked_lm.frequent_of(ways).num_rows == kept


def test_ways_of_frequent_words_are_looked_up():
    words = np.sort(np.random.default_rng(7).integers(-(1 << 63), 1 << 62, 50_000))
    n = np.random.default_rng(8).zipf(1.4, len(words))
    listed = masked_lm.halved(pa.table({"word": words, "n": n}))
    whole, often = ways_in(listed), np.asarray(listed["n"]) > 3
    assert 0 < often.sum() < len(words)
    frequent, rare = (masked_lm.listed_ways(listed.filter(pa.array(x))) for x in (often, ~often))
    found = masked_lm.all_ways(words, frequent, *(rare[c] for c in masked_lm.WAY_TYPES if c != "word"))
    assert all(np.array_equal(x, y) for x, y in zip(found, whole))
    none = {c: x[:0] for c, x in frequent.items()}
    every = masked_lm.listed_ways(listed)
    found = masked_lm.all_ways(words, none, *(every[c] for c in masked_lm.WAY_TYPES if c != "word"))
    assert all(np.array_equal(x, y) for x, y in zip(found, whole))


def test_parts_of_a_block_share_their_turn(spark):
    rows = spark.range(3000).selectExpr("id doc_id", "repeat('some word ', 100) text")
    parts, number = masked_lm.in_parts(rows, "doc_id", "text")
    found = parts.select("part", "block").distinct().collect()
    assert number == 3000 * 1000 // masked_lm.SMALL_PART_BYTES == len(found)
    assert all(r["part"] % masked_lm.ROUNDS == r["block"] % masked_lm.ROUNDS for r in found)
    assert len({r["block"] for r in found}) == masked_lm.ROUNDS


def test_gradients_are_those_of_the_chances():
    """A step on one batch moves every weight against the slope of the summed log-chance."""
    rng = np.random.default_rng(3)
    words = np.unique(rng.integers(-(1 << 63), 1 << 62, 60))
    n = np.arange(1, len(words) + 1)
    ways = ways_in(masked_lm.halved(pa.table({"word": words, "n": n})))
    known = masked_lm.Shares(*(np.zeros(masked_lm.BUCKETS) for _ in range(3)))
    rows, firsts = rng.integers(0, len(words), 50), np.array([0, 20, 20, 50])
    start = {k: (v + rng.standard_normal(v.shape) * 0.1).astype(np.float32) for k, v in masked_lm.initial().items()}
    net = {k: v.copy() for k, v in start.items()}
    # Sums so large that a step is the slope, scaled.
    sums = {k: np.full(v.shape if v.ndim == 1 else (len(v), 1), 1e8, np.float32) for k, v in net.items()}
    masked_lm.learn(net, sums, masked_lm.both_contexts(words[rows].view(np.uint64), firsts), masked_lm.branches(rows, known, ways)[0])
    gain = lambda x: masked_lm.chances(rows, firsts, known, ways, x).sum()
    for k in masked_lm.SHAPES:
        slope = (net[k] - start[k]).astype(np.float64) * 1e4 / masked_lm.RATE
        for place in rng.permutation(np.flatnonzero(np.abs(slope) > np.abs(slope).max() / 3))[:4]:
            tried = [{**start, k: start[k].astype(np.float64)} for _ in range(2)]
            for x, by in zip(tried, (1e-3, -1e-3)):
                x[k].flat[place] += by
            assert np.isclose((gain(tried[0]) - gain(tried[1])) / 2e-3, slope.flat[place], rtol=0.03, atol=0.02)


def test_parts_have_one_turn_whatever_their_number(spark, monkeypatch):
    blocks = spark.createDataFrame([(t,) for t in range(masked_lm.ROUNDS)], "turn int")
    for number in (1, 4, 4000):
        taken = []
        monkeypatch.setattr(masked_lm, "one_round", lambda mine, *_: taken.append([r["turn"] for r in mine.collect()]))
        masked_lm.train(blocks, None, number, None, {})
        assert taken == [[t] for t in range(masked_lm.ROUNDS)]
