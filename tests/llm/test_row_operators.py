"""Packing, token counts, quality, language-model scores, WARC and link trust on small tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpweave.llm import link_trust, masked_lm, packing, quality, token_counts, warc
from corpweave.llm.arrow import utf8

ODD = [None, "", " ", "a", "The  end.\n\nIt's\x1cover 12.5 <|endoftext|> x", "é" * 700, "ΑΣ ΣΑΣ İx ́y", "word " * 6000, "z" * 9000]


def odd_texts():
    random.seed(6)
    alphabet = "ab  \n\té'sll🙂　0 12., -THE"
    return ODD + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(150)]


def frame(spark, texts):
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(0, texts[0]), (7, texts[7])]
    clash = "1 AS n_tokens", "'x' AS start", "2.5 AS score", "'s' AS length"
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", *clash).repartition(3)


def test_token_counts_equal_the_library(spark):
    rows, docs = frame(spark, odd_texts())
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    found = token_counts.token_counts(docs).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(docs.limit(0)).collect() == []


def test_prefix_counts():
    counter = token_counts.counter(token_counts.TOKENIZER)
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    for word in ["internationalisation", " Überraschung", "zzzzqqqq", " 1234567", "…—🙂"]:
        counts = counter.prefixes(word)
        assert counts == [len(library.encode(word[:i], add_special_tokens=False).ids) for i in range(len(word) + 1)]
    text = "The quick brown fox jumps over the lazy dog's back. " * 5
    counts = counter.prefixes(text)
    for budget in (0, 1, 7, 30, 10_000):
        assert counter.fitting(text, budget) == max(i for i, n in enumerate(counts) if n <= budget)


def test_packing(spark):
    rows, docs = frame(spark, odd_texts())
    library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    packed = packing.pack(docs, group_tokens=9000).collect()
    assert packing.pack(docs.limit(0)).collect() == []
    pieces, want = [], []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [packing.CLOSING_ID]
        for at in range(0, len(ids), 4096):
            part = ids[at:at + 4096]
            want.append((i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    sequences = {}
    for r in packed:
        pieces.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(pieces, key=repr) == sorted(want, key=repr)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_first_fit_decreasing_equals_a_plain_loop():
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 4097, 300)
    rooms, places = [], np.zeros(300, int)
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        if k == len(rooms):
            rooms.append(4096)
        rooms[k] -= lengths[i]
        places[i] = k
    assert (packing.first_fit_decreasing(lengths, 4096)[0] == places).all()


def test_quality_learns_and_scores_everything(spark):
    random.seed(1)
    good = lambda: " ".join(random.choice(["the", "house", "is", "old", "and", "green"]) for _ in range(90))
    bad = lambda: "".join(random.choice("#$%&*|") for _ in range(300))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)]
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "x"), (0, rows[0][1])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300)] + [(None, 1), (5, None), (7, 9)], "doc_id bigint, quality int")
    net = quality.fit(docs, labels)
    found = quality.judge(docs.selectExpr("*", "1 AS score"), net).collect()
    assert len(found) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    tested = [r for r in found if r["held_out"] and r["doc_id"] < 300]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in tested) >= 0.95 * len(tested)
    kept = quality.accepted(docs, net)
    assert kept.columns == docs.columns and kept.where("doc_id < 300").count() >= 190
    untrained = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.judge(docs, untrained).collect()} == {0.5}


def test_long_texts_score_alike_part_by_part(monkeypatch):
    net = quality.initial(3)
    raw, offsets = utf8(pa.array(["ab|c" * 40_000, "x", "yz" * 999]))
    assert abs(quality.long_score(raw[:160_000], net) - quality.forward(net, *quality.chunks(raw, offsets))["score"][0]) < 1e-6
    for n in range(1, 2000, 37):
        starts = quality.chunk_starts(n)
        assert starts[0] == 0 and starts[-1] + quality.CHUNK >= n and (np.diff(starts) == quality.STRIDE).all()


def test_gradients_of_the_quality_network():
    draw = np.random.default_rng(4)
    net = {k: v.astype(np.float64) for k, v in quality.initial(1).items()}
    pieces, firsts, wanted = draw.integers(0, 257, (5, quality.CHUNK)), np.array([0, 2]), np.array([1, 0])
    loss = lambda n: -np.mean(np.log(np.where(wanted == 1, s := quality.forward(n, pieces, firsts)["score"], 1 - s)))
    found = quality.gradients(net, pieces, firsts, wanted)
    for name in ("last", "hidden", "hidden_bias", "filter_bias", "filters", "bytes"):
        place = np.unravel_index(np.abs(found[name]).argmax(), net[name].shape)
        step = np.zeros_like(net[name])
        step[place] = 1e-6
        slope = (loss(net | {name: net[name] + step}) - loss(net | {name: net[name] - step})) / 2e-6
        assert found[name][place] == pytest.approx(slope, rel=1e-2)


def test_language_model(spark):
    random.seed(9)
    lines = [(i, " ".join(["red", "fox", "sees", "blue", "hen"] * 30)) for i in range(300)]
    docs = spark.createDataFrame(lines + [(900, None), (901, " "), (902, "hen fox RED blue sees " * 30), (0, lines[0][1])],
                                 "doc_id bigint, text string").selectExpr("*", "1 AS n_tokens").repartition(2)
    found = {r["doc_id"]: r for r in masked_lm.score(docs, *masked_lm.fit(docs)).collect()}
    assert found[900]["n_tokens"] == 0 and found[901]["log_likelihood"] == 0 and found[900]["mean_log_likelihood"] is None
    assert found[0]["n_tokens"] == 150 and found[0]["mean_log_likelihood"] > found[902]["mean_log_likelihood"]
    assert masked_lm.score(docs.limit(0), *masked_lm.fit(docs.limit(0))).collect() == []


def test_contexts_stop_at_text_ends():
    got = masked_lm.contexts(np.array([1, 2, 3, 4]), np.array([0, 3, 3, 4]))
    v = masked_lm.VOCABULARY
    assert got.tolist() == [[v, v, 2, 3], [v, 1, 3, v], [1, 2, v, v], [v, v, v, v]]


def test_warc_round_trip(spark):
    page = "<html><head><title>A &amp; B</title><style>p{}</style></head><body><p>One <b>two</b></p><a href='/x'>go</a><!-- no --></body></html>"
    pages = spark.createDataFrame([(1, "http://a.example/", page), (2, None, None), (1, "http://a.example/", page)],
                                  "page_id bigint, url string, html string").selectExpr("*", "1 AS warc")
    found = warc.derivatives(warc.responses(pages)).collect()
    assert len(found) == 6
    one = {r["record_type"]: r for r in found if r["page_id"] == 1}
    text, meta = one["conversion"], one["metadata"]
    assert text["content"] == "One two\ngo" and text["refers_to"] == meta["refers_to"] and text["concurrent_to"] == meta["record_id"]
    assert "title: A & B" in meta["content"] and "outlink: /x" in meta["content"] and "source-payload-digest-verified: true" in meta["content"]
    headers, block = warc.parse(bytes(text["warc"]))
    assert block.decode() == text["content"] and headers["warc-refers-to"] == text["refers_to"]
    assert headers["warc-block-digest"] == warc.digest(block) == text["block_digest"] and headers["warc-target-uri"] == "http://a.example/"
    broken = [None, b"", b"junk", warc.record([("WARC-Type", "request"), ("WARC-Record-ID", "x")], b""),
              warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "x")], b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n")]
    rows = warc.derivatives(spark.createDataFrame([(i, b) for i, b in enumerate(broken)], "page_id int, warc binary")).collect()
    assert len(rows) == 5 and all(r["problem"] and r["record_type"] is None for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []


def judged(spark, rows, **options):
    rules = [link_trust.Rule("allow", "com", "/"), link_trust.Rule("block", "example.com", "/en/"),
             link_trust.Rule("allow", "www.example.com", "/en/"), link_trust.Rule("block", "net", "/es/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'h' AS host", "1 AS trust")
    return {r["page_id"]: r for r in link_trust.judge(pages, rules, **options).collect()}


def test_rules_and_hosts(spark):
    rows = [(1, "HTTP://WWW.Example.com/en/a?x#y", ""), (2, "http://b.example.com/en/", None), (3, "http://example.com/EN/", ""),
            (4, "no url", "<a href='//x.org/'>"), (5, None, None), (6, "http://notexample.com/en/", ""), (7, "http://é.net#/es/", ""),
            (8, "http://a.com", ""), (9, "http://a.org/x", "")]
    found = judged(spark, rows)
    assert [(found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) for i in range(1, 10)] == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("b.example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "/EN/", "com/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("notexample.com", "/en/", "com/", "allow"), ("é.net", "", None, "allow"), ("a.com", "", None, "allow"), ("a.org", "/x", None, "allow")]
    assert judged(spark, []) == {}


def test_trust_and_distrust_equal_power_iteration(spark):
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p">l</a>' for h in hosts)
    rows = [(1, "http://bad.net/es/", ""), (2, "http://fan.org/1", link("bad.net", "bad.net", "good.com")),
            (3, "http://good.com/1", link("fine.org")), (4, "http://fine.org/1", link("good.com")), (5, "http://lone.org/", "")]
    found = judged(spark, rows)
    hosts = ["bad.net", "fan.org", "good.com", "fine.org", "lone.org"]
    ways = {("fan.org", "bad.net"): 2, ("fan.org", "good.com"): 1, ("good.com", "fine.org"): 1, ("fine.org", "good.com"): 1}

    def rank(edges, seed):
        seed = np.array([float(h == seed) for h in hosts])
        matrix = np.zeros((5, 5))
        for (a, b), w in edges.items():
            matrix[hosts.index(b), hosts.index(a)] = w / sum(x for (c, _), x in edges.items() if c == a)
        now = seed
        for _ in range(link_trust.ROUNDS):
            now = 0.15 * seed + 0.85 * matrix @ now
        return now

    trust, distrust = rank(ways, "good.com"), rank({(b, a): w for (a, b), w in ways.items()}, "bad.net")
    for page, host in ((1, "bad.net"), (2, "fan.org"), (3, "good.com"), (4, "fine.org"), (5, "lone.org")):
        at = hosts.index(host)
        assert found[page]["trust"] == pytest.approx(trust[at]) and found[page]["distrust"] == pytest.approx(distrust[at])
    assert [found[i]["verdict"] for i in range(1, 6)] == ["block", "block", "allow", "allow", "allow"]
