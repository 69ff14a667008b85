"""How ways and texts reach the blocks of the masked model."""

import random

import numpy as np
import pyarrow as pa

from corpweave.llm import masked_lm


def test_ways_travel_many_to_a_row_and_rounds_are_stored_one_by_one(spark, monkeypatch):
    stored, cut = [], masked_lm.lineage.cut

    def noted(df, *by, **options):
        found = cut(df, *by, **options)
        stored.append((found.columns, found.count()))
        return found

    monkeypatch.setattr(masked_lm.lineage, "cut", noted)
    monkeypatch.setattr(masked_lm, "FREQUENT", 0)
    monkeypatch.setattr(masked_lm, "SMALL_PART_BYTES", 4000)
    random.seed(6)
    names = [f"n{i}" for i in range(5000)]
    docs = spark.createDataFrame(
        [(i, " ".join(random.choices(names, k=200))) for i in range(200)], "doc_id bigint, text string").repartition(4)
    blocks = masked_lm.fit(docs)[0].blocks.select("turn", "block").collect()
    assert {r["turn"] for r in blocks} == set(range(masked_lm.ROUNDS))
    assert all(r["turn"] == r["block"] % masked_lm.ROUNDS for r in blocks)
    words = next(n for columns, n in stored if columns == ["home", "word", "n"])
    (listed,) = (n for columns, n in stored if {"home", "turns"} <= set(columns))
    assert words > 10_000 and listed < words / 100
    rounds = [n for columns, n in stored if "rows" in columns]
    assert len(rounds) == masked_lm.ROUNDS and sum(rounds) == len(blocks)


def test_packed_ways_come_back_in_order(monkeypatch):
    monkeypatch.setattr(masked_lm, "PACKED_WORDS", 700)  # so that a block's words are in several rows
    rng = np.random.default_rng(9)
    words = np.unique(rng.integers(-(1 << 63), 1 << 62, 3000))
    ways = masked_lm.halved(pa.table({"word": words, "n": rng.zipf(1.5, len(words))})).drop(["n"])
    unknown = pa.table({"word": [(1 << 62) + i for i in range(5)]})
    listed = pa.concat_tables([ways, unknown], promote_options="default")
    listed = listed.append_column("home", pa.array(rng.integers(0, 3, len(listed)), pa.int32()))
    mixed = listed.take(rng.permutation(len(listed))).combine_chunks()
    rows = pa.Table.from_batches(masked_lm.packed(iter(mixed.to_batches(max_chunksize=100))))
    assert 3 < len(rows) < 30
    for home in range(3):
        wanted = masked_lm.listed_ways(listed.filter(pa.compute.equal(listed["home"], home)))
        found = masked_lm.unpacked(rows.filter(pa.compute.equal(rows["home"], home)))
        assert all(np.array_equal(found[c], wanted[c]) and found[c].dtype == wanted[c].dtype for c in masked_lm.WAY_TYPES)
    assert (found["depth"] == -1).any() and all(not len(x) for x in masked_lm.unpacked(rows.slice(0, 0)).values())
