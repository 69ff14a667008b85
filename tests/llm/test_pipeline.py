"""The pipeline stage by stage against plain versions, and the queries with SQL."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpweave.llm import packing, quality, queries
from tests.llm import test_decontaminate, test_near_duplicates, test_repeats

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


def stored(spark, frame, path):
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 90").selectExpr("*", "1 AS _spans")
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == len(corpus_pipeline.STAGES) == 5
    run = lambda name, before: stored(spark, steps[name](spark, before, FOLDER), f"{tmp_path}/{name}")
    good = run("quality classifier", docs)
    net = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    accepted = {r["doc_id"] for r in quality.judge(docs, net).where("predicted = 1").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == accepted
    pairs = lambda frame: [(r["doc_id"], r["text"]) for r in frame.collect()]
    alone = run("MinHash near-dedup", good)
    kept = {i for i, _, _, kept in test_near_duplicates.brute(pairs(good)) if kept}
    assert alone.columns == docs.columns and {i for i, _ in pairs(alone)} == kept
    cut = run("suffix-array dedup", alone)
    left = {r[0]: (r[1] - r[2], r[3]) for r in test_repeats.brute(pairs(alone))}
    assert cut.columns == docs.columns and {i for i, _ in pairs(cut)} == set(left)
    for i, text in pairs(cut):
        size, spans = left[i]
        assert size - 6 * spans <= len(text.encode()) <= size  # but for halves of characters
    clean = run("benchmark decontamination", cut)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {i for i, _ in pairs(clean)} == {r[0] for r in test_decontaminate.brute(pairs(cut), items) if not r[5]}
    packed = run("packing", clean)
    ids = packing.word_ids(packing.TOKENIZER)
    tokens = {i: len(ids.text(t)) // 4 + 1 for i, t in pairs(clean)}
    summed = {r[0]: r[1] for r in packed.groupBy("doc_id").sum("length").collect()}
    assert summed == tokens


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 11)} == {n.split("_")[0] for n in queries.QUERIES}
    assert set(entry.queries()) >= {*queries.QUERIES, "pipeline"} and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = queries.QUERIES[name](spark, FOLDER)
    wanted = db.execute(queries.SQL[name]).df()
    got = sorted(tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect())
    assert got == sorted(wanted[sorted(wanted.columns)].itertuples(index=False, name=None))
