"""Rows of one id in the near-duplicate and repeated-string stages."""

import corpus_pipeline


def test_repeated_rows_keep_one_text(spark):
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(120))
    rows = [(1, text(1)), (1, text(1)), (2, text(2)), (3, text(2)), (3, text(3)), (4, None), (4, None), (None, text(5))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'s' AS source")
    steps = dict(corpus_pipeline.STAGES)
    alone = steps["MinHash near-dedup"](spark, docs, "")
    assert alone.columns == docs.columns
    wanted = sorted([(1, text(1)), (2, text(2)), (3, text(3)), (4, None), (4, None), (None, text(5))], key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in alone.collect()), key=repr) == wanted
    cut = steps["suffix-array dedup"](spark, alone, "")
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect() if r["text"]), key=repr) == [w for w in wanted if w[1]]
