"""Blocks of phrases one after the other."""

import pytest

from corpweave.llm import decontaminate


@pytest.mark.parametrize("cleaning", [False, True])
def test_a_block_is_stored_before_the_next_is_made(spark, monkeypatch, cleaning):
    words = [f"w{i}" for i in range(60)]
    benchmark = spark.createDataFrame([("a", " ".join(words[:40])), ("b", " ".join(words[20:]))], "item_id string, text string")
    texts = [" ".join(words), " ".join(words[:30]), "nothing here", None, " ".join(words[45:])]
    docs = spark.createDataFrame([(1, t) for t in texts] + [(None, texts[0])], "doc_id bigint, text string")
    whole = sorted(map(str, decontaminate.contamination(docs, benchmark, window=5).collect()))
    events, make, cut = [], decontaminate.blocks, decontaminate.lineage.cut

    def blocks(found, most=7):
        for block in make(found, 7):
            events.append("block")
            yield block

    monkeypatch.setattr(decontaminate, "blocks", blocks)
    monkeypatch.setattr(decontaminate.lineage, "cut", lambda df: events.append("stored") or cut(df))
    if cleaning:
        assert [r["text"] for r in decontaminate.clean(docs, benchmark, window=5).collect()] == ["nothing here", None]
    else:
        assert sorted(map(str, decontaminate.contamination(docs, benchmark, window=5).collect())) == whole
    # The second block is made to see whether there is one.
    assert events.count("block") >= 5 and events[:2] == ["block"] * 2 and "block block" not in " ".join(events[2:])
