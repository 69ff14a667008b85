"""The news stream's keyed state: what is late or comes again costs the table nothing."""

import json

from corpweave.operators import news
from corpweave.sources import registry_table
from corpweave.streaming import news_stream
from tests.conftest import rows

HEAD = {"corporate_id": "C-1", "company": "x", "current_date": "2026-01-26"}


def document(*items):
    return json.dumps(HEAD | {"items": [
        {"corporate_id": "C-1", "url": url, "title": title, "date": date} for url, title, date in items]})


def test_late_and_repeated_items_write_nothing(spark, tmp_path, monkeypatch):
    folder, written, store = tmp_path / "in", [], registry_table.store
    folder.mkdir()

    def counted(spark, table, staged, keys):
        written.append(rows(staged.select("url", "title")))
        return store(spark, table, staged, keys)

    monkeypatch.setattr(registry_table, "store", counted)

    def files():
        return sorted(f.name for f in (tmp_path / "table").rglob("*.parquet"))

    def run(progress="progress"):
        written.clear()
        news_stream.start(news_stream.news_lines(spark, str(folder)), str(tmp_path / "table"),
                          str(tmp_path / "quarantine"), str(tmp_path / progress)).awaitTermination()
        table = registry_table.current(spark, str(tmp_path / "table"))
        return list(written), rows(table.select("url", "title"))

    (folder / "1").write_text(document(("u", "first", "2026-01-28"), ("u", "second", "2026-01-29"), ("v", "t", "2026-01-28")) + "\n")
    first = [("u", "second"), ("v", "t")]
    assert run() == ([first], first)
    # An older item, the same item again, and a line that cannot be read.
    (folder / "2").write_text(document(("u", "late", "2026-01-27"), ("v", "t", "2026-01-28")) + "\n{bad\n")
    before = files()
    assert run() == ([], first) and files() == before
    (folder / "3").write_text(document(("u", "late", "2026-01-27"), ("v", "news", "2026-02-01")) + "\n")
    assert run() == ([[("v", "news")]], [("u", "second"), ("v", "news")])
    assert rows(spark.read.parquet(str(tmp_path / "quarantine")).select("error")) == [("unreadable document",)]
    # Without its state the stream passes everything on, and the table has the last word.
    before = files()
    assert run("lost") == ([[]], [("u", "second"), ("v", "news")]) and files() == before


def test_overtaking_leaves_out_what_is_stored(spark):
    def items(*listed):
        lines = spark.createDataFrame([(document(*listed),)], "value string")
        return news.accepted(news.read_news(lines))

    table = items(("u", "a", "2026-01-28"), ("w", "z", "2026-01-28"))
    came = items(("u", "a", "2026-01-28"), ("u", "b", "2026-01-27"), ("v", "c", "2026-01-27"), ("w", "y", "2026-01-29"))
    found = news.overtaking(came, table)
    assert rows(found.select("url", "title")) == [("v", "c"), ("w", "y")]
    assert found.columns == came.columns
    assert rows(news.overtaking(came, None).select("url", "title")) == [("u", "a"), ("v", "c"), ("w", "y")]
    assert news.overtaking(came, came).collect() == []


def test_state_needs_no_python(spark, tmp_path):
    """Items of many keys would cross to Python one by one."""
    (tmp_path / "in").mkdir()
    lines = news_stream.news_lines(spark, str(tmp_path / "in"))
    items = news_stream.newest_so_far(news.accepted(news.read_news(lines)))
    plan = items._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan
