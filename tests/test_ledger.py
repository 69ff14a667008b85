"""Adjudication that is broken off and gone on with."""

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from corpweave.operators import adjudicate
from tests.conftest import rows

SCHEMA = "left_id string, right_id string, left_company_name string, right_company_name string"


def pairs_of(spark, count):
    return spark.createDataFrame([(f"l{i}", f"r{i}", f"name {i % 40}", f"name {i % 40}x") for i in range(count)], SCHEMA)


def scorer_into(folder, dies_after=None):
    """A scorer that notes every request as a file, as scorers run in other processes."""

    def score(request):
        import hashlib

        pairs = json.loads(request)["pairs"]
        if dies_after is not None and len(list(Path(folder).iterdir())) >= dies_after:
            raise RuntimeError("service is gone")
        (Path(folder) / hashlib.md5(request.encode()).hexdigest()).write_text(
            json.dumps([p["left_company_name"] for p in pairs]))
        return json.dumps({"results": [{"left_id": p["left_id"], "right_id": p["right_id"], "match": True, "match_confidence": 0.5}
                                       for p in pairs]})

    return score


def asked(folder):
    return sorted(n for f in folder.iterdir() for n in json.loads(f.read_text()))


def test_a_restart_asks_only_for_the_rest(spark, tmp_path):
    ledger, first, second = (tmp_path / n for n in ("ledger", "first", "second"))
    first.mkdir(), second.mkdir()
    pairs = pairs_of(spark, 100)
    with pytest.raises(PySparkException, match="service is gone"):
        adjudicate.ask_once(pairs, scorer_into(first, 15), str(ledger), batch=2, portion=5)
    kept = sorted(t for r in adjudicate.ledger_of(spark, str(ledger)).collect() for t in r["tags"])
    found = adjudicate.adjudicate_names(pairs, scorer_into(second), batch=2, ledger=str(ledger))
    assert rows(found) == sorted(((f"l{i}", f"r{i}", True, 0.5) for i in range(100)), key=repr)
    # What was stored is not asked again, all else is, once per pair of names.
    assert kept and len(asked(second)) == 40 - len(kept)
    everything = adjudicate.ledger_of(spark, str(ledger)).collect()
    assert len({t for r in everything for t in r["tags"]}) == sum(len(r["tags"]) for r in everything) == 40
    third = tmp_path / "third"
    third.mkdir()
    adjudicate.ask_once(pairs, scorer_into(third), str(ledger))
    assert asked(third) == []


def test_null_and_empty_names_have_tags_of_their_own(spark, tmp_path):
    data = [("1", "2", None, "a"), ("3", "4", "", "a"), ("5", "6", "a", None), ("7", "8", "a", "")]
    folder = tmp_path / "asked"
    folder.mkdir()
    found = adjudicate.adjudicate_names(spark.createDataFrame(data, SCHEMA), scorer_into(folder), ledger=str(tmp_path / "ledger"))
    assert {r[:2] for r in rows(found)} == {(a, b) for a, b, *_ in data} and sum(len(json.loads(f.read_text())) for f in folder.iterdir()) == 4


def test_nothing_to_ask(spark, tmp_path):
    assert rows(adjudicate.adjudicate_names(pairs_of(spark, 1).limit(0), scorer_into(tmp_path), ledger=str(tmp_path / "l"))) == []


def test_the_number_of_jobs_that_ask_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adjudicate, "ROUNDS", 4, raising=False)
    folder, ledger, at = tmp_path / "asked", str(tmp_path / "ledger"), tmp_path / "kept"
    folder.mkdir()
    monkeypatch.setattr(adjudicate.lineage, "new_folder", lambda _: f"{at}/{len(list(at.glob('*')))}")
    adjudicate.ask_once(pairs_of(spark, 40), scorer_into(folder), ledger, batch=1, portion=1)
    assert len(set(at.glob("*/portion=*"))) <= 4
    assert asked(folder) == sorted(f"name {i}" for i in range(40))
