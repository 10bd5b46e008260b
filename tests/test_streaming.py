"""Arriving batches are run once each."""

import pytest
from feeds import scenario, write_feeds

from tidemark import DataContractError
from tidemark.session import tune
from tidemark.sinks.commits import read_table
from tidemark.streaming.arrivals import run_arrivals


def batches(spark, target):
    rows = read_table(tune(spark), target, "gold/daily_revenue").select("batch_id").distinct().collect()
    return sorted(row["batch_id"] for row in rows)


def stored_at(tmp_path, batch):
    (marker,) = (tmp_path / f"lake/gold/daily_revenue/batch_id={batch}").glob("run_id=*/_SUCCESS")
    return marker.stat().st_mtime_ns


def test_complete_batches_run_once(spark, tmp_path):
    inbox, target = tmp_path / "inbox", str(tmp_path / "lake")
    checkpoint = str(tmp_path / "checkpoint")
    for name in ("001", "002"):
        write_feeds(inbox / name, *scenario())
    (inbox / "001.ready").write_text("done\n")
    run_arrivals(spark, str(inbox), target, checkpoint)
    assert batches(spark, target) == ["001"]
    first = stored_at(tmp_path, "001")
    (inbox / "002.ready").write_text("done\n")
    run_arrivals(spark, str(inbox), target, checkpoint)
    assert batches(spark, target) == ["001", "002"]
    assert stored_at(tmp_path, "001") == first


def test_a_bad_batch_does_not_hold_up_the_others(spark, tmp_path):
    inbox, target = tmp_path / "inbox", str(tmp_path / "lake")
    for name in ("001", "002"):
        write_feeds(inbox / name, *scenario())
        (inbox / f"{name}.ready").write_text("done\n")
    (inbox / "001/offers.csv").write_text("offer_id\n")
    with pytest.raises(ExceptionGroup, match="001") as error:
        run_arrivals(spark, str(inbox), target, str(tmp_path / "checkpoint"))
    assert isinstance(error.value.exceptions[0], DataContractError)
    assert batches(spark, target) == ["002"]
