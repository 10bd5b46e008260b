"""What runs leave on disk, and for how long."""

import time
from pathlib import Path

import pytest
from feeds import scenario, write_feeds
from pyspark.sql import functions as F

from tidemark import run_pipeline, scratch
from tidemark.catalog import star
from tidemark.catalog.queries import QUERIES
from tidemark.session import tune
from tidemark.sources import landing

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return [name for name in manager.getAllBlocks().mkString("\n").split("\n") if name.startswith("shuffle_")]


def test_shuffle_files_go_with_their_query(spark):
    before = set(shuffle_files(spark))
    rows = tune(spark).range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert len(rows.collect()) == 10 and len(rows.collect()) == 10
    until = time.time() + 10
    while set(shuffle_files(spark)) - before and time.time() < until:
        time.sleep(0.1)
    assert set(shuffle_files(spark)) <= before


@pytest.mark.parametrize("name", ["files_to_gold", "two_batches", "files_to_damaged_ranges"])
def test_written_feeds_go_once_they_are_landed(spark, name):
    rows = QUERIES[name](spark, SF)
    root = next(Path(s.root) for s in reversed(scratch._until_exit) if (Path(s.root) / "lake").is_dir())
    assert not (root / "source").exists()
    assert rows.count()


def test_a_source_may_go_when_its_copy_is_proven(spark, tmp_path, monkeypatch):
    source = str(write_feeds(tmp_path / "source", *scenario()))
    gone = []
    run = run_pipeline(spark, source, str(tmp_path / "lake"), when_landed=lambda: gone.append(1))
    assert gone == [1] and run.metrics["source_rows"]["bookings"]
    monkeypatch.setattr(landing, "intact", lambda landed: False)
    run_pipeline(spark, source, str(tmp_path / "other"), when_landed=lambda: gone.append(2))
    assert gone == [1]


def test_feeds_are_shuffled_before_they_are_text(spark):
    for rows, texts, order in (
        (star.placed_lines(spark, SF), star.booking_texts(), ["booking_id", "updated_at"]),
        (star.closed_lines(spark, SF), star.payment_texts(), ["payment_id", "paid_at"]),
    ):
        found = star._in_order(rows, texts, order)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index(f"AS {order[0]}") < plan.index("Exchange rangepartitioning")
        keys = [tuple(row[name] for name in order) for row in found.collect()]
        assert keys == sorted(keys) and len(keys) == rows.count()


def test_sorted_parts_of_one_file_are_compressed(spark, tmp_path, monkeypatch):
    seen, one_file = [], star._one_file

    def watched(spark, parts, path, header):
        seen.extend(file.name for file in Path(parts).glob("part-*"))
        one_file(spark, parts, path, header)

    monkeypatch.setattr(star, "_one_file", watched)
    star.write_one_file_feeds(spark, SF, str(tmp_path / "one"), whole=("payments",))
    assert seen and all(name.endswith(".json.gz") for name in seen)
    (file,) = (tmp_path / "one" / "payments.jsonl").glob("part-*")
    assert file.read_bytes().count(b"\n") == star.closed_lines(spark, SF).count()


def test_feeds_without_rows_have_their_headers(spark, tmp_path):
    for name in ("customer", "orders", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.read.parquet(f"{SF}/lineitem.parquet").where("false").write.parquet(str(tmp_path / "lineitem.parquet"))
    source = star.write_text_feeds(spark, str(tmp_path), str(tmp_path / "source"))
    texts = [file.read_text() for file in Path(source, "bookings.csv").glob("part-*")]
    assert [text.count("\n") for text in texts] == [1] and texts[0].startswith("booking_id,")
