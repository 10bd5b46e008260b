"""Versions carried over batches: the same as one batch of all, and only touched buckets are read."""

import random
import shutil

import pytest

from tidemark.sinks import commits
from tidemark.sinks.state import POINTED, KeyedState

SCHEMA = "k string, stamp int, tie int, v string"


def versions(rng, n):
    return [(f"k{rng.randrange(40)}", rng.randrange(6), rng.randrange(3), rng.choice("abc")) for _ in range(n)]


def newest(rows):
    best = {}
    for row in rows:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: (r[1], r[2], r[3]))
    return set(best.values())


def state(spark, path, **options):
    return KeyedState(spark, str(path), ["k"], ["stamp", "tie"], **options)


def test_batches_one_after_the_other_equal_one_of_all(spark, tmp_path):
    rng = random.Random(3)
    batches = [versions(rng, n) for n in (120, 60, 200)]
    mine, seen = state(spark, tmp_path / "three", buckets=8), []
    assert mine.read() is None
    for batch in batches:
        before = newest(seen)
        told = mine.apply(spark.createDataFrame(batch, SCHEMA)).collect()
        seen += batch
        current = newest(seen)
        assert set(map(tuple, mine.read().collect())) == current and mine.read().count() == len(current)
        told = {tuple(r)[:4]: r.is_current for r in told}
        assert {row for row, now in told.items() if now} <= current
        assert {row for row, now in told.items() if not now} == (set(batch) | before) - current
    whole = state(spark, tmp_path / "one", buckets=8)
    whole.apply(spark.createDataFrame(sum(batches, []), SCHEMA))
    assert set(map(tuple, whole.read().collect())) == newest(sum(batches, []))
    before = mine.runs()
    mine.apply(spark.createDataFrame(batches[1], SCHEMA))  # again: nothing changes
    assert set(map(tuple, mine.read().collect())) == newest(seen) and mine.runs().keys() == before.keys()


def test_untouched_buckets_are_not_read(spark, tmp_path):
    mine = state(spark, tmp_path, buckets=8)
    mine.apply(spark.createDataFrame([(f"k{i}", 1, 0, "a") for i in range(40)], SCHEMA))
    first = mine.runs()
    assert len(first) == 8
    mine.apply(spark.createDataFrame([("k7", 2, 0, "new")], SCHEMA))
    (touched,) = [bucket for bucket, run in mine.runs().items() if run != first[bucket]]
    other = next(bucket for bucket in first if bucket != touched)
    shutil.move(tmp_path / f"rows/run_id={first[other]}/bucket={other}", tmp_path / "away")
    mine.apply(spark.createDataFrame([("k7", 3, 0, "newer")], SCHEMA))
    shutil.move(tmp_path / "away", tmp_path / f"rows/run_id={first[other]}/bucket={other}")
    found = {r.k: r.v for r in mine.read().collect()}
    assert len(found) == 40 and found["k7"] == "newer"
    mine.prune()
    assert len(list((tmp_path / "rows").iterdir())) == 2 and mine.read().count() == 40


def test_a_new_reader_keeps_the_buckets_of_the_table(spark, tmp_path):
    state(spark, tmp_path, buckets=4).apply(spark.createDataFrame([("a", 1, 0, "x")], SCHEMA))
    state(spark, tmp_path, buckets=99).apply(spark.createDataFrame([("a", 0, 9, "old"), ("b", 1, 0, "y")], SCHEMA))
    found = state(spark, tmp_path).read().collect()
    assert {tuple(r) for r in found} == {("a", 1, 0, "x"), ("b", 1, 0, "y")}


def test_the_later_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    mine, other = state(spark, tmp_path), state(spark, tmp_path)
    point, done = commits.point, []

    def overtaken(*args):
        if not done:
            done.append(1)
            other.apply(spark.createDataFrame([("b", 1, 0, "y")], SCHEMA))
        return point(*args)

    monkeypatch.setattr(commits, "point", overtaken)
    with pytest.raises(commits.CommitConflict):
        mine.apply(spark.createDataFrame([("a", 1, 0, "x")], SCHEMA))
    assert [r.k for r in mine.read().collect()] == ["b"]
    assert commits.last_number(spark, str(tmp_path), POINTED) == 1


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    mine = state(spark, tmp_path)
    mine.apply(spark.createDataFrame([("a", 1, 0, "x")], SCHEMA))
    assert mine.apply(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine.read().count() == 1
