"""Digest trees against hashlib, and the descent to what differs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tree
from tidemark.operators.fingerprint import row_text
from tidemark.plans import replay
from tidemark.scratch import Scratch


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root(texts, fan):
    level = [sha(t) for t in texts]
    while True:
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
        if len(level) == 1:
            return level[0]


def grown(spark, rows, fan, scratch):
    frame = spark.createDataFrame([(g, n, t) for g, texts in rows.items() for n, t in enumerate(texts)], "g string, n long, t string")
    return tree.grow(frame.repartition(5), ["g"], "n", F.unhex(F.sha2("t", 256)), scratch.keep, fan=fan)


@pytest.mark.parametrize("fan", [2, 3, 10])
def test_roots_equal_hashlib(spark, fan):
    rows = {f"g{size}": [f"text {i}" for i in range(size)] for size in (1, 2, 9, 10, 11, 28)}
    found = tree.roots(grown(spark, rows, fan, Scratch(spark)), ["g"]).collect()
    assert {r.g: r.digest.hex() for r in found} == {g: root(texts, fan) for g, texts in rows.items()}
    assert {r.g: (r.first, r["last"]) for r in found} == {g: (0, len(texts) - 1) for g, texts in rows.items()}


def test_nodes_read_in_order_are_finished_before_the_shuffle(spark):
    """Rows with a number of their own, in order or not, next to rows in pieces: the same tree, of few shuffled rows."""
    rng, fan = random.Random(5), 8
    rows = [(g, n, 0, 1, f"{g}{n}") for g, size in (("a", 1000), ("b", 17), (None, 9)) for n in range(size)]
    rows += [("p", n, piece, 3, f"{n}.{piece}") for n in range(20) for piece in range(3)]
    rows += [("q", n, piece, 1 + n % 2, f"{n}.{piece}") for n in range(20) for piece in range(1 + n % 2)]
    schema = "g string, n long, piece int, pieces int, t string"
    ordered = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), schema)
    mixed = spark.createDataFrame(spark.sparkContext.parallelize(rng.sample(rows, len(rows)), 4), schema)
    measures = {"bytes": F.length("t"), "ones": F.lit(1)}

    def levels(frame, alone):
        made = tree.grow(frame, ["g"], "n", F.unhex(F.sha2("t", 256)), Scratch(spark).keep, ["piece"], measures, fan=fan, alone=alone)
        return sorted((tuple(map(str, r)) for r in made.select("level", "g", "node", "digest", "first", "last", "bytes", "ones").collect()))

    plain = levels(ordered, None)
    assert plain == levels(ordered, F.col("pieces") == 1) == levels(mixed, F.col("pieces") == 1)
    listed = ordered.select("g", "piece", F.col("n").alias("_number"), F.unhex(F.sha2("t", 256)).alias("_digest"), F.lit(1).alias("ones"), (F.col("pieces") == 1).alias("_alone"))
    listed = listed.withColumn("ones", F.col("ones").cast("bigint"))
    runs = tree._runs(listed.where("g = 'a'"), ["g", "piece"], ["ones"], fan)
    assert runs.count() <= 125 + 3 and runs.agg(F.sum("ones")).first()[0] == 1000
    assert runs.where("_whole").count() >= 122


def test_damage_is_found_by_its_range(spark):
    rows = {"a": [f"{i}" for i in range(50)], "b": [f"{i}" for i in range(7)], "c": ["x"]}
    other = {"a": list(rows["a"]), "b": rows["b"] + ["more"], "d": ["y"]}
    other["a"][13], other["a"][40], other["a"][41] = "?", "41", "40"
    scratch = Scratch(spark)
    found = tree.damaged(grown(spark, rows, 3, scratch), grown(spark, other, 3, scratch), ["g"], fan=3)
    assert {tuple(r) for r in found.collect()} == {("a", 12, 14), ("a", 39, 41), ("b", 6, 6), ("c", 0, 0), ("d", 0, 0)}
    same = grown(spark, rows, 3, scratch)
    assert tree.damaged(same, same, ["g"], fan=3).isEmpty()


def test_the_ordered_digest_depends_on_order_and_not_on_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(20), rng.choice("ab"), rng.randrange(3)) for _ in range(300)] + [(None, None, 1)]
    frame = spark.createDataFrame(rows, "o int, x string, y int")
    digest = lambda df, *by: tree.ordered_tree_digest(df, row_text(["o", "x", "y"]), [F.col(c).asc_nulls_last() for c in by], Scratch(spark), fan=7).first()["digest"]
    base = digest(frame, "o")
    assert base == digest(frame.repartition(7), "o") == digest(frame.coalesce(1).orderBy("y"), "o")
    assert base != digest(frame, "x") and base != digest(frame.where("o > 0 or x = 'a'"), "o")
    assert digest(frame.limit(0), "o") == sha("")


def test_changed_months_and_their_rows(spark):
    import datetime as dt

    def gold(rows):
        return spark.createDataFrame([(d, x, n, "B") for d, x, n in rows], "business_date date, destination string, amount int, batch_id string")

    day = lambda m, d: dt.date(2031, m, d)
    before = [(day(1, 3), "a", 1), (day(1, 9), "b", 2), (day(2, 1), "a", 3), (day(3, 1), "a", 4), (None, "z", 5)]
    now = [(day(1, 3), "a", 1), (day(1, 9), "b", 9), (day(2, 1), "a", 3), (day(4, 1), "a", 4), (None, "z", 6)]
    sides = gold(now), gold(before)
    ranges = replay.changed_ranges(*map(replay.range_digests, sides))
    assert {r.key_range: (r.rows_now, r.rows_before) for r in ranges.collect()} == {"2031-01": (2, 2), "2031-03": (0, 1), "2031-04": (1, 0), "none": (1, 1)}
    rows = {(r.key_range, r.destination, r.amount, r.side) for r in replay.changed_rows(*sides, ranges).collect()}
    assert rows == {("2031-01", "b", 2, "expected"), ("2031-01", "b", 9, "actual"), ("2031-03", "a", 4, "expected"),
                    ("2031-04", "a", 4, "actual"), ("none", "z", 5, "expected"), ("none", "z", 6, "actual")}
