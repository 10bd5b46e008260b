"""Operators against brute force on small frames, hot keys included."""

import hashlib
import json
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as col
from tidemark.operators.diff import bag_difference, keyed_difference
from tidemark.operators.fingerprint import bag_digest, ordered_digest
from tidemark.operators.numbering import number_in_order
from tidemark.operators.quarantine import quarantine, reason_histogram, reject
from tidemark.operators.relations import (
    duplicate_groups,
    off_newest,
    orphan_total,
    orphans,
    pair_total,
)
from tidemark.operators.versions import hot_keys, keep_one, newest_first, oldest_first, rank_versions
from tidemark.plans.evidence import GOLD_TEXT, gold_fingerprint, ordered_gold_fingerprint
from tidemark.scratch import Scratch, checkpoint_root, materialise


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one key, a few rows have none; times repeat within keys."""
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 700}"
        rows.append((key, (i * 37) % 91, i))
    return spark.createDataFrame(rows, "k string, t int, n int").repartition(16)


@pytest.fixture
def many_parts(spark):
    """Keep all shuffle partitions, however small the test's data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "2")


def brute_ranks(rows, newest):
    groups = {}
    for row in rows:
        groups.setdefault(row["k"], []).append((row["t"], row["n"]))
    return {
        (key, *row): rank
        for key, members in groups.items()
        for rank, row in enumerate(sorted(members, reverse=newest), 1)
    }


@pytest.mark.parametrize("newest", [True, False])
def test_hot_keys_rank_as_the_others_do(spark, many_parts, skewed, newest):
    stored = materialise(skewed, "skewed")
    hot = hot_keys(stored, ["k"], hot_rows=30)
    assert {row["k"] for row in hot.collect()} == {"hot", None}
    order = (newest_first if newest else oldest_first)(["t", "n"])
    ranked = rank_versions(stored, ["k"], order, "r", hot).collect()
    found = {(row["k"], row["t"], row["n"]): row["r"] for row in ranked}
    assert len(ranked) == 3000
    assert found == brute_ranks(skewed.collect(), newest)


def test_a_hot_key_is_ranked_by_many_tasks(spark, many_parts, skewed):
    stored = materialise(skewed, "skewed")
    kept = {}

    def keep(df, name):
        kept[name] = materialise(df, name)
        return kept[name]

    hot = hot_keys(stored, ["k"], hot_rows=30, keep=keep)
    rank_versions(stored, ["k"], newest_first(["t", "n"]), "r", hot, keep).count()
    pieces = kept["placed"].where("k = 'hot'").groupBy("_part").count().collect()
    assert len(pieces) >= 4
    assert max(row["count"] for row in pieces) < 500


def test_without_hot_keys_one_window_is_enough(spark, skewed):
    stored = materialise(skewed, "skewed")
    assert hot_keys(stored, ["k"], hot_rows=3000) is None
    assert hot_keys(stored, ["k"], hot_rows=1500) is None
    ranked = rank_versions(stored, ["k"], newest_first(["t", "n"]), "r").collect()
    assert {(r["k"], r["t"], r["n"]): r["r"] for r in ranked} == brute_ranks(skewed.collect(), True)


def test_keep_one(spark, skewed):
    found = {r["k"]: (r["t"], r["n"]) for r in keep_one(skewed, ["k"], newest_first(["t", "n"])).collect()}
    ranks = brute_ranks(skewed.collect(), True)
    assert found == {key[0]: key[1:] for key, rank in ranks.items() if rank == 1}


def test_numbers_are_contiguous_and_in_order(spark, many_parts, skewed):
    numbered = number_in_order(
        skewed, [F.col("t").asc(), F.col("n").asc()], Scratch(spark), "row"
    ).collect()
    wanted = sorted((row["t"], row["n"]) for row in skewed.collect())
    assert [(r["t"], r["n"]) for r in sorted(numbered, key=lambda r: r["row"])] == wanted
    assert sorted(r["row"] for r in numbered) == list(range(1, 3001))


def test_bag_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, "a")] * 5 + [(2, None)] * 2 + [(3, "c")], "x int, y string")
    right = spark.createDataFrame([("a", 1)] * 3 + [(None, 2)] * 2 + [("d", 3)] * 4, "y string, x int")
    found = {(r["x"], r["y"], r["side"]): r["copies"] for r in bag_difference(left, right).collect()}
    assert found == {(1, "a", "expected"): 2, (3, "c", "expected"): 1, (3, "d", "actual"): 4}


def test_keyed_difference(spark):
    schema = "k int, n int, v decimal(10,2)"
    expected = [(1, 1, "1.00"), (2, 1, "1.00"), (3, 1, None), (4, 1, "1.00"), (5, 1, "1.00"), (7, 2, "9.99")]
    actual = [(1, 1, "1.01"), (2, 1, "1.02"), (3, 1, None), (4, None, "1.00"), (6, 1, "1.00"), (7, 2, "9.99"), (7, 2, "9.99")]

    def frame(rows):
        return spark.createDataFrame([(k, n, v and Decimal(v)) for k, n, v in rows], schema)

    rows = keyed_difference(frame(expected), frame(actual), ["k"], ["n"], ["v"]).collect()
    assert {r["k"]: (r["expected_rows"], r["actual_rows"]) for r in rows} == {
        2: (1, 1),
        3: (1, 1),
        4: (1, 1),
        5: (1, 0),
        6: (0, 1),
        7: (1, 2),
    }


def test_ordered_digest_is_the_json_of_the_ordered_rows(spark):
    rows = [("b", Decimal("1.50"), None), ("a", Decimal("2.00"), "é/\"")]
    df = spark.createDataFrame(rows, "x string, y decimal(10,2), z string")
    text = json.dumps(
        [["a", "2.00", "é/\""], ["b", "1.50", None]], ensure_ascii=False, separators=(",", ":")
    )
    found = ordered_digest(df, df.columns, ["x"]).first()["digest"]
    assert found == hashlib.sha256(text.encode()).hexdigest()
    empty = ordered_digest(df.where("false"), df.columns, ["x"]).first()["digest"]
    assert empty == hashlib.sha256(b"[]").hexdigest()


def test_bag_digest_ignores_order_and_sees_every_change(spark, skewed):
    def digest(df):
        return bag_digest(df).first()["digest"]

    base = digest(skewed)
    assert digest(skewed.repartition(3).sort("n")) == base
    assert digest(skewed.withColumn("t", F.when(F.col("n") == 7, 1000).otherwise(F.col("t")))) != base
    assert digest(skewed.unionByName(skewed.where("n = 9"))) != base
    assert digest(skewed.where("n <> 9")) != base


def test_gold_fingerprints(spark):
    row = ("2031-03-01", "Oslo", 1, "2.00", "0.20", "1.80", "B")
    other = ("2031-03-02", "Bern", 2, "4.00", "0.40", "3.60", "B")
    schema = ", ".join(f"{name} string" for name in GOLD_TEXT).replace(
        "confirmed_bookings string", "confirmed_bookings int"
    )

    def gold(rows):
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("gross_revenue_eur", F.col("gross_revenue_eur").cast("decimal(18,2)"))

    small = ordered_gold_fingerprint(gold([other, row])).first()
    text = "||".join("|".join(map(str, r)) for r in (row, other))
    assert small["gold_digest"] == hashlib.md5(text.encode()).hexdigest()
    assert (small["row_count"], str(small["gross_sum"])) == (2, "6.00")
    large = [gold_fingerprint(gold(rows)).first() for rows in ([row, other], [other, row], [row, row])]
    assert large[0] == large[1] != large[2]
    assert large[0]["gold_digest"] != small["gold_digest"]
    assert (large[0]["row_count"], str(large[0]["gross_sum"])) == (2, "6.00")


def test_relations(spark, skewed):
    known = spark.createDataFrame([("hot",), ("k1",), ("k1",)], "k string")
    rows = skewed.collect()
    lost = sum(row["k"] not in ("hot", "k1") for row in rows)
    assert orphan_total(skewed, known, "k").first()["n"] == lost
    assert orphans(skewed, known, "k").count() == lost
    copies = {r["k"]: r["copies"] for r in duplicate_groups(skewed, ["k"]).collect()}
    assert copies == {k: n for k, n in Counter(r["k"] for r in rows).items() if n > 1}
    oldest = keep_one(skewed, ["k"], oldest_first(["t", "n"])).where("k IS NOT NULL")
    stale = {r["k"] for r in off_newest(oldest, skewed, "k", "t").collect()}
    times = {}
    for r in rows:
        times.setdefault(r["k"], set()).add(r["t"])
    assert stale == {k for k, seen in times.items() if k and len(seen) > 1}


def test_pair_total(spark, skewed):
    limits = spark.createDataFrame([("hot", 45), ("k1", 10)], "k string, top int")
    wrong = F.col("t") > F.col("top")
    found = pair_total(skewed, limits, "k", ["t"], wrong).first()["n"]
    top = {"hot": 45, "k1": 10}
    assert found == sum(r["k"] in top and r["t"] > top[r["k"]] for r in skewed.collect())


def test_quarantine_shapes(spark):
    df = spark.createDataFrame([("", 3, "R1"), ("x", 4, "R2")], "id string, n long, why string")
    df = df.withColumn("batch_id", F.lit("B"))
    first = reject(df, "a", col.record_id(F.col("id"), "A_ROW_", F.col("n")), F.col("why"), F.lit("d"), F.col("n"))
    second = reject(df, "b", F.col("id"), F.lit("R1"), F.lit("d"))
    both = quarantine(first, second)
    assert [r["record_id"] for r in first.collect()] == ["A_ROW_3", "x"]
    assert dict(both.dtypes)["source_row_number"] == "bigint"
    assert {(r["reason_code"]): r["rejected_rows"] for r in reason_histogram(both).collect()} == {
        "R1": 3,
        "R2": 1,
    }


def test_scalar_functions(spark):
    df = spark.createDataFrame([(" a ", "1.005", None), (" ", "x", "ABC")], "a string, b string, c string")
    out = df.select(
        col.is_blank(F.col("c")).alias("blank"),
        col.amount(F.col("b")).alias("amount"),
        col.differs(F.col("c"), F.lit("ABC")).alias("differs"),
        col.is_digest(col.pseudonym(F.col("a"))).alias("digest"),
        col.code(F.col("a")).alias("code"),
    ).collect()
    assert [r["blank"] for r in out] == [True, False]
    assert [r["amount"] for r in out] == [Decimal("1.01"), None]
    assert [r["differs"] for r in out] == [True, False]
    assert [r["digest"] for r in out] == [True, True]
    assert out[0]["code"] == "A"


def test_scratch_folder_is_the_clusters(spark):
    scratch = Scratch(spark)
    kept = scratch.keep(spark.range(5).toDF("x"), "five")
    assert scratch.root.startswith(checkpoint_root(spark))
    assert kept.count() == 5
    scratch.drop()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{scratch.root}/x").count()
