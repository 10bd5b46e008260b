"""Ordered listings that explain a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import total
from tidemark.operators.fingerprint import bag_digest, ordered_md5
from tidemark.operators.quarantine import reason_histogram
from tidemark.operators.tree import ordered_tree_digest
from tidemark.scratch import Scratch

GOLD_TEXT = (
    "business_date",
    "destination",
    "confirmed_bookings",
    "gross_revenue_eur",
    "commission_revenue_eur",
    "net_revenue_eur",
    "batch_id",
)


def gold_fingerprint(gold: DataFrame) -> DataFrame:
    """Rows, gross total and an order-free digest of all rows, at any size."""
    return bag_digest(gold.select(*GOLD_TEXT), _gold_measures()).withColumnRenamed("digest", "gold_digest")


def ordered_gold_fingerprint(gold: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The same with a digest of the rows in order: the root of a tree, at any size. Without ``scratch``, the
    flat form for small tables."""
    if scratch is None:
        return flat_gold_fingerprint(gold)
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in GOLD_TEXT])
    order = [F.col(name).asc_nulls_last() for name in ("business_date", "destination", "batch_id")]
    digest = ordered_tree_digest(gold, text, order, scratch).select(F.lit(1).alias("one"), F.col("digest").alias("gold_digest"))
    return gold.agg(F.lit(1).alias("one"), *_gold_measures()).join(digest, "one").drop("one")


def flat_gold_fingerprint(gold: DataFrame) -> DataFrame:
    """The same with an MD5 over one text of all rows, for a caller that knows the table to be small."""
    order = ["business_date", "destination", "batch_id"]
    return gold.agg(*_gold_measures(), ordered_md5(gold, GOLD_TEXT, order).alias("gold_digest"))


def _gold_measures():
    return [
        F.count("*").alias("row_count"),
        F.round(total(F.col("gross_revenue_eur")), 2).cast("decimal(18,2)").alias("gross_sum"),
    ]


def rejects_by_cause(records: DataFrame) -> DataFrame:
    return reason_histogram(records, "source_entity").orderBy(
        "source_entity", F.col("rejected_rows").desc(), "reason_code"
    )


def validation_results(checks: DataFrame) -> DataFrame:
    """The control suite as a report listing, ordered by check."""
    return checks.select(
        "check_id",
        F.col("check_name").alias("control_name"),
        F.col("severity").alias("priority"),
        "status",
        F.concat(F.col("violations").cast("string"), F.lit(" violation(s)")).alias("actual_value"),
        F.lit("0 violation(s)").alias("expected_value"),
        F.col("parts_json").alias("details"),
    ).orderBy("check_id")


def ordered_differences(differences: DataFrame) -> DataFrame:
    return differences.orderBy(
        F.col("business_date").asc_nulls_last(), F.col("destination").asc_nulls_last()
    )
