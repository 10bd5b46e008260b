"""Where the Gold of two runs differs: digests by month, then only the months that changed.

A run stores one row per month of business dates. Two runs are compared by these small tables; rows are read
only for months whose digests differ, by a condition on the date that Gold is sorted by.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.diff import bag_difference
from tidemark.operators.fingerprint import bag_of, row_text

NO_DATE = "none"


def key_range() -> Column:
    return F.coalesce(F.date_format("business_date", "yyyy-MM"), F.lit(NO_DATE))


def range_digests(gold: DataFrame) -> DataFrame:
    """``key_range, first_day, last_day, rows, digest``; the batch's own name and its run do not count."""
    columns = sorted(name for name in gold.columns if name != "batch_id")
    hashed = gold.select("business_date", key_range().alias("key_range"), F.sha2(row_text(columns), 256).alias("_hash"))
    return hashed.groupBy("key_range").agg(
        F.min("business_date").alias("first_day"),
        F.max("business_date").alias("last_day"),
        F.count("*").alias("rows"),
        bag_of(F.col("_hash")).alias("digest"),
    )


def changed_ranges(now: DataFrame, before: DataFrame) -> DataFrame:
    """Months whose digests differ, or that only one run has, with the days they span in either."""
    sides = [
        df.select("key_range", *[F.col(name).alias(f"{name}_{side}") for name in ("first_day", "last_day", "rows", "digest")])
        for side, df in (("now", now), ("before", before))
    ]
    both = sides[0].join(sides[1], "key_range", "full")
    return both.where(~F.col("digest_now").eqNullSafe(F.col("digest_before"))).select(
        "key_range",
        F.least("first_day_now", "first_day_before").alias("first_day"),
        F.greatest("last_day_now", "last_day_before").alias("last_day"),
        F.coalesce("rows_now", F.lit(0)).alias("rows_now"),
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
    )


def changed_rows(now: DataFrame, before: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of the changed months that one run holds more often than the other; ``side`` "expected" is the earlier run."""
    found = ranges.collect()  # one row per month
    within = [
        F.col("business_date").isNull() if row["key_range"] == NO_DATE else F.col("business_date").between(row["first_day"], row["last_day"])
        for row in found
    ]
    wanted = reduce(or_, within, F.lit(False))
    columns = sorted(name for name in now.columns if name != "batch_id")
    differing = bag_difference(before.where(wanted).select(*columns), now.where(wanted).select(*columns))
    return differing.withColumn("key_range", key_range())
