"""Joins used as checks, shaped so that a hot key never gathers in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import total

def enrich(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keep every fact row. Spark broadcasts the dimension while its stored size allows it, and
    otherwise sort-merges with adaptive skew splitting on the fact side."""
    return facts.join(dimension, key, "left")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def orphan_total(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row ``n``: child rows without a parent. Both sides shrink to one row per key first."""
    per_key = child.groupBy(key).agg(F.count("*").alias("_rows"))
    known = parent.select(key).distinct()
    return per_key.join(known, key, "left_anti").agg(total(F.col("_rows")).alias("n"))


def off_newest(current: DataFrame, versions: DataFrame, key: str, stamp: str) -> DataFrame:
    """Current rows whose stamp is not the newest among all versions of their key."""
    newest = versions.groupBy(key).agg(F.max(stamp).alias("newest_version"))
    stale = ~F.col(stamp).eqNullSafe(F.col("newest_version"))
    return current.join(newest, key).where(stale)


def pair_total(
    left: DataFrame, right: DataFrame, key: str, values: list[str], wrong: Column
) -> DataFrame:
    """One row ``n``: left rows whose pair on ``key`` (unique on the right) is ``wrong``.

    Equal (key, values) rows of the left are counted before the join.
    """
    counted = left.groupBy(key, *values).agg(F.count("*").alias("_rows"))
    return counted.join(right, key).where(wrong).agg(total(F.col("_rows")).alias("n"))
