"""Pick or rank the versions of each key.

``keep_one`` filters on rank 1 right above the window, so Spark cuts every key to one row per map
task before the shuffle; a key with a third of all rows costs nothing extra.

``rank_versions`` needs the rank of every row, so a plain window would send all rows of a hot key
to one task. Hot keys are found first and ranked by a distributed sort instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialise

Keep = Callable[[DataFrame, str], DataFrame]

# Rows one task can comfortably sort for one key.
HOT_ROWS = 1_000_000


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def newest_first(names: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]


def oldest_first(names: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def direction(keep: str, names: Sequence[str]) -> list[Column]:
    if keep == "latest":
        return newest_first(names)
    if keep == "oldest":
        return oldest_first(names)
    raise ValueError("dedup_mode must be 'latest' or 'oldest'")


def hot_keys(
    source: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, keep: Keep = materialise
) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows; at most count / hot_rows of them, or None.

    Call it on a stored table: the row count then comes from file footers, and the counts read
    only the key columns and are combined before the shuffle.
    """
    if source.count() <= hot_rows:
        return None
    counts = source.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = keep(counts.where(F.col("_rows") > hot_rows).select(*keys), "hot_keys")
    return None if hot.isEmpty() else hot


def rank_versions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    into: str = "dedup_rank",
    hot: DataFrame | None = None,
    keep: Keep = materialise,
) -> DataFrame:
    """Rank all rows of each key; ``order`` must leave no ties among rows of one key. ``keep``
    stores an intermediate table and returns it as read back."""
    if hot is None:
        return _rank_by_window(df, keys, order, into)
    listed = hot.select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys])
    cold = _rank_by_window(df.join(listed, same, "left_anti"), keys, order, into)
    warm = df.join(listed, same, "left_semi")
    return cold.unionByName(_rank_by_sort(warm, keys, order, into, keep))


def _rank_by_window(df, keys, order, into):
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(into, F.row_number().over(window).cast("bigint"))


def _rank_by_sort(df, keys, order, into, keep):
    """Sort on key and order together, so one key spreads over many range partitions.

    Ids rise by one within a partition of the sorted frame: a row's rank is its distance from its
    key's first id there, plus the key's rows in the partitions before. That second part is a
    table of one row per key and partition it touches.
    """
    ordered = df.sort(*[F.col(key).asc_nulls_first() for key in keys], *order)
    placed = keep(
        ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn(
            "_part", F.shiftright("_id", 33)
        ),
        "placed",
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    pieces = placed.groupBy(*keys, "_part").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_rows")
    )
    starts = keep(
        pieces.select(
            *[F.col(key).alias(f"_piece_{key}") for key in keys],
            F.col("_part").alias("_piece_part"),
            "_first",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        ),
        "starts",
    )
    same = reduce(
        and_,
        [F.col(key).eqNullSafe(F.col(f"_piece_{key}")) for key in keys],
        F.col("_part") == F.col("_piece_part"),
    )
    rank = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return placed.join(starts, same).select(*df.columns, rank.alias(into))
