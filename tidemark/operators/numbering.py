"""Number rows 1..n without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import Scratch


def number_in_order(
    df: DataFrame, order: Sequence[Column], scratch: Scratch, into: str
) -> DataFrame:
    """Number rows in a stated order: ids are contiguous inside a sorted partition; add the rows of all
    partitions before it.

    The frame is written first so that counting and numbering see the same ids even if a second
    read would split the files differently. The window runs over one row per partition. Spark
    broadcasts the stored table of partitions while its size in bytes allows that.
    """
    tagged = df.sort(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = scratch.keep(tagged.withColumn("_part", F.shiftright("_id", 33)), "tagged")
    pieces = stored.groupBy("_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    starts = scratch.keep(pieces.select("_part", "_first", before.alias("_before")), "starts")
    number = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return stored.join(starts, "_part").select(number.alias(into), *df.columns)
