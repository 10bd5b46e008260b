"""Compare two tables with one shuffle each: union, group, look at the groups."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import differs


def bag_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that one table holds more often than the other, both ways, duplicates counted.

    ``copies`` says how many more; ``side`` says where. Copies of a hot row are combined before
    the shuffle, and no row is ever paired with another.
    """
    columns = expected.columns
    signed = expected.withColumn("_sign", F.lit(1)).unionByName(
        actual.select(*columns).withColumn("_sign", F.lit(-1))
    )
    surplus = signed.groupBy(*columns).agg(F.sum("_sign").alias("_surplus"))
    return surplus.where("_surplus <> 0").select(
        *columns,
        F.when(F.col("_surplus") > 0, "expected").otherwise("actual").alias("side"),
        F.abs("_surplus").alias("copies"),
    )


def keyed_difference(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    exact: Sequence[str] = (),
    close: Sequence[str] = (),
    tolerance: Decimal = Decimal("0.01"),
) -> DataFrame:
    """Keys whose values differ, with expected and actual side by side.

    A full outer comparison as one grouped pass. A key that is missing or repeated on either side
    is a difference; so is a NULL in a ``close`` column.
    """
    values = [*exact, *close]
    sides = {"expected": expected, "actual": actual}
    tagged = [df.select(*keys, *values, F.lit(side).alias("_side")) for side, df in sides.items()]
    on_side = {side: F.col("_side") == side for side in sides}
    grouped = tagged[0].unionByName(tagged[1]).groupBy(*keys).agg(
        *[F.count_if(flag).alias(f"{side}_rows") for side, flag in on_side.items()],
        *[
            F.max(F.when(flag, F.col(value))).alias(f"{side}_{value}")
            for value in values
            for side, flag in on_side.items()
        ],
    )
    broken = [F.col(f"{side}_rows") != 1 for side in sides]
    for value in values:
        left, right = F.col(f"expected_{value}"), F.col(f"actual_{value}")
        if value in exact:
            broken.append(differs(left, right))
        else:
            broken.append(left.isNull() | right.isNull())
            broken.append(F.coalesce(F.abs(left - right) > F.lit(tolerance), F.lit(False)))
    return grouped.where(reduce(or_, broken))
