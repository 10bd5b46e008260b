"""Turn rejected rows of any feed into one traceable shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject(
    df: DataFrame,
    entity: str,
    record: Column,
    reason: Column,
    details: Column,
    row_number: Column | None = None,
    source_file: Column | None = None,
) -> DataFrame:
    """``df`` holds rejected rows only, with a ``batch_id`` column."""
    nothing = F.lit(None)
    row_number = nothing if row_number is None else row_number
    source_file = nothing if source_file is None else source_file
    return df.select(
        F.lit(entity).alias("source_entity"),
        row_number.cast("bigint").alias("source_row_number"),
        record.alias("record_id"),
        reason.alias("reason_code"),
        details.alias("details"),
        "batch_id",
        source_file.cast("string").alias("source_file"),
    )


def quarantine(*rejects: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rejects)


def reason_histogram(records: DataFrame, *by: str) -> DataFrame:
    return records.groupBy(*by, "reason_code").agg(F.count("*").alias("rejected_rows"))
