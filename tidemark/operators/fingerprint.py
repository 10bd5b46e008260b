"""Content digests of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import total


def row_text(columns: Sequence[str]) -> Column:
    """Compact JSON array of a row's values as text, NULL kept."""
    return F.to_json(F.array(*[F.col(name).cast("string") for name in columns]))


def ordered_digest(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SHA-256 over all rows in order, as one compact JSON text. All rows meet in one value: for a
    caller that knows the table to be small."""
    text = F.coalesce(F.array_join(_ordered(row_text(columns), order), ","), F.lit(""))
    return df.agg(F.sha2(F.concat(F.lit("["), text, F.lit("]")), 256).alias("digest"))


def ordered_md5(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: MD5 over rows joined by ``||``, fields joined by ``|`` with NULL skipped. For
    small tables, like ``ordered_digest``."""
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in columns])
    return F.md5(F.coalesce(F.array_join(_ordered(text, order), "||"), F.lit("")))


def _ordered(text: Column, order: Sequence[str]) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, text.alias("_text"))))
    return F.transform(rows, lambda row: row["_text"])


def bag_digest(df: DataFrame, measures: Sequence[Column] = ()) -> DataFrame:
    """Digest of a table of any size, whatever its row order: count, sum and xor of row hashes.
    ``measures`` are further aggregates to take in the same pass."""
    hashed = df.withColumn("_hash", F.sha2(row_text(df.columns), 256))
    return hashed.agg(*measures, bag_of(F.col("_hash")).alias("digest"))


def bag_of(row_hash: Column) -> Column:
    """Aggregate: digest of rows given by their hexadecimal hashes, whatever their order."""
    number = F.conv(F.substring(row_hash, 1, 15), 16, 10).cast("decimal(20,0)")
    parts = F.concat_ws(
        "|",
        F.count("*").cast("string"),
        total(number).cast("string"),
        F.coalesce(F.bit_xor(F.xxhash64(row_hash)), F.lit(0)).cast("string"),
    )
    return F.sha2(parts, 256)

