"""Landed lines to Bronze rows: every business column is text, every row is numbered and traced."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import flag
from tidemark.scratch import Scratch
from tidemark.sources.contracts import Contract, DataContractError
from tidemark.sources.records import numbered_records

ROW_NUMBER = "source_row_number"
MOST_HEADERS = 100  # different ways to write a feed's header


def header_fields(headers: DataFrame, contract: Contract) -> list[str]:
    """The field names in a CSV feed's files, without spaces around them; all files must have the same."""
    texts = headers.groupBy("header").agg(F.min("source_file").alias("source_file")).orderBy("source_file").head(MOST_HEADERS + 1)
    found = [([name.strip() for name in next(csv.reader(io.StringIO(row["header"])))], row["source_file"]) for row in texts]
    if not found:
        return list(contract.columns)
    fields, first = found[0]
    for other, name in found[1:]:
        if other != fields:
            raise DataContractError(f"{name} has another header than {first}")
    if len(found) > MOST_HEADERS:
        raise DataContractError(f"more than {MOST_HEADERS} different headers in {contract.file_name}")
    return fields


def csv_columns(rows: DataFrame, fields: list[str], contract: Contract) -> DataFrame:
    """Columns are taken by header name, extra ones dropped; a short record ends in NULLs."""
    schema = ", ".join(f"c{i} string" for i in range(len(fields)))
    place = {name: i for i, name in reversed(list(enumerate(fields)))}
    parsed = rows.withColumn("record", F.from_csv("text", schema, {"escape": '"'}))
    return parsed.withColumns({name: F.col(f"record.c{place[name]}") for name in contract.columns}).drop("record", "text")


def json_columns(rows: DataFrame, contract: Contract) -> DataFrame:
    """Each value as its text. A broken line gives all NULLs, so that row validation rejects it and the row
    is still counted; its text is in the raw lines."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in contract.columns])
    return rows.withColumn("record", F.from_json("text", schema)).select("*", "record.*").drop("record", "text")


def source_file(path, contract: Contract):
    """A file's name within its feed: the feed's name and, for a part file, the way to it.

    ``path`` is ``_metadata.file_path``, which escapes some characters as URLs do. Every line asks this, so a path
    without escapes is not decoded.
    """
    plain = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    name = contract.file_name.replace(".", r"\.")
    return F.regexp_extract(plain, f"(?s)^.*?/({name}(?:/.*)?)$", 1)


def parsed(lines: DataFrame, blocks: DataFrame, contract: Contract, scratch: Scratch, line_breaks: bool = True) -> DataFrame:
    """Numbered rows of one feed's landed lines and their blocks, with their file. Without ``line_breaks`` every line of
    a CSV feed is a record, whatever its quotes."""
    mine = F.col("source_name") == contract.entity
    rows, headers = numbered_records(
        lines.where(mine), blocks.where(mine), scratch, ROW_NUMBER, not contract.is_json, line_breaks
    )
    if contract.is_json:
        rows = json_columns(rows, contract)
    else:
        rows = csv_columns(rows, header_fields(headers, contract), contract)
    return rows


def bronze(rows: DataFrame, contract: Contract, checksums: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    """Parsed rows with their lineage. ``checksums`` has one row per source file."""
    digests = checksums.select("source_file", F.col("checksum").alias("source_checksum"))
    traced = rows.join(digests, "source_file", "left")
    if "active" in contract.columns:
        traced = traced.withColumn("active", flag(F.col("active")))
    return traced.select(
        ROW_NUMBER,
        *contract.columns,
        F.lit(batch_id).alias("batch_id"),
        "source_file",
        "source_checksum",
        F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
    )
