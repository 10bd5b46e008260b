"""Every table is a folder of ``batch_id=`` folders, and these of a folder for each run; see ``commits``."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def check_batch_id(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", batch_id):
        raise ValueError("batch_id may hold letters, digits, '_', '-' and '.'")
    return batch_id


def batch_path(root: str, table: str, batch_id: str, run_id: str | None = None) -> str:
    path = f"{root.rstrip('/')}/{table}/batch_id={batch_id}"
    return path if run_id is None else f"{path}/run_id={run_id}"


def replace_batch(
    df: DataFrame,
    root: str,
    table: str,
    batch_id: str,
    order: list[Column] | None = None,
    total_order: bool = False,
    rows_per_file: int = 0,
    run_id: str | None = None,
) -> DataFrame:
    """Write one batch, or one run of it, and return it as stored.

    The path is overwritten, so an empty replay leaves nothing behind. Large layers
    are ordered within files; ``total_order`` sorts across files, for small published tables.
    ``rows_per_file`` bounds files whose rows are large.
    """
    rows = df.drop("batch_id")
    if order:
        rows = rows.sort(*order) if total_order else rows.sortWithinPartitions(*order)
    path = batch_path(root, table, batch_id, run_id)
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return read_batch(df.sparkSession, root, table, batch_id, rows.schema, run_id)


def read_batch(
    spark: SparkSession,
    root: str,
    table: str,
    batch_id: str,
    schema: T.StructType | None = None,
    run_id: str | None = None,
) -> DataFrame:
    reader = spark.read.option("basePath", f"{root.rstrip('/')}/{table}")
    if schema is not None:
        places = ["batch_id"] if run_id is None else ["batch_id", "run_id"]
        fields = [*schema.fields, *(T.StructField(name, T.StringType()) for name in places)]
        reader = reader.schema(T.StructType(fields))
    return reader.parquet(batch_path(root, table, batch_id, run_id)).drop("run_id")


def write_document(spark: SparkSession, document: dict, root: str, name: str, batch_id: str, run_id: str | None = None) -> str:
    """One JSON document as a single-line text file."""
    path = batch_path(root, name, batch_id, run_id)
    text = json.dumps(document, ensure_ascii=False, default=str)
    row = spark.createDataFrame([(text,)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_document(spark: SparkSession, root: str, name: str, batch_id: str, run_id: str | None = None) -> dict | None:
    """The stored document, or None when it is absent or unreadable."""
    try:
        row = spark.read.text(batch_path(root, name, batch_id, run_id), wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if row is None:
        return None
    try:
        found = json.loads(row["value"])
    except json.JSONDecodeError:
        return None
    return found if isinstance(found, dict) else None
