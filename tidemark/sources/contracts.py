"""What each feed must look like before any row is read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DataContractError(ValueError):
    """Feeds that cannot be interpreted; the message names every gap found in them."""


@dataclass(frozen=True)
class Contract:
    entity: str
    file_name: str
    columns: tuple[str, ...]

    @property
    def is_json(self) -> bool:
        return self.file_name.endswith(".jsonl")


# Feed files and their mandatory columns.
BOOKINGS = Contract(
    "bookings",
    "bookings.csv",
    (
        "booking_id",
        "offer_id",
        "client_id",
        "source_channel",
        "booking_status",
        "booking_ts",
        "service_date",
        "gross_amount",
        "currency",
        "updated_at",
    ),
)
PAYMENTS = Contract(
    "payments",
    "payments.jsonl",
    ("payment_id", "booking_id", "payment_status", "amount", "currency", "paid_at"),
)
OFFERS = Contract(
    "offers",
    "offers.csv",
    ("offer_id", "destination", "commission_rate", "active"),
)
FEEDS = (BOOKINGS, PAYMENTS, OFFERS)


def feed_paths(source_dir: str, feeds=FEEDS) -> dict[str, str]:
    """Where each feed is expected: a file, or a folder of part files, of the contract's name."""
    return {feed.entity: f"{source_dir.rstrip('/')}/{feed.file_name}" for feed in feeds}


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The feed's lines, part files in nested folders included."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def csv_fields(spark: SparkSession, path: str) -> list[str] | None:
    """Header names; None for a feed without a single line."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    return [name.strip() for name in reader.csv(path).columns] or None


def json_fields(spark: SparkSession, path: str) -> list[str] | None:
    """Keys of the first record that is not blank; an empty list if that is no object."""
    filled = text_lines(spark, path).where(F.trim("value") != "")
    row = filled.select(F.json_object_keys("value").alias("keys")).first()
    return None if row is None else list(row["keys"] or [])


def absent_keys(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """``column, records``: how many records of a whole JSON feed lack each mandatory key."""
    filled = text_lines(spark, path).where(F.trim("value") != "")
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    absent = [F.count_if(~F.array_contains(keys, name)).alias(name) for name in contract.columns]
    pairs = [F.struct(F.lit(name).alias("column"), F.col(name).alias("records")) for name in contract.columns]
    return filled.agg(*absent).select(F.inline(F.array(*pairs)))


def incomplete_records(spark: SparkSession, path: str, contract: Contract) -> dict[str, int]:
    """The mandatory keys that some records of a whole JSON feed lack, and how many do."""
    found = absent_keys(spark, path, contract).where(F.col("records") > 0)
    return {row["column"]: row["records"] for row in found.collect()}


def gaps(spark: SparkSession, path: str, contract: Contract, every_record: bool = False) -> list[str]:
    """Complaints about one feed that exists; none if it keeps its contract."""
    found = (json_fields if contract.is_json else csv_fields)(spark, path)
    if found is None:
        return [f"{contract.file_name} holds no data"]
    if not found:
        return [f"{contract.file_name} does not start with a JSON object"]
    lacking = set(contract.columns) - set(found)
    if every_record and contract.is_json:
        lacking |= set(incomplete_records(spark, path, contract))
    return [f"{contract.file_name} lacks {name}" for name in contract.columns if name in lacking]


def check_contracts(spark: SparkSession, paths: dict[str, str], feeds=FEEDS, every_record: bool = False) -> None:
    """Stop before any work, with all gaps of all feeds in one error. For JSON lines the first
    record decides, or with ``every_record`` all of them."""
    absent, complaints = [], []
    for feed in feeds:
        try:
            complaints += gaps(spark, paths[feed.entity], feed, every_record)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(paths[feed.entity])
    if absent:
        raise FileNotFoundError(f"no such feed: {', '.join(absent)}")
    if complaints:
        raise DataContractError("; ".join(complaints))
