"""Bronze bookings to ranked, typed versions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    amount,
    any_blank,
    code,
    day,
    flag,
    instant,
    pseudonym,
    record_id,
    stored_amount,
)
from tidemark.operators.quarantine import reject
from tidemark.operators.relations import enrich
from tidemark.operators.rules import Rule, accepted, rejected, validate
from tidemark.operators.versions import Keep, direction, rank_versions
from tidemark.plans import catalogues as c
from tidemark.scratch import materialise
from tidemark.sources.contracts import BOOKINGS

PARSED = ("parsed_amount", "parsed_booking_ts", "parsed_service_date", "parsed_updated_at")


@dataclass(frozen=True)
class Strictness:
    """Stricter readings of the written contract; the defaults are the pipeline's own rules."""

    # Reject a booking whose offer has no readable active flag.
    active_must_be_known: bool = False
    # Reject a booking whose offer has no commission rate between 0 and 1.
    rate_must_be_fraction: bool = False
    # Payment statuses that need paid_at; None means every payment does.
    paid_at_required_for: tuple[str, ...] | None = None
    # How dates, times and amounts may be written: see ``functions.columns.FORMS``.
    text_forms: str = "spark"


def offers_reference(bronze_offers: DataFrame) -> DataFrame:
    return bronze_offers.select(
        "offer_id",
        "destination",
        F.col("commission_rate").try_cast("decimal(5,4)").alias("commission_rate"),
        flag(F.col("active").cast("string")).alias("active"),
    )


def booking_rules(strict: Strictness = Strictness()) -> list[Rule]:
    """Rules over parsed, enriched bookings, in the order that decides the reason."""
    value, booked = F.col("parsed_amount"), F.col("parsed_booking_ts")
    service, updated = F.col("parsed_service_date"), F.col("parsed_updated_at")
    rules = [
        Rule("mandatory fields", c.MISSING_REQUIRED, any_blank(BOOKINGS.columns)),
        Rule("amount is a number", c.MISSING_REQUIRED, value.isNull()),
        Rule("amount sign", c.NEGATIVE_AMOUNT, value < 0),
        Rule(
            "dates are dates",
            c.MISSING_REQUIRED,
            booked.isNull() | service.isNull() | updated.isNull(),
        ),
        Rule("service after booking", c.INVALID_DATE_ORDER, service < booked.cast("date")),
        Rule(
            "status", c.INVALID_STATUS, ~code(F.col("booking_status")).isin(*c.BOOKING_STATUSES)
        ),
        Rule("channel", c.INVALID_STATUS, ~code(F.col("source_channel")).isin(*c.CHANNELS)),
        Rule("currency", c.UNSUPPORTED_CURRENCY, code(F.col("currency")) != c.CURRENCY),
        Rule("offer exists", c.UNKNOWN_OFFER, F.col("offer_found").isNull()),
        Rule("offer is active", c.UNKNOWN_OFFER, ~F.col("offer_active")),
    ]
    if strict.active_must_be_known:
        rules.append(Rule("offer activity", c.UNKNOWN_OFFER, F.col("offer_active").isNull()))
    if strict.rate_must_be_fraction:
        fraction = F.coalesce(F.col("commission_rate").between(0, 1), F.lit(False))
        rules.append(Rule("commission rate", c.UNKNOWN_OFFER, ~fraction))
    return rules


def validate_bookings(
    bronze: DataFrame, offers: DataFrame, strict: Strictness = Strictness()
) -> DataFrame:
    """All Bronze rows with their offer, parsed values and reason. Keys match as written."""
    dimension = offers.select(
        "offer_id",
        "destination",
        "commission_rate",
        F.col("active").alias("offer_active"),
        F.lit(True).alias("offer_found"),
    )
    parsed = bronze.select(
        "*",
        amount(F.col("gross_amount"), strict.text_forms).alias("parsed_amount"),
        instant(F.col("booking_ts"), strict.text_forms).alias("parsed_booking_ts"),
        day(F.col("service_date"), strict.text_forms).alias("parsed_service_date"),
        instant(F.col("updated_at"), strict.text_forms).alias("parsed_updated_at"),
    )
    return validate(enrich(parsed, dimension, "offer_id"), booking_rules(strict)).drop(
        "offer_found"
    )


def booking_validation(validated: DataFrame) -> DataFrame:
    """The published validation table, without the parsed helper columns."""
    return validated.drop(*PARSED)


def judged_bookings(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every row's final values and reason, without raw text: what ranking, rejects and checks
    read, so it is stored once. The client is pseudonymised here. ``keep`` names extra columns
    wanted for ordering."""
    return validated.select(
        "source_row_number",
        "booking_id",
        "offer_id",
        pseudonym(F.col("client_id")).alias("client_id_hash"),
        code(F.col("source_channel")).alias("source_channel"),
        F.col("parsed_booking_ts").alias("booking_ts"),
        F.col("parsed_service_date").alias("service_date"),
        code(F.col("booking_status")).alias("booking_status"),
        F.col("parsed_amount").alias("gross_amount"),
        code(F.col("currency")).alias("currency"),
        F.col("parsed_updated_at").alias("updated_at"),
        "destination",
        "commission_rate",
        "validation_reason",
        "source_file",
        "batch_id",
        *keep,
    )


# The columns of a Silver booking.
VERSION = (
    "booking_id",
    "offer_id",
    "client_id_hash",
    "source_channel",
    "booking_ts",
    "service_date",
    "booking_status",
    "gross_amount",
    "currency",
    "updated_at",
    "destination",
    "commission_rate",
    "batch_id",
)


def typed_versions(judged: DataFrame, keep: Sequence[str] = (), wanted: Sequence[str] = VERSION) -> DataFrame:
    """Valid versions with the columns and widths of Silver, or those of them that are ``wanted``."""
    width = {"gross_amount": stored_amount(F.col("gross_amount"), F.col("booking_id")).alias("gross_amount")}
    return accepted(judged).select(*[width.get(name, F.col(name)) for name in VERSION if name in wanted], *keep)


def rank_bookings(
    judged: DataFrame,
    dedup_mode: str = "latest",
    tie_break: Sequence[str] = ("source_row_number",),
    hot: DataFrame | None = None,
    keep: Keep = materialise,
) -> DataFrame:
    """Typed versions with their rank: 1 is the one to keep."""
    order = direction(dedup_mode, ["updated_at", *tie_break])
    ranked = rank_versions(
        typed_versions(judged, tie_break), ["booking_id"], order, "dedup_rank", hot, keep
    )
    return ranked.drop(*tie_break)


def current_candidates(ranked: DataFrame) -> DataFrame:
    return ranked.where("dedup_rank = 1").drop("dedup_rank")


def superseded_bookings(ranked: DataFrame, dedup_mode: str) -> DataFrame:
    return ranked.where("dedup_rank > 1").select(
        *[name for name in ranked.columns if name != "batch_id"],
        F.lit(dedup_mode).alias("dedup_mode"),
        "batch_id",
    )


def booking_rejects(judged: DataFrame) -> DataFrame:
    row_number = F.col("source_row_number")
    return reject(
        rejected(judged),
        "bookings",
        record_id(F.col("booking_id"), "BOOKING_ROW_", row_number),
        F.col("validation_reason"),
        F.lit(c.ROW_FAILED),
        row_number,
        F.col("source_file"),
    )
