"""Bronze payments, matched to current bookings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    amount,
    any_blank,
    beyond_cent,
    code,
    instant,
    is_blank,
    record_id,
    stored_amount,
)
from tidemark.operators.quarantine import reject
from tidemark.operators.rules import Rule, accepted, rejected, validate
from tidemark.operators.versions import keep_one
from tidemark.plans import catalogues as c
from tidemark.plans.bookings import Strictness
from tidemark.sources.contracts import PAYMENTS


def payment_rules(strict: Strictness = Strictness()) -> list[Rule]:
    value, paid_at, status = F.col("parsed_amount"), F.col("parsed_paid_at"), code(F.col("payment_status"))
    mandatory = PAYMENTS.columns
    needs_paid_at = ("PAID", "REFUNDED")
    if strict.paid_at_required_for is not None:
        mandatory = tuple(name for name in mandatory if name != "paid_at")
        needs_paid_at = strict.paid_at_required_for
    return [
        Rule("mandatory fields", c.MISSING_REQUIRED, any_blank(mandatory)),
        Rule("amount is a number", c.MISSING_REQUIRED, value.isNull()),
        Rule("amount sign", c.NEGATIVE_AMOUNT, value < 0),
        Rule("paid_at", c.MISSING_REQUIRED, status.isin(*needs_paid_at) & paid_at.isNull()),
        Rule("status", c.INVALID_STATUS, ~status.isin(*c.PAYMENT_STATUSES)),
        Rule("currency", c.UNSUPPORTED_CURRENCY, code(F.col("currency")) != c.CURRENCY),
        Rule("booking exists", c.MISSING_REQUIRED, F.col("booking_gross_amount").isNull()),
        Rule(
            "amounts agree", c.AMOUNT_MISMATCH, beyond_cent(value, F.col("booking_gross_amount"))
        ),
    ]


def validate_payments(
    bronze: DataFrame, candidates: DataFrame, strict: Strictness = Strictness()
) -> DataFrame:
    """All Bronze payments with the amount of their current booking and a reason.

    A current booking always has an amount, so a NULL there means that none matched. Payments
    whose booking id is missing or blank cannot match, as no accepted booking has such a one; they pass the
    join by instead of gathering in one task.
    Bookings are unique on the right, so a booking with very many payments is split by adaptive
    skew handling.
    """
    booked = candidates.select("booking_id", F.col("gross_amount").alias("booking_gross_amount"))
    parsed = bronze.select(
        "*",
        amount(F.col("amount"), strict.text_forms).alias("parsed_amount"),
        instant(F.col("paid_at"), strict.text_forms).alias("parsed_paid_at"),
    )
    nowhere = is_blank(F.col("booking_id"))
    named = parsed.where(~nowhere).join(booked, "booking_id", "left")
    nameless = parsed.where(nowhere)
    amount_type = booked.schema["booking_gross_amount"].dataType
    nameless = nameless.withColumn("booking_gross_amount", F.lit(None).cast(amount_type))
    return validate(named.unionByName(nameless), payment_rules(strict))


def payment_validation(validated: DataFrame) -> DataFrame:
    return validated.drop("parsed_amount", "parsed_paid_at")


def judged_payments(validated: DataFrame) -> DataFrame:
    """Every payment's final values and reason, without raw text."""
    return validated.select(
        "source_row_number",
        "payment_id",
        "booking_id",
        code(F.col("payment_status")).alias("payment_status"),
        F.col("parsed_amount").alias("amount"),
        code(F.col("currency")).alias("currency"),
        F.col("parsed_paid_at").alias("paid_at"),
        "booking_gross_amount",
        "validation_reason",
        "source_file",
        "batch_id",
    )


def silver_payments(judged: DataFrame) -> DataFrame:
    return accepted(judged).select(
        "payment_id",
        "booking_id",
        "payment_status",
        stored_amount(F.col("amount"), F.col("payment_id")).alias("amount"),
        "currency",
        "paid_at",
        "batch_id",
    )


def latest_payment(silver: DataFrame) -> DataFrame:
    order = [F.col("paid_at").desc_nulls_last(), F.col("payment_id").desc_nulls_last()]
    return keep_one(silver, ["booking_id"], order)


def payment_rejects(judged: DataFrame) -> DataFrame:
    reason, row_number = F.col("validation_reason"), F.col("source_row_number")
    unmatched = (reason == c.MISSING_REQUIRED) & F.col("booking_gross_amount").isNull()
    details = (
        F.when(reason == c.AMOUNT_MISMATCH, c.AMOUNT_DIFFERS)
        .when(unmatched, c.NO_BOOKING)
        .otherwise(c.ROW_FAILED)
    )
    return reject(
        rejected(judged),
        "payments",
        record_id(F.col("payment_id"), "PAYMENT_ROW_", row_number),
        reason,
        details,
        row_number,
        F.col("source_file"),
    )
