"""Current bookings against their latest payment, and the revenue that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import money
from tidemark.operators.quarantine import reject
from tidemark.plans import catalogues as c
from tidemark.sources.contracts import BOOKINGS

PAYMENT = ("payment_id", "payment_status")


def settle(candidates: DataFrame, latest: DataFrame) -> DataFrame:
    """One join serves the outcome rule, Silver and revenue: both sides are unique per booking."""
    paid = latest.select("booking_id", *PAYMENT)
    unpaid = (F.col("booking_status") == "CONFIRMED") & F.col("payment_id").isNull()
    return candidates.join(paid, "booking_id", "left").withColumn(
        "business_reason", F.when(unpaid, F.lit(c.MISSING_PAYMENT))
    )


def booking_outcome(settled: DataFrame) -> DataFrame:
    return settled.drop(*PAYMENT)


def silver_bookings(settled: DataFrame) -> DataFrame:
    return settled.where(F.col("business_reason").isNull()).drop("business_reason", *PAYMENT)


def missing_payment_rejects(settled: DataFrame) -> DataFrame:
    return reject(
        settled.where(F.col("business_reason").isNotNull()),
        "bookings",
        F.col("booking_id"),
        F.col("business_reason"),
        F.lit(c.NO_PAYMENT),
        source_file=F.lit(BOOKINGS.file_name),
    )


def _detail(eligible: DataFrame) -> DataFrame:
    return eligible.where(
        (F.col("booking_status") == "CONFIRMED") & (F.col("payment_status") == "PAID")
    ).select(
        "booking_id",
        "payment_id",
        F.col("service_date").alias("business_date"),
        "destination",
        "booking_status",
        "payment_status",
        "gross_amount",
        "commission_rate",
        "batch_id",
    )


def revenue_detail(settled: DataFrame) -> DataFrame:
    """Eligible bookings, without any client column."""
    return _detail(settled.where(F.col("business_reason").isNull()))


def revenue_detail_of(silver: DataFrame, latest: DataFrame) -> DataFrame:
    """The same from stored Silver tables, for controls that must not trust ``settle``."""
    return _detail(silver.join(latest.select("booking_id", *PAYMENT), "booking_id"))


def daily_revenue(detail: DataFrame, one_row_per_booking: bool = False) -> DataFrame:
    """Revenue by day and destination. ``one_row_per_booking`` is for detail that ``settle`` made:
    a plain count then equals the distinct one and rows are combined before the only shuffle."""
    count = F.count if one_row_per_booking else F.countDistinct
    gross = F.sum("gross_amount")
    commission = F.sum(F.col("gross_amount") * F.col("commission_rate"))
    return (
        detail.groupBy("business_date", "destination", "batch_id")
        .agg(
            money(gross).alias("gross_revenue_eur"),
            money(commission).alias("commission_revenue_eur"),
            money(gross - commission).alias("net_revenue_eur"),
            count("booking_id").alias("confirmed_bookings"),
        )
        .select(
            "business_date",
            "destination",
            "gross_revenue_eur",
            "commission_revenue_eur",
            "net_revenue_eur",
            "confirmed_bookings",
            "batch_id",
        )
    )
