"""Gold recomputed straight from Bronze, sharing no code with the pipeline's own chain.

Rows are kept by predicates here, not rejected by reasons, and the written contract is read
strictly: offers need a destination, a rate between 0 and 1 and an active flag; only PAID and
REFUNDED need paid_at; the latest payment is chosen before its amount is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def expected_offers(bronze_offers: DataFrame) -> DataFrame:
    return bronze_offers.selectExpr(
        "offer_id",
        "trim(destination) AS destination",
        "try_cast(commission_rate AS decimal(9,6)) AS commission_rate",
        "try_cast(cast(active AS string) AS boolean) AS is_active",
    ).where(
        "trim(offer_id) <> '' AND destination <> '' AND commission_rate BETWEEN 0 AND 1"
        " AND is_active"
    ).drop("is_active")


def expected_bookings(
    bronze_bookings: DataFrame, offers: DataFrame, tie_break: Sequence[str]
) -> DataFrame:
    typed = bronze_bookings.selectExpr(
        "booking_id",
        "offer_id",
        "client_id",
        "upper(trim(source_channel)) AS channel",
        "upper(trim(booking_status)) AS booking_status",
        "upper(trim(currency)) AS currency",
        "cast(try_cast(booking_ts AS timestamp_ntz) AS date) AS booked_on",
        "try_cast(service_date AS date) AS business_date",
        "try_cast(updated_at AS timestamp_ntz) AS version",
        "try_cast(gross_amount AS decimal(18,2)) AS gross_amount",
        *tie_break,
    )
    # Channels, booking statuses and the currency, stated here again on purpose.
    valid = typed.where(
        "trim(booking_id) <> '' AND trim(offer_id) <> '' AND trim(client_id) <> ''"
        " AND channel IN ('WEB', 'AGENCY', 'B2B_API')"
        " AND booking_status IN ('PENDING', 'CONFIRMED', 'CANCELLED')"
        " AND currency = 'EUR' AND version IS NOT NULL AND gross_amount >= 0"
        " AND business_date >= booked_on"
    ).join(offers, "offer_id")
    newest = Window.partitionBy("booking_id").orderBy(
        F.desc("version"), *[F.desc(name) for name in tie_break]
    )
    return valid.withColumn("nth", F.row_number().over(newest)).where("nth = 1").drop("nth")


def expected_payments(bronze_payments: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    typed = bronze_payments.selectExpr(
        "payment_id",
        "booking_id",
        "upper(trim(payment_status)) AS payment_status",
        "upper(trim(currency)) AS payment_currency",
        "try_cast(amount AS decimal(18,2)) AS paid_amount",
        "try_cast(paid_at AS timestamp_ntz) AS paid_at",
        *tie_break,
    )
    # Payment statuses and the currency.
    valid = typed.where(
        "trim(payment_id) <> '' AND trim(booking_id) <> ''"
        " AND payment_status IN ('PAID', 'DECLINED', 'REFUNDED')"
        " AND paid_amount >= 0 AND payment_currency = 'EUR'"
        " AND (payment_status = 'DECLINED' OR paid_at IS NOT NULL)"
    )
    newest = Window.partitionBy("booking_id").orderBy(
        F.desc_nulls_last("paid_at"), *[F.desc(name) for name in tie_break]
    )
    return (
        valid.withColumn("nth", F.row_number().over(newest))
        .where("nth = 1")
        .select("booking_id", "payment_status", "payment_currency", "paid_amount")
    )


def expected_gold(
    bronze_bookings: DataFrame,
    bronze_payments: DataFrame,
    bronze_offers: DataFrame,
    batch_id: str,
    booking_tie_break: Sequence[str] = ("source_row_number",),
    payment_tie_break: Sequence[str] = ("source_row_number",),
) -> DataFrame:
    bookings = expected_bookings(bronze_bookings, expected_offers(bronze_offers), booking_tie_break)
    payments = expected_payments(bronze_payments, payment_tie_break)
    eligible = bookings.join(payments, "booking_id").where(
        "booking_status = 'CONFIRMED' AND payment_status = 'PAID'"
        " AND currency = payment_currency AND abs(gross_amount - paid_amount) <= 0.01"
    )
    summed = eligible.groupBy("business_date", "destination").agg(
        F.expr("count(DISTINCT booking_id)").alias("confirmed_bookings"),
        F.expr("round(sum(gross_amount), 2)").alias("gross"),
        F.expr("round(sum(gross_amount * commission_rate), 2)").alias("commission"),
    )
    return summed.selectExpr(
        "business_date",
        "destination",
        "confirmed_bookings",
        "cast(gross AS decimal(18,2)) AS gross_revenue_eur",
        "cast(commission AS decimal(18,2)) AS commission_revenue_eur",
        "cast(round(gross - commission, 2) AS decimal(18,2)) AS net_revenue_eur",
    ).withColumn("batch_id", F.lit(batch_id))
