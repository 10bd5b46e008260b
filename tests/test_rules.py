"""Every rule alone, and which rule wins."""

import pytest
from feeds import OFFERS, booking, payment
from pyspark.sql import functions as F

from tidemark.operators.rules import Rule, accepted, first_reason, rejected, validate
from tidemark.plans import bookings as b
from tidemark.plans import catalogues as c
from tidemark.plans import payments as p
from tidemark.sources.contracts import BOOKINGS, PAYMENTS

FAULTS = [
    ({name: ""}, c.MISSING_REQUIRED) for name in BOOKINGS.columns if name != "booking_id"
] + [
    ({"client_id": "   "}, c.MISSING_REQUIRED),
    ({"gross_amount": "12,50"}, c.MISSING_REQUIRED),
    ({"gross_amount": "-0.01"}, c.NEGATIVE_AMOUNT),
    ({"gross_amount": "0"}, None),
    ({"booking_ts": "yesterday"}, c.MISSING_REQUIRED),
    ({"service_date": "2031-13-01"}, c.MISSING_REQUIRED),
    ({"updated_at": "x"}, c.MISSING_REQUIRED),
    ({"service_date": "2031-03-03"}, c.INVALID_DATE_ORDER),
    ({"service_date": "2031-03-04", "booking_ts": "2031-03-04T23:59:59Z"}, None),
    ({"booking_status": "HELD"}, c.INVALID_STATUS),
    ({"booking_status": " cancelled"}, None),
    ({"source_channel": "FAX"}, c.INVALID_STATUS),
    ({"source_channel": "b2b_api"}, None),
    ({"currency": "CHF"}, c.UNSUPPORTED_CURRENCY),
    ({"offer_id": "igloo"}, c.UNKNOWN_OFFER),
    ({"offer_id": "jetty"}, c.UNKNOWN_OFFER),
    # Two faults: the earlier rule names the reason.
    ({"gross_amount": "", "booking_status": "HELD"}, c.MISSING_REQUIRED),
    ({"gross_amount": "-1", "booking_ts": "x"}, c.NEGATIVE_AMOUNT),
    ({"service_date": "2031-02-01", "booking_status": "HELD"}, c.INVALID_DATE_ORDER),
    ({"booking_status": "HELD", "currency": "CHF"}, c.INVALID_STATUS),
    ({"source_channel": "FAX", "currency": "CHF"}, c.INVALID_STATUS),
    ({"currency": "CHF", "offer_id": "igloo"}, c.UNSUPPORTED_CURRENCY),
    ({}, None),
]


def test_booking_rules(spark):
    rows = [booking(i, **changes) for i, (changes, _) in enumerate(FAULTS, 1)]
    bronze = spark.createDataFrame(
        [tuple(row[name] or None for name in BOOKINGS.columns) for row in rows],
        ", ".join(f"{name} string" for name in BOOKINGS.columns),
    )
    offers = b.offers_reference(
        spark.createDataFrame(OFFERS, "offer_id string, destination string, commission_rate string, active string")
    )
    found = {
        row["booking_id"]: row["validation_reason"]
        for row in b.validate_bookings(bronze, offers).collect()
    }
    wanted = {f"R{i}": reason for i, (_, reason) in enumerate(FAULTS, 1)}
    assert found == wanted


PAYMENT_FAULTS = [
    ({name: ""}, c.MISSING_REQUIRED) for name in PAYMENTS.columns if name != "payment_id"
] + [
    ({"amount": "ten"}, c.MISSING_REQUIRED),
    ({"amount": "-3"}, c.NEGATIVE_AMOUNT),
    ({"paid_at": "soon"}, c.MISSING_REQUIRED),
    ({"paid_at": "soon", "payment_status": "DECLINED"}, None),
    ({"payment_status": "LOST"}, c.INVALID_STATUS),
    ({"currency": "GBP"}, c.UNSUPPORTED_CURRENCY),
    ({"booking_id": "R99"}, c.MISSING_REQUIRED),
    ({"amount": "100.02"}, c.AMOUNT_MISMATCH),
    ({"amount": "100.01"}, None),
    ({"amount": "99.99"}, None),
    ({"amount": "-3", "booking_id": "R99"}, c.NEGATIVE_AMOUNT),
    ({"payment_status": "LOST", "currency": "GBP"}, c.INVALID_STATUS),
    ({"currency": "GBP", "amount": "1"}, c.UNSUPPORTED_CURRENCY),
    ({}, None),
]


def test_payment_rules(spark):
    of = booking(4, gross_amount="100.00")
    rows = [payment(i, of, **changes) for i, (changes, _) in enumerate(PAYMENT_FAULTS, 1)]
    bronze = spark.createDataFrame(
        [tuple(row[name] or None for name in PAYMENTS.columns) for row in rows],
        ", ".join(f"{name} string" for name in PAYMENTS.columns),
    )
    current = spark.createDataFrame([(of["booking_id"], "100.00")], "booking_id string, a string")
    current = current.select("booking_id", F.col("a").cast("decimal(12,2)").alias("gross_amount"))
    found = {
        row["payment_id"]: row["validation_reason"]
        for row in p.validate_payments(bronze, current).collect()
    }
    wanted = {f"T{i}": reason for i, (_, reason) in enumerate(PAYMENT_FAULTS, 1)}
    assert found == wanted


def test_a_rule_that_is_null_counts_as_kept(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "active boolean")
    judged = validate(df, [Rule("inactive", "INACTIVE", ~F.col("active"))])
    assert accepted(judged).count() == 2
    assert [row["active"] for row in rejected(judged).collect()] == [False]
    assert df.select(first_reason([]).alias("r")).where("r IS NOT NULL").count() == 0


@pytest.mark.parametrize("wrong", ["newest", ""])
def test_unknown_direction(spark, wrong):
    from tidemark.operators.versions import direction

    with pytest.raises(ValueError):
        direction(wrong, ["x"])
