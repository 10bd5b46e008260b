"""Small text feeds for the tests, written out by hand: a lodge's guests over one week.

Most lines break exactly one rule; "both" lines break two, to see which one names the reason.
"""

import csv
import json
from pathlib import Path

OFFERS = [
    ("attic", "Trondheim", "0.0500", "true"),
    ("cabin", "Ghent", "0.0800", "true"),
    ("barge", "Porto", "0.2000", "true"),
    ("tower", "Zermatt", "0.0250", "true"),
    ("jetty", "Old harbour", "0.1000", "false"),
]


def booking(n, **changes):
    """A line that breaks no rule."""
    return {
        "booking_id": f"R{n}",
        "offer_id": "attic",
        "client_id": f"guest {n}",
        "source_channel": "WEB",
        "booking_status": "CONFIRMED",
        "booking_ts": "2031-03-04T10:00:00Z",
        "service_date": "2031-03-20",
        "gross_amount": "80.00",
        "currency": "EUR",
        "updated_at": "2031-03-04T10:30:00Z",
        **changes,
    }


def payment(n, of, **changes):
    """The full price of a booking, paid if it is confirmed."""
    return {
        "payment_id": f"T{n}",
        "booking_id": of["booking_id"],
        "payment_status": "PAID" if of["booking_status"] == "CONFIRMED" else "DECLINED",
        "amount": of["gross_amount"],
        "currency": "EUR",
        "paid_at": "2031-03-05T09:00:00Z",
        **changes,
    }


def scenario(plain=0):
    """19 booking lines and 13 payments, and ``plain`` more of each that are in order."""
    moved = booking(1, client_id="guest one", updated_at="2031-03-06T08:00:00Z")
    cabin = booking(2, offer_id="cabin", gross_amount="120.50", source_channel="AGENCY")
    asked = booking(3, booking_status="PENDING", source_channel="B2B_API")
    gone = booking(4, booking_status="CANCELLED", offer_id="barge")
    refused = booking(5, gross_amount="61.00")
    short = booking(6, gross_amount="75.25")
    nameless = booking(7, client_id="")
    tower = booking(18, offer_id="tower", service_date="2031-03-22", gross_amount="300.00")
    bookings = [
        booking(1),
        cabin,
        moved,
        nameless,
        asked,
        gone,
        booking(8, offer_id="igloo"),
        booking(9, offer_id="jetty"),
        refused,
        booking(10, service_date="2031-03-01"),
        booking(11, booking_status="HELD"),
        booking(12, source_channel="FAX"),
        short,
        booking(13, gross_amount="-0.01"),
        booking(14, currency="CHF"),
        booking(15, gross_amount="eighty"),
        booking(16, client_id=" ", booking_status="HELD"),  # both
        booking(17, booking_status="HELD", currency="CHF"),  # both
        tower,
    ]
    payments = [
        payment(1, moved),
        payment(2, cabin),
        payment(3, asked),
        payment(4, gone, payment_status="REFUNDED"),
        payment(5, refused, payment_status="DECLINED"),
        payment(6, short, amount="70.25"),
        payment(7, tower),
        payment(8, booking(99)),
        payment(9, cabin, payment_status="MAYBE"),
        payment(10, cabin, amount="-5"),
        payment(11, cabin, currency="CHF"),
        payment(12, cabin, paid_at=""),
        payment(13, nameless),
    ]
    more = [booking(n, offer_id="barge") for n in range(1001, 1001 + plain)]
    return bookings + more, payments + [payment(n, of) for n, of in enumerate(more, 1001)]


def write_feeds(folder, bookings, payments, offers=OFFERS):
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / "bookings.csv", "w", newline="") as out:
        writer = csv.DictWriter(out, list(bookings[0]))
        writer.writeheader()
        writer.writerows(bookings)
    with open(folder / "payments.jsonl", "w") as out:
        out.writelines(json.dumps(row) + "\n" for row in payments)
    with open(folder / "offers.csv", "w", newline="") as out:
        csv.writer(out).writerows([("offer_id", "destination", "commission_rate", "active"), *offers])
    return str(folder)
