"""Fixed values of the booking domain."""

# Allowed codes.
BOOKING_STATUSES = ("PENDING", "CONFIRMED", "CANCELLED")
PAYMENT_STATUSES = ("PAID", "DECLINED", "REFUNDED")
CHANNELS = ("WEB", "AGENCY", "B2B_API")
CURRENCY = "EUR"

# Quarantine reasons.
MISSING_REQUIRED = "MISSING_REQUIRED"
INVALID_STATUS = "INVALID_STATUS"
INVALID_DATE_ORDER = "INVALID_DATE_ORDER"
NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
UNSUPPORTED_CURRENCY = "UNSUPPORTED_CURRENCY"
UNKNOWN_OFFER = "UNKNOWN_OFFER"
MISSING_PAYMENT = "MISSING_PAYMENT"
AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
REASONS = (
    MISSING_REQUIRED,
    INVALID_STATUS,
    INVALID_DATE_ORDER,
    NEGATIVE_AMOUNT,
    UNSUPPORTED_CURRENCY,
    UNKNOWN_OFFER,
    MISSING_PAYMENT,
    AMOUNT_MISMATCH,
)

# Explanations stored with rejects.
ROW_FAILED = "Row-level contract validation failed"
NO_PAYMENT = "Current CONFIRMED booking has no usable payment"
AMOUNT_DIFFERS = "Payment amount differs from current booking amount"
NO_BOOKING = "Payment references an unknown or unusable booking"

# Column names that count as personal data.
PERSONAL_IN_GOLD = ("client_id", "email", "first_name", "last_name")
PERSONAL_ANYWHERE = (
    "client_id",
    "client_name",
    "full_name",
    "first_name",
    "last_name",
    "email",
    "phone",
    "telephone",
    "address",
    "postal_address",
)
