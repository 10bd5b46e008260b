"""The catalogue's questions in SQL, written against the tables and not against the Spark code.

Fixed values, as in ``plans/catalogues.py``: the statuses, channels, currency, reason codes and
explanations, the check ids with their severities, and the personal column names.
"""

from __future__ import annotations

BOOKINGS = """
booking_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS booking_id,
         CAST(l_partkey AS VARCHAR) AS offer_id,
         CAST(o_custkey AS VARCHAR) AS client_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'FAX' ELSE 'WEB' END AS source_channel,
         CAST(o_orderdate AS TIMESTAMP) AS booking_ts,
         CAST(l_shipdate AS DATE) AS service_date,
         CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'PENDING'
                            WHEN 'P' THEN 'CANCELLED' END AS booking_status,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'USD' ELSE 'EUR' END AS currency,
         CAST(l_shipdate AS TIMESTAMP) AS updated_at,
         l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
),
offer AS (
  SELECT CAST(p_partkey AS VARCHAR) AS offer_id, p_brand AS destination,
         CAST(p_size / 1000 AS DECIMAL(5,4)) AS commission_rate,
         p_type <> 'ECONOMY' AS active
  FROM part
),
judged AS (
  SELECT f.*, o.destination, o.commission_rate, o.active,
         CASE WHEN f.gross_amount < 0 THEN 'NEGATIVE_AMOUNT'
              WHEN f.service_date < CAST(f.booking_ts AS DATE) THEN 'INVALID_DATE_ORDER'
              WHEN f.source_channel = 'FAX' THEN 'INVALID_STATUS'
              WHEN f.currency <> 'EUR' THEN 'UNSUPPORTED_CURRENCY'
              WHEN o.offer_id IS NULL OR NOT o.active THEN 'UNKNOWN_OFFER' END AS reason
  FROM booking_feed f LEFT JOIN offer o ON o.offer_id = f.offer_id
)"""


def ranked(direction: str = "DESC") -> str:
    d = direction
    return f"""{BOOKINGS},
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY booking_id
           ORDER BY updated_at {d}, gross_amount {d}, l_partkey {d}, l_suppkey {d}) AS dedup_rank
  FROM judged WHERE reason IS NULL
),
current AS (SELECT * FROM ranked WHERE dedup_rank = 1)"""


def settled(direction: str = "DESC") -> str:
    return f"""{ranked(direction)},
payment_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS booking_id,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
         CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS payment_id,
         CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'R' THEN 'REFUNDED'
                           WHEN 'A' THEN 'DECLINED' END AS payment_status,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
         'EUR' AS currency,
         CAST(l_shipdate AS TIMESTAMP) AS paid_at
  FROM lineitem WHERE l_linestatus = 'F'
),
matched AS (
  SELECT p.*, c.gross_amount AS booking_gross_amount,
         CASE WHEN p.amount < 0 THEN 'NEGATIVE_AMOUNT'
              WHEN c.booking_id IS NULL THEN 'MISSING_REQUIRED'
              WHEN ABS(p.amount - c.gross_amount) > 0.01 THEN 'AMOUNT_MISMATCH' END AS reason
  FROM payment_feed p LEFT JOIN current c ON c.booking_id = p.booking_id
),
latest AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY booking_id
             ORDER BY paid_at DESC NULLS LAST, payment_id DESC) AS n
    FROM matched WHERE reason IS NULL) WHERE n = 1
),
settled AS (
  SELECT c.*, l.payment_id, l.payment_status,
         c.booking_status = 'CONFIRMED' AND l.booking_id IS NULL AS unpaid
  FROM current c LEFT JOIN latest l ON l.booking_id = c.booking_id
),
detail AS (
  SELECT * FROM settled
  WHERE NOT unpaid AND booking_status = 'CONFIRMED' AND payment_status = 'PAID'
),
gold AS (
  SELECT service_date AS business_date, destination,
         CAST(ROUND(SUM(gross_amount), 2) AS DECIMAL(18,2)) AS gross_revenue_eur,
         CAST(ROUND(SUM(gross_amount * commission_rate), 2) AS DECIMAL(18,2))
           AS commission_revenue_eur,
         CAST(ROUND(SUM(gross_amount) - SUM(gross_amount * commission_rate), 2) AS DECIMAL(18,2))
           AS net_revenue_eur,
         COUNT(DISTINCT booking_id) AS confirmed_bookings, 'STAR' AS batch_id
  FROM detail GROUP BY 1, 2
),
rejects AS (
  SELECT 'bookings' AS source_entity, booking_id AS record_id, reason AS reason_code,
         'Row-level contract validation failed' AS details
  FROM judged WHERE reason IS NOT NULL
  UNION ALL
  SELECT 'bookings', booking_id, 'MISSING_PAYMENT',
         'Current CONFIRMED booking has no usable payment'
  FROM settled WHERE unpaid
  UNION ALL
  SELECT 'payments', payment_id, reason,
         CASE WHEN reason = 'AMOUNT_MISMATCH'
              THEN 'Payment amount differs from current booking amount'
              WHEN reason = 'MISSING_REQUIRED' AND booking_gross_amount IS NULL
              THEN 'Payment references an unknown or unusable booking'
              ELSE 'Row-level contract validation failed' END
  FROM matched WHERE reason IS NOT NULL
)"""


RECALCULATED = f"""{settled()},
oracle_bookings AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT f.*, o.destination, o.commission_rate, ROW_NUMBER() OVER (PARTITION BY f.booking_id
             ORDER BY f.updated_at DESC, f.gross_amount DESC, f.l_partkey DESC, f.l_suppkey DESC) n
    FROM booking_feed f JOIN offer o ON o.offer_id = f.offer_id AND o.active
         AND o.commission_rate BETWEEN 0 AND 1
    WHERE f.source_channel <> 'FAX' AND f.currency = 'EUR' AND f.gross_amount >= 0
      AND f.service_date >= CAST(f.booking_ts AS DATE)) WHERE n = 1
),
oracle_payments AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY booking_id
             ORDER BY paid_at DESC NULLS LAST, payment_id DESC) AS n
    FROM payment_feed) WHERE n = 1
),
oracle_sums AS (
  SELECT b.service_date AS business_date, b.destination,
         COUNT(DISTINCT b.booking_id) AS confirmed_bookings,
         ROUND(SUM(b.gross_amount), 2) AS gross,
         ROUND(SUM(b.gross_amount * b.commission_rate), 2) AS commission
  FROM oracle_bookings b JOIN oracle_payments p ON p.booking_id = b.booking_id
  WHERE b.booking_status = 'CONFIRMED' AND p.payment_status = 'PAID'
    AND ABS(b.gross_amount - p.amount) <= 0.01
  GROUP BY 1, 2
),
oracle_gold AS (
  SELECT business_date, destination, confirmed_bookings,
         CAST(gross AS DECIMAL(18,2)) AS gross_revenue_eur,
         CAST(commission AS DECIMAL(18,2)) AS commission_revenue_eur,
         CAST(ROUND(gross - commission, 2) AS DECIMAL(18,2)) AS net_revenue_eur,
         'STAR' AS batch_id
  FROM oracle_sums
)"""

VERSION = (
    "l_orderkey, l_linenumber, CAST(l_shipdate AS TIMESTAMP) AS shipped_at,"
    " CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_partkey, l_suppkey"
)


def line_rank(direction: str) -> str:
    d = direction
    return (
        f"SELECT {VERSION}, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY"
        f" CAST(l_shipdate AS TIMESTAMP) {d}, CAST(l_extendedprice AS DECIMAL(12,2)) {d},"
        f" l_partkey {d}, l_suppkey {d}) AS dedup_rank FROM lineitem"
    )


TYPED = (
    "booking_id, offer_id, sha256(client_id) AS client_id_hash, source_channel, booking_ts,"
    " service_date, booking_status, gross_amount, currency, updated_at, destination,"
    " commission_rate"
)


def gold_difference(expected: str) -> str:
    """Full outer comparison of two revenue tables; the tables have unique keys."""
    money = ("gross_revenue_eur", "commission_revenue_eur", "net_revenue_eur")
    values = ", ".join(
        f"e.{v} AS expected_{v}, g.{v} AS actual_{v}" for v in ("confirmed_bookings", *money)
    )
    off = " OR ".join(
        f"e.{v} IS NULL OR g.{v} IS NULL OR ABS(e.{v} - g.{v}) > 0.01" for v in money
    )
    return f"""
  SELECT COALESCE(e.business_date, g.business_date) AS business_date,
         COALESCE(e.destination, g.destination) AS destination, 'STAR' AS batch_id,
         CAST(e.business_date IS NOT NULL AS BIGINT) AS expected_rows,
         CAST(g.business_date IS NOT NULL AS BIGINT) AS actual_rows, {values}
  FROM {expected} e
  FULL OUTER JOIN gold g ON g.business_date = e.business_date AND g.destination = e.destination
  WHERE e.confirmed_bookings IS DISTINCT FROM g.confirmed_bookings OR {off}"""


def verdict(counts: dict[str, tuple[str, str]], prefix: str) -> str:
    """Rows of (check_id, status, severity, violations) from one count query per check."""
    rows = " UNION ALL ".join(
        f"SELECT '{check}' AS check_id, '{severity}' AS severity, CAST(({sql}) AS BIGINT) AS n"
        for check, (severity, sql) in counts.items()
    )
    return (
        f"{prefix}, verdicts AS ({rows}) SELECT check_id, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL'"
        " END AS status, severity, n AS violations FROM verdicts"
    )


DELTA = (
    "(SELECT COUNT(*) FROM booking_feed) - (SELECT COUNT(*) FROM settled WHERE NOT unpaid)"
    " - (SELECT COUNT(*) FROM ranked WHERE dedup_rank > 1)"
    " - (SELECT COUNT(*) FROM rejects WHERE source_entity = 'bookings')"
)
REPEATED = "COUNT(*) FROM (SELECT booking_id FROM settled WHERE NOT unpaid GROUP BY 1 HAVING COUNT(*) > 1)"
STALE = (
    "COUNT(*) FROM settled s JOIN (SELECT booking_id, MAX(updated_at) AS newest FROM ranked"
    " GROUP BY 1) m ON m.booking_id = s.booking_id WHERE NOT s.unpaid AND s.updated_at <> m.newest"
)
ORPHAN_DETAIL = (
    "COUNT(*) FROM detail d LEFT JOIN (SELECT * FROM settled WHERE NOT unpaid) s"
    " ON s.booking_id = d.booking_id LEFT JOIN (SELECT * FROM matched WHERE reason IS NULL) m"
    " ON m.payment_id = d.payment_id WHERE s.booking_id IS NULL OR m.payment_id IS NULL"
)
MISMATCHED = (
    "COUNT(*) FROM matched m JOIN settled s ON s.booking_id = m.booking_id"
    " WHERE m.reason IS NULL AND NOT s.unpaid AND ABS(m.amount - s.gross_amount) > 0.01"
)
TOO_EARLY = (
    "COUNT(*) FROM settled WHERE NOT unpaid AND service_date < CAST(booking_ts AS DATE)"
)
INELIGIBLE = "COUNT(*) FROM detail WHERE booking_status <> 'CONFIRMED' OR payment_status <> 'PAID'"
EXPECTED = """,
expected AS (
  SELECT s.service_date AS business_date, s.destination,
         CAST(ROUND(SUM(s.gross_amount), 2) AS DECIMAL(18,2)) AS g,
         CAST(ROUND(SUM(s.gross_amount * s.commission_rate), 2) AS DECIMAL(18,2)) AS c,
         COUNT(DISTINCT s.booking_id) AS n
  FROM settled s JOIN latest l ON l.booking_id = s.booking_id
  WHERE NOT s.unpaid AND s.booking_status = 'CONFIRMED' AND l.payment_status = 'PAID'
  GROUP BY 1, 2
),
published AS (
  SELECT business_date, destination, gross_revenue_eur AS g, commission_revenue_eur AS c,
         confirmed_bookings AS n FROM gold
)"""
SURPLUS = (
    "COUNT(*) FROM ((SELECT * FROM expected EXCEPT ALL SELECT * FROM published) UNION ALL"
    " (SELECT * FROM published EXCEPT ALL SELECT * FROM expected))"
)

GOLD_FIELDS = (
    "business_date, destination, gross_revenue_eur, commission_revenue_eur, net_revenue_eur,"
    " confirmed_bookings, batch_id"
)
GATE = {
    "AC03": ("CRITICAL", f"SELECT {DELTA}"),
    "AC04A": ("HIGH", f"SELECT {REPEATED}"),
    "AC04B": ("HIGH", f"SELECT {STALE}"),
    "AC05": ("HIGH", f"SELECT {ORPHAN_DETAIL}"),
    "AC06": ("CRITICAL", f"SELECT {INELIGIBLE}"),
    "AC07": ("HIGH", f"SELECT {MISMATCHED}"),
    "AC08": ("MEDIUM", f"SELECT {TOO_EARLY}"),
    "AC10": ("CRITICAL", f"SELECT {SURPLUS}"),
    "R09": (
        "HIGH",
        f"SELECT COUNT(*) FROM (SELECT UNNEST(string_split('{GOLD_FIELDS}', ', ')) AS name) WHERE name IN"
        " ('client_id', 'email', 'first_name', 'last_name')",
    ),
}

STALE_ACCEPTED = (
    "COUNT(*) FROM settled s JOIN (SELECT booking_id, MAX(updated_at) AS newest FROM ("
    "SELECT booking_id, updated_at FROM settled WHERE NOT unpaid UNION ALL"
    " SELECT booking_id, updated_at FROM ranked WHERE dedup_rank > 1) GROUP BY 1) m"
    " ON m.booking_id = s.booking_id WHERE NOT s.unpaid AND s.updated_at IS DISTINCT FROM m.newest"
)
CONTROLS = {
    "AC02A": (
        "CRITICAL",
        "SELECT (SELECT COUNT(*) FROM settled WHERE NOT unpaid AND (booking_id IS NULL OR"
        " offer_id IS NULL OR client_id IS NULL OR booking_ts IS NULL OR service_date IS NULL OR"
        " gross_amount IS NULL OR updated_at IS NULL)) + (SELECT COUNT(*) FROM matched WHERE"
        " reason IS NULL AND (payment_id IS NULL OR payment_status IS NULL OR amount IS NULL OR"
        " paid_at IS NULL))",
    ),
    "AC02B": (
        "CRITICAL",
        "SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END + COUNT(*) FILTER (WHERE reason_code NOT IN"
        " ('MISSING_REQUIRED', 'INVALID_STATUS', 'INVALID_DATE_ORDER', 'NEGATIVE_AMOUNT',"
        " 'UNSUPPORTED_CURRENCY', 'UNKNOWN_OFFER', 'MISSING_PAYMENT', 'AMOUNT_MISMATCH'))"
        " FROM rejects",
    ),
    "AC03": ("CRITICAL", f"SELECT {DELTA}"),
    "AC04A": ("HIGH", f"SELECT {REPEATED}"),
    "AC04B": ("HIGH", f"SELECT {STALE_ACCEPTED}"),
    "AC05": (
        "HIGH",
        "SELECT (SELECT COUNT(*) FROM settled s LEFT JOIN (SELECT DISTINCT offer_id FROM offer"
        " WHERE active) o ON o.offer_id = s.offer_id WHERE NOT s.unpaid AND o.offer_id IS NULL)"
        " + (SELECT COUNT(*) FROM matched m LEFT JOIN (SELECT * FROM settled WHERE NOT unpaid) s"
        " ON s.booking_id = m.booking_id WHERE m.reason IS NULL AND s.booking_id IS NULL)"
        f" + (SELECT {ORPHAN_DETAIL})",
    ),
    "AC06": (
        "CRITICAL",
        "SELECT ABS((SELECT COALESCE(SUM(confirmed_bookings), 0) FROM oracle_gold) -"
        " (SELECT COALESCE(SUM(confirmed_bookings), 0) FROM gold)) + CASE WHEN ABS("
        "(SELECT COALESCE(SUM(gross_revenue_eur), 0) FROM oracle_gold) -"
        " (SELECT COALESCE(SUM(gross_revenue_eur), 0) FROM gold)) > 0.01 THEN 1 ELSE 0 END"
        f" + (SELECT {INELIGIBLE})",
    ),
    "AC07": (
        "HIGH",
        "SELECT (SELECT COUNT(*) FROM settled WHERE NOT unpaid AND booking_status NOT IN"
        " ('PENDING', 'CONFIRMED', 'CANCELLED')) + (SELECT COUNT(*) FROM matched WHERE reason IS"
        f" NULL AND payment_status NOT IN ('PAID', 'DECLINED', 'REFUNDED')) + (SELECT {MISMATCHED})",
    ),
    "AC08": ("MEDIUM", f"SELECT {TOO_EARLY}"),
    "AC09A": (
        "HIGH",
        "SELECT COUNT(*) FROM (SELECT 1 FROM gold GROUP BY business_date, destination, batch_id"
        " HAVING COUNT(*) > 1)",
    ),
    "AC10": ("CRITICAL", f"SELECT COUNT(*) FROM ({gold_difference('oracle_gold')})"),
    "R09": (
        "HIGH",
        "SELECT COUNT(*) FROM settled WHERE NOT unpaid AND NOT"
        " REGEXP_FULL_MATCH(sha256(client_id), '[0-9a-f]{64}')",
    ),
}
# Every line of a feed is a Bronze row of exactly one file: what the joins drop or repeat is a gap.
UNFED = (
    "SELECT (SELECT COUNT(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders JOIN"
    " customer ON o_custkey = c_custkey)) - (SELECT COUNT(*) FROM booking_feed)"
)
FILE_CONTROLS = {
    "AC01A": ("CRITICAL", UNFED),
    "AC01B": ("CRITICAL", UNFED),
    **CONTROLS,
}
FED = (
    "SELECT 'bookings' AS source_name, 'bookings.csv' AS file_name, COUNT(*) AS n FROM lineitem"
    " JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey UNION ALL"
    " SELECT 'payments', 'payments.jsonl', COUNT(*) FROM lineitem WHERE l_linestatus = 'F' UNION ALL"
    " SELECT 'offers', 'offers.csv', COUNT(*) FROM part"
)


def faulty() -> str:
    """The settled tables of feeds with broken text; NULL stands for text that is no value."""
    changes = [
        ("CASE WHEN f.gross_amount < 0 THEN 'NEGATIVE_AMOUNT'",
         "CASE WHEN f.l_partkey % 37 IN (0, 1, 6) THEN 'MISSING_REQUIRED'"
         " WHEN f.l_partkey % 37 = 2 OR f.gross_amount < 0 THEN 'NEGATIVE_AMOUNT'"
         " WHEN f.l_partkey % 37 = 3 THEN 'MISSING_REQUIRED'"),
        ("WHEN f.source_channel = 'FAX' THEN", "WHEN f.l_partkey % 37 = 4 OR f.source_channel = 'FAX' THEN"),
        ("WHEN o.offer_id IS NULL OR NOT o.active", "WHEN f.l_partkey % 37 = 5 OR o.offer_id IS NULL OR NOT o.active"),
        ("p_type <> 'ECONOMY' AS active", "CASE WHEN p_partkey % 29 <> 0 THEN p_type <> 'ECONOMY' END AS active"),
        ("CAST(l_shipdate AS TIMESTAMP) AS paid_at\n", "CAST(l_shipdate AS TIMESTAMP) AS paid_at, l_suppkey % 11 AS fault\n"),
        ("CASE WHEN p.amount < 0 THEN 'NEGATIVE_AMOUNT'",
         "CASE WHEN p.fault IN (0, 1) THEN 'MISSING_REQUIRED'"
         " WHEN p.fault = 2 OR p.amount < 0 THEN 'NEGATIVE_AMOUNT'"
         " WHEN p.fault = 3 AND p.payment_status IN ('PAID', 'REFUNDED') THEN 'MISSING_REQUIRED'"
         " WHEN p.fault = 4 THEN 'INVALID_STATUS' WHEN p.fault = 5 THEN 'UNSUPPORTED_CURRENCY'"),
    ]
    text = settled()
    for before, after in changes:
        assert text.count(before) == 1, before
        text = text.replace(before, after)
    return text


def summary(verdicts: str) -> str:
    return (
        "SELECT COUNT(*) AS checks_total, COUNT(*) FILTER (WHERE status = 'PASS') AS checks_pass,"
        " COUNT(*) FILTER (WHERE status = 'FAIL') AS checks_fail,"
        " COUNT(*) FILTER (WHERE status = 'NOT_EVALUATED') AS checks_not_evaluated,"
        " CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL' AND severity IN ('CRITICAL', 'HIGH')) > 0"
        f" THEN 'NO-GO' ELSE 'GO' END AS decision FROM ({verdicts})"
    )


FIELDS = GOLD_FIELDS
GOLD_TEXT = (
    "CONCAT_WS('|', CAST(business_date AS VARCHAR), destination,"
    " CAST(confirmed_bookings AS VARCHAR), CAST(gross_revenue_eur AS VARCHAR),"
    " CAST(commission_revenue_eur AS VARCHAR), CAST(net_revenue_eur AS VARCHAR), batch_id)"
)
GOLD_JSON = "'[' || CONCAT_WS(',', {}) || ']'".format(
    ", ".join(f"'\"' || CAST({name.strip()} AS VARCHAR) || '\"'" for name in FIELDS.split(","))
)

# Row numbers of the text feeds: their files are written in this order.
NUMBERED = f"""{settled()},
numbered_bookings AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY booking_id, updated_at, gross_amount, l_partkey, l_suppkey)
           AS source_row_number FROM judged
),
numbered_payments AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY payment_id, paid_at, amount) AS source_row_number
  FROM matched
)"""


def tree_digest(rows: str, fan: int, name: str = "digest", extra: str = "") -> str:
    """The root over ``rows``, a query of ``n`` (from 0) and ``t``, the text of a row; enough for fan ** 4 rows."""
    level = "SELECT n // {0} AS n, sha256(string_agg(d, '' ORDER BY n)) AS d FROM {1} GROUP BY 1"
    levels = ", ".join(f"l{i} AS ({level.format(fan, f'l{i - 1}')})" for i in range(1, 5))
    top = " ".join(f"WHEN (SELECT COUNT(*) FROM l{i}) = 1 THEN (SELECT MAX(d) FROM l{i})" for i in range(1, 5))
    return (
        f"l0 AS (SELECT n, sha256(t) AS d FROM ({rows})), {levels} SELECT {extra}"
        f" CASE {top} ELSE sha256('') END AS {name}"
    )


CLIENT = (
    "CASE l_partkey % 23 WHEN 0 THEN 'guest' || chr(10) || client_id WHEN 1 THEN client_id || ', \"of\"' ||"
    " chr(10) || chr(10) || 'the house' WHEN 2 THEN client_id || '\" pipe' ELSE client_id END"
)

ORACLE = {
    "latest_version": f"SELECT * EXCLUDE (dedup_rank) FROM ({line_rank('DESC')}) WHERE dedup_rank = 1",
    "oldest_version": f"SELECT * EXCLUDE (dedup_rank) FROM ({line_rank('ASC')}) WHERE dedup_rank = 1",
    "ranked_versions": line_rank("DESC"),
    "ranked_events_by_type": (
        "SELECT event_type, CAST(ts AS TIMESTAMP) AS ts, event_id, user_id, ROW_NUMBER() OVER ("
        "PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS type_rank FROM events"
    ),
    "latest_event_per_user": (
        "SELECT * EXCLUDE (n) FROM (SELECT user_id, ts, event_id, event_type,"
        " CAST(value AS DECIMAL(12,2)) AS value, ROW_NUMBER() OVER (PARTITION BY user_id"
        " ORDER BY ts DESC NULLS LAST, event_id DESC) AS n FROM events) WHERE n = 1"
    ),
    "row_numbers": (
        f"SELECT *, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, shipped_at, price,"
        f" l_partkey, l_suppkey) AS source_row_number FROM (SELECT {VERSION} FROM lineitem)"
    ),
    "normalised_codes": (
        "SELECT CAST(c_custkey AS VARCHAR) AS customer, UPPER(TRIM('  ' || LOWER(c_mktsegment) ||"
        " ' ')) AS segment, c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD') AS outside_catalogue"
        " FROM customer"
    ),
    "required_blank": (
        "SELECT source, COUNT(*) AS rows, COUNT(*) FILTER (WHERE NULLIF(TRIM(text), '') IS NULL"
        " OR NULLIF(TRIM(lang), '') IS NULL OR NULLIF(TRIM(source), '') IS NULL"
        " OR quality IS NULL) AS blank_rows"
        " FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source"
    ),
    "safe_casts": (
        "SELECT c_nationkey, COUNT(TRY_CAST(t AS DECIMAL(18,2))) AS parsed_amounts,"
        " COUNT(TRY_CAST(c_name AS DECIMAL(18,2))) AS parsed_names,"
        " COUNT(TRY_CAST(c_name AS TIMESTAMP)) AS parsed_instants,"
        " COUNT(TRY_CAST(c_name AS BOOLEAN)) AS parsed_flags,"
        " CAST(SUM(TRY_CAST(t AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS balance FROM (SELECT *,"
        " CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS t FROM customer) GROUP BY 1"
    ),
    "fallback_ids": (
        "SELECT event_id, COALESCE(NULLIF(CASE WHEN event_type = 'error' THEN '' ELSE props END,"
        " ''), 'EVENT_ROW_' || CAST(event_id AS VARCHAR)) AS record_id FROM events"
    ),
    "pseudonymise": (
        "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS client_id_hash, c_mktsegment FROM customer"
    ),
    "hash_format": (
        "SELECT c_mktsegment,"
        " COUNT(*) FILTER (WHERE REGEXP_FULL_MATCH(sha256(c_name), '[0-9a-f]{64}')) AS hashed,"
        " COUNT(*) FILTER (WHERE NOT REGEXP_FULL_MATCH(sha256(c_name), '[0-9a-f]{64}'))"
        " AS badly_hashed,"
        " COUNT(*) FILTER (WHERE NOT REGEXP_FULL_MATCH(c_name, '[0-9a-f]{64}')) AS raw"
        " FROM customer GROUP BY 1"
    ),
    "row_md5": (
        "SELECT doc_id, MD5(CONCAT_WS('|', lang, source, CAST(quality AS VARCHAR), text)) AS row_md5"
        " FROM documents LEFT JOIN labels USING (doc_id)"
    ),
    "null_safe_compare": (
        "SELECT lang, COUNT(*) FILTER (WHERE quality IS DISTINCT FROM 1) AS not_known_good,"
        " COUNT(*) FILTER (WHERE quality <> 1) AS known_bad"
        " FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"
    ),
    "rate_in_range": (
        "SELECT p_brand AS destination, COUNT(*) FILTER (WHERE CAST(p_size / 1000 AS DECIMAL(9,6))"
        " BETWEEN 0 AND 0.02) AS low_rates, COUNT(*) FILTER (WHERE CAST(p_size / 1000 AS"
        " DECIMAL(9,6)) BETWEEN 0 AND 1) AS fractions FROM part GROUP BY 1"
    ),
    "decimal_sums": (
        "SELECT l_returnflag, l_linestatus, CAST(ROUND(SUM(p), 2) AS DECIMAL(18,2)) AS gross,"
        " CAST(ROUND(SUM(p * d), 2) AS DECIMAL(18,2)) AS commission,"
        " CAST(ROUND(SUM(p) - SUM(p * d), 2) AS DECIMAL(18,2)) AS net FROM (SELECT l_returnflag,"
        " l_linestatus, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS"
        " DECIMAL(5,4)) AS d FROM lineitem) GROUP BY 1, 2"
    ),
    "sign_rule": (
        "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, CASE WHEN c_acctbal < 0"
        " THEN 'NEGATIVE_AMOUNT' WHEN c_mktsegment = 'MACHINERY' THEN 'UNSUPPORTED_CURRENCY' END"
        " AS validation_reason FROM customer"
    ),
    "date_order": (
        "SELECT o_orderstatus, COUNT(*) FILTER (WHERE CAST(l_shipdate AS DATE) <"
        " CAST(o_orderdate AS DATE)) AS too_early, COUNT(*) AS lines"
        " FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
    ),
    "amount_tolerance": (
        "SELECT o_orderpriority, COUNT(*) FILTER (WHERE ABS(t - lines) > 0.01) AS off,"
        " COUNT(*) FILTER (WHERE ABS(t - lines) <= 0.01) AS agreeing FROM (SELECT o_orderpriority,"
        " o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS t FROM orders) JOIN (SELECT l_orderkey,"
        " SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS lines FROM lineitem GROUP BY 1)"
        " ON o_orderkey = l_orderkey GROUP BY 1"
    ),
    "duplicate_keys": (
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2"
        " HAVING COUNT(*) > 1"
    ),
    "orders_without_lines": (
        "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders LEFT JOIN lineitem"
        " ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL"
    ),
    "orphan_totals": (
        f"WITH {settled()} SELECT 'payments' AS relation, COUNT(*) AS n FROM payment_feed p WHERE"
        " NOT EXISTS (SELECT 1 FROM ranked r WHERE r.booking_id = p.booking_id) UNION ALL"
        " SELECT 'events', COUNT(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)"
    ),
    "stale_current": (
        "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key,"
        " MIN(CAST(l_shipdate AS TIMESTAMP)) AS shipped_at,"
        " MAX(CAST(l_shipdate AS TIMESTAMP)) AS newest_version"
        " FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING MIN(l_shipdate) <> MAX(l_shipdate)"
    ),
    "max_per_key": (
        "SELECT l_orderkey, MAX(CAST(l_shipdate AS TIMESTAMP)) AS last_shipped FROM lineitem GROUP BY 1"
    ),
    "exact_distinct": (
        "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS"
        " parts FROM lineitem GROUP BY 1"
    ),
    "zero_default_total": (
        "SELECT 'full' AS batch, CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2))), 0) AS"
        " DECIMAL(18,2)) AS gross, COUNT(*) AS rows FROM lineitem UNION ALL"
        " SELECT 'empty', CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2))), 0) AS"
        " DECIMAL(18,2)), COUNT(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '1900-01-01'"
    ),
    "active_offers": (
        "SELECT DISTINCT p_brand AS destination, CAST(CAST(p_size / 1000 AS DECIMAL(5,4)) AS"
        " VARCHAR) AS commission_rate FROM part WHERE p_type <> 'ECONOMY'"
    ),
    "bag_difference_rows": (
        "WITH early AS (SELECT CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, CAST(l_discount AS"
        " DECIMAL(12,2)) AS l_discount, CAST(l_tax AS DECIMAL(12,2)) AS l_tax FROM lineitem WHERE"
        " l_linenumber <= 3), late AS (SELECT CAST(l_quantity AS DECIMAL(12,2)), CAST(l_discount AS"
        " DECIMAL(12,2)), CAST(l_tax AS DECIMAL(12,2)) FROM lineitem WHERE l_linenumber > 3)"
        " SELECT l_quantity, l_discount, l_tax, 'expected' AS side, COUNT(*) AS copies FROM"
        " (SELECT * FROM early EXCEPT ALL SELECT * FROM late) GROUP BY 1, 2, 3 UNION ALL"
        " SELECT *, 'actual', COUNT(*) FROM (SELECT * FROM late EXCEPT ALL SELECT * FROM early)"
        " GROUP BY ALL"
    ),
    "keyed_difference_rows": (
        "WITH sums AS (SELECT l_returnflag, l_suppkey, CAST(l_shipdate AS DATE) AS shipped,"
        " COUNT(*) AS lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS"
        " gross FROM lineitem GROUP BY 1, 2, 3) SELECT COALESCE(e.l_suppkey, a.l_suppkey) AS"
        " l_suppkey, COALESCE(e.shipped, a.shipped) AS shipped,"
        " CAST(e.shipped IS NOT NULL AS BIGINT) AS expected_rows,"
        " CAST(a.shipped IS NOT NULL AS BIGINT) AS actual_rows,"
        " e.lines AS expected_lines, a.lines AS actual_lines, e.gross AS expected_gross,"
        " a.gross AS actual_gross FROM (SELECT * FROM sums WHERE l_returnflag = 'R') e"
        " FULL OUTER JOIN (SELECT * FROM sums WHERE l_returnflag = 'A') a"
        " ON a.l_suppkey = e.l_suppkey AND a.shipped = e.shipped"
        " WHERE e.lines IS DISTINCT FROM a.lines OR e.gross IS NULL OR a.gross IS NULL"
        " OR ABS(e.gross - a.gross) > 0.01"
    ),
    "booking_reasons": (
        f"WITH {BOOKINGS} SELECT booking_id, offer_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS"
        " updated_at, gross_amount AS line_amount, l_suppkey AS line_supplier, destination,"
        " commission_rate, active AS offer_active, reason AS validation_reason FROM judged"
    ),
    "booking_candidates": f"WITH {ranked()} SELECT {TYPED}, 'STAR' AS batch_id FROM current",
    "superseded_versions": (
        f"WITH {ranked()} SELECT {TYPED}, dedup_rank, 'latest' AS dedup_mode, 'STAR' AS batch_id"
        " FROM ranked WHERE dedup_rank > 1"
    ),
    "payment_reasons": (
        f"WITH {settled()} SELECT payment_id, booking_id, booking_gross_amount, reason AS"
        " validation_reason FROM matched"
    ),
    "silver_payments": (
        f"WITH {settled()} SELECT payment_id, booking_id, payment_status, amount, currency, paid_at,"
        " 'STAR' AS batch_id FROM matched WHERE reason IS NULL"
    ),
    "latest_payment": (
        f"WITH {settled()} SELECT payment_id, booking_id, payment_status, amount, currency, paid_at,"
        " 'STAR' AS batch_id FROM latest"
    ),
    "booking_outcome": (
        f"WITH {settled()} SELECT {TYPED}, 'STAR' AS batch_id,"
        " CASE WHEN unpaid THEN 'MISSING_PAYMENT' END AS business_reason FROM settled"
    ),
    "missing_payment": (
        f"WITH {settled()} SELECT *, 'STAR' AS batch_id, 'bookings.csv' AS source_file FROM rejects"
        " WHERE reason_code = 'MISSING_PAYMENT'"
    ),
    "silver_bookings": (
        f"WITH {settled()} SELECT {TYPED}, 'STAR' AS batch_id FROM settled WHERE NOT unpaid"
    ),
    "quarantine_union": (
        f"WITH {settled()} SELECT *, 'STAR' AS batch_id, CASE WHEN reason_code = 'MISSING_PAYMENT'"
        " THEN 'bookings.csv' ELSE 'lineitem' END AS source_file FROM rejects"
    ),
    "reject_histogram": (
        f"WITH {settled()} SELECT source_entity, reason_code, COUNT(*) AS rejected_rows FROM rejects"
        " GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"
    ),
    "reject_reasons": (
        f"WITH {settled()} SELECT reason_code, COUNT(*) AS rejected_rows FROM rejects GROUP BY 1"
    ),
    "revenue_detail": (
        f"WITH {settled()} SELECT booking_id, payment_id, service_date AS business_date, destination,"
        " booking_status, payment_status, gross_amount, commission_rate, 'STAR' AS batch_id"
        " FROM detail"
    ),
    "daily_revenue": f"WITH {settled()} SELECT * FROM gold",
    "daily_revenue_oracle": f"WITH {RECALCULATED} SELECT * FROM oracle_gold",
    "gold_differences": f"WITH {RECALCULATED} {gold_difference('oracle_gold')}",
    "gold_against_unpaid": (
        f"WITH {settled()}, confirmed AS (SELECT service_date AS business_date, destination,"
        " COUNT(DISTINCT booking_id) AS confirmed_bookings,"
        " CAST(ROUND(SUM(gross_amount), 2) AS DECIMAL(18,2)) AS gross_revenue_eur,"
        " CAST(ROUND(SUM(gross_amount * commission_rate), 2) AS DECIMAL(18,2)) AS"
        " commission_revenue_eur,"
        " CAST(ROUND(SUM(gross_amount) - SUM(gross_amount * commission_rate), 2) AS DECIMAL(18,2))"
        " AS net_revenue_eur FROM settled WHERE NOT unpaid AND booking_status = 'CONFIRMED'"
        f" GROUP BY 1, 2) {gold_difference('confirmed')}"
    ),
    "reconciliation": (
        f"WITH {settled()}, c AS (SELECT (SELECT COUNT(*) FROM booking_feed) AS raw_count,"
        " (SELECT COUNT(*) FROM settled WHERE NOT unpaid) AS accepted_count,"
        " (SELECT COUNT(*) FROM ranked WHERE dedup_rank > 1) AS superseded_count,"
        " (SELECT COUNT(*) FROM rejects WHERE source_entity = 'bookings') AS quarantined_count)"
        " SELECT *, raw_count - accepted_count - superseded_count - quarantined_count AS"
        " reconciliation_delta FROM c"
    ),
    "run_volumes": (
        f"WITH {settled()}, v AS ("
        "SELECT 'raw_bookings' AS part, COUNT(*) AS n FROM booking_feed UNION ALL"
        " SELECT 'raw_payments', COUNT(*) FROM payment_feed UNION ALL"
        " SELECT 'raw_offers', COUNT(*) FROM offer UNION ALL"
        " SELECT 'bookings', COUNT(*) FROM settled WHERE NOT unpaid UNION ALL"
        " SELECT 'payments', COUNT(*) FROM matched WHERE reason IS NULL UNION ALL"
        " SELECT 'superseded', COUNT(*) FROM ranked WHERE dedup_rank > 1 UNION ALL"
        " SELECT 'gold_rows', COUNT(*) FROM gold UNION ALL"
        " SELECT 'reject:' || source_entity || ':' || reason_code, COUNT(*) FROM rejects GROUP BY 1)"
        " SELECT part, n, CAST(NULL AS DECIMAL(18,2)) AS value FROM v UNION ALL"
        " SELECT 'gross', 0, CAST(COALESCE(SUM(gross_revenue_eur), 0) AS DECIMAL(18,2)) FROM gold"
    ),
    "repeated_keys": (
        f"WITH {settled()}, p AS (SELECT payment_id, COUNT(*) AS n FROM payment_feed GROUP BY 1"
        " HAVING COUNT(*) > 1), o AS (SELECT offer_id, COUNT(*) AS n FROM offer GROUP BY 1"
        " HAVING COUNT(*) > 1) SELECT 'payment_id' AS key, COUNT(*) AS repeated,"
        " CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS extra_rows FROM p UNION ALL"
        " SELECT 'offer_id', COUNT(*), CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM o"
    ),
    "gold_fingerprint": (
        f"WITH {settled()}, "
        + tree_digest(
            "SELECT ROW_NUMBER() OVER (ORDER BY business_date, destination, batch_id) - 1 AS n,"
            f" {GOLD_TEXT} AS t FROM gold",
            1024,
            "gold_digest",
            "(SELECT COUNT(*) FROM gold) AS row_count, (SELECT CAST(ROUND(COALESCE(SUM(gross_revenue_eur), 0), 2)"
            " AS DECIMAL(18,2)) FROM gold) AS gross_sum,",
        )
    ),
    "gold_rows_hash": f"WITH {settled()}, "
    + tree_digest(
        f"SELECT ROW_NUMBER() OVER (ORDER BY business_date, destination) - 1 AS n, {GOLD_JSON} AS t FROM gold", 32
    ),
    "ordered_lines_digest": "WITH "
    + tree_digest(
        "SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, sha256(t)) - 1 AS n, t FROM (SELECT l_orderkey,"
        " l_linenumber, CONCAT_WS('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),"
        " l_returnflag) AS t FROM lineitem)",
        1024,
    ),
    "current_over_batches": f"SELECT * EXCLUDE (dedup_rank) FROM ({line_rank('DESC')}) WHERE dedup_rank = 1",
    "files_with_breaks": (
        f"WITH {NUMBERED}, texts AS (SELECT *, {CLIENT} AS c FROM booking_feed) SELECT ROW_NUMBER() OVER (ORDER BY"
        " booking_id, updated_at, gross_amount, l_partkey, l_suppkey) AS source_row_number, booking_id, c AS"
        " client_id, currency FROM texts"
    ),
    "files_to_damaged_ranges": (
        "WITH n AS (SELECT COUNT(*) AS n FROM lineitem WHERE l_linestatus = 'F'), hurt AS (SELECT DISTINCT"
        " (line - 1) // 1024 AS node FROM (SELECT UNNEST(range(77, n + 1, 3001)) AS line FROM n))"
        " SELECT 'payments' AS feed, node * 1024 + 1 AS first_line, LEAST(node * 1024 + 1024, n) AS last_line FROM hurt, n"
    ),
    "gate_checks": f"WITH {verdict(GATE, settled() + EXPECTED)}",
    "gate_decision": summary(f"WITH {verdict(GATE, settled() + EXPECTED)}"),
    "gate_decision_oldest": (
        f"SELECT check_id, severity, violations FROM (WITH {verdict(GATE, settled('ASC') + EXPECTED)})"
        " WHERE status = 'FAIL'"
    ),
    "control_checks": f"WITH {verdict(CONTROLS, RECALCULATED)}",
    "control_summary": summary(f"WITH {verdict(CONTROLS, RECALCULATED)}"),
    "manifest_vs_counts": (
        "WITH m AS (SELECT source, COUNT(*) AS row_count FROM documents GROUP BY 1), a AS (SELECT"
        " source, COUNT(*) AS actual_row_count FROM documents JOIN labels USING (doc_id) GROUP BY 1)"
        " SELECT m.source AS listed_file, row_count, actual_row_count FROM m FULL OUTER JOIN a"
        " ON a.source = m.source WHERE m.source IS NULL OR a.source IS NULL OR row_count IS"
        " DISTINCT FROM actual_row_count"
    ),
    "files_to_bronze": (
        f"WITH {NUMBERED} SELECT source_row_number, booking_id, offer_id, client_id, source_channel,"
        " strftime(booking_ts, '%Y-%m-%d %H:%M:%S') AS booking_ts, CAST(service_date AS VARCHAR) AS"
        " service_date, booking_status, CAST(gross_amount AS VARCHAR) AS gross_amount, currency,"
        " strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, 'STAR' AS batch_id"
        " FROM numbered_bookings"
    ),
    "files_to_quarantine": (
        f"WITH {NUMBERED} SELECT 'bookings' AS source_entity, source_row_number, booking_id AS"
        " record_id, reason AS reason_code, 'Row-level contract validation failed' AS details,"
        " 'STAR' AS batch_id FROM numbered_bookings WHERE reason IS NOT NULL UNION ALL"
        " SELECT source_entity, NULL, record_id, reason_code, details, 'STAR' FROM rejects"
        " WHERE reason_code = 'MISSING_PAYMENT' UNION ALL"
        " SELECT 'payments', source_row_number, payment_id, reason, CASE WHEN reason ="
        " 'AMOUNT_MISMATCH' THEN 'Payment amount differs from current booking amount' ELSE"
        " 'Payment references an unknown or unusable booking' END, 'STAR' FROM numbered_payments"
        " WHERE reason IS NOT NULL"
    ),
    "files_to_superseded": (
        f"WITH {ranked()} SELECT {TYPED}, dedup_rank, 'latest' AS dedup_mode, 'STAR' AS batch_id"
        " FROM ranked WHERE dedup_rank > 1"
    ),
    "files_to_gold": f"WITH {settled()} SELECT * FROM gold",
    "files_to_checks": f"WITH {verdict(FILE_CONTROLS, RECALCULATED)}",
    "files_to_manifest": f"SELECT source_name, n AS row_count, n > 0 AS has_checksums FROM ({FED})",
    "files_to_lineage": (
        "SELECT source_name, n AS rows, n AS named, n AS signed, n AS last_number, n AS numbers,"
        f" n AS stamped FROM ({FED})"
    ),
    "files_to_manifest_document": f"SELECT 'STAR' AS batch_id, file_name, n AS row_count FROM ({FED})",
    "files_to_report": (
        f"WITH {settled()}, counted AS (SELECT (SELECT COUNT(*) FROM booking_feed) AS raw_bookings,"
        " (SELECT COUNT(*) FROM payment_feed) AS raw_payments, (SELECT COUNT(*) FROM offer) AS raw_offers,"
        " (SELECT COUNT(*) FROM settled WHERE NOT unpaid) AS bookings,"
        " (SELECT COUNT(*) FROM matched WHERE reason IS NULL) AS payments,"
        " (SELECT COUNT(*) FROM ranked WHERE dedup_rank > 1) AS superseded,"
        " (SELECT COUNT(*) FROM rejects) AS quarantined, (SELECT COUNT(*) FROM gold) AS gold_rows,"
        f" {DELTA} AS difference, (SELECT CAST(SUM(gross_revenue_eur) AS DECIMAL(18,2)) FROM gold) AS gross)"
        f" SELECT 'STAR' AS batch_id, counted.*, d.decision FROM counted, ({summary(f'WITH {verdict(GATE, settled() + EXPECTED)}')}) d"
    ),
    "files_to_replay": (
        "WITH n AS (SELECT COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN"
        " customer ON o_custkey = c_custkey), c(check_id, severity) AS (VALUES ('AC01', 'CRITICAL'),"
        " ('AC09', 'HIGH'), ('AC11', 'HIGH'), ('AC13', 'MEDIUM')) SELECT check_id, severity,"
        " CASE WHEN check_id = 'AC13' AND n < 100000 THEN 'NOT_EVALUATED' WHEN n > 0 THEN 'PASS' END AS status,"
        " CASE WHEN check_id = 'AC13' AND n < 100000 THEN n END AS rows FROM c, n"
    ),
    "two_batches": " UNION ALL ".join(
        f"SELECT * FROM (WITH {settled(direction)} SELECT '{batch}' AS batch, COUNT(*) AS gold_rows,"
        " CAST(SUM(gross_revenue_eur) AS DECIMAL(18,2)) AS gross, CAST(SUM(confirmed_bookings) AS BIGINT)"
        " AS bookings FROM gold)"
        for batch, direction in (("STAR", "DESC"), ("OLD", "ASC"))
    ),
    "files_with_faults": (
        f"WITH {faulty()} SELECT source_entity, reason_code, COUNT(*) AS rejected_rows FROM rejects GROUP BY 1, 2"
    ),
    "lineage_controls": (
        "WITH listed AS (SELECT source, COUNT(*) + CASE source WHEN 'src2' THEN 1 ELSE 0 END AS declared"
        " FROM documents WHERE source <> 'src5' GROUP BY 1), arrived AS (SELECT source, COUNT(*) AS n FROM"
        " documents GROUP BY 1), wrong AS (SELECT COUNT(*) AS n FROM arrived a LEFT JOIN listed l ON"
        " l.source = a.source WHERE l.source IS NULL OR declared <> n OR a.source = 'src7'), untraced AS"
        " (SELECT COUNT(*) AS n FROM documents WHERE source IN ('src5', 'src7') OR (source = 'src9' AND"
        " lang = 'de')) SELECT 'AC01A' AS check_id, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,"
        " 'CRITICAL' AS severity, n AS violations FROM wrong UNION ALL SELECT 'AC01B', CASE WHEN n = 0 THEN"
        " 'PASS' ELSE 'FAIL' END, 'CRITICAL', n FROM untraced"
    ),
    "personal_columns": (
        "SELECT 'customer' AS table_name, CAST(1 AS BIGINT) AS columns, COUNT(c_name) AS filled FROM customer UNION ALL"
        " SELECT 'supplier', 1, COUNT(s_name) FROM supplier UNION ALL SELECT 'part', 0, COUNT(NULL) FROM part UNION ALL"
        " SELECT 'nation', 1, COUNT(n_name) FROM nation"
    ),
    "full_text_forms": (
        "WITH t AS (SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN strftime(d, '%Y') WHEN 1 THEN strftime(d, '%Y-%m')"
        " WHEN 2 THEN strftime(d, '%Y/%m/%d') WHEN 3 THEN strftime(d, '%Y-%m-%d') WHEN 4 THEN strftime(d,"
        " '%Y/%m/%d %H:%M:%S') WHEN 5 THEN strftime(d, '%Y-%m-%dT%H:%M:%SZ') WHEN 6 THEN strftime(d, '%d.%m.%Y') ELSE ' '"
        " END AS day, CASE WHEN o_orderkey % 9 IN (1, 4, 7) THEN '1_0' WHEN o_orderkey % 9 = 8 THEN '1__0' ELSE '' END ||"
        " o_orderkey || '.0' || o_orderkey % 9 AS number, CASE WHEN o_orderkey % 9 % 2 = 0 THEN ' true ' ELSE 'false' END"
        " AS known FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d FROM orders))"
        " SELECT o_orderkey, TRY_CAST(day AS DATE) AS as_day, TRY_CAST(day AS TIMESTAMP) AS as_instant,"
        " TRY_CAST(number AS DECIMAL(18,2)) AS as_amount, TRY_CAST(known AS BOOLEAN) AS as_flag FROM t"
    ),
    "changed_ranges": (
        f"WITH now AS (WITH {settled()} SELECT * FROM gold), before AS (WITH {settled('ASC')} SELECT * FROM gold),"
        " differing AS (SELECT strftime(business_date, '%Y-%m') AS key_range, COUNT(*) AS differing FROM ((SELECT * FROM"
        " now EXCEPT ALL SELECT * FROM before) UNION ALL (SELECT * FROM before EXCEPT ALL SELECT * FROM now)) GROUP BY 1)"
        " SELECT key_range, (SELECT COUNT(*) FROM now WHERE strftime(business_date, '%Y-%m') = key_range) AS rows_now,"
        " (SELECT COUNT(*) FROM before WHERE strftime(business_date, '%Y-%m') = key_range) AS rows_before, differing"
        " FROM differing"
    ),
    "reconciliation_parts": (
        f"WITH {settled()}, n AS (SELECT (SELECT COUNT(*) FROM booking_feed) AS raw, (SELECT COUNT(*) FROM settled WHERE"
        " NOT unpaid) AS cur, (SELECT COUNT(*) FROM ranked WHERE dedup_rank > 1) AS sup, (SELECT COUNT(*) FROM rejects"
        " WHERE source_entity = 'bookings') AS rej) SELECT 'AC03' AS check_id, CASE WHEN raw - cur - sup - rej = 0 THEN"
        " 'PASS' ELSE 'FAIL' END AS status, '{\"current\":' || -cur || ',\"quarantined\":' || -rej || ',\"raw\":' || raw"
        " || ',\"superseded\":' || -sup || '}' AS parts_json FROM n"
    ),
    "files_to_ordered_gold": (
        f"WITH {settled()} SELECT ROW_NUMBER() OVER (ORDER BY business_date, destination) AS place, business_date,"
        " destination, net_revenue_eur FROM gold"
    ),
    "files_to_absent_keys": (
        "SELECT UNNEST(['payment_id', 'booking_id', 'payment_status', 'amount', 'currency', 'paid_at']) AS column,"
        " UNNEST([0, 0, 0, 0, COUNT(*) FILTER (WHERE l_suppkey % 7 = 0), COUNT(*) FILTER (WHERE l_suppkey % 5 = 0)])"
        " AS records FROM lineitem WHERE l_linestatus = 'F'"
    ),
    "files_to_checksums": (
        "WITH lines AS (SELECT 0 AS n, 'offer_id,destination,commission_rate,active' AS t UNION ALL SELECT"
        " ROW_NUMBER() OVER (ORDER BY CAST(p_partkey AS VARCHAR)), p_partkey || ',' || p_brand || ',' ||"
        " CAST(p_size / 1000 AS DECIMAL(5,4)) || ',' || (p_type <> 'ECONOMY') FROM part), file AS (SELECT"
        " string_agg(t || chr(10), '' ORDER BY n) AS body FROM lines), whole AS (SELECT strlen(body) AS size, sha256(body)"
        " AS sha256 FROM file), "
        + tree_digest("SELECT n, t FROM lines", 1024, "root").replace(" SELECT  CASE", ", top AS (SELECT CASE")
        + ") SELECT size AS size_bytes, size AS copied_bytes, sha256(size || '|' || root) AS checksum,"
        " 'sha256-tree-1024' AS checksum_kind, sha256 FROM whole, top"
    ),
    "ordered_rejects": (
        f"WITH {settled()}, l AS (SELECT source_entity, reason_code, COUNT(*) AS rejected_rows FROM rejects"
        " GROUP BY 1, 2) SELECT *, ROW_NUMBER() OVER (ORDER BY source_entity, rejected_rows DESC, reason_code)"
        " AS place FROM l"
    ),
}
