"""Quality checks: violation counts, verdicts, gate.

Every check is a set of tallies, one-row frames ``(check_id, part, n)``. All tallies are unioned
and summed per check, so one job evaluates a whole suite and one small result reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    any_blank,
    beyond_cent,
    differs,
    is_blank,
    is_digest,
    total,
)
from tidemark.operators.diff import bag_difference, keyed_difference
from tidemark.operators.relations import (
    duplicate_groups,
    off_newest,
    orphan_total,
    pair_total,
)
from tidemark.operators.rules import accepted
from tidemark.operators.versions import Keep
from tidemark.plans import catalogues as c
from tidemark.plans.payments import latest_payment
from tidemark.plans.recalculation import expected_gold
from tidemark.plans.settlement import daily_revenue, revenue_detail_of
from tidemark.scratch import materialise
from tidemark.sources.landing import manifest_anomalies, row_counts

PASS, FAIL, NOT_EVALUATED = "PASS", "FAIL", "NOT_EVALUATED"
BLOCKING = ("CRITICAL", "HIGH")

# Check ids and severities of the gate.
GATE = {
    "AC01": ("Manifest and raw copies intact", "CRITICAL"),
    "AC03": ("Bookings reconcile", "CRITICAL"),
    "AC04A": ("One current row per booking", "HIGH"),
    "AC04B": ("Current version is the newest valid one", "HIGH"),
    "AC05": ("No orphan in revenue detail", "HIGH"),
    "AC06": ("Revenue only for CONFIRMED and PAID", "CRITICAL"),
    "AC07": ("Booking and payment amounts agree within 0.01", "HIGH"),
    "AC08": ("Service is not before booking", "MEDIUM"),
    "AC10": ("Gold equals an independent aggregation", "CRITICAL"),
    "R09": ("No personal column in Gold", "HIGH"),
    "AC09": ("Same batch gives the same Gold", "HIGH"),
    "AC11": ("Report holds the required metrics", "HIGH"),
    "AC13": ("Large batch within its time limit", "MEDIUM"),
}

# Check ids and severities of the control suite.
CONTROLS = {
    "AC01A": ("Manifest matches Bronze volumes", "CRITICAL"),
    "AC01B": ("Lineage on every Bronze row", "CRITICAL"),
    "AC02A": ("Mandatory fields present in Silver", "CRITICAL"),
    "AC02B": ("Rejects carry a known reason", "CRITICAL"),
    "AC03": ("Bookings reconcile", "CRITICAL"),
    "AC04A": ("One current row per booking", "HIGH"),
    "AC04B": ("Current version is the newest accepted one", "HIGH"),
    "AC05": ("No orphan offer, payment or revenue", "HIGH"),
    "AC06": ("Revenue totals equal the recalculation", "CRITICAL"),
    "AC07": ("Known statuses, agreeing amounts and currencies", "HIGH"),
    "AC08": ("Service is not before booking", "MEDIUM"),
    "AC09A": ("No repeated Gold group", "HIGH"),
    "AC10": ("Gold equals the recalculation within 0.01", "CRITICAL"),
    "R09": ("No personal column; clients pseudonymised", "HIGH"),
}

VERDICT = "check_id string, check_name string, severity string"


@dataclass(frozen=True)
class Layers:
    """The tables one batch produced, as stored."""

    bronze_bookings: DataFrame
    bronze_payments: DataFrame
    bronze_offers: DataFrame
    judged_bookings: DataFrame
    silver_bookings: DataFrame
    silver_payments: DataFrame
    superseded: DataFrame
    quarantine: DataFrame
    revenue_detail: DataFrame
    daily_revenue: DataFrame
    batch_id: str
    manifest: DataFrame | None = None
    booking_tie_break: tuple[str, ...] = ("source_row_number",)
    payment_tie_break: tuple[str, ...] = ("source_row_number",)


def tally(check_id: str, part: str, one_row: DataFrame) -> DataFrame:
    """``one_row`` has a single count column."""
    count = F.col(one_row.columns[0]).cast("bigint")
    return one_row.select(F.lit(check_id).alias("check_id"), F.lit(part).alias("part"), count.alias("n"))


def tally_rows(check_id: str, part: str, violations: DataFrame) -> DataFrame:
    return tally(check_id, part, violations.agg(F.count("*").alias("n")))


def tallies_of(df: DataFrame, measures: dict[tuple[str, str], Column]) -> DataFrame:
    """Several checks over one table in one scan; each measure is an aggregate."""
    counted = df.agg(
        *[measure.cast("bigint").alias(f"c{i}") for i, measure in enumerate(measures.values())]
    )
    rows = [
        F.struct(
            F.lit(check_id).alias("check_id"), F.lit(part).alias("part"), F.col(f"c{i}").alias("n")
        )
        for i, (check_id, part) in enumerate(measures)
    ]
    return counted.select(F.inline(F.array(*rows)))


def fixed(spark: SparkSession, check_id: str, part: str, n: int) -> DataFrame:
    """A count the driver already knows, such as one taken from a schema."""
    return spark.range(1).select(
        F.lit(check_id).alias("check_id"),
        F.lit(part).alias("part"),
        F.lit(n).cast("bigint").alias("n"),
    )


def personal_columns(df: DataFrame, names: Sequence[str]) -> int:
    return sum(name.lower() in names for name in df.columns)


def personal_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row ``columns, filled``: the columns with such names, and how many values they hold."""
    found = [name for name in df.columns if name.lower() in names]
    filled = sum((F.count(F.col(f"`{name}`")) for name in found), F.count(F.lit(None)))
    return df.agg(F.lit(len(found)).cast("bigint").alias("columns"), filled.alias("filled"))


def verdicts(tallies: Sequence[DataFrame], catalogue: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per check: it passes when its counts add up to zero."""
    spark = tallies[0].sparkSession
    merged = reduce(DataFrame.unionByName, tallies).groupBy("check_id").agg(
        F.sum("n").alias("violations"),
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("part", "n"))))
        ).alias("parts_json"),
    )
    known = spark.createDataFrame([(key, *value) for key, value in catalogue.items()], VERDICT)
    return merged.join(known, "check_id").select(
        "check_id",
        "check_name",
        F.when(F.col("violations") == 0, PASS).otherwise(FAIL).alias("status"),
        "severity",
        "violations",
        "parts_json",
    )


def repeated_keys(layers: Layers) -> DataFrame:
    """Keys the contract calls unique but no rule enforces: a repeated offer explains a negative
    reconciliation delta, a repeated payment an ambiguous one."""
    feeds = {
        "offer_id": layers.bronze_offers,
        "payment_id": layers.bronze_payments,
    }
    counted = [
        duplicate_groups(df.where(~is_blank(F.col(key))), [key]).agg(
            F.lit(key).alias("key"),
            F.count("*").alias("repeated"),
            total(F.col("copies") - 1).cast("bigint").alias("extra_rows"),
        )
        for key, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def reconciliation_tallies(layers: Layers) -> list[DataFrame]:
    def signed(part, df, sign):
        return tally("AC03", part, df.agg((F.count("*") * sign).alias("n")))

    rejects = layers.quarantine.where(F.col("source_entity") == "bookings")
    return [
        signed("raw", layers.bronze_bookings, 1),
        signed("current", layers.silver_bookings, -1),
        signed("superseded", layers.superseded, -1),
        signed("quarantined", rejects, -1),
    ]


def reconciliation(layers: Layers) -> DataFrame:
    """One row: raw = accepted + superseded + quarantined, and what is missing to that."""
    counted = reduce(DataFrame.unionByName, reconciliation_tallies(layers))
    parts = ("raw", "current", "superseded", "quarantined")
    volume = {part: F.abs(F.sum(F.when(F.col("part") == part, F.col("n")))) for part in parts}
    return counted.agg(
        volume["raw"].alias("raw_count"),
        volume["current"].alias("accepted_count"),
        volume["superseded"].alias("superseded_count"),
        volume["quarantined"].alias("quarantined_count"),
        F.sum("n").alias("reconciliation_delta"),
    )


def orphan_revenue(layers: Layers) -> DataFrame:
    """Revenue rows that lack their booking or their payment, as one count."""
    detail = layers.revenue_detail
    whole = detail.join(layers.silver_bookings.select("booking_id"), "booking_id", "left_semi").join(
        layers.silver_payments.select("payment_id"), "payment_id", "left_semi"
    )
    counts = detail.agg(F.count("*").alias("n")).unionByName(
        whole.agg((-F.count("*")).alias("n"))
    )
    return counts.agg(F.sum("n").alias("n"))


def mismatched_pairs(layers: Layers, wrong: Column) -> DataFrame:
    payments = layers.silver_payments.withColumnRenamed("currency", "payment_currency")
    booked = layers.silver_bookings.select("booking_id", "gross_amount", "currency")
    return pair_total(payments, booked, "booking_id", ["amount", "payment_currency"], wrong)


def ineligible() -> Column:
    return (F.col("booking_status") != "CONFIRMED") | (F.col("payment_status") != "PAID")


def before_booking() -> Column:
    return F.col("service_date") < F.col("booking_ts").cast("date")


def gate_tallies(layers: Layers) -> list[DataFrame]:
    """The pipeline's own gate, apart from the checks that compare runs."""
    spark = layers.daily_revenue.sparkSession
    silver, detail = layers.silver_bookings, layers.revenue_detail
    valid = accepted(layers.judged_bookings).select("booking_id", "updated_at")
    expected = daily_revenue(revenue_detail_of(silver, latest_payment(layers.silver_payments)))
    surplus = bag_difference(expected, layers.daily_revenue)
    personal = sum(
        personal_columns(df, c.PERSONAL_IN_GOLD) for df in (layers.daily_revenue, detail)
    )
    amounts = beyond_cent(F.col("amount"), F.col("gross_amount"))
    return [
        *reconciliation_tallies(layers),
        tally_rows("AC04A", "repeated", duplicate_groups(silver, ["booking_id"])),
        tally_rows("AC04B", "stale", off_newest(silver, valid, "booking_id", "updated_at")),
        tally("AC05", "orphans", orphan_revenue(layers)),
        tally_rows("AC06", "ineligible", detail.where(ineligible())),
        tally("AC07", "mismatched", mismatched_pairs(layers, amounts)),
        tally_rows("AC08", "too_early", silver.where(before_booking())),
        tally("AC10", "different", surplus.agg(total(F.col("copies")).alias("n"))),
        fixed(spark, "R09", "columns", personal),
    ]


def recalculated(layers: Layers) -> DataFrame:
    return expected_gold(
        layers.bronze_bookings,
        layers.bronze_payments,
        layers.bronze_offers,
        layers.batch_id,
        layers.booking_tie_break,
        layers.payment_tie_break,
    )


def gold_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    keys = ["business_date", "destination", "batch_id"]
    money = ["gross_revenue_eur", "commission_revenue_eur", "net_revenue_eur"]
    return keyed_difference(expected, actual, keys, ["confirmed_bookings"], money)


def lineage_gaps(tables: Sequence[DataFrame], manifest: DataFrame) -> DataFrame:
    """Bronze rows without lineage or with a checksum the manifest does not know, as one count.

    Rows are counted per distinct lineage before the join: one row per source file remains.
    """
    lineage = ["batch_id", "source_file", "source_checksum"]
    stamped = reduce(DataFrame.unionByName, [table.select(*lineage) for table in tables])
    counted = stamped.groupBy(*lineage).agg(F.count("*").alias("_rows"))
    listed = manifest.select("batch_id", "source_file", "checksum")
    gap = (
        F.col("batch_id").isNull()
        | is_blank(F.col("source_file"))
        | is_blank(F.col("source_checksum"))
        | differs(F.col("source_checksum"), F.col("checksum"))
    )
    joined = counted.join(listed, ["batch_id", "source_file"], "left")
    return joined.where(gap).agg(total(F.col("_rows")).alias("n"))


def total_gap_tallies(layers: Layers, expected: DataFrame) -> DataFrame:
    """Published totals against recalculated ones: bookings exactly, gross within 0.01."""
    sides = [(expected, 1), (layers.daily_revenue, -1)]
    signed = [
        df.agg(
            (total(F.col("confirmed_bookings")) * sign).alias("bookings"),
            (total(F.col("gross_revenue_eur")) * sign).alias("gross"),
        )
        for df, sign in sides
    ]
    gross_off = F.when(beyond_cent(F.sum("gross"), F.lit(0)), 1).otherwise(0)
    return tallies_of(
        signed[0].unionByName(signed[1]),
        {("AC06", "bookings_off"): F.abs(F.sum("bookings")), ("AC06", "gross_off"): gross_off},
    )


def control_tallies(
    layers: Layers, expected: DataFrame, expect_rejects: bool = True
) -> list[DataFrame]:
    """The independent control suite over the stored tables and the recalculated Gold."""
    spark = layers.daily_revenue.sparkSession
    silver, payments = layers.silver_bookings, layers.silver_payments
    versions = silver.select("booking_id", "updated_at").unionByName(
        layers.superseded.select("booking_id", "updated_at")
    )
    active = layers.bronze_offers.where(
        ~is_blank(F.col("offer_id")) & F.col("active").cast("string").try_cast("boolean")
    )
    texts = ("booking_id", "offer_id", "client_id_hash", "source_channel", "currency")
    values = ("booking_ts", "service_date", "gross_amount", "updated_at")
    incomplete = any_blank(texts)
    for name in values:
        incomplete = incomplete | F.col(name).isNull()
    unpaid = F.col("payment_status").isin("PAID", "REFUNDED") & F.col("paid_at").isNull()
    incomplete_payment = (
        any_blank(("payment_id", "booking_id", "payment_status", "currency"))
        | F.col("amount").isNull()
        | unpaid
    )
    hashed = F.coalesce(is_digest(F.col("client_id_hash")), F.lit(False))
    unexplained = any_blank(("source_entity", "record_id", "reason_code")) | ~F.col(
        "reason_code"
    ).isin(*c.REASONS)
    empty = F.when((F.count("*") == 0) & F.lit(expect_rejects), 1).otherwise(0)
    wrong_pair = beyond_cent(F.col("amount"), F.col("gross_amount")) | differs(
        F.col("currency"), F.col("payment_currency")
    )
    groups = duplicate_groups(layers.daily_revenue, ["business_date", "destination", "batch_id"])
    personal = sum(
        personal_columns(df, c.PERSONAL_ANYWHERE) for df in (silver, layers.daily_revenue)
    )
    found = [
        tallies_of(
            silver,
            {
                ("AC02A", "bookings"): F.count_if(incomplete),
                ("AC07", "booking_statuses"): F.count_if(
                    ~F.col("booking_status").isin(*c.BOOKING_STATUSES)
                ),
                ("AC08", "too_early"): F.count_if(before_booking()),
                ("R09", "hashes"): F.count_if(~hashed),
            },
        ),
        tallies_of(
            payments,
            {
                ("AC02A", "payments"): F.count_if(incomplete_payment),
                ("AC07", "payment_statuses"): F.count_if(
                    ~F.col("payment_status").isin(*c.PAYMENT_STATUSES)
                ),
            },
        ),
        tallies_of(
            layers.quarantine,
            {("AC02B", "unexplained"): F.count_if(unexplained), ("AC02B", "empty"): empty},
        ),
        *reconciliation_tallies(layers),
        tally_rows("AC04A", "repeated", duplicate_groups(silver, ["booking_id"])),
        tally_rows("AC04B", "stale", off_newest(silver, versions, "booking_id", "updated_at")),
        tally("AC05", "offers", orphan_total(silver, active, "offer_id")),
        tally("AC05", "payments", orphan_total(payments, silver, "booking_id")),
        tally("AC05", "revenue", orphan_revenue(layers)),
        total_gap_tallies(layers, expected),
        tally_rows("AC06", "ineligible", layers.revenue_detail.where(ineligible())),
        tally("AC07", "mismatched", mismatched_pairs(layers, wrong_pair)),
        tally_rows("AC09A", "repeated", groups),
        tally_rows("AC10", "different", gold_differences(expected, layers.daily_revenue)),
        fixed(spark, "R09", "columns", personal),
    ]
    if layers.manifest is not None:
        counts = row_counts(layers.bronze_bookings, layers.bronze_payments, layers.bronze_offers)
        found.append(tally_rows("AC01A", "files", manifest_anomalies(layers.manifest, counts)))
        tables = (layers.bronze_bookings, layers.bronze_payments, layers.bronze_offers)
        found.append(tally("AC01B", "rows", lineage_gaps(tables, layers.manifest)))
    return found


def gate_checks(layers: Layers) -> DataFrame:
    return verdicts(gate_tallies(layers), GATE)


def control_checks(
    layers: Layers, expect_rejects: bool = True, keep: Keep = materialise
) -> DataFrame:
    """Three checks use the recalculated Gold; it is stored once for them."""
    expected = keep(recalculated(layers), "expected_gold")
    return verdicts(control_tallies(layers, expected, expect_rejects), CONTROLS)


def summary(checks: DataFrame) -> DataFrame:
    """Counts by status and the decision, from any frame with status and severity."""
    failed = F.col("status") == FAIL
    blockers = F.count_if(failed & F.col("severity").isin(*BLOCKING))
    return checks.agg(
        F.count("*").alias("checks_total"),
        F.count_if(F.col("status") == PASS).alias("checks_pass"),
        F.count_if(failed).alias("checks_fail"),
        F.count_if(F.col("status") == NOT_EVALUATED).alias("checks_not_evaluated"),
        F.when(blockers > 0, "NO-GO").otherwise("GO").alias("decision"),
    )


class QualityGateError(RuntimeError):
    """The gate said NO-GO and the caller asked to be stopped."""


def decide(checks: Sequence[dict], fail: bool = False) -> str:
    blockers = [
        check["check_id"]
        for check in checks
        if check["status"] == FAIL and check["severity"] in BLOCKING
    ]
    if blockers and fail:
        raise QualityGateError(f"NO-GO: {', '.join(blockers)}")
    return "NO-GO" if blockers else "GO"


CHECK_TABLE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "check_id",
            "check_name",
            "status",
            "severity",
            "actual_json",
            "expected_json",
            "evidence",
        )
    ]
)
