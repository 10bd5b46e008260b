"""One query per operator; each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import star
from tidemark.catalog.star import price, table
from tidemark.functions import columns as col
from tidemark.operators.diff import bag_difference, keyed_difference
from tidemark.operators.fingerprint import row_text
from tidemark.operators.numbering import number_in_order
from tidemark.operators.quarantine import reason_histogram
from tidemark.operators.relations import duplicate_groups, off_newest, orphan_total, orphans
from tidemark.operators.rules import Rule, validate
from tidemark.operators.tree import ordered_tree_digest
from tidemark.operators.versions import (
    direction,
    hot_keys,
    keep_one,
    newest_first,
    rank_versions,
)
from tidemark.plans import bookings as b
from tidemark.plans import checks as k
from tidemark.plans import evidence
from tidemark.plans import payments as p
from tidemark.plans import replay
from tidemark.plans import settlement as s
from tidemark.plans.batch import run_pipeline, volumes
from tidemark.plans.recalculation import expected_gold
from tidemark.scratch import Scratch, run_scratch
from tidemark.session import tune
from tidemark.sinks.commits import read_table
from tidemark.sinks.state import KeyedState
from tidemark.sinks.writers import read_batch, replace_batch
from tidemark.sources import landing
from tidemark.sources.contracts import FEEDS, OFFERS, PAYMENTS, absent_keys, feed_paths
from tidemark.sources.landing import manifest_anomalies

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- versions of line items, straight from the table -------------------------------------------


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipped_at"),
        price().alias("price"),
        "l_partkey",
        "l_suppkey",
    )


LINE = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["shipped_at", "price", "l_partkey", "l_suppkey"]


@query
def latest_version(spark, sf_dir):
    return keep_one(line_versions(spark, sf_dir), LINE, direction("latest", LINE_ORDER))


@query
def oldest_version(spark, sf_dir):
    return keep_one(line_versions(spark, sf_dir), LINE, direction("oldest", LINE_ORDER))


@query
def ranked_versions(spark, sf_dir):
    lines = line_versions(spark, sf_dir)
    hot = hot_keys(table(spark, sf_dir, "lineitem"), LINE)
    return rank_versions(lines, LINE, newest_first(LINE_ORDER), "dedup_rank", hot)


@query
def ranked_events_by_type(spark, sf_dir):
    """Five keys hold all rows, so every one of them is hot and is ranked by sorting."""
    events = table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "user_id"
    )
    hot = hot_keys(events, ["event_type"], hot_rows=1_000)
    order = newest_first(["ts", "event_id"])
    return rank_versions(events, ["event_type"], order, "type_rank", hot)


@query
def latest_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value")
    )
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    return keep_one(events, ["user_id"], order)


@query
def row_numbers(spark, sf_dir):
    """Contiguous numbers over all rows in a stated order, without a global window."""
    lines = line_versions(spark, sf_dir)
    order = [F.col(name).asc_nulls_last() for name in [*LINE, *LINE_ORDER]]
    return number_in_order(lines, order, Scratch(spark), "source_row_number")


# --- scalar building blocks --------------------------------------------------------------------


@query
def normalised_codes(spark, sf_dir):
    messy = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer"),
        col.code(messy).alias("segment"),
        (~col.code(messy).isin("MACHINERY", "HOUSEHOLD")).alias("outside_catalogue"),
    )


@query
def required_blank(spark, sf_dir):
    """Labels are missing for most documents: a blank mandatory field per source."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string"))
    blank = col.any_blank(["text", "lang", "source", "quality"])
    return documents.join(labels, "doc_id", "left").groupBy("source").agg(
        F.count("*").alias("rows"), F.count_if(blank).alias("blank_rows")
    )


@query
def safe_casts(spark, sf_dir):
    """Text that is an amount parses; text that is a name becomes NULL, not an error."""
    customers = table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("t")
    )
    return customers.groupBy("c_nationkey").agg(
        F.count(col.amount(F.col("t"))).alias("parsed_amounts"),
        F.count(col.amount(F.col("c_name"))).alias("parsed_names"),
        F.count(col.instant(F.col("c_name"))).alias("parsed_instants"),
        F.count(col.flag(F.col("c_name"))).alias("parsed_flags"),
        F.sum(col.amount(F.col("t"))).cast("decimal(18,2)").alias("balance"),
    )


@query
def full_text_forms(spark, sf_dir):
    """Dates, times, amounts and flags written in several ways, read by the grammar that asks for whole dates."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    kind = F.col("o_orderkey") % 9
    written = {0: "yyyy", 1: "yyyy-MM", 2: "yyyy/MM/dd", 3: "yyyy-MM-dd", 4: "yyyy/MM/dd HH:mm:ss", 5: "yyyy-MM-dd'T'HH:mm:ss'Z'", 6: "dd.MM.yyyy"}
    day, number = F.lit(" "), F.format_string("%d.%02d", "o_orderkey", kind.cast("int"))
    for value, form in written.items():
        day = F.when(kind == value, F.date_format("d", form)).otherwise(day)
    number = F.when(kind % 3 == 1, F.concat(F.lit("1_0"), number)).when(kind == 8, F.concat(F.lit("1__0"), number)).otherwise(number)
    texts = orders.select("o_orderkey", day.alias("day"), number.alias("number"), F.when(kind % 2 == 0, " true ").otherwise("false").alias("known"))
    return texts.select(
        "o_orderkey",
        col.day(F.col("day"), "full").alias("as_day"),
        col.instant(F.col("day"), "full").alias("as_instant"),
        col.amount(F.col("number"), "full").alias("as_amount"),
        col.flag(F.col("known"), "full").alias("as_flag"),
    )


@query
def changed_ranges(spark, sf_dir):
    """Months in which Gold of the newest versions and Gold of the oldest differ, by their digests, and the
    rows that differ there."""
    keep = run_scratch(spark).keep
    now, before = star.daily_by_mode(spark, sf_dir, ("latest", "oldest"))
    ranges = keep(replay.changed_ranges(replay.range_digests(now), replay.range_digests(before)), "ranges")
    differing = replay.changed_rows(now, before, ranges).groupBy("key_range").agg(F.sum("copies").alias("differing"))
    return ranges.join(differing, "key_range").select("key_range", "rows_now", "rows_before", "differing")


@query
def fallback_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    own = F.when(F.col("event_type") == "error", "").otherwise(F.col("props"))
    return events.select(
        "event_id", col.record_id(own, "EVENT_ROW_", F.col("event_id")).alias("record_id")
    )


@query
def pseudonymise(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        col.pseudonym(F.col("c_custkey").cast("string")).alias("client_id_hash"), "c_mktsegment"
    )


@query
def hash_format(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    hashed = col.is_digest(col.pseudonym(F.col("c_name")))
    return customers.groupBy("c_mktsegment").agg(
        F.count_if(hashed).alias("hashed"),
        F.count_if(~hashed).alias("badly_hashed"),
        F.count_if(~col.is_digest(F.col("c_name"))).alias("raw"),
    )


@query
def row_md5(spark, sf_dir):
    """Canonical row text; concat_ws skips NULL labels."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    labels = table(spark, sf_dir, "labels")
    text = F.concat_ws("|", "lang", "source", F.col("quality").cast("string"), "text")
    return documents.join(labels, "doc_id", "left").select("doc_id", F.md5(text).alias("row_md5"))


@query
def null_safe_compare(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels")
    unlike = col.differs(F.col("quality"), F.lit(1))
    return documents.join(labels, "doc_id", "left").groupBy("lang").agg(
        F.count_if(unlike).alias("not_known_good"),
        F.count_if(F.col("quality") != 1).alias("known_bad"),
    )


@query
def rate_in_range(spark, sf_dir):
    offers = star.bronze_offers(spark, sf_dir)
    rate = F.col("commission_rate").try_cast("decimal(9,6)")
    return offers.groupBy("destination").agg(
        F.count_if(rate.between(0, 0.02)).alias("low_rates"),
        F.count_if(rate.between(0, 1)).alias("fractions"),
    )


@query
def decimal_sums(spark, sf_dir):
    rate = F.col("l_discount").cast("decimal(5,4)")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        col.money(F.sum(price())).alias("gross"),
        col.money(F.sum(price() * rate)).alias("commission"),
        col.money(F.sum(price()) - F.sum(price() * rate)).alias("net"),
    )


@query
def sign_rule(spark, sf_dir):
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    rules = [
        Rule("sign", "NEGATIVE_AMOUNT", balance < 0),
        Rule("segment", "UNSUPPORTED_CURRENCY", F.col("c_mktsegment") == "MACHINERY"),
    ]
    return validate(table(spark, sf_dir, "customer"), rules).select(
        "c_custkey", balance.alias("balance"), "validation_reason"
    )


@query
def date_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    early = F.col("l_shipdate").cast("date") < F.col("o_orderdate").cast("date")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "o_orderstatus"
    ).agg(F.count_if(early).alias("too_early"), F.count("*").alias("lines"))


@query
def amount_tolerance(spark, sf_dir):
    """Orders whose total is off the sum of their lines."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(12,2)").alias("total")
    )
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(price()).alias("lines"))
    off = col.beyond_cent(F.col("total"), F.col("lines"))
    return orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(
        "o_orderpriority"
    ).agg(F.count_if(off).alias("off"), F.count_if(~off).alias("agreeing"))


# --- joins, groups, differences ----------------------------------------------------------------


@query
def duplicate_keys(spark, sf_dir):
    return duplicate_groups(table(spark, sf_dir, "lineitem"), LINE)


@query
def orders_without_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orphans(orders, lines, "o_orderkey")


@query
def orphan_totals(spark, sf_dir):
    """Payments of bookings that never made it to Silver, and events of unknown customers."""
    current = b.typed_versions(star.judged_bookings(spark, sf_dir)).select("booking_id")
    payments = star.bronze_payments(spark, sf_dir).select("booking_id")
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    counted = {
        "payments": orphan_total(payments, current, "booking_id"),
        "events": orphan_total(events, table(spark, sf_dir, "customer"), "c_custkey"),
    }
    rows = [df.select(F.lit(name).alias("relation"), "n") for name, df in counted.items()]
    return rows[0].unionByName(rows[1])


@query
def stale_current(spark, sf_dir):
    """Keeping the oldest version on purpose must show every key that has a newer one."""
    key = F.concat_ws("-", *[F.col(name).cast("string") for name in LINE]).alias("line_key")
    versions = line_versions(spark, sf_dir).select("*", key)
    oldest = keep_one(versions, ["line_key"], direction("oldest", LINE_ORDER))
    found = off_newest(oldest, versions.select("line_key", "shipped_at"), "line_key", "shipped_at")
    return found.select("line_key", "shipped_at", "newest_version")


@query
def max_per_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.col("l_shipdate").cast("timestamp_ntz")).alias("last_shipped")
    )


@query
def exact_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts")
    )


@query
def zero_default_total(spark, sf_dir):
    """Totals of a batch that turns out empty are zero, not NULL."""
    lines = table(spark, sf_dir, "lineitem")
    none = lines.where(F.col("l_shipdate") < F.lit("1900-01-01").cast("timestamp_ntz"))
    rows = [
        df.agg(
            F.lit(name).alias("batch"),
            col.total(price()).cast("decimal(18,2)").alias("gross"),
            F.count("*").alias("rows"),
        )
        for name, df in (("full", lines), ("empty", none))
    ]
    return rows[0].unionByName(rows[1])


@query
def active_offers(spark, sf_dir):
    offers = star.bronze_offers(spark, sf_dir)
    usable = ~col.is_blank(F.col("offer_id")) & F.col("active")
    return offers.where(usable).select("destination", "commission_rate").distinct()


@query
def bag_difference_rows(spark, sf_dir):
    """Which (quantity, discount, tax) occur more often among early than among late lines."""
    columns = [
        F.col(name).cast("decimal(12,2)").alias(name)
        for name in ("l_quantity", "l_discount", "l_tax")
    ]
    lines = table(spark, sf_dir, "lineitem")
    early = lines.where(F.col("l_linenumber") <= 3).select(*columns)
    late = lines.where(F.col("l_linenumber") > 3).select(*columns)
    return bag_difference(early, late)


@query
def keyed_difference_rows(spark, sf_dir):
    """Line items per order and month: returned against accepted goods, side by side."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey"), F.col("l_shipdate").cast("date").alias("shipped"), price().alias("p"),
        "l_returnflag",
    )
    sides = [
        lines.where(F.col("l_returnflag") == value)
        .groupBy("l_suppkey", "shipped")
        .agg(F.count("*").alias("lines"), F.sum("p").cast("decimal(18,2)").alias("gross"))
        for value in ("R", "A")
    ]
    return keyed_difference(*sides, ["l_suppkey", "shipped"], ["lines"], ["gross"])


# --- the booking pipeline on the star schema ---------------------------------------------------


@query
def booking_reasons(spark, sf_dir):
    return b.booking_validation(star.validated_bookings(spark, sf_dir)).select(
        "booking_id",
        "offer_id",
        "updated_at",
        "line_amount",
        "line_supplier",
        "destination",
        "commission_rate",
        "offer_active",
        "validation_reason",
    )


@query
def booking_candidates(spark, sf_dir):
    return star.candidates(spark, sf_dir)


@query
def superseded_versions(spark, sf_dir):
    return b.superseded_bookings(star.ranked_bookings(spark, sf_dir), "latest")


@query
def payment_reasons(spark, sf_dir):
    return p.payment_validation(star.validated_payments(spark, sf_dir)).select(
        "payment_id", "booking_id", "booking_gross_amount", "validation_reason"
    )


@query
def silver_payments(spark, sf_dir):
    return p.silver_payments(star.judged_payments(spark, sf_dir))


@query
def latest_payment(spark, sf_dir):
    return p.latest_payment(p.silver_payments(star.judged_payments(spark, sf_dir)))


@query
def booking_outcome(spark, sf_dir):
    return s.booking_outcome(star.settled(spark, sf_dir))


@query
def missing_payment(spark, sf_dir):
    return s.missing_payment_rejects(star.settled(spark, sf_dir)).drop("source_row_number")


@query
def silver_bookings(spark, sf_dir):
    return s.silver_bookings(star.settled(spark, sf_dir))


@query
def quarantine_union(spark, sf_dir):
    return star.quarantine_records(spark, sf_dir).drop("source_row_number")


@query
def reject_histogram(spark, sf_dir):
    return evidence.rejects_by_cause(star.quarantine_records(spark, sf_dir))


@query
def reject_reasons(spark, sf_dir):
    return reason_histogram(star.quarantine_records(spark, sf_dir))


@query
def revenue_detail(spark, sf_dir):
    return s.revenue_detail(star.settled(spark, sf_dir))


@query
def daily_revenue(spark, sf_dir):
    return s.daily_revenue(s.revenue_detail(star.settled(spark, sf_dir)), one_row_per_booking=True)


@query
def daily_revenue_oracle(spark, sf_dir):
    return expected_gold(
        star.bronze_bookings(spark, sf_dir),
        star.bronze_payments(spark, sf_dir),
        star.bronze_offers(spark, sf_dir),
        star.BATCH,
        star.TIE_BREAK,
        ("payment_id",),
    )


@query
def gold_differences(spark, sf_dir):
    """Recalculated Gold against the pipeline's: rows here are real findings."""
    layers = star.layers(spark, sf_dir)
    return k.gold_differences(k.recalculated(layers), layers.daily_revenue)


@query
def gold_against_unpaid(spark, sf_dir):
    """Gold against revenue that ignores payments: every day a missing payment changes."""
    layers = star.layers(spark, sf_dir)
    confirmed = layers.silver_bookings.where(F.col("booking_status") == "CONFIRMED")
    unpaid = s.daily_revenue(confirmed.withColumnRenamed("service_date", "business_date"))
    return k.gold_differences(unpaid, layers.daily_revenue)


@query
def reconciliation(spark, sf_dir):
    return k.reconciliation(star.layers(spark, sf_dir, gold=False))


@query
def reconciliation_parts(spark, sf_dir):
    """The reconciliation as a check with its counts as JSON."""
    found = k.verdicts(k.reconciliation_tallies(star.layers(spark, sf_dir, gold=False)), k.GATE)
    return found.select("check_id", "status", "parts_json")


@query
def run_volumes(spark, sf_dir):
    return volumes(star.layers(spark, sf_dir))


@query
def repeated_keys(spark, sf_dir):
    return k.repeated_keys(star.layers(spark, sf_dir))


@query
def gold_fingerprint(spark, sf_dir):
    """Gold's rows in order as one digest, the root of a tree."""
    scratch = run_scratch(spark)
    return evidence.ordered_gold_fingerprint(scratch.keep(daily_revenue(spark, sf_dir), "gold"), scratch)


@query
def gold_rows_hash(spark, sf_dir):
    gold = daily_revenue(spark, sf_dir)
    order = [F.col(name).asc_nulls_last() for name in ("business_date", "destination")]
    return ordered_tree_digest(gold, row_text(gold.columns), order, run_scratch(spark), fan=32)


@query
def ordered_lines_digest(spark, sf_dir):
    """All line items in order as one digest; equal rows count each."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem").select(*[F.col(name).cast("long" if name == "l_quantity" else "string").alias(name) for name in columns])
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in columns])
    order = [F.col(name).cast("long") for name in columns[:2]]
    return ordered_tree_digest(lines, text, order, run_scratch(spark))


@query
def gate_checks(spark, sf_dir):
    return k.gate_checks(star.layers(spark, sf_dir)).drop("check_name", "parts_json")


@query
def gate_decision(spark, sf_dir):
    return k.summary(k.gate_checks(star.layers(spark, sf_dir)))


@query
def gate_decision_oldest(spark, sf_dir):
    """The deliberate defect: keeping the oldest version must end in NO-GO."""
    checks = k.gate_checks(star.layers(spark, sf_dir, "oldest"))
    return checks.where("status = 'FAIL'").select("check_id", "severity", "violations")


@query
def control_checks(spark, sf_dir):
    return k.control_checks(star.layers(spark, sf_dir)).drop("check_name", "parts_json")


@query
def control_summary(spark, sf_dir):
    return k.summary(k.control_checks(star.layers(spark, sf_dir)))


@query
def manifest_vs_counts(spark, sf_dir):
    """Declared rows per source (documents) against the rows that arrived (labels)."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    declared = documents.groupBy(F.col("source").alias("source_file")).agg(
        F.count("*").alias("row_count"),
        F.md5(F.max("source")).alias("checksum"),
        F.max("source").alias("bronze_copy"),
    )
    arrived = documents.join(labels, "doc_id").groupBy(F.col("source").alias("source_file")).agg(
        F.count("*").alias("actual_row_count")
    )
    return manifest_anomalies(declared, arrived).select(
        "listed_file", "row_count", "actual_row_count"
    )


FAULTY_FILES = {"uncounted": "src2", "unlisted": "src5", "unsigned": "src7", "altered": "src9"}


@query
def lineage_controls(spark, sf_dir):
    """The lineage checks over documents as three feeds, with a manifest that is wrong on purpose."""
    source, signed = F.col("source"), F.sha2("source", 256)
    stamped = table(spark, sf_dir, "documents").select(
        "lang",
        F.lit(star.BATCH).alias("batch_id"),
        source.alias("source_file"),
        F.when((source == FAULTY_FILES["altered"]) & (F.col("lang") == "de"), F.sha2("lang", 256))
        .otherwise(signed)
        .alias("source_checksum"),
    )
    files = table(spark, sf_dir, "documents").where(source != FAULTY_FILES["unlisted"]).groupBy("source").agg(
        F.count("*").alias("n")
    )
    manifest = files.select(
        F.lit(star.BATCH).alias("batch_id"),
        source.alias("source_file"),
        F.when(source == FAULTY_FILES["unsigned"], "").otherwise(signed).alias("checksum"),
        F.lit("copy").alias("bronze_copy"),
        (F.col("n") + F.when(source == FAULTY_FILES["uncounted"], 1).otherwise(0)).alias("row_count"),
    )
    feeds = [stamped.where(F.col("lang") == lang) for lang in ("en", "de")]
    feeds.append(stamped.where(~F.col("lang").isin("en", "de")))
    counts = stamped.groupBy("source_file").agg(F.count("*").alias("actual_row_count"))
    found = [
        k.tally_rows("AC01A", "files", manifest_anomalies(manifest, counts)),
        k.tally("AC01B", "rows", k.lineage_gaps(feeds, manifest)),
    ]
    return k.verdicts(found, k.CONTROLS).select("check_id", "status", "severity", "violations")


@query
def personal_columns(spark, sf_dir):
    """How many values tables hold in columns with personal names, whatever the names' case."""
    names = ("c_name", "c_phone", "c_address", "s_name", "n_name")
    found = []
    for name in ("customer", "supplier", "part", "nation"):
        df = table(spark, sf_dir, name)
        found.append(k.personal_values(df.toDF(*[c.upper() for c in df.columns]), names).withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


@query
def current_over_batches(spark, sf_dir):
    """Three batches of line versions, one after the other, into a state of newest versions: its rows, and how many
    rows of each batch were newer than all before."""
    state = KeyedState(tune(spark), f"{run_scratch(spark).root}/state", LINE, LINE_ORDER, buckets=16)
    lines = line_versions(spark, sf_dir)
    for batch in range(3):
        state.apply(lines.where(F.col("l_suppkey") % 3 == batch))
    return state.read()


@query
def files_with_breaks(spark, sf_dir):
    """Bronze bookings of feeds whose fields hold line breaks, commas and quotes."""
    layers = run_from_files(spark, sf_dir, write=star.write_broken_lines).layers
    return layers.bronze_bookings.select("source_row_number", "booking_id", "client_id", "currency")


@query
def files_to_ordered_gold(spark, sf_dir):
    """Gold's rows with their place in the stored files, part by part and row by row."""
    stored = tune(spark).read.parquet(run_from_files(spark, sf_dir).paths["gold"])
    placed = stored.select("*", F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("row"))
    numbered = number_in_order(placed, [F.col("part"), F.col("row")], run_scratch(spark), "place")
    return numbered.select("place", "business_date", "destination", "net_revenue_eur")


@query
def files_to_absent_keys(spark, sf_dir):
    """How many payment records lack each mandatory key, in a feed whose missing values have no key at all."""
    source = star.write_sparse_payments(spark, sf_dir, f"{run_scratch(spark).root}/source")
    return absent_keys(tune(spark), feed_paths(source)[PAYMENTS.entity], PAYMENTS)


@query
def files_to_checksums(spark, sf_dir):
    """Sizes and checksums of the offers feed, of one file, as landing records them."""
    folder = run_scratch(spark).root
    source = star.write_one_file_feeds(spark, sf_dir, f"{folder}/source", whole=(OFFERS.entity,))
    landed = landing.land(tune(spark), feed_paths(source), FEEDS, f"{folder}/lake", "B")
    return landed.where(F.col("source_name") == OFFERS.entity).select(
        "size_bytes", "copied_bytes", "checksum", "checksum_kind", "sha256"
    )


@query
def files_to_damaged_ranges(spark, sf_dir):
    """A landed feed whose copy is changed afterwards: the ranges of lines that are no longer what was landed."""
    scratch = run_scratch(spark)
    folder, tuned = scratch.root, tune(spark)
    source = star.write_one_file_feeds(spark, sf_dir, f"{folder}/source", whole=(PAYMENTS.entity,))
    landing.land(tuned, feed_paths(source), FEEDS, f"{folder}/lake", "B")
    scratch.drop("source")
    lines, blocks, grown = (read_batch(tuned, f"{folder}/lake", name, "B") for name in (landing.RAW_LINES, landing.RAW_BLOCKS, landing.RAW_TREE))
    number = landing.numbered_lines(lines, blocks)
    hurt = (F.col("source_name") == "payments") & (F.col("line_number") % 3001 == 77)
    changed = number.where(~hurt | (F.col("line_number") % 2 == 0)).withColumn("value", F.when(hurt, F.lit(b"?")).otherwise(F.col("value")))
    for name, df in ((landing.RAW_LINES, changed.drop("line_number")), (landing.RAW_BLOCKS, blocks), (landing.RAW_TREE, grown)):
        replace_batch(df, f"{folder}/changed", name, "B")
    ranges = landing.damaged_ranges(tuned, f"{folder}/changed", "B")
    return ranges.select(F.col("source_name").alias("feed"), "first_line", "last_line")


@query
def ordered_rejects(spark, sf_dir):
    """The listing of rejects with each row's place in it."""
    listing = evidence.rejects_by_cause(star.quarantine_records(spark, sf_dir)).coalesce(1)
    return listing.withColumn("place", F.monotonically_increasing_id() + 1)


# --- whole runs from text files -----------------------------------------------------------------


def run_from_files(spark, sf_dir, mode="fixed", write=star.write_text_feeds):
    """Text feeds written from the tables, then one full run over them. The feeds go once their copy is proven."""
    scratch = run_scratch(spark)
    source = write(spark, sf_dir, f"{scratch.root}/source")
    return run_pipeline(
        spark, source, f"{scratch.root}/lake", batch_id=star.BATCH, mode=mode, when_landed=lambda: scratch.drop("source")
    )


@query
def files_to_lineage(spark, sf_dir):
    """Bronze rows per feed, and how many name their file, its checksum, their number and arrival."""
    layers = run_from_files(spark, sf_dir).layers
    tables = (layers.bronze_bookings, layers.bronze_payments, layers.bronze_offers)
    counted = [
        df.agg(
            F.lit(feed.entity).alias("source_name"),
            F.count("*").alias("rows"),
            F.count_if(F.col("source_file").startswith(f"{feed.file_name}/part-")).alias("named"),
            F.count_if(col.is_digest(F.col("source_checksum"))).alias("signed"),
            F.max("source_row_number").alias("last_number"),
            F.countDistinct("source_row_number").alias("numbers"),
            F.count("ingested_at").alias("stamped"),
        )
        for feed, df in zip(FEEDS, tables)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def files_to_report(spark, sf_dir):
    """The stored report document, read back."""
    run = run_from_files(spark, sf_dir)
    text = spark.read.text(run.paths["quality_report"], wholetext=True)
    count = lambda path: F.get_json_object("value", f"$.metrics.{path}").cast("long")
    return text.select(
        F.get_json_object("value", "$.run.batch_id").alias("batch_id"),
        count("source_rows.bookings").alias("raw_bookings"),
        count("source_rows.payments").alias("raw_payments"),
        count("source_rows.offers").alias("raw_offers"),
        count("silver_rows.bookings").alias("bookings"),
        count("silver_rows.payments").alias("payments"),
        count("superseded_bookings").alias("superseded"),
        count("quarantine_rows").alias("quarantined"),
        count("gold_rows").alias("gold_rows"),
        count("reconciliation.difference").alias("difference"),
        F.get_json_object("value", "$.metrics.gold_gross_revenue_eur").cast("decimal(18,2)").alias("gross"),
        F.get_json_object("value", "$.summary.decision").alias("decision"),
    )


@query
def files_to_manifest_document(spark, sf_dir):
    """The manifest document's feeds, read back."""
    run = run_from_files(spark, sf_dir)
    text = spark.read.text(run.paths["manifest_document"], wholetext=True)
    feed = "array<struct<file_name:string,row_count:long>>"
    feeds = F.explode(F.from_json(F.get_json_object("value", "$.feeds"), feed)).alias("feed")
    return text.select(F.get_json_object("value", "$.batch_id").alias("batch_id"), feeds).select(
        "batch_id", "feed.file_name", "feed.row_count"
    )


@query
def files_to_replay(spark, sf_dir):
    """The checks that need a report or an earlier run, from the stored table of a second run: the
    number of booking rows decides whether the time check applies."""
    folder = run_scratch(spark).root
    source = star.write_text_feeds(spark, sf_dir, f"{folder}/source")
    for _ in range(2):
        run = run_pipeline(spark, source, f"{folder}/lake", batch_id=star.BATCH)
    checks = spark.read.parquet(run.paths["quality_checks"])
    measured = F.when((F.col("check_id") == "AC13") & (F.col("status") == "NOT_EVALUATED"), F.col("actual_json"))
    return checks.where(F.col("check_id").isin("AC01", "AC09", "AC11", "AC13")).select(
        "check_id", "severity", "status", measured.cast("long").alias("rows")
    )


@query
def two_batches(spark, sf_dir):
    """A second batch in the same lake leaves the first as it is, and each is read alone."""
    scratch = run_scratch(spark)
    folder = scratch.root
    source = star.write_text_feeds(spark, sf_dir, f"{folder}/source")
    for batch, mode, landed in (("STAR", "fixed", None), ("OLD", "buggy", lambda: scratch.drop("source"))):
        run = run_pipeline(spark, source, f"{folder}/lake", batch_id=batch, mode=mode, when_landed=landed)
    gold = read_table(tune(spark), f"{folder}/lake", "gold/daily_revenue")
    parts = [
        gold.where(F.col("batch_id") == batch).agg(
            F.lit(batch).alias("batch"),
            F.count("*").alias("gold_rows"),
            F.sum("gross_revenue_eur").cast("decimal(18,2)").alias("gross"),
            F.sum("confirmed_bookings").alias("bookings"),
        )
        for batch in ("STAR", run.batch_id)
    ]
    return parts[0].unionByName(parts[1])


@query
def files_with_faults(spark, sf_dir):
    """Rejects by cause of feeds whose text is broken in every way the rules know."""
    run = run_from_files(spark, sf_dir, write=star.write_faulty_feeds)
    return reason_histogram(run.layers.quarantine, "source_entity")


@query
def files_to_bronze(spark, sf_dir):
    return run_from_files(spark, sf_dir).layers.bronze_bookings.drop(
        "source_checksum", "ingested_at", "source_file"
    )


@query
def files_to_quarantine(spark, sf_dir):
    return run_from_files(spark, sf_dir).layers.quarantine.drop("source_file")


@query
def files_to_superseded(spark, sf_dir):
    return run_from_files(spark, sf_dir).layers.superseded


@query
def files_to_gold(spark, sf_dir):
    return run_from_files(spark, sf_dir).layers.daily_revenue


@query
def files_to_checks(spark, sf_dir):
    return k.control_checks(run_from_files(spark, sf_dir).layers).drop("check_name", "parts_json")


@query
def files_to_manifest(spark, sf_dir):
    """Rows and files per feed as the manifest counted them; file counts vary with the cluster."""
    manifest = run_from_files(spark, sf_dir).layers.manifest
    traced = F.every(col.is_digest(F.col("checksum")))
    return manifest.groupBy("source_name").agg(
        F.sum("row_count").alias("row_count"), traced.alias("has_checksums")
    )
