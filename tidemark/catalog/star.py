"""The booking feeds as read from star-schema tables.

Line items are booking versions, parts are offers, line items of closed lines are payments. All
business columns are text, as in Bronze, so that the pipeline's own code runs on them. There is
no file row number; versions tie-break on amount, part and supplier, which leaves no ties.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quarantine import quarantine
from tidemark.operators.versions import direction, hot_keys, keep_one
from tidemark.plans import bookings as b
from tidemark.plans import payments as p
from tidemark.plans import settlement as s
from tidemark.plans.checks import Layers
from tidemark.scratch import Scratch, materialise, together
from tidemark.session import tune
from tidemark.sources.contracts import FEEDS

BATCH = "STAR"
TIE_BREAK = ("line_amount", "line_part", "line_supplier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def line_key():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def price():
    return F.col("l_extendedprice").cast("decimal(12,2)")


def coded(column: str, codes: dict[str, str], otherwise: str | None = None):
    found = F.lit(otherwise)
    for value, code in codes.items():
        found = F.when(F.col(column) == value, code).otherwise(found)
    return found


def placed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, in the columns and types that booking texts are made of."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    placed = placed.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        coded("o_orderstatus", {"F": "CONFIRMED", "O": "PENDING", "P": "CANCELLED"}).alias("status"),
        (F.col("o_orderpriority") == "5-LOW").alias("by_fax"),
        (F.col("c_mktsegment") == "MACHINERY").alias("in_usd"),
    )
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        price().alias("price"),
        "o_custkey",
        "o_orderdate",
        "status",
        "by_fax",
        "in_usd",
    )


def booking_texts() -> dict[str, Column]:
    """The columns of Bronze bookings, from placed lines."""
    return {
        "booking_id": line_key(),
        "offer_id": F.col("l_partkey").cast("string"),
        "client_id": F.col("o_custkey").cast("string"),
        "source_channel": F.when(F.col("by_fax"), "FAX").otherwise("WEB"),
        "booking_ts": F.col("o_orderdate").cast("string"),
        "service_date": F.col("l_shipdate").cast("date").cast("string"),
        "booking_status": F.col("status"),
        "gross_amount": F.col("price").cast("string"),
        "currency": F.when(F.col("in_usd"), "USD").otherwise("EUR"),
        "updated_at": F.col("l_shipdate").cast("string"),
        "batch_id": F.lit(BATCH),
        "source_file": F.lit("lineitem"),
        "source_row_number": F.lit(None).cast("bigint"),
        "line_amount": F.col("price"),
        "line_part": F.col("l_partkey"),
        "line_supplier": F.col("l_suppkey"),
    }


def closed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of closed lines, in the columns and types that payment texts are made of."""
    return table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", price().alias("price")
    )


def payment_texts() -> dict[str, Column]:
    """The columns of Bronze payments, from closed lines."""
    return {
        "payment_id": F.concat_ws(
            "-", line_key(), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
        ),
        "booking_id": line_key(),
        "payment_status": coded("l_returnflag", {"N": "PAID", "R": "REFUNDED", "A": "DECLINED"}),
        "amount": F.col("price").cast("string"),
        "currency": F.lit("EUR"),
        "paid_at": F.col("l_shipdate").cast("string"),
        "batch_id": F.lit(BATCH),
        "source_file": F.lit("lineitem"),
        "source_row_number": F.lit(None).cast("bigint"),
    }


def offer_texts() -> dict[str, Column]:
    """The columns of Bronze offers, from parts."""
    return {
        "offer_id": F.col("p_partkey").cast("string"),
        "destination": F.col("p_brand"),
        "commission_rate": (F.col("p_size") / 1000).cast("decimal(5,4)").cast("string"),
        "active": F.col("p_type") != "ECONOMY",
        "batch_id": F.lit(BATCH),
        "source_file": F.lit("part"),
    }


def named(rows: DataFrame, texts: dict[str, Column]) -> DataFrame:
    return rows.select(*[text.alias(name) for name, text in texts.items()])


def bronze_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(placed_lines(spark, sf_dir), booking_texts())


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(closed_lines(spark, sf_dir), payment_texts())


def bronze_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(table(spark, sf_dir, "part"), offer_texts())


def validated_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = b.offers_reference(bronze_offers(spark, sf_dir))
    return b.validate_bookings(bronze_bookings(spark, sf_dir), offers)


def judged_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.judged_bookings(validated_bookings(spark, sf_dir), TIE_BREAK)


def ranked_bookings(spark: SparkSession, sf_dir: str, dedup_mode: str = "latest") -> DataFrame:
    """Judged rows are stored first: ranking reads them up to three times when a key is hot."""
    judged = materialise(judged_bookings(spark, sf_dir), "judged")
    return b.rank_bookings(judged, dedup_mode, TIE_BREAK, hot_keys(judged, ["booking_id"]))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank 1 only: no row of a hot key beyond its first per map task is shuffled."""
    versions = b.typed_versions(judged_bookings(spark, sf_dir), TIE_BREAK)
    order = direction("latest", ["updated_at", *TIE_BREAK])
    return keep_one(versions, ["booking_id"], order).drop(*TIE_BREAK)


def validated_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.validate_payments(bronze_payments(spark, sf_dir), candidates(spark, sf_dir))


def judged_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.judged_payments(validated_payments(spark, sf_dir))


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current bookings are needed twice, so they are stored once."""
    current = materialise(candidates(spark, sf_dir), "candidates")
    payments = p.judged_payments(p.validate_payments(bronze_payments(spark, sf_dir), current))
    return s.settle(current, p.latest_payment(p.silver_payments(payments)))


# What payments, outcomes and rejects read of a booking.
OUTCOME = ("booking_id", "booking_status", "gross_amount", "updated_at", "batch_id")


def quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rejects. Of the judged bookings only the columns that rejects depend on are stored and shuffled."""
    judged = judged_bookings(spark, sf_dir).select(*OUTCOME, "source_row_number", "validation_reason", "source_file", *TIE_BREAK)
    judged = materialise(judged, "judged")
    order = direction("latest", ["updated_at", *TIE_BREAK])
    versions = keep_one(b.typed_versions(judged, TIE_BREAK, OUTCOME), ["booking_id"], order)
    current = materialise(versions.drop(*TIE_BREAK), "candidates")
    matched = p.validate_payments(bronze_payments(spark, sf_dir), current)
    payments = materialise(p.judged_payments(matched), "payments")
    latest = p.latest_payment(p.silver_payments(payments))
    return quarantine(
        b.booking_rejects(judged),
        s.missing_payment_rejects(s.settle(current, latest)),
        p.payment_rejects(payments),
    )


def daily_by_mode(spark: SparkSession, sf_dir: str, modes: tuple[str, ...]) -> list[DataFrame]:
    """Gold of each mode, stored. Bronze payments and judged bookings, the same for all modes, are stored once."""
    judged, payments = together(
        lambda: materialise(judged_bookings(spark, sf_dir), "judged"),
        lambda: materialise(bronze_payments(spark, sf_dir), "payments"),
    )
    hot = hot_keys(judged, ["booking_id"])

    def daily(mode):
        ranked = b.rank_bookings(judged, mode, TIE_BREAK, hot)
        current = materialise(b.current_candidates(ranked), "candidates")
        matched = p.judged_payments(p.validate_payments(payments, current))
        detail = s.revenue_detail(s.settle(current, p.latest_payment(p.silver_payments(matched))))
        return materialise(s.daily_revenue(detail, one_row_per_booking=True), "daily")

    return [daily(mode) for mode in modes]


def layers(spark: SparkSession, sf_dir: str, dedup_mode: str = "latest", gold: bool = True) -> Layers:
    """All tables of one batch, each stored once, for the check suites. Without ``gold``, rejects
    are not stored and Gold is not worked out, for questions that need neither."""
    bookings, payments, offers = together(
        lambda: materialise(bronze_bookings(spark, sf_dir), "bookings"),
        lambda: materialise(bronze_payments(spark, sf_dir), "payments"),
        lambda: materialise(bronze_offers(spark, sf_dir), "offers"),
    )
    validated = b.validate_bookings(bookings, b.offers_reference(offers))
    judged = materialise(b.judged_bookings(validated, TIE_BREAK), "judged")
    hot = hot_keys(judged, ["booking_id"])
    ranked = materialise(b.rank_bookings(judged, dedup_mode, TIE_BREAK, hot), "ranked")
    current = b.current_candidates(ranked)
    matched = materialise(
        p.judged_payments(p.validate_payments(payments, current)), "matched"
    )
    silver_payments = p.silver_payments(matched)
    outcome = materialise(s.settle(current, p.latest_payment(silver_payments)), "settled")
    detail = s.revenue_detail(outcome)
    rejects = quarantine(
        b.booking_rejects(judged), s.missing_payment_rejects(outcome), p.payment_rejects(matched)
    )
    daily = s.daily_revenue(detail, one_row_per_booking=True)
    if gold:
        rejects, daily = together(
            lambda: materialise(rejects, "rejects"), lambda: materialise(daily, "daily")
        )
    return Layers(
        bronze_bookings=bookings,
        bronze_payments=payments,
        bronze_offers=offers,
        judged_bookings=judged,
        silver_bookings=s.silver_bookings(outcome),
        silver_payments=silver_payments,
        superseded=b.superseded_bookings(ranked, dedup_mode),
        quarantine=rejects,
        revenue_detail=detail,
        daily_revenue=daily,
        batch_id=BATCH,
        booking_tie_break=TIE_BREAK,
        payment_tie_break=("payment_id",),
    )


def write_text_feeds(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The same feeds as text part files, in key order, for runs that start from files."""
    return _write(spark, sf_dir, folder)


def broken(column: Column, fault, faults: dict[int, str]):
    """The column with other text where ``fault`` has a number."""
    found = column
    for number, text in faults.items():
        found = F.when(fault == number, F.lit(text)).otherwise(found)
    return found


def write_faulty_feeds(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Feeds whose text breaks a rule where the part or supplier number says so."""
    fault, texts = F.col("l_partkey") % 37, booking_texts()
    bookings = {
        "client_id": broken(texts["client_id"], fault, {0: "", 6: "  "}),
        "gross_amount": broken(texts["gross_amount"], fault, {1: "many", 2: "-0.01"}),
        "booking_ts": broken(texts["booking_ts"], fault, {3: "soon"}),
        "booking_status": broken(texts["booking_status"], fault, {4: "HELD"}),
        "offer_id": broken(texts["offer_id"], fault, {5: "none"}),
    }
    texts = payment_texts()
    fault = F.split(texts["payment_id"], "-")[3].cast("long") % 11
    payments = {
        "currency": broken(texts["currency"], fault, {0: "", 5: "GBP"}),
        "amount": broken(texts["amount"], fault, {1: "few", 2: "-3"}),
        "paid_at": broken(texts["paid_at"], fault, {3: "later"}),
        "payment_status": broken(texts["payment_status"], fault, {4: "LOST"}),
    }
    texts = offer_texts()
    perhaps = F.when(texts["offer_id"].cast("long") % 29 == 0, F.lit("perhaps")).otherwise(texts["active"].cast("string"))
    return _write(spark, sf_dir, folder, bookings, payments, {"active": perhaps})


def write_broken_lines(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Feeds whose client ids hold line breaks, commas and quotes where the part number says so."""
    kind, client = F.col("l_partkey") % 23, booking_texts()["client_id"]
    text = (
        F.when(kind == 0, F.concat(F.lit("guest\n"), client))
        .when(kind == 1, F.concat(client, F.lit(', "of"\n\nthe house')))
        .when(kind == 2, F.concat(client, F.lit('" pipe')))
        .otherwise(client)
    )
    return _write(spark, sf_dir, folder, {"client_id": text}, escape='"')


def write_sparse_payments(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Feeds whose payments lack a currency or a time where the supplier number says so; a missing value has no key."""
    texts = payment_texts()
    supplier = F.split(texts["payment_id"], "-")[3].cast("long")
    payments = {
        "currency": F.when(supplier % 7 != 0, texts["currency"]),
        "paid_at": F.when(supplier % 5 != 0, texts["paid_at"]),
    }
    return _write(spark, sf_dir, folder, payments=payments)


def write_one_file_feeds(spark: SparkSession, sf_dir: str, folder: str, whole: tuple[str, ...] | None = None) -> str:
    """The feeds with one file each, whose lines are in key order. With ``whole``, only the entities named there
    have one file; the others have part files."""
    return _write(spark, sf_dir, folder, whole=tuple(feed.entity for feed in FEEDS) if whole is None else whole)


def _one_file(spark: SparkSession, parts: str, path: str, header: str | None) -> None:
    """One text file of the lines of all part files, in the order of their names. The task that writes it
    holds a line at a time: the parts are sorted already."""
    reader = spark.read.option("lineSep", "\n")
    names = sorted(uri.rpartition("/")[2] for uri in reader.text(parts).inputFiles())
    lines = [reader.text(f"{parts}/{name}") for name in names]
    if header is not None:
        lines.insert(0, spark.range(1, numPartitions=1).select(F.lit(header).alias("value")))
    reduce(DataFrame.unionAll, lines).coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def _in_order(rows: DataFrame, texts: dict[str, Column], order: list[str]) -> DataFrame:
    """The texts of all rows, sorted. Rows are dealt to ranges in the types they have in the tables, a fraction of their
    texts; these are made and sorted behind that shuffle."""
    return named(rows.repartitionByRange(*[texts[name] for name in order]), texts).sortWithinPartitions(*order)


def _write(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    bookings: dict[str, Column] = {},
    payments: dict[str, Column] = {},
    offers: dict[str, Column] = {},
    escape: str = "\\",
    whole: tuple[str, ...] = (),
) -> str:
    """The three feeds as text files, with other texts in the columns named."""
    feeds = {
        "bookings.csv": (placed_lines(spark, sf_dir), {**booking_texts(), **bookings}, ["booking_id", "updated_at", *TIE_BREAK]),
        "payments.jsonl": (closed_lines(spark, sf_dir), {**payment_texts(), **payments}, ["payment_id", "paid_at", "amount"]),
        "offers.csv": (table(spark, sf_dir, "part"), {**offer_texts(), **offers}, ["offer_id"]),
    }

    def write(feed):
        rows, texts, order = feeds[feed.file_name]
        rows = _in_order(rows, texts, order).select(*feed.columns)
        one_file, spark = feed.entity in whole, rows.sparkSession
        scratch, path = Scratch(spark), f"{folder}/{feed.file_name}"
        parts = f"{scratch.root}/parts" if one_file else path
        writer = rows.write.mode("overwrite").option("compression", "gzip" if one_file else "none")
        writer.json(parts) if feed.is_json else writer.option("header", not one_file).option("escape", escape).csv(parts)
        if one_file:
            _one_file(spark, parts, path, None if feed.is_json else ",".join(feed.columns))
            scratch.drop()

    together(*[lambda feed=feed: write(feed) for feed in FEEDS])
    return folder
