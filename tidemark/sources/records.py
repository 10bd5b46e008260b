"""Records of landed lines: which lines belong together, and their numbers.

A CSV field in quotes may hold line breaks, so a line can be read only when it is known whether it begins inside such a
field. That is a scan: each line is a function from "began outside or inside quotes" to "ends outside or inside", the functions
are composed over the lines of a block, the blocks' results over a file, and the state before every line
follows. Blocks are scanned side by side; over a whole file only one row per block is scanned. A field is quoted
only if it begins with a quote; a quote anywhere else is text, so ``5" pipe`` opens nothing. Most lines
leave every field closed, and then none of this is done.

Numbers come from the table of blocks. Only blocks with blank lines or with records of several lines are
counted row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import Scratch
from tidemark.sources.contracts import DataContractError

# What a line does to the state: nothing, leaves it outside, leaves it inside, turns it over.
NOTHING, OUTSIDE, INSIDE, OVER = range(4)
# Where a piece of text between two quotes stands.
PLAIN, QUOTED, CLOSED, BEGINNING = range(4)
FILE = ["source_name", "source_file"]
BLOCK = [*FILE, "block_start"]


def turn(line: Column) -> Column:
    """What a CSV line does to the state before it. A line without quotes does nothing."""

    def step(state, text):
        starts_field = F.endswith(text, F.lit(",")) | ((state == BEGINNING) & (text == ""))
        doubled = (state == CLOSED) & (text == "")
        return F.when(state == QUOTED, CLOSED).when(doubled | starts_field, QUOTED).otherwise(PLAIN)

    def ends_inside(state):
        parts = F.split(line, '"')
        between = F.slice(parts, 1, F.size(parts) - 1)
        return F.aggregate(between, F.lit(state), step) == QUOTED

    from_outside, from_inside = ends_inside(BEGINNING), ends_inside(QUOTED)
    found = (
        F.when(from_outside & from_inside, INSIDE)
        .when(from_outside, OVER)
        .when(from_inside, NOTHING)
        .otherwise(OUTSIDE)
    )
    return F.when(F.contains(line, F.lit('"')), found).otherwise(NOTHING)


def _scan(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``settled`` and ``flips`` before each row: the state its last settling row left (null if none), and
    whether it has turned over since."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    value = F.when(F.col("turn") == OUTSIDE, 0).when(F.col("turn") == INSIDE, 1)
    flips = F.when(F.col("turn") == OVER, 1).otherwise(0)
    counted = df.withColumn("_flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    at = F.last(F.when(value.isNotNull(), F.col("_flips")), ignorenulls=True).over(before)
    return counted.select(
        *df.columns,
        F.last(value, ignorenulls=True).over(before).alias("settled"),
        ((F.col("_flips") - F.coalesce(at, F.lit(0))) % 2).alias("flips"),
    )


def _after(before: Column) -> Column:
    """The state behind a row from the state before it."""
    return (
        F.when(F.col("turn") == OUTSIDE, 0)
        .when(F.col("turn") == INSIDE, 1)
        .when(F.col("turn") == OVER, 1 - before)
        .otherwise(before)
    )


def stretches(lines: DataFrame, blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """``BLOCK, from, to, head_block, head``: runs of lines that belong to a record of several lines, and that
    record's first line.

    Raises when a file ends inside a quoted field.
    """
    open_files = blocks.groupBy(*FILE).agg(F.sum("opening").alias("n")).where(F.col("n") > 0).select(*FILE)
    marks = lines.where((F.col("turn") != NOTHING) & (F.col("piece") == 0)).select(*BLOCK, "line_id", "turn")
    marks = scratch.keep(_scan(marks.join(open_files, FILE, "left_semi"), BLOCK, "line_id"), "marks")

    # a block as one function: that of its last mark behind those before it
    last = F.max_by(F.struct("turn", "settled", "flips"), "line_id").alias("m")
    whole = marks.groupBy(*BLOCK).agg(last).select(
        *BLOCK,
        F.when(F.col("m.turn").isin(OUTSIDE, INSIDE), F.col("m.turn"))
        .when(
            F.col("m.settled").isNotNull(),
            F.when((F.col("m.settled") + F.col("m.flips") + (F.col("m.turn") == OVER).cast("int")) % 2 == 1, INSIDE).otherwise(OUTSIDE),
        )
        .when((F.col("m.flips") + (F.col("m.turn") == OVER).cast("int")) % 2 == 1, OVER)
        .otherwise(NOTHING)
        .alias("turn"),
    )
    places = blocks.join(open_files, FILE, "left_semi").select(*BLOCK, "first", "last", "lines_before")
    places = places.join(whole, BLOCK, "left").withColumn("turn", F.coalesce("turn", F.lit(NOTHING)))
    begins = (F.coalesce("settled", F.lit(0)) + F.col("flips")) % 2
    places = scratch.keep(
        _scan(places, FILE, "block_start").withColumn("begins", begins).withColumn("ends", _after(begins)), "places"
    )

    state = F.when(F.col("settled").isNull(), F.col("begins")).otherwise(F.col("settled"))
    events = marks.join(places.select(*BLOCK, "begins"), BLOCK).withColumn("before", (state + F.col("flips")) % 2)
    events = events.withColumn("behind", _after(F.col("before"))).where(F.col("before") != F.col("behind"))
    following = Window.partitionBy(*BLOCK).orderBy("line_id")
    events = events.withColumn("closes", F.lead("line_id").over(following))
    events = scratch.keep(events.select(*BLOCK, "line_id", "behind", "closes"), "events")

    within = Window.partitionBy(*FILE).orderBy("block_start")
    summary = events.groupBy(*BLOCK).agg(
        F.min("line_id").alias("first_event"),
        F.max(F.when(F.col("behind") == 1, F.col("line_id"))).alias("last_open"),
    )
    opened = F.when(F.col("last_open").isNotNull(), F.struct(F.col("block_start").alias("head_block"), F.col("last_open").alias("head")))
    carried = scratch.keep(
        places.join(summary, BLOCK, "left")
        .withColumn("carry", F.last(opened, ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open_at", F.last(opened, ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("is_last", F.lead("block_start").over(within).isNull()),
        "carried",
    )
    unclosed = carried.where(F.col("is_last") & (F.col("ends") == 1)).select("source_file", "open_at.head", "open_at.head_block")
    if found := unclosed.orderBy("source_file").head(5):
        starts = carried.select("source_file", "block_start", "first", "lines_before")
        told = []
        for row in found:
            place = starts.where((F.col("source_file") == row["source_file"]) & (F.col("block_start") == row["head_block"])).first()
            told.append(f"{row['source_file']} line {place['lines_before'] + row['head'] - place['first'] + 1}")
        raise DataContractError(f"a quoted field is never closed: {', '.join(told)}")

    own = events.where(F.col("behind") == 1).join(places.select(*BLOCK, "last"), BLOCK).select(
        *BLOCK,
        F.col("line_id").alias("from"),
        F.coalesce("closes", "last").alias("to"),
        F.col("block_start").alias("head_block"),
        F.col("line_id").alias("head"),
    )
    rest = carried.where(F.col("begins") == 1).select(
        *BLOCK,
        F.col("first").alias("from"),
        F.coalesce("first_event", "last").alias("to"),
        F.col("carry.head_block").alias("head_block"),
        F.col("carry.head").alias("head"),
    )
    return own.unionByName(rest)


def _whole(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines as text, those in pieces put together."""
    columns = [*BLOCK, "line_id", "blank"]
    short = lines.where(F.col("pieces") == 1).select(*columns, F.col("value").cast("string").alias("text"))
    if blocks.where(F.col("more_pieces") > 0).isEmpty():
        return short
    listed = F.array_sort(F.collect_list(F.struct("piece", "value")))
    joined = F.aggregate(listed, F.lit(b""), lambda all_, one: F.concat(all_, one["value"]))
    long = lines.where(F.col("pieces") > 1).groupBy(*columns).agg(joined.cast("string").alias("text"))
    return short.unionByName(long)


def _merged(lines: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of one line, and of several joined by line feeds under their first line's place."""
    place = [*BLOCK, "line_id"]
    spread = members.select(*BLOCK, F.explode(F.sequence("from", "to")).alias("line_id"), "head_block", "head")
    met = lines.join(spread, place, "left")
    alone = met.where(F.col("head").isNull()).select(*place, "blank", "text")
    listed = F.array_sort(F.collect_list(F.struct("block_start", "line_id", "text")))
    text = F.array_join(F.transform(listed, lambda line: line["text"]), "\n")
    together = met.where(F.col("head").isNotNull()).groupBy(*FILE, "head_block", "head").agg(text.alias("text"))
    together = together.select(
        *FILE, F.col("head_block").alias("block_start"), F.col("head").alias("line_id"), F.lit(False).alias("blank"), "text"
    )
    return alone, together


def numbered_records(
    lines: DataFrame, blocks: DataFrame, scratch: Scratch, into: str, has_header: bool, line_breaks: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The records of a feed with their numbers from 1, files by name and records by place; and each file's header.

    Blank lines and headers have no number. With ``line_breaks`` a quoted field of a CSV feed may hold line breaks;
    without, every line is a record.
    """
    texts = _whole(lines, blocks)
    breaks = has_header and line_breaks and not blocks.where(F.col("opening") > 0).isEmpty()
    continued = None
    if breaks:
        members = scratch.keep(stretches(lines, blocks, scratch), "stretches")
        alone, together = _merged(texts, members)
        # stored, as headers, sizes and numbers each read it: the join and the grouping behind it run once
        texts = scratch.keep(alone.unionByName(together), "records")
        # blocks that hold part of a record of several lines
        continued = members.select(*BLOCK).distinct().withColumn("continued", F.lit(True))
    texts = texts.where(~F.col("blank")).drop("blank")

    table = blocks if continued is None else blocks.join(continued, BLOCK, "left")
    merged = F.lit(False) if continued is None else F.coalesce("continued", F.lit(False))
    if has_header:
        top = F.min(F.when(F.col("first_filled").isNotNull(), F.struct("block_start", "first_filled"))).over(Window.partitionBy(*FILE))
        table = table.withColumn("_top", top).withColumn("header", F.when(F.col("_top.block_start") == F.col("block_start"), F.col("_top.first_filled")))
    else:
        table = table.withColumn("header", F.lit(None).cast("bigint"))
    table = table.withColumn("by_row", merged | (F.col("blanks") > 0)).withColumn(
        "records", F.col("lines") - F.when(F.col("header").isNotNull(), 1).otherwise(0)
    )
    table = scratch.keep(table.select(*BLOCK, "first", "header", "by_row", "records"), "record_blocks")
    placed = texts.join(table.select(*BLOCK, "first", "header", "by_row"), BLOCK)
    headers = placed.where(F.col("line_id") == F.col("header")).select(*FILE, F.rtrim("text", F.lit("\r")).alias("header"))
    rows = placed.where(F.col("header").isNull() | (F.col("line_id") != F.col("header")))

    plain = rows.where(~F.col("by_row")).withColumn("_place", F.col("line_id") - F.col("first") + F.when(F.col("header").isNull(), 1).otherwise(0))
    if not table.where("by_row").isEmpty():
        inside = Window.partitionBy(*BLOCK).orderBy("line_id")
        listed = rows.where(F.col("by_row"))
        counted = listed.withColumn("_place", F.row_number().over(inside).cast("bigint"))
        sizes = listed.groupBy(*BLOCK).agg(F.count("*").alias("_counted"))
        table = table.join(sizes, BLOCK, "left").withColumn(
            "records", F.when(F.col("by_row"), F.coalesce("_counted", F.lit(0))).otherwise(F.col("records"))
        )
        plain = plain.unionByName(counted)
    within = Window.partitionBy(*FILE).orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    files = table.groupBy(*FILE).agg(F.sum("records").alias("_file"))
    earlier = Window.orderBy(*FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_earlier", F.coalesce(F.sum("_file").over(earlier), F.lit(0))).drop("_file")
    starts = table.withColumn("_inside", F.coalesce(F.sum("records").over(within), F.lit(0))).join(files, FILE)
    starts = scratch.keep(starts.select(*BLOCK, (F.col("_inside") + F.col("_earlier")).alias("_before")), "starts")
    numbered = plain.join(starts, BLOCK).select(
        (F.col("_before") + F.col("_place")).alias(into), *FILE, F.rtrim("text", F.lit("\r")).alias("text")
    )
    return numbered, headers
