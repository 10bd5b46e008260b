"""Raw landing: an untouched copy of every source file, with checksums proving it.

Files of every size are copied by line, cut at line feeds only, as bytes: carriage returns and bytes
that are no UTF-8 stay, and a line of more than ``PIECE_BYTES`` is stored in pieces. With the file's size, which
tells whether the last line ends in a line feed and whether the file began with a byte order mark, the
lines rebuild the file exactly. Source files are read once: what is known of a line (its SHA-256, whether it is blank, how
quotes in it open and close) is worked out while it is copied, and Bronze rows come from the copy.

A file's checksum is the root of a tree over the SHA-256 of its lines in order (``operators.tree``): many tasks
hash one file, how it was split does not show, and a lost, changed or swapped line is found by its range.
Files also have the plain SHA-256 of their bytes, as other tools compute it, whatever their size. That hash goes
through a file from its first byte to its last, so for that alone each file is read a second time, by one task that
holds a batch of lines at a time.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_blank, total
from tidemark.operators import tree
from tidemark.scratch import Scratch, together
from tidemark.session import whole_files
from tidemark.sinks.writers import batch_path, read_batch, replace_batch
from tidemark.sources.contracts import Contract
from tidemark.sources.feeds import source_file
from tidemark.sources.records import turn

RAW_FILES = "bronze/raw_files"
RAW_LINES = "bronze/raw_lines"
RAW_BLOCKS = "bronze/raw_blocks"
RAW_TREE = "bronze/raw_tree"
BYTE_ORDER_MARK = bytes([0xEF, 0xBB, 0xBF])
PIECE_BYTES = 1 << 20
CHECKSUM_KIND = f"sha256-tree-{tree.FAN}"
FILE = ["source_name", "source_file"]


def land(
    spark: SparkSession,
    paths: dict[str, str],
    feeds: tuple[Contract, ...],
    root: str,
    batch_id: str,
    run_id: str | None = None,
) -> DataFrame:
    """Copy all files; return one row per file with its size, copy, checksums and what the copy holds.

    Stores four tables: the lines, the blocks in which files were read, the checksum tree and the files.
    """
    stored, blocks = copy_lines(spark, paths, feeds, root, batch_id, run_id)
    return describe(spark, paths, feeds, stored, blocks, root, batch_id, run_id)


def copy_lines(
    spark: SparkSession, paths: dict[str, str], feeds: tuple[Contract, ...], root: str, batch_id: str, run_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored lines of all files, and the blocks in which they were read."""
    lines = reduce(DataFrame.unionByName, [_lines(spark, paths[feed.entity], feed) for feed in feeds])
    stored = replace_batch(lines, root, RAW_LINES, batch_id, run_id=run_id)
    return stored, replace_batch(_blocks(stored), root, RAW_BLOCKS, batch_id, run_id=run_id)


def describe(
    spark: SparkSession,
    paths: dict[str, str],
    feeds: tuple[Contract, ...],
    stored: DataFrame,
    blocks: DataFrame,
    root: str,
    batch_id: str,
    run_id: str | None = None,
) -> DataFrame:
    """Hash the stored lines again, grow their trees, and list the files with both."""
    scratch = Scratch(spark)
    try:
        grown, files = together(
            lambda: replace_batch(_tree(stored, blocks, F.col("line_hash"), scratch), root, RAW_TREE, batch_id, run_id=run_id),
            lambda: scratch.keep(reduce(DataFrame.unionByName, [_files(spark, paths[feed.entity], feed, scratch) for feed in feeds]), "files"),
        )
        return _describe(files, grown, root, batch_id, run_id)
    finally:
        scratch.drop()


def _describe(files: DataFrame, grown: DataFrame, root: str, batch_id: str, run_id: str | None) -> DataFrame:
    copied = tree.roots(grown, FILE).select(
        *FILE, F.lower(F.hex("digest")).alias("digest"), F.col("bytes").alias("copied_bytes"), "damaged_lines"
    )
    described = files.join(copied, FILE, "left").select(
        *FILE,
        "source_path",
        "size_bytes",
        file_checksum(F.col("digest"), F.col("size_bytes")).alias("checksum"),
        F.lit(CHECKSUM_KIND).alias("checksum_kind"),
        "sha256",
        F.coalesce("copied_bytes", F.lit(0)).alias("copied_bytes"),
        F.coalesce("damaged_lines", F.lit(0)).alias("damaged_lines"),
        F.lit(batch_path(root, RAW_LINES, batch_id, run_id)).alias("bronze_copy"),
    )
    return replace_batch(described, root, RAW_FILES, batch_id, run_id=run_id).drop("batch_id")


def _files(spark, path, feed, scratch):
    """The files of a feed, with the plain SHA-256 of their bytes."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    place = F.col("_metadata.file_path")
    named = listing.select(
        place.alias("place"),
        F.lit(feed.entity).alias("source_name"),
        source_file(place, feed).alias("source_file"),
        F.col("path").alias("source_path"),
        F.col("length").alias("size_bytes"),
    )
    files = named.join(scratch.keep(_plain_digests(spark, path), "digests"), "place", "left")
    # Compressed files, whose lines are not their bytes, and files without lines are hashed as they are.
    rest = [row["source_path"] for row in files.where(F.col("sha256").isNull()).collect()]
    if rest:
        content = spark.read.format("binaryFile").load(rest).select(place.alias("place"), F.sha2("content", 256).alias("content"))
        files = files.join(content, "place", "left").withColumn("sha256", F.coalesce("sha256", "content")).drop("content")
    return files.drop("place")


def _plain_digests(spark, path):
    """``place, sha256`` of every file with lines: each is read in order by one task. Null where the lines do not
    make up the file's size."""
    text = whole_files(spark).read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    lines = text.select(
        F.when(first, F.col("_metadata.file_path")).alias("place"),
        F.when(first, F.col("_metadata.file_size")).alias("size"),
        F.concat(F.lit(b"\n"), F.col("value").cast("binary")).alias("line"),
    )
    mark = BYTE_ORDER_MARK

    def hashed(batches):
        # imported here, as the function is sent to workers that need not have this package
        import hashlib

        import numpy as np
        import pyarrow as pa

        place = None
        for batch in batches:
            if not batch.num_rows:
                continue
            line = batch.column("line")
            width = np.int64 if pa.types.is_large_binary(line.type) else np.int32
            ends = np.frombuffer(line.buffers()[1], width, len(line) + 1, line.offset * np.dtype(width).itemsize)
            body = memoryview(line.buffers()[2])[ends[0] : ends[-1]]
            if place is None:
                place, size = batch.column("place")[0].as_py(), batch.column("size")[0].as_py()
                # whether the file begins with a byte order mark shows at its end
                hashes, read, body = {False: hashlib.sha256(), True: hashlib.sha256(mark)}, 1, body[1:]
            for one in hashes.values():
                one.update(body)
            read += len(body)
        if place is not None:
            over, found = size - read, None
            if over in (-1, 0, 2, 3):
                found = hashes[over > 0]
                found.update(b"\n" if over in (0, 3) else b"")
                found = found.hexdigest()
            yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.string()), "sha256": pa.array([found], pa.string())})

    return lines.mapInArrow(hashed, "place string, sha256 string")


def _lines(spark, path, feed):
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    whole = F.expr(
        f"CASE WHEN octet_length(value) <= {PIECE_BYTES} THEN array(CAST(value AS BINARY)) ELSE"
        f" transform(sequence(0, int((octet_length(value) - 1) div {PIECE_BYTES})),"
        f" i -> substring(CAST(value AS BINARY), i * {PIECE_BYTES} + 1, {PIECE_BYTES})) END"
    )
    quotes = F.lit(0) if feed.is_json else turn(F.col("value"))
    lines = text.select(
        F.lit(feed.entity).alias("source_name"),
        source_file(F.col("_metadata.file_path"), feed).alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        (F.btrim("value", F.lit(" \t\r")) == "").alias("blank"),
        quotes.cast("tinyint").alias("turn"),
        whole.alias("whole"),
    )
    cut = lines.select("*", F.size("whole").alias("pieces"), F.posexplode("whole").alias("piece", "value"))
    return cut.drop("whole").withColumn("line_hash", F.unhex(F.sha2("value", 256)))


def _blocks(stored: DataFrame) -> DataFrame:
    """One row per block in which a file was read: its line ids, which are contiguous, and the lines of its file
    before it; and how many lines are blank, leave a quoted field open, or lie in pieces."""
    once = F.col("piece") == 0
    blocks = stored.groupBy(*FILE, "block_start").agg(
        F.min("line_id").alias("first"),
        F.max("line_id").alias("last"),
        F.count_if(once).alias("lines"),
        F.count_if(once & F.col("blank")).alias("blanks"),
        F.count_if(once & F.col("turn").isin(2, 3)).alias("opening"),
        F.count_if(~once).alias("more_pieces"),
        F.min(F.when(~F.col("blank"), F.col("line_id"))).alias("first_filled"),
    )
    earlier = Window.partitionBy(*FILE).orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("lines_before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))


def numbered_lines(stored: DataFrame, blocks: DataFrame) -> DataFrame:
    """The raw lines with ``line_number`` within their file, from 1."""
    places = blocks.select(*FILE, "block_start", "first", "lines_before")
    number = F.col("lines_before") + F.col("line_id") - F.col("first") + 1
    return stored.join(places, [*FILE, "block_start"]).withColumn("line_number", number).drop("first", "lines_before")


def _tree(stored: DataFrame, blocks: DataFrame, line_hash: Column, scratch: Scratch) -> DataFrame:
    """The checksum tree of each file, with the bytes of its lines and how many do not match their hash."""
    again = F.unhex(F.sha2("value", 256))
    lines = numbered_lines(stored, blocks).withColumn("number", F.col("line_number") - 1)
    measures = {
        "bytes": F.octet_length("value") + F.when(F.col("piece") == 0, 1).otherwise(0),
        "damaged_lines": F.when(again != F.col("line_hash"), 1).otherwise(0),
    }
    return tree.grow(lines, FILE, "number", line_hash, scratch.keep, ["piece"], measures, alone=F.col("pieces") == 1)


def file_checksum(digest: Column, size: Column) -> Column:
    return F.sha2(F.concat_ws("|", size.cast("string"), F.coalesce(digest, F.lit("empty"))), 256)


def hash_number(text: Column) -> Column:
    """The first 60 bits of the text's SHA-256."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def combined_digest(number: Column) -> Column:
    """Aggregate: digest of a bag of hash numbers, whatever their order."""
    parts = F.concat_ws(
        "|",
        F.count("*").cast("string"),
        total(number.cast("decimal(20,0)")).cast("string"),
        F.coalesce(F.bit_xor(F.xxhash64(number)), F.lit(0)).cast("string"),
    )
    return F.sha2(parts, 256)


def file_bytes(lines: list[bytes], size: int) -> bytes:
    """A file from its raw lines in order and its size. For files that fit in memory."""
    body = b"".join(line + b"\n" for line in lines)
    if size - len(body) in (2, 3):
        body = BYTE_ORDER_MARK + body
    return body[:size]


def complete() -> Column:
    """Whether a landed file's copy has all its bytes: the last line may lack its line feed, and a byte
    order mark is not part of a line."""
    return (F.col("size_bytes") - F.col("copied_bytes")).isin(-1, 0, 2, 3)


def intact(landed: DataFrame) -> bool:
    """Every file's copy has as many bytes as the file, and every stored line the hash it had when it was read."""
    return landed.where(~complete() | (F.col("damaged_lines") > 0)).isEmpty()


def damaged_ranges(spark: SparkSession, root: str, batch_id: str, run_id: str | None = None) -> DataFrame:
    """``source_name, source_file, first_line, last_line`` of the parts of the stored copy that are not what was
    landed: the lines are hashed again, and the tree is compared with the stored one from its roots down."""
    stored, blocks, recorded = (read_batch(spark, root, table, batch_id, run_id=run_id) for table in (RAW_LINES, RAW_BLOCKS, RAW_TREE))
    scratch = Scratch(spark)
    found = _tree(stored, blocks, F.unhex(F.sha2("value", 256)), scratch)
    ranges = scratch.keep(tree.damaged(recorded.drop("batch_id"), found, FILE), "ranges")
    return ranges.select(*FILE, (F.col("first") + 1).alias("first_line"), (F.col("last") + 1).alias("last_line"))


def verify(spark: SparkSession, landed: DataFrame, root: str, batch_id: str, run_id: str | None = None) -> bool:
    """Hash the copy again: it is still what was landed, and that had the files' lengths and checksums."""
    recorded = tree.roots(read_batch(spark, root, RAW_TREE, batch_id, run_id=run_id), FILE)
    recorded = recorded.select(*FILE, F.lower(F.hex("digest")).alias("digest"))
    matched = landed.join(recorded, FILE, "left")
    unlike = ~F.col("checksum").eqNullSafe(file_checksum(F.col("digest"), F.col("size_bytes")))
    return (
        intact(landed)
        and matched.where(unlike).isEmpty()
        and damaged_ranges(spark, root, batch_id, run_id).isEmpty()
    )


def manifest(landed: DataFrame, row_counts: DataFrame, batch_id: str) -> DataFrame:
    """One row per source file. ``row_counts`` counts the Bronze rows of each file."""
    rows = row_counts.select("source_file", F.col("actual_row_count").alias("row_count"))
    return landed.join(rows, "source_file", "left").select(
        "source_name",
        "source_file",
        "source_path",
        "bronze_copy",
        "checksum",
        "checksum_kind",
        "sha256",
        "size_bytes",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        F.lit(batch_id).alias("batch_id"),
    )


def row_counts(*bronze_tables: DataFrame) -> DataFrame:
    counts = [
        table.groupBy("source_file").agg(F.count("*").alias("actual_row_count"))
        for table in bronze_tables
    ]
    return reduce(DataFrame.unionByName, counts)


def feed_totals(manifest_rows: DataFrame) -> DataFrame:
    """One row per feed: files, bytes, rows and an order-free digest of its files' names and
    checksums, also for a feed of one file."""
    combined = combined_digest(hash_number(F.concat_ws("|", "source_file", "checksum")))
    return manifest_rows.groupBy("source_name").agg(
        F.count("*").alias("files"),
        F.sum("size_bytes").alias("size_bytes"),
        F.sum("row_count").alias("row_count"),
        combined.alias("checksum"),
    )


def source_fingerprint(feed_checksums: dict[str, str], feeds: tuple[Contract, ...]) -> str:
    text = "|".join(feed_checksums[feed.entity] for feed in feeds)
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def manifest_anomalies(manifest_rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Files that only one side knows, whose count is off, or that lack checksum or copy."""
    both = manifest_rows.withColumnRenamed("source_file", "listed_file").join(
        counts, F.col("listed_file") == F.col("source_file"), "full"
    )
    return both.where(
        F.col("listed_file").isNull()
        | F.col("source_file").isNull()
        | ~F.col("row_count").eqNullSafe(F.col("actual_row_count"))
        | is_blank(F.col("checksum"))
        | is_blank(F.col("bronze_copy"))
    )
