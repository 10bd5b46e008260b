"""WARC archives with revisit resolution.

Record headers (page, payload digest, length) are shuffled by digest; the smallest page of each
payload becomes its response record, the others become revisit records that name it. Only then do
payloads move, once, to be written under fresh headers. Archives are gzip files of WARC/1.1
records in a folder that every executor reaches; they are written and listed by Spark, so the
folder may be in any store Spark knows.

Defined results: a null payload is an empty one; a null url has no target line; payloads of fewer
than ``least_bytes`` bytes are never shared. A row that repeats the smallest page_id with the same
payload is a response too, since a record cannot revisit itself. A null page_id revisits the
smallest known page of its payload, and where no page is known all are responses. Extra columns
are not archived.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import Scratch

ALPHABET, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 1 << 29  # of records in an archive before compression
SMALL_BYTES, HEADER_BYTES = 8 << 20, 600  # an archive that is not worth its file; what a record has besides its payload
READ_BYTES = 1 << 20


def base32_sha1(column):
    """SHA-1 of a column's bytes in upper-case base32, without prefix. The bytes are hashed once: a digest named in
    each of its parts would be worked out again for every one of them."""

    def letters(hexed):
        groups = [F.lpad(F.conv(F.substring(hexed, at, size), 16, 32), size * 4 // 5, "0") for at, size in ((1, 15), (16, 15), (31, 10))]
        return F.translate(F.concat(*groups), DIGITS, ALPHABET)

    return F.transform(F.array(F.sha1(column.cast("binary"))), letters)[0]


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, payload_digest, refers_to``: the records that repeat another record's payload."""
    heads = pages.select(
        "page_id", base32_sha1(F.coalesce("html", F.lit(""))).alias("payload_digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"),
    ).filter(F.col("size") >= least_bytes).drop("size")
    shared = heads.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter("n > 1 and refers_to is not null").drop("n")
    found = heads.join(shared, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "payload_digest", "refers_to").distinct()


def _line(name, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def _urn(page, digest):
    name = F.md5(F.concat_ws("|", page.cast("string"), digest))
    parts = [F.substring(name, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _archives(pages: DataFrame) -> int:
    """How many archives: so many that they are half full on average, and, below that, one for each task of a shuffle."""
    total = pages.agg(F.sum(F.octet_length("html") + HEADER_BYTES)).first()[0] or 0
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-2 * total // FILE_BYTES), min(tasks, -(-total // SMALL_BYTES)))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """One record per page, equal payloads once, as gzipped WARC files in ``folder``.

    Records are dealt evenly to as many files as their bytes ask for, in one pass, so that a file holds about half of
    ``FILE_BYTES``, and more than that only where single pages are nearly as long.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("payload_digest", base32_sha1(F.col("html"))).alias("p")
    again = Scratch(pages.sparkSession).keep(revisits(pages, least_bytes), "revisits").alias("r")
    typed = pages.join(
        again, F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.payload_digest") == F.col("r.payload_digest")), "left"
    ).select("p.*", "r.refers_to")
    is_revisit = F.col("refers_to").isNotNull()
    payload = F.when(is_revisit, F.lit("")).otherwise(F.col("html"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"), F.lit("\r\n\r\n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    size = F.octet_length(http) + F.octet_length(payload)
    refers = F.when(is_revisit, _urn(F.col("refers_to"), F.col("payload_digest")))
    profile = F.when(is_revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("payload_digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", profile),
        _line("WARC-Refers-To", refers),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"),
        F.lit("\r\n\r\n"), http, payload)
    # a row's own number deals it out, so equal rows spread like any others
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = typed.select(record.alias("value"), place.alias("place")).repartition(_archives(pages), "place").select("value")
    dealt.write.mode("error").options(lineSep="\r\n\r\n", compression="gzip").text(folder)


def _records(content):
    """(headers, block) of each record of one gzipped archive, by its content lengths."""
    unpacker, at, held = zlib.decompressobj(wbits=31), 0, b""

    def more():
        nonlocal unpacker, at, held
        if at >= len(content):
            return False
        piece = content[at : at + READ_BYTES]
        at += len(piece)
        held += unpacker.decompress(piece)
        while unpacker.eof and unpacker.unused_data:  # the next gzip member
            rest, unpacker = unpacker.unused_data, zlib.decompressobj(wbits=31)
            held += unpacker.decompress(rest)
        return True

    start = 0
    while True:
        while (end := held.find(b"\r\n\r\n", start)) < 0:
            held, start = held[start:], 0
            if not more():
                if held.strip(b"\r\n"):
                    raise ValueError("an archive ends inside a record")
                return
        lines = held[start:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record where one is expected: {lines[0][:40]!r}")
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        size, start = int(headers["content-length"]), end + 4
        while len(held) < start + size + 4:
            held, start = held[start:], 0
            if not more():
                raise ValueError("an archive ends inside a record")
        yield headers, held[start : start + size]
        start += size + 4


RECORD = ("record_id string, record_type string, page_id long, target_uri string, payload_digest string,"
          " refers_to long, payload binary")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives in ``folder``; a revisit has no payload of its own."""

    def run(batches):
        def number(text):
            return None if text is None else int(text)

        def made(rows):
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = [field.split()[0] for field in RECORD.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for headers, block in _records(content.as_py()):
                    kind = headers["warc-type"]
                    payload = block[block.index(b"\r\n\r\n") + 4 :] if kind == "response" else None
                    rows.append((
                        headers["warc-record-id"], kind, number(headers.get("x-page-id")), headers.get("warc-target-uri"),
                        headers["warc-payload-digest"].removeprefix("sha1:"), number(headers.get("x-refers-to-page-id")), payload))
                    held += len(block)
                    if held >= 4 * READ_BYTES:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, RECORD)


def resolved(heads: DataFrame) -> DataFrame:
    """Revisit headers joined to the original of their payload, for its length and page.

    ``heads`` has ``page_id, record_type, payload_digest, payload_bytes``, the last null for revisits.
    """
    originals = heads.filter("record_type = 'response'").groupBy("payload_digest").agg(
        F.min("page_id").alias("original"), F.min("payload_bytes").alias("original_bytes"))
    return heads.join(originals, "payload_digest", "left").select(
        "page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("original")).alias("refers_to"))
