"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points has a rolling hash. Of each ``WINDOW`` consecutive hashes the
smallest is chosen, the rightmost on a tie, and kept with its position. Two texts that share
``GRAM + WINDOW - 1`` consecutive code points share a chosen hash at the same place in them.

A fingerprint is text: per chosen hash eight characters of base64, four bytes of hash and two of
distance from the position before (a distance never exceeds the window). Likeness is the Jaccard
index of the sets of chosen hashes.

Defined results: null and empty texts have the empty fingerprint and are alike to each other only.
A text shorter than a gram is one gram. A text with fewer grams than a window has one window.
"""

from __future__ import annotations

import base64
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import BLOCK_BYTES, U64, mix, powers

GRAM, WINDOW = 16, 32
BLOCK = 1 << 19  # grams hashed at a time; the table of powers is longer
CODE_POINTS = mix(np.arange(1, 0x110001, dtype=U64))


def _gram_hashes(codes, gram):
    power, inverse = powers()
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(CODE_POINTS[codes] * power[: len(codes)], out=sums[1:])
    found = (sums[gram:] - sums[:-gram]) * inverse[: len(codes) - gram + 1]
    found = (found ^ (found >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return found >> U64(32)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW):
    """Positions and 32-bit hashes that are chosen in a text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    gram = min(gram, len(codes))
    grams = len(codes) - gram + 1
    window = min(window, grams)
    chosen = []
    for start in range(0, grams - window + 1, BLOCK - window - gram):
        stop = min(grams, start + BLOCK - gram - 1)
        hashes = _gram_hashes(codes[start : stop + gram - 1], gram)
        # hash above, position from the right below: the minimum is the rightmost smallest hash
        values = (hashes << U64(32)) | (U64(0xFFFFFFFF) - np.arange(len(hashes), dtype=U64))
        reach = 1
        while reach < window:
            step = min(reach, window - reach)
            values = np.minimum(values[: len(values) - step], values[step:])
            reach += step
        at = (U64(0xFFFFFFFF) - (values & U64(0xFFFFFFFF))).astype(np.int64)
        at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        chosen.append((at + start, hashes[at].astype(np.uint32)))
    if len(chosen) == 1:
        return chosen[0]
    at, hashes = (np.concatenate(x) for x in zip(*chosen))
    new = np.flatnonzero(np.diff(at, prepend=-1))
    return at[new], hashes[new]


def packed(at, hashes):
    out = np.empty(len(at), np.dtype([("hash", ">u4"), ("step", ">u2")]))
    out["hash"], out["step"] = hashes, np.diff(at, prepend=0)
    return base64.b64encode(out.tobytes()).decode()


def unpacked(fingerprint: str):
    out = np.frombuffer(base64.b64decode(fingerprint), np.dtype([("hash", ">u4"), ("step", ">u2")]))
    return np.cumsum(out["step"].astype(np.int64)), out["hash"].astype(np.uint32)


def likeness(one, other):
    one, other = set(one.tolist()), set(other.tolist())
    return len(one & other) / len(one | other) if one or other else 1.0


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
RANGE_ROWS, MOST_RANGES = 1_000, 20_000


def _row(doc_id, text, chosen, following, next_chosen):
    edited = edited_text(text, following)
    changed = winnow(edited) if edited != text else chosen
    return (doc_id, len(text), sha256(edited.encode()).hexdigest(), packed(*chosen), packed(*changed),
            likeness(chosen[1], changed[1]), likeness(chosen[1], next_chosen[1]))


class _Out:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, fields):
        self.fields, self.rows, self.held = fields, [], 0

    def add(self, row):
        self.rows.append(row)
        self.held += sum(len(x) for x in row if isinstance(x, str))
        return self.held > BLOCK_BYTES * 4

    def batch(self):
        columns = list(zip(*self.rows)) or [()] * len(self.fields)
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, self.fields)], [n for n, _ in self.fields])


def _pairs(batches):
    """Rows sorted by range, then in order: each but a guest with the text that follows it in its range."""
    out, before, same = _Out(FIELDS), None, None
    for batch in batches:
        for place, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("place", "guest", "doc_id", "text"))):
            if before is not None and before[0] != place:
                before = None
            if before is None and guest:
                continue
            chosen = before[3] if before is not None and before[2] == text else winnow(text)
            if before is not None:
                # copies one behind the other have one result
                if same is None or same[0] != before[2] or same[1] != text:
                    same = before[2], text, _row(*before[1:3], before[3], text, chosen)
                if out.add((before[1], *same[2][1:])):
                    yield out.batch()
            before = None if guest else (place, doc_id, text, chosen)
    yield out.batch()


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Every row with the fingerprint of its text."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {name}")

    def run(batches):
        for batch in batches:
            found = [packed(*winnow(t or "")) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def _ranged(docs: DataFrame) -> DataFrame:
    """``place, guest, doc_id, text``: each row in its range, and as a guest the row that follows the range."""
    rows, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    ranges = min(MOST_RANGES, rows // RANGE_ROWS + 1)
    nulls = min(MOST_RANGES, (rows - known) // RANGE_ROWS + 1)
    shares = [i / ranges for i in range(1, ranges)]
    bounds = np.array(docs.select("doc_id").approxQuantile("doc_id", shares, 0.2 / ranges) if shares else [])

    @F.pandas_udf("int")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        known = ids.fillna(0)
        last = np.searchsorted(bounds, known, "right")
        # an id that is several bounds has as many ranges, by hash; beyond 2**53 bounds are not exact
        parts = np.where(known.abs() < 1 << 53, np.maximum(last - np.searchsorted(bounds, known, "left"), 1), 1)
        # null ids lie below all others
        last, parts = np.where(ids.isna(), -1, last), np.where(ids.isna(), nulls, parts)
        part = np.floor((hashes / 2.0**64 + 0.5) * parts).astype(np.int64)
        return pd.Series(last - np.minimum(part, parts - 1))

    docs = docs.withColumns({"hash": F.xxhash64("text"), "length": F.length("text")})
    docs = docs.withColumn("place", place("doc_id", "hash"))
    # the first row of each range is a guest at the end of the range before; one row of numbers per range
    first = F.min(F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "hash", "length", "doc_id"))
    heads = docs.groupBy("place").agg(first.alias("h")).select("place", "h.doc_id", "h.hash", "h.length").collect()
    heads = sorted((tuple(r) for r in heads), key=lambda r: r[0])
    guests = [(place, *heads[i - 1][1:]) for i, (place, *_) in enumerate(heads)]  # of the lowest range, the highest
    guests = docs.sparkSession.createDataFrame(guests, "to int, head long, head_hash long, head_length int")
    guests = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash")) & (
        F.col("length") == F.col("head_length"))).groupBy("to", "doc_id").agg(F.first("text").alias("text"))
    guests = guests.select(F.col("to").alias("place"), F.lit(True).alias("guest"), "doc_id", "text")
    return docs.select("place", F.lit(False).alias("guest"), "doc_id", "text").unionAll(guests)


def against_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text are.

    The next document is the one with the next lower doc_id, after the last the first; rows of one
    doc_id follow each other by the hash of their text, null ids come last. Texts are shuffled
    once, by ranges of doc_id whose bounds are quantiles; an id, or null, with rows for several
    ranges is cut by the hash of the text. Each range gets a copy of the first row of
    the next. At most ``MOST_RANGES`` bounds and twice as many first rows' numbers pass the driver. Only
    rows equal in id and text always share a range; their text is fingerprinted once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.length("text")]
    return _ranged(docs).repartition("place").sortWithinPartitions("place", "guest", *order).mapInArrow(_pairs, SCHEMA)
