"""Exact byte substring dedup on a logarithmic family of levels that stand in for suffix arrays.

Texts arrive in batches. Of every window of ``window`` bytes the position with the smallest rolling
hash of ``GRAM`` bytes (rightmost on a tie) is sampled, so equal windows sample the same place and
only about two of ``window`` suffixes are looked at. A level is a table with one entry per hash of the
``GRAM`` bytes at sampled places: how many there are and the smallest and largest hash of the stretch
around them that their windows cover. Suffixes are not sorted by their text; whether a window stands
elsewhere does not need their order. Levels are stored bucketed and sorted by hash, so a scan of two
side by side needs no shuffle: it sums their counts and writes the level of twice the size, and
reports no match by itself. Two levels of equal size always merge, so each entry is rewritten
as often as the number of batches has binary digits, and a new batch never touches more than the
levels it merges with. After the last batch, the spans of all texts are made again and meet the levels.

``repeats`` turns repeated entries into exact results: an entry with one stretch is decided by it, the
windows of the others are compared one by one.

Defined results: null and empty texts have no bytes; matches never cross texts; every row is kept.
The rest of a text may end inside a character, so it is binary.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.arrays import BYTE_CODES, U64, Rolling, blocks, flat, signed
from tidemark.scratch import Scratch

WINDOW = 200
GRAM = 24
BATCHES = 4
PIECE = 1 << 20


def byte_spans(batches, window, gram=GRAM):
    """The spans of each text of Arrow batches with ``row`` and ``text``, anchored at sampled suffixes."""
    gram = min(gram, window)
    for block in blocks(batches):
        data, offsets = flat(block.column("text"))
        rows = block.column("row").to_numpy()
        for begin in range(0, max(0, len(data) - window + 1), PIECE):
            piece = data[begin : begin + PIECE + window - 1]
            places = np.arange(len(piece) - gram + 1)
            rolling = Rolling(BYTE_CODES[piece])
            hashes = rolling.hashes(places, places + gram)
            values = (hashes & ~U64(0xFFFFFF)) | (U64(0xFFFFFF) - places.astype(U64))
            reach, wanted = 1, window - gram + 1
            while reach < wanted:
                step = min(reach, wanted - reach)
                values = np.minimum(values[: len(values) - step], values[step:])
                reach += step
            index = (U64(0xFFFFFF) - (values & U64(0xFFFFFF))).astype(np.int64)
            # one span per run of windows with one anchor; none may cross texts
            new = np.ones(len(index), bool)
            new[1:] = index[1:] != index[:-1]
            inner = offsets[(offsets > begin) & (offsets < begin + len(index))] - begin
            new[inner] = True
            heads = np.flatnonzero(new)
            owner = np.searchsorted(offsets, heads + begin, "right") - 1
            last = offsets[owner + 1] - begin - window  # last start of a window in that text
            n = np.minimum(np.append(heads[1:], len(index)), last + 1) - heads
            real = n > 0
            heads, owner, n = heads[real], owner[real], n[real]
            yield pa.RecordBatch.from_arrays(
                [signed(hashes[index[heads]]), signed(rolling.hashes(heads, heads + n + window - 1)), pa.array(rows[owner]),
                 pa.array(heads + begin - offsets[owner]), pa.array(n.astype(np.int32)),
                 pa.array(((index[heads] + begin - offsets[owner]) % repeats.GRID).astype(np.int32))],
                ["key", "span", "row", "at", "n", "phase"])


@dataclass
class Level:
    """A stored table of entries: its name and how many batches it holds."""

    table: str
    batches: int


class SuffixIndex:
    """Levels of entries; at most one of each size after an insertion."""

    def __init__(self, spark: SparkSession, scratch: Scratch):
        self.spark, self.scratch, self.levels = spark, scratch, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _store(self, array: DataFrame, batches: int) -> Level:
        name = f"suffixes_{uuid.uuid4().hex}"
        # equal stretches are stored once
        array = array.select("key", "occurs", "low", F.when(F.col("high") != F.col("low"), F.col("high")).alias("high"))
        writer = array.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("compression", "zstd")
        writer.option("path", f"{self.scratch.root}/{name}").saveAsTable(name)
        return Level(name, batches)

    def _read(self, level: Level) -> DataFrame:
        return self.spark.table(level.table).withColumn("high", F.coalesce("high", "low"))

    def _merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        """Both levels scanned side by side, counts summed."""
        a, b = one.alias("a"), other.alias("b")
        return a.join(b.hint("merge"), F.col("a.key") == F.col("b.key"), "full").select(
            F.coalesce("a.key", "b.key").alias("key"),
            (F.coalesce("a.occurs", F.lit(0)) + F.coalesce("b.occurs", F.lit(0))).alias("occurs"),
            F.least("a.low", "b.low").alias("low"), F.greatest("a.high", "b.high").alias("high"))

    def add(self, spans: DataFrame) -> None:
        """A new batch: its level, merged with the levels of equal size."""
        fresh = self._store(repeats.grouped(spans), 1)
        while self.levels and self.levels[-1].batches == fresh.batches:
            older = self.levels.pop()
            merged = self._store(self._merged(self._read(older), self._read(fresh)), 2 * fresh.batches)
            for level in (older, fresh):
                self._drop(level)
            fresh = merged
        self.levels.append(fresh)

    def _drop(self, level: Level) -> None:
        self.spark.sql(f"DROP TABLE {level.table}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.scratch.root}/{level.table}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Forget the levels' names in the catalog; their files go with the scratch folder."""
        for level in self.levels:
            self.spark.sql(f"DROP TABLE {level.table}")
        self.levels = []

    def entries(self) -> DataFrame:
        """All levels, scanned side by side."""
        found = self._read(self.levels[0])
        for level in self.levels[1:]:
            found = self._merged(found, self._read(level))
        return found


def kept_bytes(n_bytes, removed, n_spans, kept):
    """The default result: sizes, the number of maximal removed runs, and the remaining bytes."""
    return n_bytes, removed, n_spans, kept


KEPT_BYTES = ([("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary")], kept_bytes)


def deduplicate(docs: DataFrame, keep: list[str], result=KEPT_BYTES, key: str = "doc_id", text: str = "text", window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """Drop every byte in a string of ``window`` bytes that also starts anywhere else.

    ``result`` is a pair of named fields and a function of the number of bytes, of removed bytes, of
    maximal removed runs, and the remaining bytes. A result whose name is among ``keep`` gets an underscore.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    made = result[1]
    docs, inner = repeats.prepared(docs, keep, key, text)
    texts = docs.select("row", "text")
    index = SuffixIndex(spark, scratch)
    for batch in range(batches):
        arrived = texts.filter(F.pmod(F.hash("row"), F.lit(batches)) == batch)
        index.add(arrived.mapInArrow(lambda b: byte_spans(b, window), repeats.SPAN))
    spans = texts.mapInArrow(lambda b: byte_spans(b, window), repeats.SPAN)
    marks = repeats.marked(spans, index.entries(), scratch)
    index.close()

    def finish(value, gone):
        data = value.encode()
        if gone is None:
            return made(len(data), 0, 0, data)
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
        return made(len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes())

    rolling = lambda value: Rolling(BYTE_CODES[np.frombuffer(value.encode(), np.uint8)])
    fields = [(f"result_{i}", kind) for i, (_, kind) in enumerate(result[0])]
    finder = repeats.Finder(window, lambda value: len(value.encode()), rolling, finish, fields)
    return repeats.restored(repeats.cut(docs, marks, finder, scratch, inner), keep, [name for name, _ in result[0]])
