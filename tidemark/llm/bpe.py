"""Byte-level BPE: overlapping chunks, stitched where their pre-tokens meet again.

A pre-token match looks forward only, so two passes over one text that ever break at the same
place agree from there on. A text is therefore cut into overlapping chunks of ``CHUNK`` code points that are
pre-tokenised each for itself; between neighbours the first break that both trust is the seam. The
pre-tokens between two seams are a piece that can be encoded alone. Where a pre-token is longer than an
overlap there is no seam, and the chunks around it form one piece. Chunks of a text of at most ``SPREAD`` code points stay
in its task; those of a longer one are dealt to many tasks. A text no longer than a chunk is one chunk.

Results: ids are those of the tiktoken library for each match of the pattern, without special
tokens. Null and empty texts have no ids and decode to no bytes. Rows are kept one for one,
repeated rows and null keys included; other columns are untouched, whatever their names.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.arrays import BLOCK_BYTES, blocks, lists

CHUNK, OVERLAP = 1 << 11, 1 << 8  # code points between the starts of two chunks, and how far one reaches into the next
SPREAD, WIDE = 1 << 16, 1 << 12  # the same where chunks move between tasks; longer, as each is a row
LOOKAHEAD = 4  # a match is known once this many further characters are
CACHED_PIECES, CACHED_LENGTH = 200_000, 40


@lru_cache(2)
def _ranks(path):
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(2)
def _odd_characters(path):
    """Characters that the two regex engines class differently, with a stand-in of one mind.

    They know different Unicode versions: a letter to one is unassigned to the other.
    """
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    found = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        other = tiktoken.Encoding(f"class {kind}", pat_str=kind, mergeable_ranks=single, special_tokens={})
        ours, theirs = set(regex.findall(kind, every)), set(other.decode(other.encode_ordinary(every)))
        for c in ours ^ theirs:
            kinds = found.setdefault(c, set())
            if c in theirs:
                kinds.add(kind)
    stand_in = {r"\p{L}": "é", r"\p{N}": "²", r"\s": "　"}
    table = {ord(c): stand_in[min(kinds)] if kinds else "" for c, kinds in found.items()}
    return table, (regex.compile(f"[{chr(min(table))}-\U0010ffff]") if table else None)


class Encoder(dict):
    """Ids of pre-tokens as little-endian 32-bit bytes; holds a bounded number of them."""

    def __init__(self, path, pattern):
        import regex
        import tiktoken

        self.tiktoken = tiktoken.Encoding("byte bpe", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
        self.pattern = regex.compile(pattern)
        self.odd, self.maybe_odd = _odd_characters(path)

    def __missing__(self, piece):
        ids = np.array(self.tiktoken.encode_ordinary(piece), "<i4").tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def pieces(self, text):
        if self.maybe_odd is None or not self.maybe_odd.search(text):
            return self.pattern.findall(text)
        out, start = [], 0
        for piece in self.pattern.findall(text.translate(self.odd)):
            out.append(text[start : start + len(piece)])
            start += len(piece)
        return out

    def ids(self, text):
        return b"".join(map(self.__getitem__, self.pieces(text)))

    def stitched(self, text, chunk=CHUNK, overlap=OVERLAP):
        """The pre-tokens of a text from those of its overlapping chunks."""
        if len(text) <= chunk + overlap:
            return self.pieces(text)
        starts = range(0, len(text) - overlap, chunk)
        found = [self.pieces(text[at : at + chunk + overlap]) for at in starts]
        ends = [np.cumsum(np.fromiter(map(len, pieces), np.int64)) + at for at, pieces in zip(starts, found)]
        out, began, opened = [], 0, 0  # where the open piece begins, and its first chunk
        for k, at in enumerate(starts):
            if k + 1 < len(found):
                tail = ends[k][(ends[k] > at + chunk) & (ends[k] <= at + chunk + overlap - LOOKAHEAD)]
                common = np.intersect1d(tail, ends[k + 1][ends[k + 1] < at + chunk + overlap], assume_unique=True)
                if not len(common):
                    continue
                cut = int(common[0])
            else:
                cut = len(text)
            if opened == k:
                low, high = np.searchsorted(ends[k], (began, cut), "right")
                out += found[k][low:high]
            else:
                out += self.pieces(text[began:cut])
            began, opened = cut, k + 1
        return out

    def breaks(self, text):
        """Code point positions at which a pre-token ends, those near the end left out."""
        ends = np.cumsum(np.fromiter(map(len, self.pieces(text)), np.int64))
        return ends[ends <= len(text) - LOOKAHEAD]


@lru_cache(2)
def encoder(path, pattern):
    return Encoder(path, pattern)


@lru_cache(2)
def _token_bytes(path):
    ranks = sorted(_ranks(path).items(), key=lambda x: x[1])
    sizes = np.zeros(ranks[-1][1] + 1, np.int64)
    sizes[[rank for _, rank in ranks]] = [len(token) for token, _ in ranks]
    return np.frombuffer(b"".join(token for token, _ in ranks), np.uint8), sizes, np.cumsum(sizes) - sizes


def _with(batch, name, column):
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def _fresh(df, *wanted):
    """Column names that the table does not have yet, case ignored."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def _encode_whole(df, text, ids, path, pattern):
    def run(batches):
        code = encoder(path, pattern)
        for block in blocks(batches, text):
            found = [b"".join(map(code.__getitem__, code.stitched(t))) if t else b"" for t in block.column(text).to_pylist()]
            counts = [len(x) // 4 for x in found]
            yield _with(block, ids, lists(np.frombuffer(b"".join(found), "<i4"), counts))

    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])
    return df.mapInArrow(run, schema)


def chunked(df: DataFrame, text: str, key: str, chunk: int = SPREAD, overlap: int = WIDE) -> DataFrame:
    """Overlapping chunks of each text: ``key, k, at`` (code points before it) and ``chunk``."""

    def run(batches):
        for block in blocks(batches, text):
            for row, value in zip(block.column(key).to_pylist(), block.column(text).to_pylist()):
                rows, held = [], 0
                for k, at in enumerate(range(0, len(value), chunk)):
                    rows.append((row, k, at, value[at : at + chunk + overlap]))
                    held += len(rows[-1][3])
                    if held >= BLOCK_BYTES or at + chunk >= len(value):
                        columns = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                             pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                            ["key", "k", "at", "chunk"])
                        rows, held = [], 0

    return df.select(key, text).mapInArrow(run, "key string, k int, at long, chunk string")


def _seams(pieces, path, pattern, overlap, chunk):
    """Trusted breaks in the first and the last ``overlap`` characters of each chunk, from the text's start."""

    def run(batches):
        code = encoder(path, pattern)
        for block in blocks(batches, "chunk"):
            heads, tails = [], []
            for at, value in zip(block.column("at").to_pylist(), block.column("chunk").to_pylist()):
                ends = code.breaks(value)
                heads.append(ends[ends < overlap] + at)
                tails.append(ends[ends > chunk] + at)
            for name, found in (("heads", heads), ("tails", tails)):
                values = np.concatenate(found) if found else np.zeros(0, np.int64)
                block = _with(block, name, lists(values.astype(np.int64), [len(x) for x in found]))
            yield block

    return pieces.mapInArrow(run, "key string, k int, at long, chunk string, heads array<long>, tails array<long>")


def _encode_long(df, text, ids, path, pattern, chunk, overlap):
    """Texts of more than a chunk. Work moves by chunk, so one huge text keeps many tasks busy."""
    key, joined = _fresh(df, "text_key", "piece_key")
    # equal texts have equal ids, so the text itself names its chunks
    named = df.withColumn(key, F.sha2(F.col(text), 256))
    pieces = chunked(named.select(key, text).dropDuplicates([key]), text, key, chunk, overlap)
    pieces = pieces.repartition(F.col("key"), F.col("k"))
    order = Window.partitionBy("key").orderBy("k")
    known = _seams(pieces, path, pattern, overlap, chunk)
    known = known.withColumn("cut", F.array_min(F.array_intersect("tails", F.lead("heads").over(order))))
    known = known.withColumn("began", F.lag("cut").over(order)).withColumn("piece", F.count("cut").over(order) - F.when(F.col("cut").isNull(), 0).otherwise(1))
    known = known.withColumn("part", F.expr(
        f"substring(chunk, cast(coalesce(began, at) - at + 1 as int), cast(coalesce(cut, at + {chunk}) - coalesce(began, at) as int))"))
    whole = known.groupBy("key", "piece").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"])).alias("text"))
    coded = _encode_whole(whole, "text", "ids", path, pattern)
    coded = coded.groupBy(F.col("key").alias(joined)).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias(ids))
    return named.join(coded, F.col(key) == F.col(joined), "left").drop(key, joined)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           chunk: int = SPREAD, overlap: int = WIDE) -> DataFrame:
    """Every row of ``df`` with the token ids of its text in a new column ``ids``. ``chunk`` and ``overlap`` are those of
    texts whose chunks are dealt to many tasks."""
    if ids.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {ids}")
    long = F.length(text) > chunk
    short = _encode_whole(df.filter(F.coalesce(~long, F.lit(True))), text, ids, path, pattern)
    return short.unionByName(_encode_long(df.filter(long), text, ids, path, pattern, chunk, overlap))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Every row with the bytes that its ids stand for, concatenated; null ids give no bytes."""
    if decoded.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {decoded}")

    def run(batches):
        data, sizes, firsts = _token_bytes(path)
        for batch in batches:
            step = max(1, batch.num_rows * BLOCK_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                block = batch.slice(start, step)
                column = block.column(ids)
                values, counts = column.flatten().to_numpy(), column.value_lengths().fill_null(0).to_numpy()
                each = sizes[values]
                behind = np.cumsum(each)
                index = np.repeat(firsts[values] - (behind - each), each) + np.arange(behind[-1] if len(behind) else 0)
                ends = np.concatenate([[0], behind])[np.concatenate([[0], np.cumsum(counts)])]
                column = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[index])])
                yield _with(block, decoded, column.cast(pa.binary()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))
