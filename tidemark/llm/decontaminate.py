"""Benchmark decontamination with SimHash windows.

Words are lower-case runs between white space and ASCII punctuation, weights the counts of the
five-word shingles. Every window of a document that is as long as a benchmark item has a 64-bit
SimHash of its weighted shingles. Items are found through a multi-index: the fingerprint is cut
into one block more than the Hamming ``RADIUS``, and two fingerprints within the radius agree in
at least one block. Candidates are verified by the exact weighted Jaccard similarity of their shingles.

A window that reaches the similarity t has at least 2t / (1 + t) of the item's shingles, so
windows with fewer are passed over before any SimHash is made, and nothing is lost. A document
shorter than an item is one window. At the threshold 0.8 two fingerprints of many shingles differ in about ten
bits, with a deviation of three, and those of few shingles in up to twelve; the radius, wider for items of
fewer than ``FEW`` shingles, leaves out fewer than one in a million of either.

Items are a query set. They are read in blocks of at most ``ITEMS`` rows and ``ITEM_BYTES`` bytes,
chosen by hash; each block's index is sent to the tasks and every document passes it, without
any shuffle of documents. With several blocks the documents' finds are stored after each, so a worker
never holds more than one.

Defined results: items and documents that are null or without words match nothing. Repeated items
match each under its own id, repeated documents each on its own row. All columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.arrays import U64, Rolling, blocks
from tidemark.scratch import Scratch

SHINGLE = 5
SIMILARITY = 0.8
BITS, RADIUS = 64, 24
FEW, WIDE_RADIUS = 16, 32
ITEMS, ITEM_BYTES = 20_000, 16 << 20
FILTER_BITS = 22
WORD_BYTES = arrays.WORD_BYTES.copy()
WORD_BYTES[[c for c in range(33, 127) if not chr(c).isalnum()]] = False


class _Words(arrays.Words):
    inside = WORD_BYTES


def _words(column):
    return _Words(pc.utf8_lower(column))


def _simhash(hashes):
    """Fingerprint of a window's shingle hashes; a repeated shingle weighs as often as it stands there."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0]


def _counts(hashes):
    return np.unique(hashes, return_counts=True)


def _similarity(one, other):
    _, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(one[1][i], other[1][j]).sum())
    return common / (int(one[1].sum() + other[1].sum()) - common)


class MultiIndex:
    """Fingerprints by block value; ``within`` finds all that differ in at most ``radius`` bits."""

    def __init__(self, prints, radius=RADIUS):
        self.prints, self.radius = np.asarray(prints, U64), radius
        cuts = np.linspace(0, BITS, radius + 2).astype(int)
        self.blocks = [(U64(a), U64((1 << int(b - a)) - 1)) for a, b in zip(cuts[:-1], cuts[1:])]
        self.tables = []
        for shift, mask in self.blocks:
            table = {}
            for number, value in enumerate(((self.prints >> shift) & mask).tolist()):
                table.setdefault(value, []).append(number)
            self.tables.append({value: np.array(numbers) for value, numbers in table.items()})

    def within(self, fingerprint):
        seen = np.zeros(len(self.prints), bool)
        for (shift, mask), table in zip(self.blocks, self.tables):
            found = table.get(int((fingerprint >> shift) & mask))
            if found is not None:
                seen[found] = True
        numbers = np.flatnonzero(seen)
        return numbers[np.bitwise_count(self.prints[numbers] ^ fingerprint) <= self.radius]


class Items:
    """A block of benchmark items, ready to be sought in documents."""

    def __init__(self, ids, texts, threshold=SIMILARITY, size=SHINGLE):
        words = _words(pa.array(texts, pa.string()))
        rolling, counts = Rolling(words.codes), words.counts()
        self.size, self.threshold, self.ids, self.lengths, self.counted = size, threshold, [], [], []
        prints, hashes, owners = [], [], []
        for first, count, item in zip(words.firsts, counts, ids):
            if not count:
                continue
            gram = min(size, count)
            starts = np.arange(first, first + count - gram + 1)
            own = rolling.hashes(starts, starts + gram)
            owners.append(np.full(len(np.unique(own)), len(self.ids)))
            hashes.append(np.unique(own))
            self.ids.append(item)
            self.lengths.append(int(count))
            self.counted.append(_counts(own))
            prints.append(_simhash(own))
        self.shingles = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(self.shingles, kind="stable")
        self.shingles, self.owners = self.shingles[order], self.owners[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.shingles >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.grams = sorted({min(size, n) for n in self.lengths})
        self.by_length = {}
        for length in set(self.lengths):
            numbers = [i for i, n in enumerate(self.lengths) if n == length]
            few = length - min(size, length) + 1 < FEW
            self.by_length[length] = np.array(numbers), MultiIndex([prints[i] for i in numbers], WIDE_RADIUS if few else RADIUS)

    def hits(self, hashes):
        """(place, item) for each hash that is a shingle of an item, in order of place."""
        maybe = np.flatnonzero(self.filter[(hashes >> U64(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.shingles, hashes[maybe], "left")
        n = np.searchsorted(self.shingles, hashes[maybe], "right") - low
        return np.repeat(maybe, n), self.owners[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def windows(self, places, length, n_words):
        """Starts of the windows of ``length`` words that have enough shingles at ``places``."""
        gram = min(self.size, length)
        n = length - gram + 1  # shingles of the item
        if n_words <= length:
            have = max(n_words - gram + 1, 0)
            enough = len(places) >= self.threshold / (1 + self.threshold) * (n + have) - 1e-9
            return np.zeros(int(enough and n_words >= gram), np.int64)
        needed = int(np.ceil(2 * self.threshold / (1 + self.threshold) * n - 1e-9))
        if len(places) < needed:
            return np.zeros(0, np.int64)
        # a window that has enough of them has `needed` in a row of the sorted places
        last = places[needed - 1 :]
        near = last - places[: len(places) - needed + 1] < n
        low = np.maximum(last[near] - n + 1, 0)
        high = np.minimum(places[: len(places) - needed + 1][near], n_words - length)
        steps = np.maximum(high - low + 1, 0)
        ends = np.cumsum(steps)
        return np.unique(np.repeat(low - (ends - steps), steps) + np.arange(ends[-1] if len(ends) else 0))

    def found(self, codes, hits):
        """(item id, similarity, start) of the best window for each item in one document."""
        rolling, best = Rolling(codes), {}
        asked = set()
        for gram, (places, owners) in hits.items():
            for item in np.unique(owners):
                length = self.lengths[item]
                if min(self.size, length) != gram:
                    continue
                for start in self.windows(np.unique(places[owners == item]), length, len(codes)):
                    if (length, int(start)) not in asked:
                        asked.add((length, int(start)))
                        self._look(rolling, len(codes), gram, length, int(start), best)
        return [(self.ids[i], s, at) for i, (s, at) in sorted(best.items())]

    def _look(self, rolling, n_words, gram, length, start, best):
        end = min(start + length, n_words)
        starts = np.arange(start, end - gram + 1)
        hashes = rolling.hashes(starts, starts + gram)
        numbers, index = self.by_length[length]
        counted = None
        for number in numbers[index.within(_simhash(hashes))]:
            counted = _counts(hashes) if counted is None else counted
            alike = _similarity(counted, self.counted[number])
            if alike >= self.threshold - 1e-9 and alike > best.get(number, (0, 0))[0]:
                best[number] = alike, start


def leaks_in(column, items: Items):
    """For each text of an Arrow column, the items found in it."""
    words = _words(column)
    rolling, found = Rolling(words.codes), [[] for _ in range(len(column))]
    by_text = {}
    for gram in items.grams:
        starts = np.arange(max(0, len(words.codes) - gram + 1))
        places, owners = items.hits(rolling.hashes(starts, starts + gram))
        texts = np.searchsorted(words.firsts, places, "right") - 1
        inside = places + gram <= words.firsts[texts + 1]  # not across two texts
        places, owners, texts = places[inside], owners[inside], texts[inside]
        cuts = np.flatnonzero(np.diff(texts, prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(texts)]):
            text = int(texts[low])
            by_text.setdefault(text, {})[gram] = places[low:high] - words.firsts[text], owners[low:high]
    for text, hits in by_text.items():
        found[text] = items.found(words.codes[words.firsts[text] : words.firsts[text + 1]], hits)
    return found


LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("word", T.LongType())]))
ARROW_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word", pa.int64())]))


def _item_blocks(items: DataFrame, threshold: float):
    """The benchmark in blocks of bounded size, one at a time, each with whether it is the last."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    parts = max(1, -(-size.n // ITEMS), -(-size.b // ITEM_BYTES))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0))
        yield Items([r.item_id for r in rows], [r.text for r in rows], threshold), part == parts - 1


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "leaks", threshold: float = SIMILARITY) -> DataFrame:
    """Every document with the benchmark items found in it: item, best similarity, and the word where that window starts."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table already has a column {name}")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, LEAK)])
    spark, columns, scratch = docs.sparkSession, docs.columns, Scratch(docs.sparkSession)
    out = docs.withColumn(name, F.array().cast(LEAK))
    for items, last in _item_blocks(benchmark, threshold):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent):
            for block in blocks(batches, text):
                before = block.column(name).to_pylist()
                found = leaks_in(block.column(text).fill_null(""), sent.value)
                rows = [[*old, *({"item_id": i, "similarity": s, "word": w} for i, s, w in new)] for old, new in zip(before, found)]
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in columns), pa.array(rows, ARROW_LEAK)], [*columns, name])

        out = out.mapInArrow(run, schema)
        if not last:
            out = scratch.keep(out, "leaks")
            sent.unpersist()
    return out
