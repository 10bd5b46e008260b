"""Which windows of a fixed length occur more than once, given anchors chosen from their content.

The two substring operators share this second half. Each finds, by its own method, an anchor for
every window such that equal windows choose the same anchor. Consecutive windows of one text with
one anchor form a span: ``key`` names the anchor's content, ``span`` the whole span's, ``at`` is the
first window's start, ``n`` the number of windows and ``phase`` the anchor's place modulo ``GRID``.

* A key that occurs once has no repeated window.
* A span that occurs twice under its key: all its windows repeat.
* Spans that stand alone under a repeated key, and one speaker for each span that does not, are cut into blocks of ``GRID`` windows, on a grid that starts at the anchor, so equal
  windows fall into equal places of a block. A block's core is what all its windows share. The
  same cases hold for blocks, with the core as key and all of the block's units as span.
* The windows of the blocks that are left are compared by hash.

So copies cost one row per span, and single windows are compared only where a repeat begins or ends.
Counts are aggregated before they are shuffled and joins leave hot keys to Spark's skew splitting;
no key is ever gathered. The marks of a text are: a set, which copies with the same ``row`` share, so it
never exceeds the spans of one text. Texts are shuffled once to meet their spans; only texts with something
left to compare move again. ``row`` is a hash of id and text: repeated rows share it and have the
same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import U64, blocks, mix
from tidemark.llm.names import fresh
from tidemark.scratch import Scratch

SPAN = "key long, span long, row long, at long, n int, phase int"
LARGEST_SPAN = 1 << 12
GRID = 16


def prepared(docs: DataFrame, keep: list[str], key: str, text: str) -> tuple[DataFrame, list[str]]:
    """``row, text`` and the columns ``keep`` under names that clash with none of these; and those names."""
    inner = [f"keep_{i}" for i in range(len(keep))]
    kept = [docs[name].alias(new) for name, new in zip(keep, inner)]
    return docs.select(*kept, F.xxhash64(docs[key], docs[text]).alias("row"), docs[text].alias("text")), inner


def restored(found: DataFrame, keep: list[str], results: list[str]) -> DataFrame:
    """The columns ``keep`` under their own names, and the results; one whose name is taken gets an underscore."""
    return found.toDF(*keep, *fresh(results, keep))


def grouped(spans: DataFrame) -> DataFrame:
    """``key, n, low, high``: occurrences of each key, and its smallest and largest span."""
    return spans.groupBy("key").agg(F.count(F.lit(1)).alias("occurs"), F.min("span").alias("low"), F.max("span").alias("high"))


def marked(spans: DataFrame, keys: DataFrame, scratch: Scratch) -> DataFrame:
    """``row, marks``: the spans with a repeated key in each text, packed as ``at, n, phase, ask, same``.

    ``same``: the whole span stands elsewhere too. ``ask``: its parts must be compared, because it
    stands alone under its key, or because it is the one that speaks for its equals there.
    """
    keys = keys.filter("occurs > 1").select("key", (F.col("low") == F.col("high")).alias("alike"))
    found = scratch.keep(spans.join(keys, "key"), "found")
    place = F.struct("row", "at")
    kinds = found.filter("not alike").groupBy("key", "span").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("speaker"))
    kinds = scratch.keep(kinds, "kinds")
    # both sides and the result are stored, so that Spark may split a hot key's side of the join
    single = scratch.keep(kinds.filter("copies = 1").select("key").distinct(), "single")
    # without a single one under the key, all of its spans are decided
    kinds = scratch.keep(kinds.join(single.withColumn("open", F.lit(True)), "key", "left"), "open")
    mixed = found.filter("not alike").join(kinds, ["key", "span"]).select(
        "row", "at", "n", "phase", (F.coalesce("open", F.lit(False)) & (F.col("speaker") == place)).alias("ask"), (F.col("copies") > 1).alias("same"))
    alike = found.filter("alike").select("row", "at", "n", "phase", F.lit(False), F.lit(True))
    mark = (F.col("at") * LARGEST_SPAN + F.col("n")) * GRID + F.col("phase")
    mark = mark * 4 + F.col("ask").cast("long") * 2 + F.col("same").cast("long")
    return mixed.unionAll(alike).select("row", mark.alias("mark")).groupBy("row").agg(F.collect_set("mark").alias("marks"))


def unpack(marks):
    """Starts, window counts, phases and both flags of a text's marks, repeated ones once."""
    marks = np.unique(np.asarray(marks, np.int64))
    same, ask, marks = (marks & 1).astype(bool), (marks & 2).astype(bool), marks >> 2
    phase, marks = marks % GRID, marks // GRID
    return marks // LARGEST_SPAN, marks % LARGEST_SPAN, phase, ask, same


def covered(size: int, starts, lengths):
    """Which of ``size`` units lie in any of the stretches."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def within(starts, counts):
    """The integers of all stretches ``start .. start + count``."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Finder:
    """A text's units: their number, their rolling hashes, and the result of a mask.

    ``finish`` gives the values of the fields ``result`` from the text and which units go.
    """

    window: int
    count: Callable
    rolling: Callable
    finish: Callable
    result: list


def blocks_of(at, n, phase):
    """Starts of the blocks of spans; a start may lie before the text."""
    first = (at - phase) // GRID
    each = (at + n - 1 - phase) // GRID - first + 1
    return np.unique(within(first, each) * GRID + np.repeat(phase, each))


def block_hashes(rolling, starts, size, window, row):
    """Core and whole of each block. A block that a text's end cuts has a whole of its own."""
    cores = rolling.hashes(starts + GRID - 1, starts + window)
    inside = (starts >= 0) & (starts + GRID - 1 + window <= size)
    low, high = np.where(inside, starts, 0), np.where(inside, starts + GRID - 1 + window, 0)
    own = mix(mix(starts.astype(U64)) + U64(row % (1 << 64)))
    return cores, np.where(inside, rolling.hashes(low, high), own)


LISTS = ["sure_at", "sure_n", "probe_at", "probe_key", "probe_whole"]
KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


class _Step:
    """Rows that are finished and rows that stay open, as Arrow columns."""

    def __init__(self, finder, batch, keep):
        self.finder, self.batch, self.keep = finder, batch, keep
        self.done, self.open = [], {name: [] for name in ("open_text", *LISTS)}

    def close(self, text, gone):
        self.done.append(self.finder.finish(text, gone))
        for values in self.open.values():
            values.append(None)

    def leave(self, text, *lists):
        self.done.append((None,) * len(self.finder.result))
        for name, value in zip(self.open, (text, *lists)):
            self.open[name].append(value)

    def columns(self, with_open=True):
        columns = [self.batch.column(c) for c in (*self.keep, *(["row"] if with_open else []))]
        names = [*self.keep, *(["row"] if with_open else [])]
        for i, (name, kind) in enumerate(self.finder.result):
            columns.append(pa.array([d[i] for d in self.done], KINDS[kind]))
            names.append(name)
        if with_open:
            for name, values in self.open.items():
                columns.append(pa.array(values, pa.string() if name == "open_text" else pa.list_(pa.int64())))
                names.append(name)
        return pa.RecordBatch.from_arrays(columns, names)


def _array(scalar):
    return np.zeros(0, np.int64) if scalar.values is None else scalar.values.to_numpy()


def cut(docs: DataFrame, marks: DataFrame, finder: Finder, scratch: Scratch, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the finder's result for each row of ``docs`` (which has ``row, text``)."""
    window = finder.window
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    results = [f"{name} {kind}" for name, kind in finder.result]
    names = [name for name, _ in finder.result]
    open_schema = ", ".join([*plain, "row long", *results, "open_text string", *(f"{x} array<long>" for x in LISTS)])

    def spans_step(batches):
        """Decide texts by their spans; of the others, the blocks of undecided spans."""
        for batch in blocks(batches):
            step = _Step(finder, batch, keep)
            for row, text, marks in zip(*(batch.column(c) for c in ("row", "text", "marks"))):
                text, found = text.as_py() or "", _array(marks)
                if not len(found):
                    step.close(text, None)
                    continue
                at, n, phase, ask, same = unpack(found)
                if not ask.any():
                    step.close(text, covered(finder.count(text), at[same], n[same] + window - 1))
                    continue
                starts, size = blocks_of(at[ask], n[ask], phase[ask]), finder.count(text)
                cores, wholes = block_hashes(finder.rolling(text), starts, size, window, row.as_py())
                step.leave(text, at[same], n[same] + window - 1, starts, cores.view(np.int64), wholes.view(np.int64))
            yield step.columns()

    def blocks_step(batches):
        """Decide texts by their blocks; of the others, the windows of undecided blocks."""
        for batch in blocks(batches, "open_text"):
            step = _Step(finder, batch, keep)
            for text, at, n, marks in zip(*(batch.column(c) for c in ("open_text", "sure_at", "sure_n", "marks"))):
                text = text.as_py()
                size = finder.count(text)
                starts, _, _, ask, same = unpack(_array(marks))
                starts = starts - GRID
                low, high = np.maximum(starts[same], 0), np.minimum(starts[same] + GRID - 1 + window, size)
                at, n = np.concatenate([_array(at), low]), np.concatenate([_array(n), high - low])
                first = np.maximum(starts[ask], 0)
                left = np.unique(within(first, np.minimum(starts[ask] + GRID, size - window + 1) - first))
                if not len(left):
                    step.close(text, covered(size, at, n))
                    continue
                hashes = finder.rolling(text).hashes(left, left + window)
                step.leave(text, at, n, left, hashes.view(np.int64), np.zeros(0, np.int64))
            yield step.columns()

    def windows_step(batches):
        for batch in blocks(batches, "open_text"):
            step = _Step(finder, batch, keep)
            for text, at, n, hits in zip(*(batch.column(c) for c in ("open_text", "sure_at", "sure_n", "hits"))):
                text, hits = text.as_py(), _array(hits)
                at, n = np.concatenate([_array(at), hits]), np.concatenate([_array(n), np.full(len(hits), window)])
                step.close(text, covered(finder.count(text), at, n))
            yield step.columns(False)

    met = docs.select(*keep, "row", "text").join(marks, "row", "left")
    spanned = scratch.keep(met.mapInArrow(spans_step, open_schema), "spans")

    left = spanned.filter("open_text is not null")
    probes = left.select("row", F.explode(F.arrays_zip("probe_at", "probe_key", "probe_whole")).alias("p"))
    # a block may start before its text; marks hold no negative numbers
    probes = probes.select("row", (F.col("p.probe_at") + GRID).alias("at"), F.lit(1).alias("n"), F.lit(0).alias("phase"),
                           F.col("p.probe_key").alias("key"), F.col("p.probe_whole").alias("span"))
    again = left.select(*keep, "row", "open_text", "sure_at", "sure_n").join(marked(probes, grouped(probes), scratch), "row", "left")
    blocked = scratch.keep(again.mapInArrow(blocks_step, open_schema), "blocks")

    left = blocked.filter("open_text is not null")
    probes = left.select("row", F.explode(F.arrays_zip("probe_at", "probe_key")).alias("p")).select(
        "row", F.col("p.probe_at").alias("at"), F.col("p.probe_key").alias("hash"))
    repeated = probes.groupBy("hash").agg(F.count(F.lit(1)).alias("occurs")).filter("occurs > 1").select("hash")
    hits = probes.join(repeated, "hash").groupBy("row").agg(F.collect_set("at").alias("hits"))
    last = left.select(*keep, "row", "open_text", "sure_at", "sure_n").join(hits, "row", "left")
    last = last.mapInArrow(windows_step, ", ".join([*plain, *results]))
    for step in (spanned, blocked):
        last = last.unionAll(step.filter("open_text is null").select(*keep, *names))
    return last
