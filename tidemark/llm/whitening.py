"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Vectors are put on a grid: an entry c becomes the integer floor(scale * c). The model is fitted to
each distinct grid vector once. Spark sums their entries exactly; tasks centre their rows and reduce them by QR,
block by block, to one triangle, and triangles are stacked and reduced again in rounds of
``FAN`` until one is left. Its singular values and directions come from ``bidiagonal``. Only that one
triangle, whose size is that of the dimension, reaches the driver. The covariance of the whitened
rows is then measured by a further pass over the distinct vectors.

Defined results: a row whose vector is null or holds a null, NaN or infinite entry is left out; other
rows are kept one for one, repeated ones too. Vectors shorter than the longest one end in zeros; an
empty vector is all zeros. Entries beyond a long's range count as its ends. A component without
variance (fewer distinct vectors than components, or a constant dimension) has a null ``whitened``; without any
variance ``explained`` and ``identity_error`` are null. A deviation beyond a long's range is null. An
empty table, or one of empty vectors, gives no rows. Where a kept column has a result's name, the result's gets an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bidiagonal import leading
from tidemark.llm.names import fresh
from tidemark.scratch import Scratch

SCALE = 256
COMPONENTS = 4
FAN = 16
ENTRIES = 1 << 20  # of a block that is centred at a time
LONG = np.iinfo(np.int64)


def grid(column, scale):
    """Grid vectors of an Arrow list column, packed as bytes that are equal when the vectors are, and their lengths.

    A row that is left out is None. A packed vector has the width of its integers in front and no zeros at its end.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    entries = column.flatten()
    values = entries.cast(pa.float64(), safe=False).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = usable & (bad[ends] == bad[ends - lengths])
    with np.errstate(all="ignore"):
        cells = np.floor(scale * np.where(np.isfinite(values), values, 0.0))
        whole = np.where(cells >= 2.0**63, LONG.max, np.maximum(cells, -(2.0**63)).astype(np.int64))
    packed = []
    for ok, end, length in zip(usable, ends, lengths):
        packed.append(_pack(whole[end - length : end]) if ok else None)
    return pa.array(packed, pa.binary()), pa.array(lengths, pa.int32())


def _pack(row):
    used = np.flatnonzero(row)
    row = row[: used[-1] + 1] if len(used) else row[:0]
    low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + row.astype(f"<i{width}").tobytes()


def unpack(column, size):
    """Packed vectors as rows of ``size`` integers."""
    rows = np.zeros((len(column), size), np.int64)
    for row, value in zip(rows, column.to_pylist()):
        found = np.frombuffer(value, f"<i{value[0]}", offset=1)
        row[: len(found)] = found
    return rows


@dataclass
class Fit:
    """Count and sums of the distinct vectors, and the directions."""

    n: int
    sums: list[int]
    directions: np.ndarray | None = None  # as columns
    values: np.ndarray | None = None  # eigenvalues, falling
    trace: float = 0.0

    def offsets(self, rows):
        """n * row - sums, exact: 64-bit integers where they suffice, else Python's."""
        sums = np.array(self.sums, object)
        most = max((abs(s) for s in self.sums), default=0)
        largest = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
        if self.n * largest + most < 1 << 62:
            return rows * self.n - sums.astype(np.int64)
        return rows.astype(object) * self.n - sums

    def centred(self, rows):
        return (self.offsets(rows) / self.n).astype(float)

    def deviations(self, rows):
        offsets = self.offsets(rows)
        largest = int(np.abs(offsets).max(initial=0))
        if largest * largest * max(1, rows.shape[1]) >= 1 << 63:
            offsets = offsets.astype(object)
        found = (offsets * offsets).sum(1)
        return pa.array([x if x <= LONG.max else None for x in found.tolist()], pa.int64())

    def project(self, rows):
        """Whitened coordinates; NaN along a direction without variance."""
        with np.errstate(all="ignore"):
            spread = np.where(self.values > 0, np.sqrt(self.values), np.nan)
        return self.centred(rows) @ self.directions / spread


def _blocks(batches, name, size):
    """Slices of Arrow batches of about ``ENTRIES`` entries, as packed columns."""
    rows = max(64, ENTRIES // max(1, size))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).column(name)


def _distinct(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            packed, lengths = grid(batch.column(vector), scale)
            yield pa.RecordBatch.from_arrays([packed, lengths], ["x", "size"]).filter(packed.is_valid())

    return vectors.select(vector).mapInArrow(run, "x binary, size int").groupBy("x").agg(F.max("size").alias("size"))


def _totals(fit: DataFrame) -> Fit:
    """Exact sums per dimension; each is sent in two halves, whose sums stay within a long."""

    def run(batches):
        high, low, n, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            size = max(size, int(pc.max(batch.column("size")).as_py() or 0))
            if size > len(high):
                high, low = (np.concatenate([x, np.zeros(size - len(x), np.int64)]) for x in (high, low))
            for column in _blocks([batch], "x", size):
                rows = unpack(column, size)
                n += len(rows)
                high += (rows >> 32).sum(0)
                low += (rows & 0xFFFFFFFF).sum(0)
        if n:
            place = np.arange(-1, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(np.concatenate([[0], high])), pa.array(np.concatenate([[n], low]))], ["place", "high", "low"])

    wide = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    found = fit.mapInArrow(run, "place long, high long, low long").groupBy("place").agg(wide("high"), wide("low")).collect()
    sums = {r.place: (int(r.high) << 32) + int(r.low) for r in found}
    n = sums.pop(-1, 0)
    return Fit(n, [sums[i] for i in range(len(sums))])


def _stack(triangle, rows):
    return np.linalg.qr(rows if triangle is None else np.vstack([triangle, rows]), mode="r")


def _triangle(fit: DataFrame, model: Fit, scratch: Scratch) -> np.ndarray:
    """R of the centred rows, from the triangles of tasks, ``FAN`` at a time."""
    size = len(model.sums)

    def rows_of(value):
        return np.frombuffer(value, float).reshape(-1, size)

    def reduce_task(batches):
        triangle = None
        for column in _blocks(batches, "x", size):
            triangle = _stack(triangle, model.centred(unpack(column, size)))
        if triangle is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([triangle.tobytes()], pa.binary())], ["part", "r"])

    def reduce_group(table):
        triangle = None
        for value in table.column("r"):
            triangle = _stack(triangle, rows_of(value.as_py()))
        return pa.table({"part": pa.array([table.column("part")[0].as_py() // FAN], pa.int64()), "r": pa.array([triangle.tobytes()], pa.binary())})

    schema = "part long, r binary"
    parts = scratch.keep(fit.mapInArrow(reduce_task, schema), "triangles")
    while parts.count() > 1:
        # numbered anew by order, so that every round is FAN times shorter
        parts = scratch.keep(parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(reduce_group, schema), "triangles")
    found = rows_of(parts.first().r)
    return np.vstack([found, np.zeros((size - len(found), size))])


def fit(distinct: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> Fit:
    model = _totals(distinct)
    if not model.sums:
        return model
    triangle = _triangle(distinct, model, scratch)
    singular, model.directions = leading(triangle, components)
    model.values = singular**2 / model.n
    model.trace = float((triangle**2).sum() / model.n)
    return model


def identity_error(distinct: DataFrame, model: Fit) -> float | None:
    """Largest absolute entry of the whitened distinct rows' covariance minus the identity."""
    size, usable = len(model.sums), np.flatnonzero(model.values > 0)
    if not len(usable):
        return None

    def run(batches):
        k, total = len(usable), 0
        sums, products = np.zeros(k), np.zeros((k, k))
        for column in _blocks(batches, "x", size):
            rows = model.project(unpack(column, size))[:, usable]
            mean = rows.mean(0)
            total += len(rows)
            sums += rows.sum(0)
            products += (rows - mean).T @ (rows - mean) + len(rows) * np.outer(mean, mean)
        if total:
            values = np.concatenate([sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["place", "value"])

    found = {r.place: r.value for r in distinct.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()}
    k = len(usable)
    flat = np.array([found[i] for i in range(k + k * k)]) / model.n
    covariance = flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, keep: list[str], vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """The columns ``keep`` with ``component, n, deviation, whitened, explained, identity_error`` for each row and component."""
    scratch = Scratch(vectors.sparkSession)
    distinct = scratch.keep(_distinct(vectors, vector, scale), "distinct")
    model = fit(distinct, scratch, components)
    names = fresh(["component", "n", "deviation", "whitened", "explained", "identity_error"], keep)
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([*vectors.select(*keep).schema.fields, *(T.StructField(*x) for x in zip(names, kinds))])
    if not model.sums:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, model)
    size, k = len(model.sums), len(model.values)
    shares = [float(v / model.trace) if model.trace else None for v in model.values]

    def run(batches):
        rows_each = max(64, ENTRIES // size)
        for batch in batches:
            for start in range(0, batch.num_rows, rows_each):
                block = batch.slice(start, rows_each)
                packed, _ = grid(block.column(vector), scale)
                block, packed = block.filter(packed.is_valid()), packed.filter(packed.is_valid())
                rows = unpack(packed, size)
                m = len(rows)
                each = pa.array(np.repeat(np.arange(m), k))
                whitened = model.project(rows).ravel()
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c).take(each) for c in keep), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.n)), model.deviations(rows).take(each), pa.array(whitened, mask=np.isnan(whitened)),
                     pa.array(shares * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                    [*keep, *names])

    return vectors.select(*dict.fromkeys([*keep, vector])).mapInArrow(run, schema)
