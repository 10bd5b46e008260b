"""Quality classifier: regularised quadratic discriminant over document statistics.

A document becomes a dozen statistics of its bytes and words, transformed to be roughly normal.
Each class keeps its count, sum and sum of outer products, added up over tasks by Spark, so the fit
sees every labelled row and only a few hundred numbers reach the driver. Class covariances are
shrunk towards the pooled one and that towards a sphere; their Cholesky factors are inverted once
and sent with the scoring function. A score is the logistic of the difference of the two
Mahalanobis log-densities plus the log prior odds.

Defined results: null and empty texts have all counts zero and are scored like any other. With no
labelled rows the score is 0.5, with one usable class it is the smoothed share of label 1. Rows are
kept one for one with all their columns; a clash with the new column's name is refused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, Rolling, Words, blocks, flat, lists, mix

POOLED, SPHERE = 0.3, 0.02  # shares of the pooled covariance, and of the sphere in the result
CLASSES = {  # bytes that are counted
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256), "line": (10, 13),
    "space": (32, 9), "sentence": b".,;:?'\"", "mark": b"!", "symbol": b"#$%&*|@^~=+<>/\\_{}[]()`-",
}
KINDS = np.full(256, len(CLASSES), np.uint8)
for _number, _bytes in enumerate(CLASSES.values()):
    KINDS[list(_bytes)] = _number


def _distinct(codes, owner, count):
    """How many different codes each owner has."""
    _, first = np.unique(mix(codes + owner.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner[first], minlength=count)


def statistics(column):
    """One row of transformed statistics for each text of an Arrow column."""
    data, offsets = flat(column)
    n, sizes = len(column), np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * (len(CLASSES) + 1) + KINDS[data], minlength=n * (len(CLASSES) + 1)).reshape(n, -1)
    words = Words(column)
    counts = words.counts()
    word_owner = np.repeat(np.arange(n), counts)
    last = KINDS[data[words.ends - 1]]
    names = list(CLASSES)
    odd_ends = np.bincount(word_owner[(last == names.index("symbol")) | (last == names.index("mark"))], minlength=n)
    lengths = words.ends - words.starts
    squares = np.bincount(word_owner, lengths.astype(float) ** 2, minlength=n)
    runs = np.flatnonzero(word_owner[:-2] == word_owner[2:]) if len(word_owner) > 2 else np.zeros(0, np.int64)
    triples = Rolling(words.codes).hashes(runs, runs + 3)
    share = lambda part, whole: part / np.maximum(whole, 1)
    mean = share(np.bincount(word_owner, lengths, minlength=n), counts)
    parts = share(kinds[:, : len(CLASSES)], sizes[:, None])
    new_triples = share(_distinct(triples, word_owner[runs], n), np.bincount(word_owner[runs], minlength=n))
    return np.column_stack([
        np.log1p(counts), np.log1p(mean), np.log1p(np.sqrt(np.maximum(share(squares, counts) - mean**2, 0))),
        np.sqrt(parts), np.sqrt(share(odd_ends, counts)),
        np.log1p(_distinct(words.codes, word_owner, n)) - np.log1p(counts), np.sqrt(1 - new_triples) * (counts > 2),
    ])


WIDTH = len(CLASSES) + 6


def _appended(df, name, kind):
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def with_statistics(df: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    def run(batches):
        for block in blocks(batches, text):
            found = statistics(block.column(text))
            column = lists(found.ravel(), np.full(len(found), WIDTH))
            yield pa.RecordBatch.from_arrays([*block.columns, column], [*block.schema.names, name])

    return df.mapInArrow(run, _appended(df, name, T.ArrayType(T.DoubleType(), False)))


@dataclass
class Model:
    """Means, inverted Cholesky factors and log-determinants of both classes, and the prior odds."""

    share: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    logdets: np.ndarray | None = None
    odds: float = 0.0

    def scores(self, x):
        if self.means is None:
            return np.full(len(x), self.share)
        density = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets):
            z = (x - mean) @ factor.T
            density.append(-0.5 * (z**2).sum(1) - 0.5 * logdet)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.odds, -60, 60)))


def fit(labelled: DataFrame, label: str, name: str = "statistics", pooled: float = POOLED, sphere: float = SPHERE) -> Model:
    """A model of the labels 0 and 1; rows with other or no labels are left out."""
    size = 1 + WIDTH + WIDTH * WIDTH

    def run(batches):
        sums = np.zeros((2, size))
        for batch in batches:
            y = batch.column(label).to_numpy(zero_copy_only=False)
            x = batch.column(name).flatten().to_numpy().reshape(-1, WIDTH)
            for kind in (0, 1):
                part = x[y == kind]
                sums[kind] += np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), lists(sums.ravel(), [size, size])], ["kind", "sums"])

    wanted = labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias(label), name)
    parts = wanted.mapInArrow(run, "kind int, sums array<double>")
    total = parts.select("kind", F.posexplode("sums")).groupBy("kind", "pos").agg(F.sum("col").alias("value"))
    sums = np.zeros((2, size))
    for row in total.collect():
        sums[row.kind, row.pos] = row.value
    counts, share = sums[:, 0], float((sums[1, 0] + 1) / (sums[:, 0].sum() + 2))
    if counts.min() < 2:
        return Model(share)
    means = sums[:, 1 : 1 + WIDTH] / counts[:, None]
    scatter = sums[:, 1 + WIDTH :].reshape(2, WIDTH, WIDTH) - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    both = scatter.sum(0) / counts.sum()
    scale = np.sqrt(np.diag(both)) + 1e-3  # shrink in standard units
    factors, logdets = [], []
    for kind in (0, 1):
        own = (1 - pooled) * scatter[kind] / counts[kind] + pooled * both
        own = own / np.outer(scale, scale)
        own = (1 - sphere) * own + sphere * np.trace(own) / WIDTH * np.eye(WIDTH) + 1e-9 * np.eye(WIDTH)
        factor = np.linalg.cholesky(own)
        logdets.append(2 * np.log(np.diag(factor)).sum())
        factors.append(np.linalg.inv(factor) / scale)
    return Model(share, means, np.array(factors), np.array(logdets), float(np.log(counts[1] / counts[0])))


def with_scores(df: DataFrame, model: Model, name: str = "statistics", score: str = "score") -> DataFrame:
    """Every row with the model's score of its statistics."""

    def run(batches):
        for batch in batches:
            x = batch.column(name).flatten().to_numpy().reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(x))], [*batch.schema.names, score])

    return df.mapInArrow(run, _appended(df, score, T.DoubleType()))
