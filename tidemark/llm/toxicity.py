"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, a document the mean of its words, and a
two-class softmax reads the document. Vectors, which start as small random ones, and softmax are trained together on a
bounded sample of labelled rows (``SAMPLE`` per class, at most ``SAMPLE_BYTES`` of text of each), chosen by a hash
of the id, whatever their length. A misspelt word shares most n-grams with the word it was, and so its vector.

For two classes only the difference of the softmax rows matters, so a trained model is one number
per n-gram bucket: the score of a document is the logistic of the mean over its words of the mean
over their n-grams, plus a bias. That table is bounded by ``BUCKETS`` and sent with the function.

Defined results: null, empty and wordless texts get the bias alone. Without rows of both classes
every score is the smoothed share of label 1. All rows and columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.arrays import U64, Rolling, blocks, mix
from tidemark.llm.repeats import within
from tidemark.scratch import Scratch

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
WIDTH = 8
SIZES = (3, 4, 5, 6)
SAMPLE = 2_000
SAMPLE_BYTES = 32 << 20
START = 0.05  # deviation of a vector's entries at the start
ROUNDS, RATE = 60, 0.1
SCREEN, DAMP = 4.0, 300.0
TEXTS_AT_ONCE = 200
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"


@lru_cache(1)
def _tables():
    """For every code point: its hash, whether it parts words, and whether it is cut off at a word's ends."""
    points = [chr(c) for c in range(0x110000)]
    spaces = np.fromiter(map(str.isspace, points), bool, len(points))
    ends = spaces.copy()
    ends[[ord(c) for c in EDGES]] = True
    return mix(np.arange(1, 0x110001, dtype=U64)), spaces, ends


class Bag:
    """The words of some texts, lower-case and without punctuation around them, and their subwords.

    ``owner`` and ``name`` have the text and the hash of each word. A word's subwords are the whole word
    and its character n-grams, ends marked, as buckets of a hash; ``sizes`` is their number per word
    and ``buckets`` all of them in the order of ``chosen``, words of which subwords are wanted.
    """

    def __init__(self, texts):
        codes, spaces, ends = _tables()
        lowered = [(text or "").lower() for text in texts]
        points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = ~spaces[points]
        starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        core, place = ~ends[points], np.arange(len(points))
        if len(starts):
            first = np.minimum.reduceat(np.where(core, place, len(points)), starts)
            last = np.maximum.reduceat(np.where(core, place, -1), starts)
        else:
            first = last = starts
        real = last >= first
        first, last = first[real], last[real]
        behind = np.cumsum([len(t) + 1 for t in lowered])
        self.owner = np.searchsorted(behind, first, "right")
        self.length = last - first + 3
        self.at = np.cumsum(self.length) - self.length
        marked = points[np.minimum(within(first - 1, self.length), len(points) - 1)]
        marked[self.at], marked[self.at + self.length - 1] = ord("<"), ord(">")
        self.rolling = Rolling(codes[marked])
        self.name = self.rolling.hashes(self.at, self.at + self.length)

    def subwords(self, chosen=slice(None)):
        """``(sizes, words, buckets)``: how many subwords each word has, and each subword's word and bucket."""
        at, length, name = self.at[chosen], self.length[chosen], self.name[chosen]
        words, buckets = [np.arange(len(at))], [name]
        for n in SIZES:
            counts = np.maximum(length - n + 1, 0)
            grams = within(at, counts)
            words.append(np.repeat(np.arange(len(at)), counts))
            buckets.append(self.rolling.hashes(grams, grams + n))
        words, buckets = np.concatenate(words), np.concatenate(buckets)
        return np.bincount(words, minlength=len(at)), words, (buckets >> U64(64 - BUCKET_BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts):
        bag = Bag(texts)
        sizes, words, buckets = bag.subwords()
        means = np.bincount(words, self.weights[buckets], len(sizes)) / sizes
        counts = np.bincount(bag.owner, minlength=len(texts))
        logits = np.bincount(bag.owner, means, len(texts)) / np.maximum(counts, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


class _Sums:
    """A sparse table of weights by owner and index; sums of index values per owner, and the way back."""

    def __init__(self, owner, index, weight, n_owners, n_values):
        order = np.argsort(index, kind="stable")
        self.there = self._half(owner, index, weight, n_owners)
        self.back = self._half(index[order], owner[order], weight[order], n_values)

    @staticmethod
    def _half(owner, index, weight, size):
        ids, starts = np.unique(owner, return_index=True)
        return ids, starts, index, weight[:, None], size

    @staticmethod
    def _sum(half, values, power):
        ids, starts, index, weight, size = half
        out = np.zeros((size, values.shape[1]), np.float32)
        if len(ids):
            out[ids] = np.add.reduceat(values[index] * weight**power, starts)
        return out

    def forward(self, values):
        return self._sum(self.there, values, 1)

    def backward(self, values, power=1):
        return self._sum(self.back, values, power)


def _screened(in_words, in_texts, residual):
    """Buckets whose pull on the first residual stands out from the noise of single words, and the curvature of all."""
    pull = in_words.backward(in_texts.backward(residual))[:, 0]
    noise = in_words.backward(in_texts.backward(residual**2, 2), 2)[:, 0]
    curve = in_words.backward(in_texts.backward(np.abs(residual) / 2, 2), 2)[:, 0]
    return np.flatnonzero(np.abs(pull) > SCREEN * np.sqrt(noise) + 1e-20), curve


def _entries(texts):
    """(text, word, share of the text) and (word, bucket, share of the word), for words of at least two texts."""
    owners, names, known, grams = [], [], [], []
    for start in range(0, len(texts), TEXTS_AT_ONCE):
        bag = Bag(texts[start : start + TEXTS_AT_ONCE])
        owners.append(bag.owner + start)
        names.append(bag.name)
        distinct, first = np.unique(bag.name, return_index=True)
        sizes, _, buckets = _by_word(*bag.subwords(first))
        known.append((distinct, sizes))
        grams.append(buckets)
    owners, names = np.concatenate(owners), np.concatenate(names)
    pairs = np.unique(np.column_stack([names, owners.astype(U64)]), axis=0, return_counts=True) if len(names) else (np.zeros((0, 2), U64), np.zeros(0))
    words, texts_with = np.unique(pairs[0][:, 0], return_counts=True)
    words = words[texts_with > 1]
    index = np.searchsorted(words, pairs[0][:, 0])
    kept = index < len(words)
    kept[kept] = words[index[kept]] == pairs[0][kept, 0]
    totals = np.bincount(owners, minlength=len(texts))
    rows = pairs[0][kept, 1].astype(np.int32)
    order = np.argsort(rows, kind="stable")
    shares = (pairs[1][kept] / totals[rows]).astype(np.float32)
    in_texts = rows[order], index[kept][order].astype(np.int32), shares[order]

    # subwords of each kept word, from the first block that has it
    every, sizes = np.concatenate([d for d, _ in known]), np.concatenate([n for _, n in known])
    starts, grams = np.cumsum(sizes) - sizes, np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    first = order[np.searchsorted(every[order], words)] if len(words) else np.zeros(0, int)
    sizes = sizes[first]
    buckets = grams[within(starts[first], sizes)]
    in_words = np.repeat(np.arange(len(words), dtype=np.int32), sizes), buckets, np.repeat(1 / np.maximum(sizes, 1), sizes).astype(np.float32)
    return in_texts, in_words, len(words)


def _by_word(sizes, words, buckets):
    order = np.argsort(words, kind="stable")
    return sizes, words[order], buckets[order]


def train(texts, labels, rounds: int = ROUNDS, rate: float = RATE, seed: int = 7) -> Model:
    """The model that ``train_vectors`` finds, as one number per bucket."""
    y = np.asarray(labels, np.float32)
    prior = float((y.sum() + 1) / (len(y) + 2))
    found = train_vectors(texts, y, rounds, rate, seed)
    if found is None:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior))))
    active, vectors, softmax, bias = found
    weights = np.zeros(BUCKETS, np.float32)
    weights[active] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


def train_vectors(texts, y, rounds: int = ROUNDS, rate: float = RATE, seed: int = 7):
    """Trained buckets, their vectors, softmax and bias, together by damped diagonal Newton steps with momentum.
    None without rows of both classes or without a word of two texts.

    The softmax follows its own gradient, taken where the vectors stand. Only
    buckets whose pull exceeds ``SCREEN`` times its noise are trained; the others would only learn
    single texts by heart. Both classes weigh the same.
    """
    if not len(y) or y.min() == y.max():
        return None
    (rows, words, shares), (owners, buckets, parts), n_words = _entries(texts)
    if not n_words:
        return None
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    in_texts = _Sums(rows, words, shares, len(y), n_words)
    active, curve = _screened(_Sums(owners, buckets, parts, n_words, BUCKETS), in_texts, (0.5 - y[:, None]) * weight)
    # the rest of the work touches the chosen buckets only
    place = np.full(BUCKETS, -1, np.int32)
    place[active] = np.arange(len(active))
    chosen = place[buckets] >= 0
    in_words = _Sums(owners[chosen], place[buckets[chosen]], parts[chosen], n_words, len(active))
    used = np.zeros(n_words, bool)
    used[owners[chosen]] = True
    in_texts = _Sums(rows[used[words]], words[used[words]], shares[used[words]], len(y), n_words)
    scale = (curve[active] + DAMP * np.median(curve[curve > 0]))[:, None]

    rng = np.random.default_rng(seed)
    softmax = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    softmax /= np.linalg.norm(softmax[:, 1] - softmax[:, 0])
    vectors = rng.normal(0, START, (len(active), WIDTH)).astype(np.float32)
    speed, bias = 0, np.zeros(2, np.float32)
    wanted = np.column_stack([1 - y, y])
    for _ in range(rounds):
        at = in_texts.forward(in_words.forward(vectors))
        z = at @ softmax + bias
        z = np.exp(z - z.max(1, keepdims=True))
        error = (z / z.sum(1, keepdims=True) - wanted) * weight
        speed = 0.8 * speed - rate * in_words.backward(in_texts.backward(error @ softmax.T)) / scale
        vectors = vectors + speed
        softmax -= 0.1 * rate * (at.T @ error) / (0.25 * (weight * at**2).sum() + 1e-6)
        bias -= 2 * error.sum(0)
    return active, vectors, softmax, bias


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled rows of each class, chosen by a hash of their key.

    Only keys with a text are drawn, and one text stands for a key and label, that
    with the smallest hash, so no more than ``sample`` texts a class reach the driver; in the order in which they were drawn
    they are taken while they fit into ``SAMPLE_BYTES``. The chosen
    keys, a bounded list, are sent to the documents; texts are not shuffled but for one per key and task.
    """
    docs = docs.filter(docs[text].isNotNull())
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.select(F.col(key).alias("sampled"), F.col(label).cast("int").alias("label_of")).distinct()
    known = docs.select(docs[key]).join(known, docs[key] == F.col("sampled")).select("sampled", "label_of").distinct()
    known = Scratch(docs.sparkSession).keep(known, "known")
    draw = [F.xxhash64("sampled"), F.col("sampled")]
    chosen = [known.filter(F.col("label_of") == kind).orderBy(*draw).limit(sample) for kind in (0, 1)]
    chosen = chosen[0].unionAll(chosen[1])
    found = docs.join(F.broadcast(chosen), docs[key] == F.col("sampled"))
    first = F.min(F.struct(F.xxhash64(docs[text]).alias("hash"), docs[text].alias("body")))
    drawn = found.groupBy("label_of", "sampled").agg(first.alias("t")).select("label_of", "sampled", "t.body")
    # at most ``sample`` rows in each of the two groups
    so_far = F.sum(F.octet_length("body")).over(Window.partitionBy("label_of").orderBy(*draw))
    drawn = drawn.withColumn("so_far", so_far).filter(F.col("so_far") <= SAMPLE_BYTES).drop("so_far")
    rows = sorted(tuple(r) for r in drawn.collect())
    return train([t for *_, t in rows], [y for y, *_ in rows])


def with_scores(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    if score.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {score}")

    def run(batches):
        for block in blocks(batches, text):
            scores = model.scores(block.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores, pa.float64())], [*block.schema.names, score])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())]))
