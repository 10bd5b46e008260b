"""Quality rules: how far a document's histograms diverge from those of its language.

A document gives two histograms: its characters by class, and its words by the common words of a language, all
others in one bin. A reference is the mean of both over all different texts of a language that pass the
base rules and are long enough; Spark adds them up as integers, so the sums do not depend on any order. A document
is compared with the references by Jensen-Shannon distance (base 2, 0 to 1) and measured by the nearest one, so a wrong
language among the known ones does no harm. A histogram of few characters or words strays from its source by chance; the
expected part of that, (bins - 1) / (8 n ln 2) of the squared distance, is taken off, and below a minimum length it
is not compared at all.

Base rules: fewer than 50 words, or more than half of the words in a window of three words that the text holds twice.

Defined results: null and empty texts have no words and fail the base rules. A document whose language
is null, has no list of common words or no reference is judged by the base rules alone, and so are
all in a corpus without references. Rows are kept one for one, repeated ones too; copies of a text count once
in a reference. Where a kept column has a result's name, the result's gets an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import blocks, lists
from tidemark.llm.names import fresh
from tidemark.llm.repeats import within
from tidemark.llm.tokens import ExactWords, renumber
from tidemark.scratch import Scratch

# Base rules and counted symbols.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"

# Function words that are common in each language.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "au", "ne", "il"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "su", "para", "es", "al", "lo"),
}
EDGES = ".,;:!?'\"()-"  # taken off both ends of a word before it is looked up

MIN_CHARS, MIN_WORDS = 200, 50  # of a histogram that is compared
MIN_TEXTS = 20  # of a reference
CLASS_DISTANCE, WORD_DISTANCE = 0.2, 0.24
UNIT = 1 << 20  # a document's share of a reference, in integers

CLASSES = {  # of characters, by byte; a character beyond ASCII counts by its first byte
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "high": range(192, 256), "space": (32, 9, 11, 12, 13),
    "line": (10,), "sentence": b".,;:!?'\"()-", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
}
OTHER, INNER = len(CLASSES), len(CLASSES) + 1
KINDS = np.full(256, OTHER, np.uint8)
KINDS[128:192] = INNER  # inside of a character
for _number, _bytes in enumerate(CLASSES.values()):
    KINDS[list(_bytes)] = _number
N_CLASSES = len(CLASSES) + 1
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _duplicate_lines(words: ExactWords):
    """How many lines with a word equal an earlier line of the same text."""
    data, offsets = words.data, words.offsets
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    owners = np.repeat(np.arange(n), np.bincount(np.searchsorted(offsets[1:], breaks, "right"), minlength=n) + 1)
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, owners = starts[filled], ends[filled], owners[filled]
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    body = np.ascontiguousarray(data[within(starts, ends - starts)])
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(body)])
    same = renumber(owners, lines.dictionary_encode().indices.to_numpy().astype(np.int64))
    _, first = np.unique(same, return_index=True)
    return np.bincount(owners, minlength=n) - np.bincount(owners[first], minlength=n)


def _repeated_words(words: ExactWords):
    """How many words lie in a window of three words that its text holds twice or more."""
    n = len(words.counts)
    numbers, owners = words.numbers, words.owners
    if len(numbers) < 3:
        return np.zeros(n, np.int64)
    starts = np.flatnonzero(owners[:-2] == owners[2:])
    keys = renumber(owners[starts], numbers[starts], numbers[starts + 1], numbers[starts + 2])
    often = starts[np.bincount(keys)[keys] > 1]
    hit = np.zeros(len(numbers), bool)
    for i in range(3):
        hit[often + i] = True
    return np.bincount(owners[hit], minlength=n)


class Lists:
    """The common words of all languages as one vocabulary, and each language's part of it."""

    def __init__(self, common):
        self.languages = list(common)
        self.words = sorted({w for words in common.values() for w in words})
        place = {w: i for i, w in enumerate(self.words)}
        self.parts = {name: np.array([place[w] for w in dict.fromkeys(words)], int) for name, words in common.items()}

    def counts(self, words: ExactWords):
        """How often each text has each word of the vocabulary, whatever its case and the marks around it."""
        n, size = len(words.counts), len(self.words)
        known = pc.utf8_trim(pc.utf8_lower(words.vocabulary.cast(pa.large_string())), EDGES)
        place = pc.index_in(known, pa.array(self.words, pa.large_string())).fill_null(-1).to_numpy().astype(np.int64)
        place = place[words.numbers] if len(words.numbers) else np.zeros(0, np.int64)
        found = place >= 0
        return np.bincount(words.owners[found] * size + place[found], minlength=n * size).reshape(n, size)


def measures(column, known: Lists):
    """The counts of each text, and its histograms: characters by class, then common words."""
    words = ExactWords(column)
    n = len(words.counts)
    owner = np.repeat(np.arange(n), np.diff(words.offsets))
    kinds = np.bincount(owner * (N_CLASSES + 1) + KINDS[words.data], minlength=n * (N_CLASSES + 1)).reshape(n, -1)[:, :N_CLASSES]
    begins = np.concatenate([[0], np.cumsum(KINDS[words.data] != INNER)])
    letters = np.bincount(words.owners, begins[words.ends] - begins[words.starts], minlength=n).astype(np.int64)
    symbols = np.bincount(owner[np.isin(words.data, np.frombuffer(SYMBOLS, np.uint8))], minlength=n)
    counts = np.column_stack([words.counts, letters, symbols, _duplicate_lines(words), _repeated_words(words)])
    return counts, np.column_stack([kinds, known.counts(words)])


def base_failed(counts):
    return (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > REPEAT_PERCENT * counts[:, 0])


def with_measures(docs: DataFrame, keep: list[str], text: str, names: list[str], known: Lists) -> DataFrame:
    """The columns ``keep`` with the counts, ``base_failed``, the histograms and a digest of the text, under ``names``."""
    kinds = [*[T.LongType()] * len(COUNTS), T.BooleanType(), T.ArrayType(T.LongType(), False)]
    digest = T.StructField(names[-1], T.BinaryType())
    schema = T.StructType([*docs.select(*keep).schema.fields, digest, *(T.StructField(*x) for x in zip(names, kinds))])
    asked = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))).alias("d"), F.col(f"`{text}`").alias("t"))

    def run(batches):
        for block in blocks(batches, "t"):
            counts, histograms = measures(block.column("t"), known)
            columns = [pa.array(c) for c in counts.T.astype(np.int64)]
            whole = lists(histograms.ravel(), np.full(len(histograms), histograms.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [*block.columns[: len(keep) + 1], *columns, pa.array(base_failed(counts)), whole], [*keep, names[-1], *names[:-1]])

    return asked.mapInArrow(run, schema)


@dataclass
class References:
    """By language: shares of character classes, and of its common words with the rest behind."""

    known: Lists
    classes: dict[str, np.ndarray]
    words: dict[str, np.ndarray]

    def excess(self, counts, histograms, class_distance=CLASS_DISTANCE, word_distance=WORD_DISTANCE):
        """Each document's larger distance to the nearest reference, as a multiple of what is allowed, and that language's place."""
        kinds, common = histograms[:, :N_CLASSES], histograms[:, N_CLASSES:]
        n_words = counts[:, 0]
        long_enough = kinds.sum(1) >= MIN_CHARS, n_words >= MIN_WORDS
        found = []
        for name in self.classes:
            mine = common[:, self.known.parts[name]]
            mine = np.column_stack([mine, n_words - mine.sum(1)])
            far = np.where(long_enough[0], distance(kinds, self.classes[name]) / class_distance, 0.0)
            found.append(np.maximum(far, np.where(long_enough[1], distance(mine, self.words[name]) / word_distance, 0.0)))
        table = np.array(found)
        return table.min(0), table.argmin(0)


def distance(counts, reference):
    """Jensen-Shannon distance, base 2, of each row of counts from a distribution, less what chance alone explains; 0 for a row
    without counts."""
    total = counts.sum(1)
    p = counts / np.maximum(total, 1)[:, None]
    middle = (p + reference) / 2
    with np.errstate(all="ignore"):
        parts = np.where(p > 0, p * np.log2(p / middle), 0.0) + np.where(reference > 0, reference * np.log2(reference / middle), 0.0)
    by_chance = (len(reference) - 1) / (8 * np.log(2) * np.maximum(total, 1))
    return np.where(total > 0, np.sqrt(np.maximum(parts.sum(1) / 2 - by_chance, 0)), 0.0)


def references(measured: DataFrame, lang: str, names: list[str], known: Lists, min_texts: int = MIN_TEXTS) -> References:
    """The mean histograms of each listed language over all its different texts that pass the base rules."""
    *count_names, failed, histogram, digest = names
    n_words = count_names[0]
    size = N_CLASSES + len(known.words)
    usable = measured.filter(~F.col(failed) & F.col(lang).isin(known.languages) & (F.col(n_words) >= MIN_WORDS)).select(
        F.col(lang).alias("lang"), F.col(digest).alias("digest"), F.col(n_words).alias("n_words"), F.col(histogram).alias("histogram"))
    once = usable.groupBy("lang", "digest").agg(F.first("n_words").alias("n_words"), F.first("histogram").alias("histogram"))

    def run(batches):
        for batch in batches:
            rows = batch.column("histogram").flatten().to_numpy().reshape(-1, size)
            kinds, common = rows[:, :N_CLASSES], rows[:, N_CLASSES:]
            shares = np.column_stack([
                np.ones(len(rows), np.int64), kinds * UNIT // np.maximum(kinds.sum(1, keepdims=True), 1),
                common * UNIT // np.maximum(batch.column("n_words").to_numpy(), 1)[:, None]])
            langs = batch.column("lang").dictionary_encode()
            sums = np.zeros((len(langs.dictionary), size + 1), np.int64)
            np.add.at(sums, langs.indices.to_numpy(), shares)
            yield pa.RecordBatch.from_arrays([langs.dictionary.cast(pa.string()), lists(sums.ravel(), np.full(len(sums), size + 1))], ["lang", "sums"])

    parts = once.mapInArrow(run, "lang string, sums array<long>").select("lang", F.posexplode("sums"))
    sums = {name: np.zeros(size + 1, np.int64) for name in known.languages}
    for row in parts.groupBy("lang", "pos").agg(F.sum("col").alias("value")).collect():
        sums[row.lang][row.pos] = row.value
    classes, words = {}, {}
    for name, total in sums.items():
        if total[0] < max(1, min_texts):
            continue
        shares = total[1:] / (total[0] * UNIT)
        classes[name] = shares[:N_CLASSES] / shares[:N_CLASSES].sum()
        mine = shares[N_CLASSES:][known.parts[name]]
        words[name] = np.append(mine, max(0.0, 1 - mine.sum()))
    return References(known, classes, words)


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", common: dict = COMMON, min_texts: int = MIN_TEXTS) -> DataFrame:
    """The columns ``keep`` of each row with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` and
    ``divergence``: the larger distance to the nearest reference as a multiple of what is allowed, null where nothing is compared."""
    scratch, known = Scratch(docs.sparkSession), Lists(common)
    names = fresh([*COUNTS, "base_failed", "kept", "divergence", "histogram", "digest"], {*keep, lang})
    results, inner = names[: len(COUNTS) + 3], [*names[: len(COUNTS) + 1], *names[-2:]]
    measured = scratch.keep(with_measures(docs, list(dict.fromkeys([*keep, lang])), text, inner, known), "measures")
    found = references(measured, lang, inner, known, min_texts)
    histogram, width = names[-2], N_CLASSES + len(known.words)
    kinds = [*[T.LongType()] * len(COUNTS), T.BooleanType(), T.BooleanType(), T.DoubleType()]
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(*x) for x in zip(results, kinds))])
    listed = pa.array(list(found.classes), pa.string())

    def run(batches):
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy() for c in results[: len(COUNTS)]])
            rows = batch.column(histogram).flatten().to_numpy().reshape(-1, width)
            compared = np.zeros(len(rows), bool)
            excess = np.zeros(len(rows))
            if len(listed):
                compared = pc.is_in(batch.column(lang).cast(pa.string()), listed).to_numpy(zero_copy_only=False)
                excess, _ = found.excess(counts, rows)
            failed = batch.column(results[len(COUNTS)]).to_numpy(zero_copy_only=False)
            kept = ~failed & ~(compared & (excess > 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in [*keep, *results[: len(COUNTS) + 1]]), pa.array(kept), pa.array(excess, mask=~compared)], [*keep, *results])

    return measured.mapInArrow(run, schema)
