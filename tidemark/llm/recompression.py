"""Substring dedup by recompression.

A text is a sequence of words. Each round names its runs of equal symbols and then its pairs: a
symbol of the left half of the alphabet followed by one of the right half becomes one symbol. Names
are 64-bit hashes of what they stand for, so they agree over the whole corpus without a table, and
the halves are bits of the names. What a symbol becomes depends on its neighbours only. Of a
window of words, each half round loses at most the symbol at either end; the rest, its interior, is
the same wherever that window stands. A window's anchor is the group of ``GROUP`` interior symbols
with the smallest hash, the rightmost on a tie; a window whose interior is shorter (inside long
runs) is its own anchor. Equal windows so have equal anchors: anchors that occur twice reveal
where repeats may be, and ``repeats`` verifies them. Spark counts the anchors globally.

A run's name leaves out its length; equal windows one after the other within a text (a long run)
are one span that counts twice.

Defined results: null and empty texts have no words. Every row is kept; rows equal in id and text
have equal results and count as different places. Words are never changed.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import repeats
from tidemark.llm.arrays import U64, Rolling, Words, blocks, mix, signed
from tidemark.scratch import Scratch

WINDOW = 35
ROUNDS = 2
GROUP = 5
PIECE = 1 << 20  # windows parsed at a time
PLACE = U64((1 << 24) - 1)


def _runs(names, number):
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    starts = np.flatnonzero(new)
    long = np.diff(starts, append=len(names)) > 1
    named = names[starts]
    return np.where(long, mix(named ^ U64(0xA5A5 + number)), named), np.cumsum(new) - 1


def _pairs(names, number):
    left = (names >> U64(number)) & U64(1) == 0
    merged = np.zeros(len(names), bool)  # with the symbol behind
    merged[:-1] = left[:-1] & ~left[1:]
    new = np.ones(len(names), bool)
    new[1:] = ~merged[:-1]
    behind = np.zeros(len(names), U64)
    behind[:-1] = names[1:]
    named = np.where(merged, mix(names * U64(3) + mix(behind) + U64(number)), names)
    return named[new], np.cumsum(new) - 1


def anchors(codes, starts, window, rounds=ROUNDS, group=GROUP):
    """Key of each window's anchor, its index (negative where the window is its own anchor) and its first unit."""
    names, first, last, units = codes, starts, starts + window - 1, np.arange(len(codes))
    for number in range(rounds):
        for half in (_runs, _pairs):
            names, where = half(names, number)
            # an empty interior stays empty, also where it leaves the sequence
            first = where[np.minimum(first, len(where) - 1)] + 1
            last = where[np.maximum(last, 0)] - 1
            units = units[np.flatnonzero(np.diff(where, prepend=-1))]
    keys = Rolling(codes).hashes(starts, starts + window)
    index = -1 - starts
    choices = last - first - group + 2
    if len(names) < group or not (choices > 0).any():
        return keys, index, starts
    ends = np.arange(len(names) - group + 1)
    hashes = Rolling(names).hashes(ends, ends + group)
    values = (hashes & ~PLACE) | (PLACE - ends.astype(U64))
    best = np.zeros(len(starts), U64)
    reach = 1
    while True:
        mine = np.flatnonzero((choices >= reach) & (choices < 2 * reach))
        best[mine] = np.minimum(values[first[mine]], values[first[mine] + choices[mine] - reach])
        reach *= 2
        if not (choices >= reach).any():
            break
        values = np.minimum(values[: -(reach // 2)], values[reach // 2 :])
    inside = choices > 0
    at = (PLACE - (best & PLACE)).astype(np.int64)
    index = np.where(inside, at, index)
    at = np.where(inside, at, 0)
    return np.where(inside, hashes[at], keys), index, np.where(inside, units[at], starts)


def word_spans(batches, window):
    """The spans of each text of Arrow batches with ``row`` and ``text``."""
    for block in blocks(batches):
        words = Words(block.column("text"))
        rows = block.column("row").to_numpy()
        counts = np.maximum(words.counts() - window + 1, 0)
        all_starts = repeats.within(words.firsts[:-1], counts)
        all_owners = np.repeat(np.arange(len(rows)), counts)
        for begin in range(0, len(all_starts), PIECE):
            starts, owners = all_starts[begin : begin + PIECE], all_owners[begin : begin + PIECE]
            base = starts[0]
            codes = words.codes[base : starts[-1] + window]
            keys, index, units = anchors(codes, starts - base, window)
            # a long run: equal windows one behind the other are one span
            alone = np.flatnonzero(index[1:] < 0) + 1
            alone = alone[(keys[alone] == keys[alone - 1]) & (index[alone - 1] < 0) & (owners[alone] == owners[alone - 1])]
            new = np.ones(len(starts), bool)
            new[1:] = (index[1:] != index[:-1]) | (owners[1:] != owners[:-1])
            new[alone] = (alone % (repeats.LARGEST_SPAN - 1)) == 0
            heads = np.flatnonzero(new)
            n = np.diff(heads, append=len(starts))
            own = index[heads] < 0
            at = starts[heads]
            spans = np.where(own, keys[heads], Rolling(codes).hashes(at - base, at - base + np.where(own, 1, n) + window - 1))
            twice = np.repeat(np.arange(len(heads)), np.where(own & (n > 1), 2, 1))
            heads, at, spans, n = heads[twice], at[twice], spans[twice], n[twice]
            yield pa.RecordBatch.from_arrays(
                [signed(keys[heads]), signed(spans), pa.array(rows[owners[heads]]),
                 pa.array(at - words.firsts[owners[heads]]), pa.array(n.astype(np.int32)),
                 pa.array(((units[heads] + base - words.firsts[owners[heads]]) % repeats.GRID).astype(np.int32))],
                ["key", "span", "row", "at", "n", "phase"])


def kept_text(n_words, kept):
    """The default result: how many words there were and went, and the rest joined by spaces."""
    return n_words, n_words - len(kept), b" ".join(kept).decode()


KEPT_TEXT = ([("n_words", "long"), ("n_removed", "long"), ("kept", "string")], kept_text)


def deduplicate(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", window: int = WINDOW, result=KEPT_TEXT) -> DataFrame:
    """Drop every word in a window of ``window`` words that also starts anywhere else.

    Returns the columns ``keep`` and those of ``result``: named fields, and a function of the
    number of words and the kept words. A result whose name is among ``keep`` gets an underscore.
    """
    scratch = Scratch(docs.sparkSession)
    made = result[1]
    docs, inner = repeats.prepared(docs, keep, key, text)
    spans = docs.select("row", "text").mapInArrow(lambda b: word_spans(b, window), repeats.SPAN)
    marks = repeats.marked(spans, repeats.grouped(spans), scratch)

    def finish(value, gone):
        found = value.encode().split()
        return made(len(found), found if gone is None else list(compress(found, ~gone)))

    rolling = lambda value: Rolling(Words(pa.array([value])).codes)
    fields = [(f"result_{i}", kind) for i, (_, kind) in enumerate(result[0])]
    finder = repeats.Finder(window, lambda value: len(value.encode().split()), rolling, finish, fields)
    return repeats.restored(repeats.cut(docs, marks, finder, scratch, inner), keep, [name for name, _ in result[0]])
