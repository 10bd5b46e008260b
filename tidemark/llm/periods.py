"""Periodic runs of words by recompression.

The words of a block of texts are one sequence of symbols with a sentinel of its own around each
text. Rounds of two half rounds shorten it: a block of equal symbols becomes one symbol, then a symbol of
the left half of the alphabet followed by one of the right half becomes one. What a symbol becomes
depends on its neighbours only, so equal stretches get equal symbols but at their ends, and the rounds
form a run-length grammar, about a quarter shorter each time. How far two places agree (the longest common
extension) is asked of the grammar: both climb while they stand at the beginnings of symbols, step over
equal ones, and climb down where they differ. A query takes a few steps per round; queries are answered together.

A run with period p of at least 4p words holds a place of the grid of every 3p words that is equal to
that p words on, also at the run's beginning. So for each p the places of its grid are the candidates, a
harmonic number of them in all; those whose next word in the period differs fall away at once, and
the grammar extends the others to both sides, exactly. Of equal stretches the smallest period counts.

Defined results: null and empty texts have no words and no runs. Words are compared as bytes, unchanged.
Every row is kept with all its columns; repeated rows have equal results. A text of any length is one row's
work. A column that has a result's name keeps it; the result's gets an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, blocks, lists, mix
from tidemark.llm.names import fresh
from tidemark.llm.repeats import within
from tidemark.llm.tokens import ExactWords, renumber

LEAST, TIMES = 6, 4  # shortest run in words and in periods
ROUNDS = 60  # at most; a longer rest is compared symbol by symbol
PIECE = 1 << 20  # candidates made at a time
STEP = U64(0x9E3779B97F4A7C15)


@dataclass
class Level:
    """Symbols of one half round.

    ``last``: the end of the block of equal symbols each is in. ``up``: the symbol of the level above that holds it; ``down``: the
    first symbol of the level below. ``at``: its first word.
    """

    names: np.ndarray
    last: np.ndarray
    at: np.ndarray
    up: np.ndarray | None = None
    down: np.ndarray | None = None

    def mirrored(self, below, above, size):
        """The same level read from right to left."""
        n = len(self.names)
        flip = lambda x, m: m - 1 - x[::-1]
        new = np.ones(n, bool)
        new[1:] = self.names[1:] != self.names[:-1]
        firsts = np.flatnonzero(new)[np.cumsum(new) - 1]
        at = np.append(self.at, size)
        down = None if below is None else flip(np.append(self.down, len(below.names))[1:] - 1, len(below.names))
        up = None if above is None else flip(self.up, len(above.names))
        return Level(self.names[::-1], flip(firsts, n), size - at[1:][::-1], up, down)


def _last(names):
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(names)) - 1
    return ends[np.cumsum(new) - 1], starts, ends


def grammar(symbols):
    """The levels of a sequence of non-negative integers, from the words up."""
    names, at = np.asarray(symbols, np.int64), np.arange(len(symbols))
    last, starts, ends = _last(names)
    levels = [Level(names, last, at)]
    for number in range(ROUNDS):
        before = len(names)
        for half in ("blocks", "pairs"):
            if half == "blocks":
                first, length = starts, ends - starts
                if not length.any():
                    continue
                named = renumber(names[first], length)
            else:
                salt = U64((number + 1) * int(STEP) % (1 << 64))
                left = (mix(names.astype(U64) + salt) >> U64(40)) & U64(1) == 0
                merged = np.zeros(len(names), bool)  # with the symbol behind
                merged[:-1] = left[:-1] & ~left[1:]
                if not merged.any():
                    continue
                new = np.ones(len(names), bool)
                new[1:] = ~merged[:-1]
                first = np.flatnonzero(new)
                behind = np.append(names[1:] + 1, 0)
                named = renumber(names[first], np.where(merged, behind, 0)[first])
            up = np.zeros(len(names), np.int64)
            up[first] = 1
            levels[-1].up = np.cumsum(up) - 1
            names, at = named, at[first]
            last, starts, ends = _last(names)
            levels.append(Level(names, last, at, None, first))
        if len(names) == 1 or len(names) == before and number > 8:
            break
    return levels


class Extensions:
    """Longest common extensions to both sides of places of one sequence.

    The sequence must begin and end with symbols that occur nowhere else, and so must whatever two
    asked places must not look across.
    """

    def __init__(self, symbols):
        self.size = len(symbols)
        self.right = grammar(symbols)
        sides = zip([None, *self.right[:-1]], self.right, [*self.right[1:], None])
        self.left = [level.mirrored(below, above, self.size) for below, level, above in sides]

    def forward(self, i, j):
        """How many symbols from ``i`` and from ``j`` on are equal; ``i < j``."""
        return _agree(self.right, i, j)

    def backward(self, i, j):
        """How many symbols before ``i`` and before ``j`` are equal; ``i < j``."""
        return _agree(self.left, self.size - j, self.size - i)


def _agree(levels, i, j):
    """Equal symbols from each pair of places on, all pairs together."""
    a, b = np.array(i, np.int64), np.array(j, np.int64)
    top = np.zeros(len(a), np.int64)  # the level at which each pair met a difference
    here = np.arange(len(a))
    for number, level in enumerate(levels):
        climbs = number + 1 < len(levels)
        rising = []
        active = here
        while len(active):
            x, y = a[active], b[active]
            if climbs:
                over_x, over_y = level.up[x], level.up[y]
                upper = levels[number + 1].down
                stands = (upper[over_x] == x) & (upper[over_y] == y)
                high = active[stands]
                a[high], b[high] = over_x[stands], over_y[stands]
                rising.append(high)
                active, x, y = active[~stands], x[~stands], y[~stands]
            equal = level.names[x] == level.names[y]
            top[active[~equal]] = number
            active, x, y = active[equal], x[equal], y[equal]
            step = np.minimum(level.last[x] - x, level.last[y] - y) + 1
            a[active], b[active] = x + step, y + step
        here = np.concatenate(rising) if rising else here[:0]
        if not len(here):
            break
    # down again: at each level over what is equal, to the first different word
    for number in range(int(top.max(initial=0)), 0, -1):
        mine = np.flatnonzero(top >= number)
        upper, level = levels[number], levels[number - 1]
        a[mine], b[mine] = upper.down[a[mine]], upper.down[b[mine]]
        while len(mine):
            x, y = a[mine], b[mine]
            equal = level.names[x] == level.names[y]
            mine, x, y = mine[equal], x[equal], y[equal]
            step = np.minimum(level.last[x] - x, level.last[y] - y) + 1
            a[mine], b[mine] = x + step, y + step
    return a - np.asarray(i)


def _candidates(counts, bases, symbols, times):
    """Places of the harmonic grids whose symbol recurs one period on: place and period."""
    periods = np.maximum(counts // times, 0)
    whose, period = np.repeat(np.arange(len(counts)), periods), within(np.ones(len(counts), np.int64), periods)
    step = (times - 1) * period
    each = (counts[whose] - period - 1) // step + 1  # places k * step with k * step + period inside
    ends = np.cumsum(each)
    begin = 0
    while begin < len(each):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PIECE, "right")))
        part = slice(begin, end)
        n = each[part]
        place = bases[whose[part]].repeat(n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step[part].repeat(n)
        shift = period[part].repeat(n)
        found = symbols[place] == symbols[place + shift]
        yield place[found], shift[found]
        begin = end


def block_runs(words: ExactWords, least: int = LEAST, times: int = TIMES):
    """Owner, first word within it, length and smallest period of all runs of a block of texts, in order."""
    n_texts = len(words.counts)
    # a sentinel before each text and one behind the last
    symbols = np.empty(len(words.numbers) + n_texts + 1, np.int64)
    bases = words.firsts[:-1] + np.arange(1, n_texts + 1)
    ends = np.append(bases - 1, len(symbols) - 1)
    is_word = np.ones(len(symbols), bool)
    is_word[ends] = False
    symbols[is_word] = words.numbers
    symbols[ends] = len(words.vocabulary) + np.arange(n_texts + 1)
    extensions, found = None, []
    for place, period in _candidates(words.counts, bases, symbols, times):
        if not len(place):
            continue
        extensions = extensions or Extensions(symbols)
        after = extensions.forward(place, place + period)
        before = extensions.backward(place, place + period)
        start, length = place - before, before + after + period
        good = length >= np.maximum(least, times * period)
        found.append((start[good], length[good], period[good]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((length, period, start))
    start, length, period = start[order], length[order], period[order]
    owner = np.searchsorted(bases, start, "right") - 1
    return owner, start - bases[owner], length, period


def covered(size, starts, lengths):
    """Which of ``size`` words lie in any stretch."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def _collapsed(words, gone):
    """Each text's words that stay, joined by one space."""
    stays = ~gone
    starts, ends, owners = words.starts[stays], words.ends[stays], words.owners[stays]
    lengths = ends - starts
    counts = np.bincount(owners, minlength=len(words.counts))
    follows = np.ones(len(starts), bool)  # a space in front, but for the first
    follows[1:] = owners[1:] == owners[:-1]
    follows[:1] = False
    out_ends = np.cumsum(lengths + follows)
    data = np.full(out_ends[-1] if len(out_ends) else 0, 32, np.uint8)
    data[within(out_ends - lengths, lengths)] = words.data[within(starts, lengths)]
    offsets = np.concatenate([[0], out_ends])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Every row with ``runs``, an array of ``start, length, period`` by start and period, and ``collapsed``, its words
    without those that a run holds after its first period, joined by one space."""
    names = fresh(["runs", "collapsed"], docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.ArrayType(RUN, False)), T.StructField(names[1], T.StringType())])

    def run(batches):
        for block in blocks(batches, text):
            words = ExactWords(block.column(text))
            owner, start, length, period = block_runs(words, least, times)
            gone = covered(len(words.numbers), words.firsts[owner] + start + period, length - period)
            offsets = np.zeros(block.num_rows + 1, np.int32)
            np.cumsum(np.bincount(owner, minlength=block.num_rows), out=offsets[1:])
            fields = [pa.array(np.asarray(x, np.int64)) for x in (start, length, period)]
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([*block.columns, runs, _collapsed(words, gone).cast(pa.string())], [*block.schema.names, *names])

    return docs.mapInArrow(run, schema)
