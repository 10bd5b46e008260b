"""Words of a block of texts as small integers that are equal exactly when the words are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidemark.llm.arrays import WORD_BYTES, flat


class ExactWords:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text of an Arrow column: bytes, places and dense numbers."""

    def __init__(self, column):
        self.data, self.offsets = flat(column)
        inside = WORD_BYTES[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(len(self.data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(self.data), bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
        ends = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=ends[1:])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(ends), pa.py_buffer(self.data[inside])])
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.numbers = coded.indices.to_numpy().astype(np.int64)
        # first word of each text, and behind the last
        self.firsts = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.firsts)
        self.owners = np.repeat(np.arange(len(self.counts)), self.counts)


def renumber(*keys):
    """Dense numbers of tuples of non-negative integers, equal exactly when the tuples are."""
    number = np.asarray(keys[0], np.int64)
    for key in keys[1:]:
        base = int(key.max(initial=0)) + 1
        if int(number.max(initial=0)) > (1 << 62) // base:
            number = np.unique(number, return_inverse=True)[1]
        number = number * base + key
    return np.unique(number, return_inverse=True)[1]
