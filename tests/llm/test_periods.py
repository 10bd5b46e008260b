"""Periodic runs against all pairs of places, extensions against a loop, and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import periods, queries
from tidemark.llm.shipping import ship
from tidemark.llm.tokens import ExactWords, renumber

SF = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """Start, length and smallest period of every run, by comparing each word with that one period on."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > start and i + p - start >= max(least, times * p):
                found.setdefault((start, i + p - start), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2], r[1]))


def collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(8)
    for _ in range(250):
        letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
        words = [rng.choice(letters) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 6))]
            words += (unit * 12)[: rng.randrange(1, 50)] + [rng.choice(letters) for _ in range(rng.randrange(4))]
        yield words
    yield from (["x"] * 3000, ["a", "b"] * 900, [], list("ababababc") * 60, ["a"] * 5, ["a"] * 6, list("abcabcabca"), list("abcabcabcabc"))
    thue = "a"
    for _ in range(9):
        thue = "".join({"a": "ab", "b": "ba"}[c] for c in thue)
    yield list(thue)


def found_in(texts):
    owner, *rest = periods.block_runs(ExactWords(pa.array([" ".join(t) for t in texts])))
    runs = [[] for _ in texts]
    for i, *run in zip(owner, *rest):
        runs[i].append(tuple(map(int, run)))
    return runs


def test_runs_equal_brute_force():
    texts = list(sequences())
    for words, runs in zip(texts, found_in(texts)):
        assert runs == brute(words)
    assert found_in(texts[:1]) == [brute(texts[0])]


def test_candidates_in_pieces(monkeypatch):
    monkeypatch.setattr(periods, "PIECE", 50)
    texts = list(sequences())[:60]
    assert found_in(texts) == [brute(t) for t in texts]


def test_extensions_equal_a_loop():
    rng = random.Random(9)
    words = [rng.choice([1, 1, 1, 2, 3]) for _ in range(500)] + [1] * 300 + [1, 2] * 200
    words = [9, *words, *words[100:700], 10]
    asked = periods.Extensions(np.array(words))
    pairs = sorted({tuple(sorted(rng.sample(range(1, len(words) - 1), 2))) for _ in range(800)})
    i, j = map(np.array, zip(*pairs))
    for a, b, after, before in zip(i, j, asked.forward(i, j), asked.backward(i, j)):
        k = 0
        while words[a + k] == words[b + k]:
            k += 1
        assert after == k
        k = 0
        while words[a - 1 - k] == words[b - 1 - k]:
            k += 1
        assert before == k


def test_grammar_spells_the_words_and_shrinks():
    rng = random.Random(10)
    words = np.array([rng.randrange(50) for _ in range(5000)] + [7] * 2000)
    levels = periods.grammar(words)
    assert len(levels[-1].names) < 100
    meaning = [(int(w),) for w in words]
    for low, high in zip(levels, levels[1:]):
        parts = np.split(np.arange(len(low.names)), high.down[1:])
        meaning = [sum((meaning[k] for k in part), ()) for part in parts]
        spelt = {}
        for name, words_ in zip(high.names, meaning):
            assert spelt.setdefault(int(name), words_) == words_


def test_numbers_are_exact():
    big = np.array([0, 1 << 40, 1 << 40, 5])
    assert len(set(renumber(big, big, big).tolist())) == 3
    words = ExactWords(pa.array(["a b a", None, "", "b\x0bé"]))
    assert words.counts.tolist() == [3, 0, 0, 2] and words.numbers[1] == words.numbers[3] and words.numbers[0] == words.numbers[2]


def test_odd_rows(spark):
    long = " ".join(str(i % 977) for i in range(30_000))
    rows = [(1, None, 1), (1, "", 2), (2, " \n ", 3), (3, "é é é é é é é", 4), (None, "a b a b a b a b", 5), (4, long, 6), (4, long, 7)]
    frame = ship(spark).createDataFrame(rows, "doc_id long, text string, runs int").withColumnRenamed("runs", "Collapsed").repartition(3)
    found = {r.Collapsed: r for r in periods.with_runs(frame).collect()}
    assert len(found) == 7 and found[1].runs == found[2].runs == found[3].runs == [] and found[1].collapsed_ == ""
    assert [tuple(r) for r in found[4].runs] == [(0, 7, 1)] and found[4].collapsed_ == "é"
    assert [tuple(r) for r in found[5].runs] == [(0, 8, 2)] and found[5].collapsed_ == "a b"
    assert [tuple(r) for r in found[6].runs] == [(0, 30_000, 977)] and found[6][3:] == found[7][3:]
    assert periods.with_runs(frame.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    found = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    changed = 0
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        n, h = len(words), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            changed += 1
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        digests = "".join(f"{s},{k},{p}\n" for s, k, p in runs), collapse(words, runs)
        assert found[doc] == (len(runs), *head, *(hashlib.sha256(d.encode()).hexdigest() for d in digests))
    assert changed


def test_null_id_has_no_tail(spark):
    frame = ship(spark).createDataFrame([(None, "a b c"), (None, None)], "doc_id long, text string")
    assert [r.text for r in queries.with_periodic_tails(frame).collect()] == ["a b c", None]
