"""Benchmark items in documents, against every window."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import MultiIndex
from tidemark.llm.shipping import ship

SPLIT = re.compile(r"[\s!-/:-@\[-`{-~]+")


def bag(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(max(0, len(words) - size + 1)))


def brute(docs, items):
    found = {}
    for doc, text in docs:
        words = [w for w in SPLIT.split((text or "").lower()) if w]
        for item, wanted in items:
            wanted = [w for w in SPLIT.split((wanted or "").lower()) if w]
            if not wanted:
                continue
            size = min(5, len(wanted))
            target, best = bag(wanted, size), 0
            for start in range(max(1, len(words) - len(wanted) + 1)):
                own = bag(words[start : start + len(wanted)], size)
                best = max(best, sum((own & target).values()) / sum((own | target).values()))
            if best >= 0.8:
                found[doc, item] = best
    return found


def planted(rng):
    vocabulary = [f"b{i}" for i in range(200)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(make(rng.randint(3, 59)))) for i in range(25)] + [(90, ""), (91, None), (92, "x x x x x x x"), (93, "..."), (94, "Déjà vu, 東京 in the morning light")]
    items.append((95, items[3][1]))
    docs = [(0, None), (1, ""), (2, "x " * 30), (3, items[4][1]), (4, "DÉJÀ vu 東京 in the morning light!"), (5, "- -")]
    for i in range(40):
        words = make(rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            leak = rng.choice(items[:25])[1].split()
            if rng.random() < 0.4:
                leak[0] = "changed"
            if rng.random() < 0.2:
                leak = leak[: len(leak) * 9 // 10]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in leak]
        docs.append((10 + i, " ".join(words)))
    docs.append((60, " ".join(items[7][1].split()[:-1])))
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 7)])
def test_leaks_equal_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(decontaminate, "ITEMS", block)
    docs, items = planted(random.Random(seed))
    frame = ship(spark).createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, ITEM_ID int").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for r in decontaminate.with_leaks(frame, benchmark).collect():
        for leak in r.leaks:
            found[r.doc_id, leak.item_id] = leak.similarity
    wanted = brute(docs, items)
    assert set(found) == set(wanted) and len(wanted) > 20
    for pair, value in found.items():
        assert value == pytest.approx(wanted[pair])


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    for radius in (0, 3, 24):
        index = MultiIndex(prints, radius)
        for _ in range(40):
            asked = prints[rng.integers(300)]
            for bit in rng.choice(63, rng.integers(0, radius + 3), replace=False):
                asked = asked ^ (np.uint64(1) << np.uint64(bit))
            assert index.within(asked).tolist() == np.flatnonzero(np.bitwise_count(prints ^ asked) <= radius).tolist()


def test_empty_tables(spark):
    docs = ship(spark).createDataFrame([(1, "some text here for all of us")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.with_leaks(docs, none).collect()[0].leaks == []
    assert decontaminate.with_leaks(docs.limit(0), spark.createDataFrame([(1, "some text")], "item_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        decontaminate.with_leaks(docs.selectExpr("*", "1 AS Leaks"), none)
