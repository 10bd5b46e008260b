"""Winnowing against brute force, and the edited texts over whole tables."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import winnowing
from tidemark.llm.shipping import ship


def brute(text, gram, window):
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(codes):
        return []
    gram = min(gram, len(codes))
    hashes = [int(winnowing._gram_hashes(codes[i : i + gram], gram)[0]) for i in range(len(codes) - gram + 1)]
    window = min(window, len(hashes))
    chosen = {max(j for j in range(i, i + window) if hashes[j] == min(hashes[i : i + window])) for i in range(len(hashes) - window + 1)}
    return [(j, hashes[j]) for j in sorted(chosen)]


@pytest.mark.parametrize("block", [1 << 19, 128])
def test_chosen_hashes(monkeypatch, block):
    monkeypatch.setattr(winnowing, "BLOCK", block)
    rng = random.Random(3)
    for n in (0, 1, 15, 16, 17, 46, 47, 48, 300, 1000):
        text = "".join(rng.choice("ab é東\U0001f389") for _ in range(n))
        at, hashes = winnowing.winnow(text, 16, 32)
        assert list(zip(at.tolist(), hashes.tolist())) == brute(text, 16, 32)
        again = winnowing.unpacked(winnowing.packed(at, hashes))
        assert again[0].tolist() == at.tolist() and again[1].tolist() == hashes.tolist()


def test_ties_are_taken_at_the_right():
    at, _ = winnowing.winnow("a" * 100, 16, 32)
    assert at.tolist() == list(range(31, 85))


def test_a_shared_stretch_is_always_matched():
    rng = random.Random(4)
    for _ in range(50):
        shared = "".join(rng.choice("abcdefgh ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
        one, other = ("".join(rng.choice("xyz") for _ in range(rng.randint(0, 80))) + shared + "".join(rng.choice("uvw") for _ in range(rng.randint(0, 80))) for _ in range(2))
        (a, m), (b, n) = winnowing.winnow(one), winnowing.winnow(other)
        assert {(h, p - one.index(shared)) for p, h in zip(a.tolist(), m.tolist())} & {(h, p - other.index(shared)) for p, h in zip(b.tolist(), n.tolist())}


def wanted(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    texts = [r[1] or "" for r in rows]
    for (doc_id, *_), text, following in zip(rows, texts, [*texts[1:], texts[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [winnowing.winnow(t) for t in (text, edited, following)]
        yield doc_id, (len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.packed(*prints[0]), winnowing.packed(*prints[1]),
                       winnowing.likeness(prints[0][1], prints[1][1]), winnowing.likeness(prints[0][1], prints[2][1]))


@pytest.mark.parametrize("n", [1, 2, 60])
def test_edited_against_the_next(spark, n):
    rng = random.Random(n)
    alphabet = "abc d é東🎉"
    rows = [(i * 7 % 101, rng.choice([None, "", "same text " * 9, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))]), "x") for i in range(n)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, Place string").repartition(5)
    found = {r.doc_id: tuple(r)[1:] for r in winnowing.against_next(docs).collect()}
    assert found == dict(wanted(rows))


def test_odd_tables(spark):
    assert winnowing.against_next(ship(spark).createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a" * 50), (3, "b" * 50), (3, "b" * 50), (3, "c" * 50)]
    found = winnowing.against_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 3, 3, 3]
    prints = winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert prints[1].fingerprint == prints[2].fingerprint != prints[3].fingerprint


def test_a_hot_id_spreads_over_ranges(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(winnowing, "RANGE_ROWS", 10)
    rng = random.Random(7)
    text = lambda: "".join(rng.choice("abc d é東") for _ in range(rng.randint(0, 60)))
    rows = [(5, text()) for _ in range(300)] + [(None, text()) for _ in range(300)] + [(i, text()) for i in range(-100, 200)]
    rows += [(2**60, text()) for _ in range(40)] + [(2**60 + i, text()) for i in range(1, 60)] + [(77, "same text " * 6)] * 50
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(5)
    placed = winnowing._ranged(docs).groupBy("place").agg(F.count_if(~F.col("guest")).alias("n"), F.count_if("guest").alias("guests")).collect()
    hot = winnowing._ranged(docs).filter("not guest and (doc_id = 5 or doc_id is null)").groupBy("doc_id", "place").count().collect()
    assert all(r.guests == 1 for r in placed)
    assert max(r["count"] for r in hot) <= 40

    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], len(r[1])))
    expected = []
    for (doc_id, one), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        edited = winnowing.edited_text(one, following)
        prints = [winnowing.winnow(t) for t in (one, edited, following)]
        expected.append((doc_id, len(one), hashlib.sha256(edited.encode()).hexdigest(), winnowing.packed(*prints[0]), winnowing.packed(*prints[1]),
                         winnowing.likeness(prints[0][1], prints[1][1]), winnowing.likeness(prints[0][1], prints[2][1])))
    assert sorted(map(str, map(tuple, winnowing.against_next(docs).collect()))) == sorted(map(str, expected))
