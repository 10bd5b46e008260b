"""Signatures without bias, and classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bagminhash
from tidemark.llm.shipping import ship
from tidemark.scratch import Scratch


def shingles(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def alike(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    """Class of each row: the smallest id of what is linked by equality or similarity."""
    bags, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (bags[i] and 5 * sum((bags[i] & bags[j]).values()) >= 4 * sum((bags[i] | bags[j]).values())):
                parent[root(i)] = root(j)
    return {i: min(rows[j][0] for j in range(len(rows)) if root(j) == root(i)) for i in range(len(rows))}


@pytest.mark.parametrize("one,other", [([1] * 40 + [0] * 10, [0] * 10 + [1] * 40), ([8, 3, 1, 20, 5, 0], [5, 3, 2, 30, 0, 4]), ([100, 1], [60, 3])])
def test_registers_agree_as_often_as_the_multisets(one, other):
    one, other = np.array(one), np.array(other)
    truth = np.minimum(one, other).sum() / np.maximum(one, other).sum()
    rng, agree = np.random.default_rng(1), []
    for _ in range(60):
        names = rng.integers(0, 2**63, len(one)).astype(np.uint64)
        both = [(names[w > 0], w[w > 0]) for w in (one, other)]
        found = bagminhash.signatures(np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both]), np.array([len(b[0]) for b in both]), 128)
        assert np.isfinite(found).all()
        agree.append((found[0] == found[1]).mean())
    assert abs(np.mean(agree) - truth) < 0.02


def test_shingles_and_similarity():
    texts = ["a b c d e f", "A b  c d e\tF", "a b", "", "x x x x x x x x"]
    hashes, counts, each = bagminhash.shingles(pa.array(texts))
    assert each.tolist() == [2, 2, 1, 0, 1] and counts.tolist() == [1, 1, 1, 1, 1, 4]
    assert hashes[0] in hashes[2:4]


def corpus(rng):
    vocabulary = [f"v{i}" for i in range(300)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [None, "", "", "  ", "few words", "few words", "few  words", "a b c d e", "A B C D E"]
    for _ in range(15):
        base = make(rng.randint(60, 200))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    chain = make(300)  # neighbours are alike, the ends are not
    for step in range(0, 240, 12):
        texts.append(" ".join(chain[step:] + make(step)))
    rng.shuffle(texts)
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,rounds", [(1, 3), (2, 1)])
def test_classes(spark, seed, rounds):
    rows = corpus(random.Random(seed))
    docs = ship(spark).createDataFrame([(*r, 0) for r in [*rows, rows[3]]], "doc_id long, text string, LABEL int").repartition(3)
    found = {r.doc_id: r.class_id for r in bagminhash.classes(docs, star_rounds=rounds).collect()}
    wanted = brute(rows)
    assert found == {rows[i][0]: c for i, c in wanted.items()}
    kept = bagminhash.first_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(wanted.values()))


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (5, 4), (4, 6), (6, 7), (7, 10), (10, 11), (11, 3)]
    edges = ship(spark).createDataFrame([(bytes([a]), bytes([b])) for a, b in links], "a binary, b binary")
    found = {bytes(r.node)[0]: bytes(r.label)[0] for r in bagminhash.components(edges, Scratch(spark)).collect()}
    assert found == {8: 8, 9: 8, **{i: 1 for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)}}


def test_odd_tables(spark):
    empty = ship(spark).createDataFrame([], "doc_id long, text string")
    assert bagminhash.classes(empty).count() == bagminhash.first_of_each(empty).count() == 0
    rows = [(None, "q w e r t y u"), (None, "q w e r t y u"), (7, "z z"), (7, "z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.class_id or 0) for r in bagminhash.classes(docs).collect()) == [0, 0, 7, 7]
    assert bagminhash.first_of_each(docs).count() == 2


def test_pairs_at_the_threshold_share_a_band():
    rng, n_registers = np.random.default_rng(4), bagminhash.BANDS * bagminhash.ROWS
    for _ in range(10):
        one, other = rng.random((2, 10_000, n_registers))
        other = np.where(rng.random(one.shape) < bagminhash.SIMILARITY, one, other)
        assert (bagminhash.band_keys(one) == bagminhash.band_keys(other)).any(1).all()


def test_comparisons_in_many_small_blocks(spark, monkeypatch):
    """Texts of very different lengths, in blocks of a few texts each, give the same classes."""
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", 20_000)
    rng = random.Random(11)
    rows = corpus(rng)
    long = [f"u{rng.randrange(900)}" for _ in range(6_000)]
    for i in range(6):
        rows.append((2000 + i, " ".join([*long[: 5900 - 10 * i], *(f"x{i}{k}" for k in range(100))])))
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in bagminhash.classes(docs, star_rounds=0).collect()}
    assert found == {rows[i][0]: c for i, c in brute(rows).items()}


def test_columns_of_any_name_stay(spark):
    rows = [(1, "q w e r t y u", 5, 6, 7), (2, "q w e r t y u", 5, 6, 7)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, head_id int, head_text int, Head_key int")
    (kept,) = bagminhash.first_of_each(docs).collect()
    assert tuple(kept) == rows[0] and kept.asDict().keys() == {"doc_id", "text", "head_id", "head_text", "Head_key"}
