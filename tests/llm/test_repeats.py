"""Both substring operators against brute force over every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import arrays, recompression, suffix_levels
from tidemark.llm.shipping import ship


def brute(units, window):
    """Which units go, for each text's sequence of units."""
    places = {}
    for text, found in enumerate(units):
        for i in range(len(found) - window + 1):
            places.setdefault(tuple(found[i : i + window]), []).append((text, i))
    gone = [np.zeros(len(found), bool) for found in units]
    for where in places.values():
        if len(where) > 1:
            for text, i in where:
                gone[text][i : i + window] = True
    return gone


def corpus(rng, words=40):
    vocabulary = [f"w{i}" for i in range(words)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, line = make(120), make(12)
    texts = [None, "", "   ", "one", " ".join(make(34)), " ".join(make(35))]
    for _ in range(12):
        texts.append(" ".join(make(rng.randint(0, 80)) + passage[rng.randint(0, 60) : rng.randint(60, 120)] + make(rng.randint(0, 40)) + line))
    base = make(200)
    for _ in range(6):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append("\t".join(copy) + "\n")
    texts += ["a " * 90, "a " * 36, "a " * 35, "b " * 35, "a b " * 60, "x y z " * 40 + " ".join(make(5)), "a a b " * 40, "b a a " * 13]
    own = make(50)
    texts += [" ".join(own + make(10) + own), texts[8], texts[8], "  ".join(make(60)) + " x\x0b" + "é東 " * 40]
    return texts


def table(spark, texts):
    rows = [(i, t, i) for i, t in enumerate(texts)]
    rows.append(rows[9])  # a row that is repeated as a whole
    return rows, ship(spark).createDataFrame(rows, "doc_id long, text string, KEY_ long").repartition(4)


@pytest.mark.parametrize("seed,words", [(1, 40), (2, 3), (3, 400)])
def test_word_windows(spark, seed, words):
    rows, docs = table(spark, corpus(random.Random(seed), words))
    units = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    wanted = sorted((i, len(u), int(g.sum()), " ".join(np.array(u, object)[~g])) for (i, *_), u, g in zip(rows, units, brute(units, 35)))
    found = recompression.deduplicate(docs, ["doc_id"]).collect()
    assert sorted(tuple(r) for r in found) == wanted
    assert any(r[2] for r in wanted)


def test_pieces_of_a_long_text_agree(monkeypatch):
    import pyarrow as pa

    text = " ".join(corpus(random.Random(8))[6:])
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([text])], ["row", "text"])
    covered = lambda: sorted(
        (k, a + j) for b in recompression.word_spans([batch], 35) for k, a, n in zip(*(b.column(c).to_pylist() for c in ("key", "at", "n"))) for j in range(n))
    whole = set(covered())
    monkeypatch.setattr(recompression, "PIECE", 50)
    assert set(covered()) == whole and len(whole) == len(text.encode().split()) - 34


@pytest.mark.parametrize("seed,batches", [(1, 4), (2, 3), (3, 1)])
def test_byte_windows(spark, seed, batches):
    rows, docs = table(spark, corpus(random.Random(seed)))
    units = [(t or "").encode() for _, t, _ in rows]
    wanted = []
    for (i, *_), data, gone in zip(rows, units, brute(units, 200)):
        runs = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        wanted.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    fields = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]
    digest = lambda n, gone, spans, kept: (n, gone, spans, hashlib.sha256(kept).hexdigest())
    found = suffix_levels.deduplicate(docs, ["doc_id"], (fields, digest), batches=batches).collect()
    assert sorted(tuple(r) for r in found) == sorted(wanted)


def test_byte_spans_at_piece_edges(monkeypatch):
    import pyarrow as pa

    texts = corpus(random.Random(4))[:20]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([t or "" for t in texts])], ["row", "text"])
    starts = lambda: sorted(
        (r, a + j) for b in suffix_levels.byte_spans([batch], 200) for r, a, n in zip(*(b.column(c).to_pylist() for c in ("row", "at", "n"))) for j in range(n))
    whole = starts()
    assert whole == sorted((i, j) for i, t in enumerate(texts) for j in range(len((t or "").encode()) - 199))
    monkeypatch.setattr(suffix_levels, "PIECE", 333)
    assert starts() == whole


def test_levels_are_geometric(spark):
    from tidemark.llm.repeats import SPAN
    from tidemark.scratch import Scratch

    index = suffix_levels.SuffixIndex(ship(spark), Scratch(spark))
    for batch in range(7):
        index.add(spark.createDataFrame([(1, 5, batch, 0, 1, 0), (100 + batch, 6, batch, 9, 2, 3)], SPAN))
    assert [level.batches for level in index.levels] == [4, 2, 1]
    found = {r.key: (r.occurs, r.low, r.high) for r in index.entries().collect()}
    assert found == {1: (7, 5, 5), **{100 + b: (1, 6, 6) for b in range(7)}}
    plan = index._merged(*(index._read(x) for x in index.levels[:2]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_the_default_result_keeps_the_bytes(spark):
    docs = ship(spark).createDataFrame([(1, "é" * 150), (2, "é" * 150 + "z"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_levels.deduplicate(docs, ["doc_id"]).collect()}
    assert found == {1: (300, 300, 1, b""), 2: (301, 300, 1, b"z"), 3: (0, 0, 0, b"")}


def test_empty_table(spark):
    docs = ship(spark).createDataFrame([], "doc_id long, text string")
    assert recompression.deduplicate(docs, ["doc_id"]).count() == 0
    result = ([("n_bytes", "long")], lambda n, *_: (n,))
    assert suffix_levels.deduplicate(docs, ["doc_id"], result).count() == 0


def test_lists_do_not_grow_with_identical_rows(spark, monkeypatch):
    """Thousands of rows equal in id and text, and copies without an id: every copy counts, each list is one text's."""
    rng = random.Random(9)
    make = lambda n: [rng.choice([f"w{i}" for i in range(300)]) for _ in range(n)]
    passage = make(90)
    texts = [" ".join(make(20) + passage + make(20)), " ".join(passage[:70] + make(30)), "a " * 150]
    rows = [(7, texts[0])] * 3000 + [(None, texts[1])] * 2000 + [(None, texts[2])] * 1000 + [(8, " ".join(make(30) + passage[10:80]))]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes = []
    marked = recompression.repeats.marked

    def seen(spans, keys, scratch):
        found = scratch.keep(marked(spans, keys, scratch), "marks")
        sizes.append(max((len(r.marks) for r in found.collect()), default=0))
        return found

    monkeypatch.setattr(recompression.repeats, "marked", seen)
    found = {}
    for r in recompression.deduplicate(docs, ["doc_id"]).collect():
        found[tuple(r)] = found.get(tuple(r), 0) + 1
    last = len(rows[-1][1].split())
    assert {(k[0], *k[1:3]): n for k, n in found.items()} == {
        (7, 130, 130): 3000, (None, 100, 100): 2000, (None, 150, 150): 1000, (8, last, 70): 1}
    assert 0 < max(sizes) < 130

    sizes.clear()
    result = ([("n_bytes", "long"), ("n_removed", "long")], lambda n, gone, *_: (n, gone))
    found = {}
    for r in suffix_levels.deduplicate(docs, ["doc_id"], result).collect():
        found[tuple(r)] = found.get(tuple(r), 0) + 1
    sized = [len(t.encode()) for t in texts]
    assert all(found[i, n, n] == c for i, n, c in zip((7, None, None), sized, (3000, 2000, 1000)))
    assert sum(found.values()) == len(rows) and 0 < max(sizes) < max(sized)


@pytest.mark.parametrize("names", [["row", "marks", "key"], ["open_text", "sure_at", "hits"], ["n_words", "kept", "keep_0"], ["n_bytes", "n_spans", "text"]])
def test_kept_columns_may_have_any_name(spark, names):
    words = " ".join(f"w{i}" for i in range(300))
    rows = [(1, words, 7, 8, 9), (2, words + " end", 7, 8, 9), (None, None, 7, 8, 9)]
    body = "body" if "text" in names else "text"
    docs = ship(spark).createDataFrame(rows, f"doc_id long, {body} string, {', '.join(f'{n} int' for n in names)}")
    for operator, window in ((recompression, 35), (suffix_levels, 50)):
        found = operator.deduplicate(docs, [*names, "doc_id"], text=body, window=window)
        assert found.columns[:4] == [*names, "doc_id"] and len({c.lower() for c in found.columns}) == len(found.columns)
        assert all(tuple(r)[:3] == (7, 8, 9) for r in found.collect())
        removed = {r.doc_id: r[5] for r in found.collect()}
        assert removed[1] > 0 and removed[2] == removed[1] and not removed[None]


def test_rolling_hashes_past_the_table_of_powers(monkeypatch):
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**63, 5000).astype(np.uint64)
    places = rng.integers(0, 4000, 300)
    whole = arrays.Rolling(codes).hashes(places, places + 777)
    monkeypatch.setattr(arrays, "POWER_BITS", 8)
    monkeypatch.setattr(arrays, "POWER_SIZE", 256)
    arrays._powers.cache_clear()
    try:
        assert (arrays.Rolling(codes).hashes(places, places + 777) == whole).all()
        assert arrays.Rolling(codes[:256]).hashes(np.array([0]), np.array([256])) == arrays.Rolling(codes).hashes(np.array([0]), np.array([256]))
    finally:
        arrays._powers.cache_clear()
