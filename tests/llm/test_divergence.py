"""Quality rules against plain loops, references against numpy, and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import divergence, queries
from tidemark.llm.shipping import ship

SF = "/root/testdata/sf0.001"


def counts(text):
    """The contract's counts, by loops."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, t in enumerate(zip(words, words[1:], words[2:])) if triples[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def classes(text):
    found = [0] * divergence.N_CLASSES
    names = list(divergence.CLASSES)
    for c in text:
        name = next((n for n, b in divergence.CLASSES.items() if ord(c) < 128 and ord(c) in b), "high" if ord(c) > 127 else None)
        found[names.index(name) if name else divergence.OTHER] += 1
    return found


def shares(text, lang):
    listed = divergence.COMMON[lang]
    words = [w.lower().strip(divergence.EDGES) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    hits = [words.count(w) for w in listed]
    return np.array([*hits, len(words) - sum(hits)])


def jensen_shannon(p, q, total):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
    return np.sqrt(max(0.0, (kl(p) + kl(q)) / 2 - (len(q) - 1) / (8 * total * np.log(2))))


def prose(rng, lang, n):
    listed = divergence.COMMON[lang]
    return " ".join(rng.choice(listed) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_counts_equal_loops(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    found = queries.QUERIES["op12_divergence"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        n, *rest = counts(texts[r.doc_id])
        assert tuple(r)[1:6] == (n, *rest)
        assert r.base_failed == (n < 50 or 100 * rest[3] > 50 * n)
        assert r.kept == (not r.base_failed and (r.divergence or 0) <= 1)


def test_measures_of_odd_texts():
    texts = ["", None, "a", "a\na\n\n a\na", "é東 🎉 # <b>\x00", "x y z x y z", "a\r\na\r\na\n", "\n\n\n", "A! a, (a) THE the", "w " * 70]
    known = divergence.Lists(divergence.COMMON)
    together = divergence.measures(pa.array(texts), known)
    for i, text in enumerate(texts):
        assert tuple(together[0][i]) == counts(text)
        assert together[1][i][: divergence.N_CLASSES].tolist() == classes(text or "")
        assert (together[1][i][divergence.N_CLASSES :][known.parts["en"]] == shares(text or "", "en")[:-1]).all()
        alone = divergence.measures(pa.array([text], pa.string()), known)
        assert (alone[0][0] == together[0][i]).all() and (alone[1][0] == together[1][i]).all()


def test_verdicts_equal_plain_jensen_shannon(spark):
    rng = random.Random(3)
    rows = [(i, lang, prose(rng, lang, rng.randrange(40, 300))) for i in range(120) for lang in ("en", "de")]
    rows += [(900 + i, "en", rows[0][2]) for i in range(200)]  # copies count once
    rows += [(2000 + i, "en", " | ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(100))) for i in range(5)]
    rows += [(3000, "de", prose(rng, "en", 200)), (3001, None, "| " * 10 + "x1 " * 1 + prose(rng, "en", 60).upper()), (3002, "xx", "$%& " * 100)]
    frame = ship(spark).createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    found = {r.doc_id * 10 + (r.lang == "de"): r for r in divergence.judge(frame, ["doc_id", "lang"]).collect()}
    assert len(found) == len(rows)
    references = {}
    for lang in ("en", "de"):
        usable = {t for _, x, t in rows if x == lang and counts(t)[0] >= 50 and 2 * counts(t)[4] <= counts(t)[0]}
        mean = lambda f: np.mean([np.array(f(t)) / sum(f(t)) for t in usable], 0)
        references[lang] = mean(classes), mean(lambda t: shares(t, lang))
    for doc, lang, text in rows:
        r = found[doc * 10 + (lang == "de")]
        n = counts(text)[0]
        failed = n < 50 or 2 * counts(text)[4] > n
        assert r.base_failed == failed
        if lang not in references:
            assert r.divergence is None and r.kept == (not failed)
            continue
        ratios = []
        for name, (kinds, words) in references.items():
            one = jensen_shannon(np.array(classes(text)), kinds, len(text)) / divergence.CLASS_DISTANCE if len(text) >= divergence.MIN_CHARS else 0
            two = jensen_shannon(shares(text, name), words, n) / divergence.WORD_DISTANCE if n >= divergence.MIN_WORDS else 0
            ratios.append(max(one, two))
        assert r.divergence == pytest.approx(min(ratios), abs=2e-3)
        assert r.kept == (not failed and r.divergence <= 1)
    assert np.mean([found[d * 10].kept for d in range(120) if not found[d * 10].base_failed]) > 0.95
    assert not any(found[(2000 + i) * 10].kept for i in range(5))


def test_labels_agree_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op12_divergence"](spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").filter("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.15


def test_odd_rows_and_names(spark):
    ship(spark)
    rows = [(None, None, None, 1), (1, "", "en", 2), (1, "", "en", 3), (2, "w " * 200_000, "en", 4), (3, "a b " * 3 + " ".join(map(str, range(90))), "en", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, Kept int")
    found = {r.Kept: r for r in divergence.judge(frame, ["doc_id", "Kept"]).collect()}
    assert len(found) == 5 and [found[i].kept_ for i in range(1, 6)] == [False, False, False, False, True]
    assert found[5].divergence is None and found[4].n_repeat_words == 200_000  # no reference: base rules alone
    assert divergence.judge(frame.limit(0), ["doc_id"]).count() == 0
    clash = frame.select("doc_id", "text", "lang", frame.Kept.alias("digest"), frame.Kept.alias("histogram"), frame.Kept.alias("t"))
    assert divergence.judge(clash, ["digest", "histogram", "t"]).count() == 5
