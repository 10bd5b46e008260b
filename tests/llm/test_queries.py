"""Queries that SQL can answer against DuckDB, and the others against brute force, over whole tables."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences
from test_bagminhash import brute as near_classes
from test_decontaminate import brute as leaks
from test_repeats import brute as windows
from test_winnowing import wanted as edited

from tidemark.llm import queries
from tidemark.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


def test_fingerprints(spark, texts):
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op2_winnowing")} == dict(edited(list(texts.items())))


def test_tokens(spark, texts):
    with open(public_tokenizers.path(queries.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: tuple(r)[1:] for r in rows(spark, "op3_byte_bpe")}
    for doc, text in texts.items():
        ids = library.encode_ordinary(text)
        joined = " ".join(map(str, ids))
        assert found[doc] == (len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_repeated_words(spark, texts):
    units = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts.values()]
    wanted = {
        doc: (len(u), int(g.sum()), hashlib.sha256(" ".join(np.array(u, object)[~g]).encode()).hexdigest())
        for doc, u, g in zip(texts, units, windows(units, 35))}
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op5_recompression")} == wanted


def test_repeated_bytes(spark, texts):
    units = [t.encode() for t in texts.values()]
    seen, wanted = {}, {}
    for n, data in enumerate(units):
        for i in range(len(data) - 199):
            seen[hash(data[i : i + 200])] = seen.get(hash(data[i : i + 200]), 0) + 1
    for doc, data in zip(texts, units):
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 199):
            if seen[hash(data[i : i + 200])] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
        wanted[doc] = (len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op6_suffix_levels")} == wanted


def test_benchmark_leaks(spark, texts):
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    wanted = leaks(list(texts.items()), items)
    found = {(r.doc_id, r.item_id): r.similarity for r in rows(spark, "op7_simhash_leaks")}
    assert found == pytest.approx(wanted) and wanted


def test_near_duplicates(spark, texts):
    wanted = near_classes(list(texts.items()))
    assert {r.doc_id: r.class_id for r in rows(spark, "op8_bagminhash")} == {doc: wanted[i] for i, doc in enumerate(texts)}


def test_url_verdicts(spark):
    from test_linkgraph import decided, parts

    found = rows(spark, "op10_link_trust")
    urls = {r.page_id: r.url for r in queries.table(spark, SF, "pages").collect()}
    assert len(found) == len(urls)
    for r in found:
        assert (r.host, r.path) == parts(urls[r.page_id])
        rule = decided(r.host, r.path, queries.URL_RULES)
        assert r.rule == (rule.name if rule else None)
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")
