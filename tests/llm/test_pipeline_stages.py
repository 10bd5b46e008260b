"""The five stages over a small corpus, each against a plain version on its own input."""

import re

import numpy as np
import pytest
from test_bagminhash import brute as near_classes
from test_bpe import library  # noqa: F401
from test_decontaminate import brute as leaks
from test_repeats import brute as windows

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), queries.table(spark, SF, "documents"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{number}")
        out.append((docs.collect(), spark.read.parquet(f"{folder}/{number}").collect()))
        docs = spark.read.parquet(f"{folder}/{number}")
    return out


def test_all_but_the_last_keep_the_columns(steps):
    for _, after in steps[:-1]:
        assert list(after[0].asDict()) == corpus_pipeline.COLUMNS


def test_quality_stage_keeps_good_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in steps[0][1]}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert np.mean([d in kept for d in good]) > 0.95 and np.mean([d in kept for d in bad]) < 0.2


def test_near_dedup_stage(steps):
    before, after = steps[1]
    rows = [(r.doc_id, r.text) for r in before]
    assert sorted(r.doc_id for r in after) == sorted(set(near_classes(rows).values()))


def test_substring_stage(steps):
    before, after = steps[2]
    units = [re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in before]
    wanted = {r.doc_id: " ".join(np.array(u, object)[~g]) for r, u, g in zip(before, units, windows(units, 35))}
    assert {r.doc_id: r.text for r in after} == wanted
    assert all(r.n_chars == len(r.text) for r in after)


def test_decontamination_stage(spark, steps):
    before, after = steps[3]
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    leaked = {doc for doc, _ in leaks([(r.doc_id, r.text) for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - leaked


def test_token_stage(steps, library):  # noqa: F811
    before, after = steps[4]
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: library.encode_ordinary(r.text) for r in before}
    assert all(r.exact and r.n_tokens == len(r.ids) for r in after)


def test_run_is_the_stages_one_after_the_other(spark, steps):
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in steps[-1][1])


def test_extra_columns_nulls_and_empty_tables(spark):
    docs = queries.table(spark, SF, "documents").selectExpr("*", "1 AS statistics", "'x' AS Score", "0 AS row", "'' AS kept", "0 AS leaks")
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "", 0, "", 0), (900001, "", "en", "s", 0, 1, "", 0, "", 0)], docs.schema)
    for docs in (docs.unionAll(odd), docs.limit(0)):
        expected = docs.count() > 0
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert (docs.count() > 0) == expected
