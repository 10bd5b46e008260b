"""One query per operator over the training-data tables, and their SQL where SQL can ask the same."""

from __future__ import annotations

from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bagminhash, bpe, decontaminate, divergence, linkgraph, periods, quality, recompression, suffix_levels, toxicity, warc, whitening,
    winnowing,
)
from tidemark.llm.shipping import ship
from tidemark.scratch import Scratch

RANKS = "byte_bpe_50k.tiktoken"
QUALITY_THRESHOLD, TOXICITY_THRESHOLD = 0.3, 0.7
URL_RULES = [
    linkgraph.Rule("block", "net", "/"),
    linkgraph.Rule("allow", "example.net", "/en/"),
    linkgraph.Rule("block", "example.com", "/de/"),
    linkgraph.Rule("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _remainder(column, divisor):
    """crc32 of the id as text, modulo; a null id has none and was never learnt from."""
    return F.crc32(column.cast("string").cast("binary")) % divisor


def quality_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = Scratch(spark).keep(quality.with_statistics(docs).drop("text"), "statistics")
    held_out = F.coalesce(_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "quality")
    model = quality.fit(known.join(labels, "doc_id"), "quality")
    return quality.with_scores(known, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, "toxic")
    return toxicity.with_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"))


def winnowed(spark, sf_dir):
    return winnowing.against_next(table(spark, sf_dir, "documents"))


def byte_bpe(spark, sf_dir):
    path = public_tokenizers.path(RANKS)
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return bpe.decode(coded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def warc_revisits(spark, sf_dir):
    folder = f"{Scratch(spark).root}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder)
    read = records.select(
        "page_id", "record_type", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("payload").isNull(), F.col("payload_digest")).otherwise(warc.base32_sha1(F.col("payload"))).alias("payload_digest"))
    return warc.resolved(Scratch(spark).keep(read, "heads"))


def _word_digest(n_words, kept):
    return n_words, n_words - len(kept), sha256(b" ".join(kept)).hexdigest()


def repeated_words(spark, sf_dir):
    fields = [("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return recompression.deduplicate(docs, ["doc_id"], result=(fields, _word_digest))


def _byte_digest(n_bytes, n_removed, n_spans, kept):
    return n_bytes, n_removed, n_spans, sha256(kept).hexdigest()


def repeated_bytes(spark, sf_dir):
    fields = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_levels.deduplicate(docs, ["doc_id"], result=(fields, _byte_digest))


def benchmark_leaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item_id").alias("item_id"), F.col("leak.similarity").alias("similarity"), F.col("leak.word").alias("word"))


def near_duplicates(spark, sf_dir):
    return bagminhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def link_trust(spark, sf_dir):
    return linkgraph.judge(table(spark, sf_dir, "pages"), URL_RULES)


def whitened(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), ["vec_id"])


def diverging(spark, sf_dir):
    return divergence.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def with_periodic_tails(docs):
    """Of one document in ten, by the hash of its id, the words from one place on repeat with one period. A null id has no hash."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    docs = docs.select("doc_id", "text", g.alias("g"), F.when(chosen, split).alias("words"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.expr("g % nullif(n, 0)")).withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    tail = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)])), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def periodic_runs(spark, sf_dir):
    docs = with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.with_runs(docs).drop("text")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_quality": quality_scores,
    "op2_winnowing": winnowed,
    "op3_byte_bpe": byte_bpe,
    "op4_warc": warc_revisits,
    "op5_recompression": repeated_words,
    "op6_suffix_levels": repeated_bytes,
    "op7_simhash_leaks": benchmark_leaks,
    "op8_bagminhash": near_duplicates,
    "op9_toxicity": toxicity_scores,
    "op10_link_trust": link_trust,
    "op11_whitening": whitened,
    "op12_divergence": diverging,
    "op13_periodic_runs": periodic_runs,
}
