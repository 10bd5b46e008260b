"""URL rules, and trust and distrust spread over the host graph.

Pages that a rule decides keep its verdict. The others take their host's: hosts whose pages are
mostly allowed by rules are seeds of trust, which flows along links; hosts mostly blocked are seeds
of distrust, which flows against links, to those that link to them. Scores are damped walks from
the seeds. A host's distrust counts the share of its own links, so it is the same however many
others link to the same blocked host; trust is split among the links of the host that gives it.
Both are judged as shares: what a host receives, over what it would receive if every host were a
seed; a seed has one more. Shares and the threshold mean the same at every graph size and degree.
A host is blocked when its distrust exceeds its trust and the threshold. Hosts without links or
seeds have no share and are allowed.

Everything is built-in DataFrame work. Links are counted per host pair before anything is joined,
so the iterated tables have a row per host pair and host, not per page; every few rounds the
scores are written to shared storage to cut their lineage.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule. Links
without a host stay on their page's host and are no edges. Repeated rows are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Scratch

DAMPING = 0.85
ROUNDS = 20
STORED_EVERY = 5
SEED_SHARE = 0.5  # of a host's pages that rules must block (or allow) to make it a seed
THRESHOLD = 0.05
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self):
        return self.host + self.path

    def fits(self, host, path):
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url):
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every page with ``host, path, rule, verdict``; the longest rule that fits wins, by name on a tie."""
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path})
    verdict = rule = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "verdict": verdict})


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: how often the pages of one host link to another."""
    source, _ = host_and_path(F.col("url"))
    links = pages.select(source.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link"))
    links = links.withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    target, _ = host_and_path(F.regexp_extract("link", r"(?i)^(https?://.*)$", 1))
    links = links.select("src", target.alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def seeds(judged: DataFrame, share: float = SEED_SHARE) -> DataFrame:
    """``kind, node``: hosts of which rules allow (trust) or block (distrust) at least ``share`` of the pages."""
    of = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, 1).otherwise(0)) / F.count(F.lit(1)) >= share
    hosts = judged.filter("host <> ''").groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))
    kinds = F.array(*[F.when(F.col(kind), F.lit(kind)) for kind in ("trust", "distrust")])
    return hosts.select(F.explode(F.array_compact(kinds)).alias("kind"), F.col("host").alias("node"))


def moved(ways: DataFrame, scores: DataFrame, values: list[str], damping: float) -> DataFrame:
    """What each node receives in one round, a row per way."""
    return ways.join(scores, ["kind", "node"]).select(
        "kind", F.col("dst").alias("node"), *[(F.lit(damping) * F.col(v) * F.col("part")).alias(v) for v in values])


def carried(ways: DataFrame, origin: DataFrame, values: list[str], scratch: Scratch, rounds: int, damping: float) -> DataFrame:
    """``kind, node`` and ``values`` after ``rounds`` of propagation of ``origin``."""
    scores = origin
    for step in range(1, rounds + 1):
        scores = origin.unionAll(moved(ways, scores, values, damping)).groupBy("kind", "node").agg(*[F.sum(v).alias(v) for v in values])
        if step % STORED_EVERY == 0:
            scores = scratch.keep(scores, "scores")
    return scores


def spread(links: DataFrame, start: DataFrame, scratch: Scratch, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``kind, node, score``: personalised PageRank after ``rounds`` of propagation from the seeds in ``start``."""
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionAll(
        links.select(F.lit("distrust"), "dst", "src", "links"))
    out = ways.groupBy("kind", "src").agg(F.sum("links").alias("out"))
    ways = ways.join(out, ["kind", "src"]).select("kind", F.col("src").alias("node"), "dst", (F.col("links") / F.col("out")).alias("part"))
    ways = scratch.keep(ways, "ways")
    origin = scratch.keep(start.select("kind", "node", F.lit(1.0 - damping).alias("score")), "seeds")
    return carried(ways, origin, ["score"], scratch, rounds, damping)


def shares(links: DataFrame, start: DataFrame, scratch: Scratch, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``kind, node, share``: what each host receives from the seeds, of what it would if all hosts were seeds.

    Both kinds weigh a link by its part of the linking host's links, so distrust does not get thinner
    with the number of hosts that link to a seed. A seed has 1 more than its share.
    """
    values = ["score", "most"]
    links = scratch.keep(links, "links")
    start = scratch.keep(start.select("kind", "node"), "seeds")
    out = links.groupBy("src").agg(F.sum("links").alias("out"))
    parts = links.join(out, "src").select("src", "dst", (F.col("links") / F.col("out")).alias("part"))
    ways = parts.select(F.lit("trust").alias("kind"), F.col("src").alias("node"), "dst", "part").unionAll(
        parts.select(F.lit("distrust"), "dst", F.col("src"), "part"))
    ways = scratch.keep(ways, "ways")
    one, none = F.lit(1.0 - damping), F.lit(0.0)
    every = ways.select("kind", "node").unionAll(ways.select("kind", "dst")).distinct()
    origin = every.select("kind", "node", none.alias("score"), one.alias("most")).unionAll(start.select("kind", "node", one, none))
    origin = scratch.keep(origin.groupBy("kind", "node").agg(*[F.sum(v).alias(v) for v in values]), "origin")
    scores = carried(ways, origin, values, scratch, rounds - 1, damping)
    received = moved(ways, scores, values, damping).groupBy("kind", "node").agg((F.sum("score") / F.sum("most")).alias("share"))
    return received.unionAll(start.select("kind", "node", F.lit(1.0))).groupBy("kind", "node").agg(F.sum("share").alias("share"))


def judge(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    scratch = Scratch(pages.sparkSession)
    judged = ruled(pages.select("page_id", "url"), rules).drop("url")
    found = shares(host_links(pages), seeds(judged), scratch)
    share = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("share")).otherwise(0.0))
    blocked = found.groupBy("node").agg(share("trust").alias("trust"), share("distrust").alias("distrust"))
    blocked = blocked.filter(f"distrust > trust and distrust > {threshold}").select(F.col("node").alias("host"), F.lit("block").alias("spread"))
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "spread", F.lit("allow")).alias("verdict"))
