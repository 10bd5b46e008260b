"""URL rules and propagation, against brute force."""

import random

import pytest

from tidemark.llm import linkgraph
from tidemark.llm.linkgraph import Rule
from tidemark.llm.queries import URL_RULES
from tidemark.scratch import Scratch


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host_end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:host_end], rest[host_end:]
    path_end = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:path_end]


def decided(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.name), r.name), default=None)


URLS = [
    "http://A.Example.NET/en/x", "http://example.net/en/", "http://example.net/en", "http://example.net", "https://x.net?/en/",
    "http://notexample.net/en/1", "http://a.example.com/de/1#f", "http://example.com/fr/", "http://b.org/fr/", "http://org/fr/1?q",
    "ftp://É.Net/", None, "", "no scheme", "a://b://c/d", "http:///p", "http://x.net/a\nb?c",
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    for r in linkgraph.ruled(pages, URL_RULES).collect():
        assert (r.host, r.path) == parts(r.url)
        rule = decided(r.host, r.path, URL_RULES)
        assert (r.rule, r.verdict) == ((rule.name, rule.verdict) if rule else (None, None)), r.url


def brute(links, start, rounds):
    out = {}
    for kind in ("trust", "distrust"):
        edges = [(a, b, n) if kind == "trust" else (b, a, n) for (a, b), n in links.items()]
        total = {}
        for a, _, n in edges:
            total[a] = total.get(a, 0) + n
        origin = {h: 1 - linkgraph.DAMPING for h in start[kind]}
        score = dict(origin)
        for _ in range(rounds):
            fresh = dict(origin)
            for a, b, n in edges:
                if a in score:
                    fresh[b] = fresh.get(b, 0) + linkgraph.DAMPING * score[a] * n / total[a]
            score = fresh
        out |= {(kind, h): s for h, s in score.items()}
    return out


def test_spread_equals_brute_force(spark):
    rng = random.Random(5)
    hosts = [f"h{i}" for i in range(12)]
    links = {}
    for _ in range(40):
        a, b = rng.sample(hosts, 2)
        links[a, b] = links.get((a, b), 0) + rng.randint(1, 3)
    start = {"trust": ["h1", "h2"], "distrust": ["h3"]}
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, links long")
    seeds = spark.createDataFrame([(k, h) for k, v in start.items() for h in v], "kind string, node string")
    found = linkgraph.spread(edges, seeds, Scratch(spark), rounds=7).collect()
    wanted = brute(links, start, 7)
    assert {(r.kind, r.node) for r in found} == set(wanted)
    for r in found:
        assert r.score == pytest.approx(wanted[r.kind, r.node])


def test_distrust_flows_to_hosts_that_link_to_blocked_ones(spark):
    rules = [Rule("block", "bad", "/"), Rule("allow", "good", "/")]
    link = '<p><A class=x href="http://{}/">t</a> <a href=/own>o</a> <a href="//good/x">g</a>'
    rows = [(1, "http://bad/", ""), (2, "http://fan/", link.format("BAD").replace("//good/x", "#")), (3, "http://good/", link.format("friend")),
            (4, "http://friend/", None), (5, "http://alone/", ""), (6, None, None), (5, "http://alone/", "")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, verdict string")
    found = {r.page_id: r.verdict for r in linkgraph.judge(pages, rules).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    links = {tuple(r) for r in linkgraph.host_links(pages).collect()}
    assert links == {("fan", "bad", 1), ("good", "friend", 1)}
    assert linkgraph.judge(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("linkers", [3, 100, 3000])
def test_distrust_does_not_thin_out_with_the_linkers_of_a_blocked_host(spark, linkers):
    rules = [Rule("block", "bad", "/"), Rule("allow", "good", "/")]
    to = lambda *hosts: "".join(f'<a href="http://{h}/">t</a>' for h in hosts)
    pages = [("bad", ""), ("good", to("friend", "fan0x")), ("far", to("fan0")), ("friend", to("bad", "good")),
             ("mixed", to("bad", "obscure")), ("rarely", to("bad", *[f"other{i}" for i in range(40)]))]
    pages += [(f"fan{i}", to("bad")) for i in range(linkers)]
    pages = spark.createDataFrame([(f"http://{h}/", h, html) for h, html in pages], "url string, page_id string, html string")
    found = {r.page_id: r.verdict for r in linkgraph.judge(pages, rules).collect()}
    wanted = {"bad": "block", "good": "allow", "far": "block", "friend": "allow", "mixed": "block", "rarely": "allow"}
    assert found == wanted | {f"fan{i}": "block" for i in range(linkers)}


def test_shares_equal_brute_force(spark):
    rng = random.Random(6)
    links = {}
    for _ in range(40):
        a, b = rng.sample([f"h{i}" for i in range(12)], 2)
        links[a, b] = links.get((a, b), 0) + rng.randint(1, 3)
    start = {"trust": ["h1", "h2"], "distrust": ["h3", "unlinked"]}
    out = {}
    for (a, _), n in links.items():
        out[a] = out.get(a, 0) + n
    wanted = {(k, h): 1.0 for k, v in start.items() for h in v}
    for kind in start:
        edges = [(*((a, b) if kind == "trust" else (b, a)), n / out[a]) for (a, b), n in links.items()]
        received = []
        for origin in (start[kind], {h for pair in links for h in pair}):
            score = dict.fromkeys(origin, 1.0)
            for _ in range(7):
                got = {}
                for a, b, part in edges:
                    got[b] = got.get(b, 0) + linkgraph.DAMPING * score.get(a, 0) * part
                score = {h: (h in origin) + got.get(h, 0) for h in {*origin, *got}}
            received.append(got)
        for h, most in received[1].items():
            wanted[kind, h] = wanted.get((kind, h), 0) + received[0].get(h, 0) / most
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, links long")
    seeds = spark.createDataFrame([(k, h) for k, v in start.items() for h in v], "kind string, node string")
    found = {(r.kind, r.node): r.share for r in linkgraph.shares(edges, seeds, Scratch(spark), rounds=7).collect()}
    assert found == pytest.approx(wanted)
