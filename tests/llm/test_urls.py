"""Verdicts against rules and a PageRank in plain Python."""

import random
from collections import defaultdict

import pytest

from basketweave.llm import urls
from basketweave.llm.queries import RULES
from tests.llm.conftest import with_clashes

PAGE = "page_id BIGINT, url STRING, html STRING"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def rule(host, path):
    fits = [
        r
        for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


ODD = [
    None, "", "no scheme", "http://", "http://A.Com", "HTTP://a.com/x?y#z", "x://y.net/es/1#/", "http://net/fr/",
    "a://b://c.net/es/", "https://WWW.Example.COM/en/1", "http://example.com/en/2", "http://sub.example.com/en/",
    "http://notexample.com/en/", "http://É.net/fr/é?q", "http://x.org?a://b", "http://x.org#/en/", "http://com/",
    "http://example.com/EN/", "//x.com/", "http://x.com\n/a\nb",
]


def test_hosts_paths_and_rules(spark, ws):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(ODD)], PAGE)
    found = {r["page_id"]: r for r in urls.judge(pages, ws, RULES).collect()}
    assert len(found) == len(ODD)
    for i, u in enumerate(ODD):
        host, path = parts(u)
        best = rule(host, path)
        assert (found[i]["host"], found[i]["path"]) == (host, path), u
        assert found[i]["rule"] == (best.text if best else None), u
        if best:
            assert found[i]["verdict"] == best.verdict


def plain_rank(seeds, links, reverse):
    """Personalised PageRank by power iteration, to convergence."""
    hosts = set(seeds) | {h for e in links for h in e}
    total = sum(seeds.values())
    start = {h: seeds.get(h, 0) / total for h in hosts}
    out = defaultdict(list)
    for (a, b), n in links.items():
        out[b if reverse else a].append((a if reverse else b, n))
    rank = dict(start)
    for _ in range(300):
        new, lost = defaultdict(float), 0.0
        for h in hosts:
            if not out[h]:
                lost += rank[h]
            for other, n in out[h]:
                new[other] += rank[h] * n / sum(m for _, m in out[h])
        rank = {h: 0.85 * (new[h] + lost * start[h]) + 0.15 * start[h] for h in hosts}
    return rank


@pytest.fixture(scope="module")
def web():
    rng = random.Random(12)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("com", "net", "org")]
    rows = []
    for i in range(200):
        host = rng.choice(hosts)
        path = rng.choice(["/en/1", "/fr/2", "/es/3"])
        links = "".join(
            rng.choice([f'<a href="http://{h}/x">', f"<a HREF = '//{h}'>", f"<a href=https://{h}?q>", '<a href="/own">'])
            for h in rng.choices(hosts, k=rng.randint(0, 4))
        )
        rows.append((i, f"http://{host}{path}", links))
    return rows


def test_propagation(spark, ws, web, monkeypatch):
    monkeypatch.setattr(urls, "MAX_ROUNDS", 60)
    pages = spark.createDataFrame(web, PAGE)
    links, good, bad = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in urls.host_links(pages).collect():
        links[r["src"], r["dst"]] += r["n"]
    expected = defaultdict(int)
    import re

    for _, u, html in web:
        src = parts(u)[0]
        for link in re.findall(urls.LINK[4:], html, re.I):
            dst = parts("x:" + link if link.startswith("//") else link)[0]
            if dst and dst != src:
                expected[src, dst] += 1
        best = rule(*parts(u))
        (good if best and best.verdict == "allow" else bad)[src] += bool(best)
    assert links == expected and len(links) > 100
    trust, distrust = plain_rank(good, links, False), plain_rank(bad, links, True)
    for r in urls.judge(pages, ws, RULES).collect():
        if r["rule"] is None:
            t, d = trust[r["host"]], distrust[r["host"]]
            if abs(t - d) > 1e-5:
                assert r["verdict"] == ("block" if d > t else "allow")


def test_a_long_chain_converges(spark, ws):
    """Production parameters; the chain ends at a blocked host."""
    chain = [f"h{i}.org" for i in range(30)]
    rows = [(i, f"http://{h}/", f'<a href="http://{n}/">') for i, (h, n) in enumerate(zip(chain, [*chain[1:], "bad.net"]))]
    rows += [(30, "http://bad.net/es/1", ""), (31, "http://good.com/", ""), (32, "http://alone.org/", "")]
    found = {r["host"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, PAGE), ws, RULES).collect()}
    assert found == {**dict.fromkeys([*chain, "bad.net"], "block"), "good.com": "allow", "alone.org": "allow"}


def test_odd_tables(spark, ws, web):
    pages = with_clashes(spark.createDataFrame([*web[:20], *web[:3], (None, "http://a.net/en/", None)], PAGE))
    assert urls.judge(pages, ws, RULES).count() == 24
    assert urls.judge(pages.limit(0), ws, RULES).collect() == []
    free = urls.judge(pages, ws, []).collect()
    assert {(r["rule"], r["verdict"]) for r in free} == {(None, "allow")}
    plan = urls.judge(pages, ws, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_relative_links_name_no_host(spark, ws):
    """An address in the query or the path of a link is not where the link goes."""
    html = " ".join(
        f'<a href="{u}">x</a>'
        for u in ("/go?u=http://bad.net/es/", "next//bad.net/es/", "?//bad.net", "#http://bad.net/es/")
    )
    out = '<a href="//far.org/x"></a><a href="HTTPS://Far.org/y"></a>'
    pages = spark.createDataFrame(
        [(1, "http://a.org/", html), (2, "http://bad.net/es/", None), (3, "http://b.org/", out)], PAGE
    )
    links = [tuple(r) for r in urls.host_links(pages).collect()]
    assert links == [("b.org", "far.org", 2)]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(pages, ws, RULES).collect()}
    assert found == {1: "allow", 2: "block", 3: "allow"}
