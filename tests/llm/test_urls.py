"""URL filters against brute force."""

from __future__ import annotations

import re

from tradelanes.llm import urls
from tradelanes.llm.queries import ALLOW, BLOCK


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in (*ALLOW, *BLOCK) if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len, default=None)


URLS = [
    "http://a.com/x", "https://EXAMPLE.com/en/1?q=/en/", "https://www.example.com/en/1", "https://sub.www.Example.com/en/#x", "http://example.com/enx", "http://example.com",
    "http://com/", "http://x.net/es/", "http://x.net/es", "http://x.net/fr/a?b", "http://xnet/fr/", "http://net/fr/", "http://x.org/en/", "no scheme", "", None, "http:///es/", "a://b://c/d",
    "http://x.net?/es/", "HTTP://ÄÖ.NET/es/", "http://x.com:80/", "http://x.com./",
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, rule string")


def test_rules(spark):
    frame = pages(spark, [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], None), (None, URLS[7], None)])
    rows = urls.judge(frame, urls.as_rules(spark, ALLOW, BLOCK)).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[7] if r.page_id is None else URLS[r.page_id]
        host, path, rule = plain(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        if rule:
            assert r.verdict == ("allow" if rule in ALLOW else "block")


def plain_scores(edges, trust, distrust, damping, rounds):
    hosts = sorted({h for e in edges for h in e[:2]} | set(trust))
    out = []
    for links, seed in (([(a, b, n) for a, b, n in edges], trust), ([(b, a, n) for a, b, n in edges], distrust)):
        links = links + [(h, h, 1) for h in hosts]
        total = {h: sum(n for a, _, n in links if a == h) for h in hosts}
        start = {h: seed.get(h, 0) / sum(seed.values()) for h in hosts}
        rank = dict(start)
        for _ in range(rounds):
            rank = {h: (1 - damping) * start[h] + damping * sum(rank[a] * n / total[a] for a, b, n in links if b == h) for h in hosts}
        out.append({h: r * len(hosts) for h, r in rank.items()})
    return out


def test_scores(spark):
    edges = [("a", "b", 3.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "spam", 5.0), ("d", "a", 1.0), ("spam", "e", 1.0)]
    trust, distrust = {"a": 1.0, "b": 0.5}, {"spam": 1.0, "a": 0.25}
    seeds = spark.createDataFrame([(h, trust.get(h, 0.0), distrust.get(h, 0.0)) for h in "a b c d spam f".split()], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in urls.scores(spark.createDataFrame(edges, "src string, dst string, n double"), seeds, tolerance=1e-11).collect()}
    right = plain_scores(edges, {h: trust.get(h, 0) for h in "a b c d spam f".split()}, distrust, urls.DAMPING, 200)
    assert set(got) == set(right[0])
    for h, (t, d) in got.items():
        assert abs(t - right[0][h]) < 1e-9 and abs(d - right[1][h]) < 1e-9


def test_scores_travel_any_way(spark):
    """A way of 40 links: the score reaches its end, and stands still at the default tolerance."""
    hosts = [f"h{i:02d}" for i in range(41)]
    edges = [(a, b, 1.0) for a, b in zip(hosts, hosts[1:])]
    seeds = spark.createDataFrame([(h, float(h == "h00"), float(h == "h40")) for h in hosts], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in urls.scores(spark.createDataFrame(edges, "src string, dst string, n double"), seeds).collect()}
    right = plain_scores(edges, {"h00": 1.0, **dict.fromkeys(hosts[1:], 0)}, {"h40": 1.0}, urls.DAMPING, 400)
    assert got["h40"][0] > 0 and got["h00"][1] > 0
    assert all(abs(got[h][k] - right[k][h]) < 2 * urls.TOLERANCE for h in hosts for k in (0, 1))


def test_very_long_url_and_html(spark):
    long = "http://long.com/" + "p" * 100_000
    html = "<p>" + "x " * 200_000 + '<a href="http://bad.net/es/1">'
    rows = [(1, long, html), (2, "http://bad.net/es/1", ""), (3, "http://far.org/" + "?" * 50_000, None)]
    got = {r.page_id: (r.host, len(r.path), r.verdict) for r in urls.judge(pages(spark, rows), urls.as_rules(spark, ALLOW, BLOCK)).collect()}
    assert got[1] == ("long.com", 100_001, "allow") and got[2][2] == "block" and got[3][:2] == ("far.org", 1)


def test_hosts_that_link_to_blocked_ones_are_blocked(spark):
    link = '<a href="http://bad.net/es/1">x</a> <A HREF = //Bad.net/fr/2>y</A> <a href="/local">z</a>'
    rows = [(i, f"http://bad.net/es/{i}", "") for i in range(5)] + [(10 + i, f"http://farm{i}.org/p", link) for i in range(3)]
    rows += [(20 + i, f"http://good{i}.com/p", f'<a href="http://fine{i}.org/">') for i in range(20)] + [(50 + i, f"http://fine{i}.org/q", None) for i in range(20)]
    got = {r.page_id: r.verdict for r in urls.judge(pages(spark, rows), urls.as_rules(spark, ALLOW, BLOCK)).collect()}
    assert {got[i] for i in (10, 11, 12)} == {"block"}
    assert {got[50 + i] for i in range(20)} == {"allow"}


def test_no_pages(spark):
    assert urls.judge(pages(spark, []), urls.as_rules(spark, ALLOW, BLOCK)).count() == 0
