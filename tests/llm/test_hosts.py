from __future__ import annotations

import math

from snapstrata.llm import host_reputation
from snapstrata.llm.queries import URL_RULES

RULES = [(r.host, r.path, r.verdict) for r in URL_RULES]


def strength(children):
    counted = [c for c in children if c[0] > 0]
    most = sum(m * (1 - m) * (n - 1) for n, _, m in counted)
    rho = sum(n * (k / n - m) ** 2 - m * (1 - m) for n, k, m in counted) / most if most else 0.001
    return 1 / max(0.001, min(0.5, rho)) - 1


def lower_bounds(pages, two_label=("co.uk",)):
    """Host to lower bound of the bad rate; pages are (host, bad or None)."""
    def suffix(host):
        two = ".".join(host.split(".")[-2:])
        return two if two in two_label else host.split(".")[-1]

    def domain(host):
        return ".".join(host.split(".")[-(suffix(host).count(".") + 2) :])

    def counts(name):
        out = {}
        for host, bad in pages:
            if host or name is None:
                key = name(host) if name else ""
                n, k = out.get(key, (0, 0))
                out[key] = (n + (bad is not None), k + bool(bad))
        return out

    n, k = counts(None).get("", (0, 0))
    parent, m = {None: (k + 1) / (n + 2)}, (k + 1) / (n + 2)
    bounds = {"": (k + 1, n - k + 1)}
    above = lambda _: m
    for name, upper in ((suffix, lambda x: None), (domain, suffix), (lambda h: h, domain)):
        own = counts(name)
        rows = {x: (n, k, parent[upper(x)]) for x, (n, k) in own.items()}
        s = strength(rows.values())
        post = {x: (k + s * m, n - k + s * (1 - m)) for x, (n, k, m) in rows.items()}
        parent = {x: a / (a + b) for x, (a, b) in post.items()}
    bounds |= post
    return {x: a / (a + b) - 1.645 * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) for x, (a, b) in bounds.items()}


def test_url_parts(spark):
    rows = [
        ("http://A.Example.NET/en/1?q#f", "a.example.net", "/en/1"), ("https://x.org", "x.org", ""), ("ftp://h?q/p", "h", ""), ("h://É.COM#/x", "É.com", ""),
        (None, "", ""), ("no scheme/x", "", ""), ("://", "", ""), ("a://b://c/d", "b:", "//c/d"), ("", "", ""),
    ]
    frame = spark.createDataFrame([r[:1] for r in rows], "url string")
    got = frame.select("url", *host_reputation.url_parts(frame.url)).collect()
    assert [tuple(r) for r in got] == rows


def test_domains_and_suffixes(spark):
    rows = [("a.b.co.uk", "b.co.uk", "co.uk"), ("xco.uk", "xco.uk", "uk"), ("a.b.com", "b.com", "com"), ("com", "com", "com"), ("co.uk", "co.uk", "co.uk"), ("", "", "")]
    frame = spark.createDataFrame([r[:1] for r in rows], "host string")
    got = frame.select("host", host_reputation.domain_of(frame.host), host_reputation.suffix_of(frame.host)).collect()
    assert [tuple(r) for r in got] == rows


def test_reputation_equals_plain_arithmetic(spark):
    pages, labels = [], []
    hosts = ["bad.evil.com", "www.evil.com", "new.evil.com", "fine.org", "a.fine.org", "b.co.uk", "shop.b.co.uk", "c.co.uk", ""]
    for h, host in enumerate(hosts):
        for k in range(3 + 17 * (h % 3)):
            page = len(pages)
            pages.append((page, f"http://{host}/p/{page}" if host else None, "x"))
            if host != "new.evil.com":
                labels.append((page, None if k % 7 == 6 else int("evil" not in host or k % 9 == 0), 0 if k % 5 else 1))
    labels += [labels[0], (None, 0, 1), (10**9, 0, 1)]
    p = spark.createDataFrame(pages, "page_id long, url string, rule string")
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in host_reputation.judge_urls(p, q, URL_RULES, two_label=("co.uk",), max_bad_rate=0.4).collect()}
    bad = {}
    for doc, quality, toxic in labels:
        if doc is not None and (quality is not None or toxic == 1):
            bad[doc] = bad.get(doc, False) or quality == 0 or toxic == 1
    host_of = lambda url: url.split("://")[1].split("/")[0] if url else ""
    bounds = lower_bounds([(host_of(u), bad.get(k)) for k, u, _ in pages])
    assert {True, False} == {v > 0.4 for v in bounds.values()}
    assert bounds["new.evil.com"] > 0.3
    for k, url, _ in pages:
        assert got[k].verdict == ("block" if bounds[host_of(url)] > 0.4 else "allow"), (url, bounds[host_of(url)])
        assert got[k].rule is None and got[k].host == host_of(url)


def test_rules(spark):
    rows = [
        ("http://x.net/a", "net/", "block"), ("http://example.net/en/a", "example.net/en/", "allow"), ("http://w.example.net/de/", "net/", "block"),
        ("http://example.com/de/", "example.com/de/", "block"), ("http://myexample.com/de/", None, "allow"), ("http://a.org/fr/x", "org/fr/", "allow"),
        ("http://a.org/fr", None, "allow"), ("http://net/", "net/", "block"), ("http://x.net", None, "allow"), (None, None, "allow"),
    ]
    p = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "page_id long, url string")
    q = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.rule, r.verdict) for r in host_reputation.judge_urls(p, q, URL_RULES).collect()}
    assert got == {k: r[1:] for k, r in enumerate(rows)}


def test_edges(spark):
    q = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert host_reputation.judge_urls(empty, q, URL_RULES).count() == 0
    p = spark.createDataFrame([(1, "http://a/" + "x" * 500_000), (1, "http://a/" + "x" * 500_000), (None, "http://b/")], "page_id long, url string")
    got = host_reputation.judge_urls(p, q, []).collect()
    assert len(got) == 3 and max(len(r.path) for r in got) == 500_001
