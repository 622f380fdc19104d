import inspect

import pytest

from strataframe.llm.url_filter import Rule, host_edges, propagate, url_filter

RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]
SCHEMA = "page_id long, url string, html string, host string, trust double, rule int"


def rows(*pages):
    return [(i, url, html, "x", 1.0, 2) for i, (url, html) in enumerate(pages)]


def test_hosts_paths_and_rules(spark):
    urls = ["http://WWW.Example.com/en/a?q#f", "x://a.example.com/en/b", "x://example.com/en", "x://example.com?/en/", "x://b.net/es/1", "x://net/fr/", "x://b.net/de/1", None, "no host", "a://b://c/d", "x://examplecom/", "x://É.COM/É?", "://com/", "x://h\n.com/a\nb", ""]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(spark.createDataFrame(rows(*[(u, None) for u in urls]), SCHEMA), RULES).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("a.example.com", "/en/b", "example.com/en/", "block"),
        ("example.com", "/en", "com/", "allow"),
        ("example.com", "", None, "allow"),
        ("b.net", "/es/1", "net/es/", "block"),
        ("net", "/fr/", "net/fr/", "block"),
        ("b.net", "/de/1", None, "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b:", "//c/d", None, "allow"),
        ("examplecom", "/", None, "allow"),
        ("É.com", "/É", "com/", "allow"),
        ("com", "/", "com/", "allow"),
        ("h\n.com", "/a\nb", "com/", "allow"),
        ("", "", None, "allow"),
    ]


def test_links(spark):
    html = '<A class="x" HREF="http://T.org/1">a</A><a href=//u.org>b</a><a href="/rel">c</a><a href="https://s.org/">self</a><link href="http://no.org/">'
    df = spark.createDataFrame(rows(("x://s.org/", html), ("x://s.org/2", html + html), (None, html), ("x://s.org/3", None)), SCHEMA)
    assert sorted(map(tuple, host_edges(df).collect())) == [("s.org", "t.org", 2), ("s.org", "u.org", 2)]


def test_propagation_matches_power_iteration(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 12, (40, 2)) if a != b})
    weighted = [(f"h{a}", f"h{b}", (a * 7 + b) % 4 + 1) for a, b in edges]
    seeds = [("h0", 2.0, 0.0), ("h1", 1.0, 0.0), ("h5", 0.0, 3.0)]
    got = {r.host: (r.trust, r.distrust) for r in propagate(spark.createDataFrame(weighted, "src string, dst string, weight long"), spark.createDataFrame(seeds, "host string, trust double, distrust double"), max_iter=60, tolerance=1e-9).collect()}
    for k, (s, flip) in enumerate((({0: 2 / 3, 1: 1 / 3}, False), ({5: 1.0}, True))):
        m = np.zeros((12, 12))
        for a, b, w in weighted:
            i, j = (int(b[1:]), int(a[1:])) if flip else (int(a[1:]), int(b[1:]))
            m[i, j] = w
        out = m.sum(1, keepdims=True)
        m = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
        v = np.zeros(12)
        for i, x in s.items():
            v[i] = x
        r = v
        for _ in range(200):
            r = 0.15 * v + 0.85 * m.T @ r
        for i in range(12):
            assert got.get(f"h{i}", (0.0, 0.0))[k] == pytest.approx(r[i], abs=1e-6)


def test_distrust_reaches_linking_hosts(spark):
    df = spark.createDataFrame(rows(("x://spam.net/es/1", None), ("x://farm.org/a", '<a href="http://spam.net/">'), ("x://good.com/a", '<a href="http://fine.org/">'), ("x://fine.org/b", None), ("x://lone.org/", None)), SCHEMA)
    assert [r.verdict for r in url_filter(df, RULES).orderBy("page_id").collect()] == ["block", "block", "allow", "allow", "allow"]


def test_empty_and_repeated(spark):
    assert url_filter(spark.createDataFrame([], SCHEMA), RULES).count() == 0
    df = spark.createDataFrame(rows(("x://a.com/", "h")) * 3 + [(None, "x://a.com/", "h", "x", 1.0, 2)], SCHEMA)
    assert [r.rule for r in url_filter(df, RULES).collect()] == ["com/"] * 4


def test_distrust_reaches_hosts_at_any_distance(spark):
    edges = spark.createDataFrame([(f"h{i + 1}", f"h{i}", 1) for i in range(8)], "src string, dst string, weight long")
    seeds = spark.createDataFrame([("h0", 0.0, 1.0)], "host string, trust double, distrust double")
    got = {r.host: r.distrust for r in propagate(edges, seeds, tolerance=1.0).collect()}
    assert len(got) == 9 and all(x > 0 for x in got.values())
    assert inspect.signature(url_filter).parameters["max_iter"].default is None
