"""URL parts and rules by hand, propagation against matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.llm import urls

CASES = [
    ("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    ("ftp://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/fr", "x.com", "/fr", None, None),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.org?/a", "x.org", "", None, None),
    ("http://a.net/b://c.org/", "a.net", "/b://c.org/", None, None),
    ("no scheme", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
    ("http:///es/", "", "/es/", None, None), ("http://ÄÉ.Net:80/\nA", "ÄÉ.net:80", "/\nA", None, None),
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, url string")
    df = df.select("i", urls.url_host(F.col("url")).alias("h"), urls.url_path(F.col("url")).alias("p"))
    rule, says = urls.by_rule(F.col("h"), F.col("p"), urls.RULES)
    got = {r["i"]: tuple(r)[1:] for r in df.select("i", "h", "p", rule.alias("r"), says.alias("v")).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[1:] for c in CASES]


def plain_ranks(edges, seeds, steps, damping):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts),) * 2)
    for a, b, x in edges:
        w[at[a], at[b]] += x
    forth = np.divide(w, w.sum(1, keepdims=True), where=w.sum(1, keepdims=True) > 0, out=np.zeros_like(w))
    back = np.divide(w.T, w.T.sum(1, keepdims=True), where=w.T.sum(1, keepdims=True) > 0, out=np.zeros_like(w))
    out = []
    for matrix, k in ((forth, 0), (back, 1)):
        seed = np.array([seeds.get(h, (0, 0))[k] for h in hosts], dtype=float)
        seed /= max(seed.sum(), 1) if not seed.sum() else seed.sum()
        now = seed
        for _ in range(steps):
            now = (1 - damping) * seed + damping * now @ matrix
        out.append(now)
    return {h: (out[0][i], out[1][i]) for h, i in at.items()}


def test_propagation(spark):
    rng = np.random.default_rng(1)
    hosts = [f"h{i}" for i in range(12)]
    edges = [(a, b, float(rng.integers(1, 5))) for a in hosts for b in ["h0", *hosts] if a != b and (rng.random() < 0.2 or b == "h0")]
    edges = list({(a, b): (a, b, x) for a, b, x in edges}.values())
    seeds = {"h1": (2.0, 0.0), "h2": (1.0, 1.0), "h5": (0.0, 3.0), "alone": (1.0, 0.0)}
    got = urls.propagated(
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"), steps=9)
    want = plain_ranks(edges, seeds, 9, urls.DAMPING)
    found = {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()}
    for h, w in want.items():
        assert found.get(h, (0, 0)) == pytest.approx(w, abs=1e-12)


def test_pages(spark):
    link = lambda *u: "".join(f'<a class=x HREF = "{x}">t</a>' for x in u)
    rows = [
        (1, "http://good.org/a", link("https://friend.net/x", "http://friend.net/y")), (2, "http://friend.net/b", None), (3, "http://farm.net/b", link("http://spam.com/de/1") * 5),
        (4, "http://spam.com/de/1", ""), (5, "http://spam.com/en/1", "<img src='//relative'>"), (6, None, None), (7, "http://apart.io/", ""), (7, "http://apart.io/", ""),
        (None, "http://deep.farm.net/", ""), (8, "http://good.org", link("http://good.org/self"))]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, verdict string")
    got = sorted(((r["page_id"], r["rule"], r["verdict"]) for r in urls.url_verdicts(pages).collect()), key=str)
    assert got == sorted([(1, "org/", "allow"), (2, None, "allow"), (3, None, "block"), (4, "com/de/", "block"), (5, None, "block"), (6, None, "allow"),
                          (7, None, "allow"), (7, None, "allow"), (None, None, "block"), (8, None, "allow")], key=str)
    hosts = pages.select(urls.url_host(F.col("url")).alias("host")).distinct()
    edges = {(r["src"], r["dst"]): r["weight"] for r in urls.host_edges(pages, hosts).collect()}
    assert edges[("good.org", "friend.net")] == 2 and edges[("farm.net", "spam.com")] == 1
    assert edges[("deep.farm.net", "farm.net")] == edges[("farm.net", "deep.farm.net")] == 1
    assert ("good.org", "good.org") not in edges
    assert urls.url_verdicts(pages.where("false")).count() == 0


def test_hosts_of_one_ending_are_judged_apart(spark):
    urls_of = ["http://mixed.com/fr/1"] * 14 + ["http://mixed.com/de/1"] * 7 + ["http://bad.com/de/1"] * 5 + ["http://a.org/x"] * 90
    asked = {
        "http://mixed.com/x": "allow", "http://bad.com/x": "block", "http://sub.bad.com/x": "block", "http://other.com/x": "allow",
        "http://quiet.farm.com/x": "allow", "http://loud.farm.com/x": "block"}
    rows = [(i, u, None) for i, u in enumerate([*urls_of, *["http://loud.farm.com/de/1"] * 5, *asked])]
    got = urls.url_verdicts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = {r["page_id"]: r["verdict"] for r in got.where("rule is null").collect()}
    assert {u: found[i] for i, u, _ in rows if u in asked} == asked


def test_parents(spark):
    cases = {"a.b.c.d": ["a.b.c.d", "b.c.d", "c.d"], "x.com": ["x.com"], "com": ["com"], "a.b.co.uk": ["a.b.co.uk", "b.co.uk"], "co.uk": ["co.uk"],
             "10.0.0.1": ["10.0.0.1"], "10.0.0.1:80": ["10.0.0.1:80"], "w.x.net:80": ["w.x.net:80", "x.net:80"]}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    assert {r["host"]: r["p"] for r in df.select("host", urls.with_parents(F.col("host")).alias("p")).collect()} == cases
