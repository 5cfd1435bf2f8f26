"""URL rules, alias edges and components against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mapstrata.llm.components import connected_components
from mapstrata.llm.queries import QUERIES, URL_RULES
from mapstrata.llm.url_filters import Rule, judge_urls, rule_table


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(2000, i) for i in range(2001, 2200)] + [(1, 1), (None, 3), (5, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == brute_components(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def own_rule(url):
    host, path = split_url(url)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


CASES = [
    ("http://a.example.org/es/1", None),
    ("HTTP://Example.ORG/en/12?q=1#x", None),
    ("https://example.org/en/2", None),
    ("https://org/", None),
    ("https://org", None),
    ("https://notorg/es/", None),
    ("http://x.com/de/y", None),
    ("http://x.com/fr/y", None),
    ("http://x.com/it", None),
    ("no scheme", None),
    ("", None),
    (None, "<link rel=canonical href='http://x.com/de/y'>"),
    ("http://x.net/a/b", '<head><LINK href="http://x.com/de/y?x=1&amp;y=2" rel="canonical"></head>'),
    ("http://x.net/c", '<meta http-equiv="refresh" content="0; URL=/a/b">'),
    ("http://x.net/d?x", '<link rel="canonical" href="c">'),
    ("http://y.net/1", '<link rel="canonical" href="//b.org/ok">'),
    ("http://y.net/2", '<link rel="canonical" href="http://b.org/ok"><meta http-equiv=refresh content="0;url=http://x.com/de/z">'),
    ("http://y.net/3#frag", '<link rel="canonical" href="http://y.net/3">'),
    ("http://x.com/fr/own", '<link rel="canonical" href="http://x.com/de/y">'),
    ("http://z.net/" + "a." * 50_000, "<p>" * 50_000),
    ("http://x.net/c", None),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, h, "clash") for i, (u, h) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    redirects = spark.createDataFrame([("http://w.net/r", "http://w.com/de/1"), (None, "http://x")], "from_url string, to_url string")
    extra = spark.createDataFrame([(100, "http://w.net/r", None, None)], pages.schema)
    return {r.page_id: r for r in judge_urls(pages.union(extra), URL_RULES, redirects).collect()}


def test_rules(judged):
    for i, (url, _) in enumerate(CASES):
        rule = own_rule(url)
        assert (judged[i].host, judged[i].path) == split_url(url)
        assert judged[i].rule == (rule and rule.text), url
        if rule:
            assert judged[i].verdict == rule.action


def test_aliases(judged):
    assert [judged[i].verdict for i in (12, 13, 14, 20)] == ["block"] * 4  # chain of canonical link, redirect, relative link
    assert judged[15].verdict == "allow" and judged[16].verdict == "allow"  # an allowed alias wins over a blocked one
    assert judged[18].verdict == "allow"  # its own rule
    assert judged[17].verdict == "allow" and not judged[17].propagated
    assert judged[100].verdict == "block" and judged[100].propagated
    assert judged[8].verdict == judged[9].verdict == judged[11].verdict == "allow"


def test_empty_paths_and_rel_lists(spark):
    blocked = "http://x.com/de/y"
    cases = [
        ("https://a.net/", f'<link rel="canonical" href="{blocked}">', "block"),
        ("http://b.net/1", '<link rel="canonical" href="https://a.net">', "block"),  # the page https://a.net/
        ("http://c.net?q=1", f'<link rel="shortlink canonical" href="{blocked}">', "block"),
        ("http://d.net/1", '<meta http-equiv=refresh content="0;url=http://c.net/?q=1">', "block"),
        ("http://e.net/1", f"<link rel='Canonical shortlink' href='{blocked}'>", "block"),
        ("http://f.net/1", f"<link href={blocked} rel=canonical>", "block"),
        ("http://g.net/1", f'<link rel="not-canonical" href="{blocked}">', "allow"),
        ("http://h.net/1", f'<link rel="canonicals" href="{blocked}">', "allow"),
        ("http://a.net?q=1", "", "allow"),
    ]
    rows = [(i, u, h) for i, (u, h, _) in enumerate(cases)] + [(100, "http://a.net", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in judge_urls(pages, URL_RULES).collect()}
    assert [found[i].verdict for i in range(len(cases))] == [v for _, _, v in cases]
    assert found[100].verdict == "block" and found[100].path == "" and found[0].path == "/"


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge_urls(pages, URL_RULES).count() == 0


def test_native(spark):
    pages = spark.range(1).select(F.col("id").alias("page_id"), F.lit("http://x").alias("url"), F.lit("").alias("html"))
    plan = judge_urls(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_verdicts(pages, rules, redirects=()):
    """Rules by trying all of them, aliases by plain components."""

    def fitting(url):
        host, path = split_url(url)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.text), r.action == "allow", r.text), default=None)

    def key(url):
        rest = re.match(r"[^/?#]*([^#]*)", url.split("://", 1)[1], re.S).group(1)
        return split_url(url)[0] + (rest if rest.startswith("/") else "/" + rest)

    groups = brute_components([(key(a), key(b)) for a, b in redirects])
    decided = {}
    for url in {u for pair in redirects for u in pair}:
        rule = fitting(url)
        if rule and key(url) in groups:
            decided[groups[key(url)]] = decided.get(groups[key(url)], False) or rule.action == "allow"
    out = {}
    for page_id, url in pages:
        host, path = split_url(url)
        rule = fitting(url)
        alias = decided.get(groups.get(key(url))) if url and "://" in url else None
        allow = rule.action == "allow" if rule else True if alias is None else alias
        out[page_id] = (host, path, rule and rule.text, "allow" if allow else "block")
    return out


def test_query_with_edges(spark, tmp_path):
    """The registered query on the given pages, some of which get a canonical link or a redirect to another one."""
    given = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    draw, edges, pages = random.Random(3), [], []
    whole = [u for _, u, _ in given if u and "://" in u and not set(u) & set("\"'<>& \n")]
    for page_id, url, html in given:
        if url in whole and draw.random() < 0.3:
            to = draw.choice(whole)
            edges.append((url, to))
            html = (html or "") + draw.choice(['<link rel="canonical" href="%s">', '<meta http-equiv="refresh" content="0; url=%s">']) % to
        pages.append((page_id, url, html))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op10_url_filters"](spark, str(tmp_path)).collect()}
    assert found == brute_verdicts([(i, u) for i, u, _ in pages], URL_RULES, edges)
    assert len(edges) > 20


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_rules(spark, monkeypatch, broadcast):
    """Rules at every depth of host and path, one host with most of them, broadcast and salted."""
    if not broadcast:
        monkeypatch.setattr("mapstrata.operators.joins.BROADCAST_BYTES", -1)
        monkeypatch.setattr("mapstrata.operators.joins.SALTS", 3)
    draw = random.Random(2)
    host = lambda: ".".join(draw.choice("abc") for _ in range(draw.randint(1, 4)))
    path = lambda: "/" + "".join(draw.choice("xy/") for _ in range(draw.randint(0, 5)))
    rules = [Rule(draw.choice(["allow", "block"]), draw.choice([host(), "a"]), path()) for _ in range(400)]
    pages = [(i, f"http://{host()}{draw.choice([path(), '', '?q'])}") for i in range(600)] + [(1000, None), (1001, "x"), (1002, "://"), (1003, None)]
    table = spark.createDataFrame([(i, u, None) for i, u in pages], "page_id long, url string, html string")
    expected = brute_verdicts(pages, rules)
    for given in (rules, rule_table(spark, rules).repartition(3)):
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(table, given).collect()} == expected
    assert {r.verdict for r in judge_urls(table, []).collect()} == {"allow"}


def test_plan_does_not_grow_with_rules(spark):
    pages = spark.range(20).select(F.col("id").alias("page_id"), F.format_string("http://h%d.net/p%d/x", "id", "id").alias("url"), F.lit("").alias("html"))
    sizes = []
    for n in (10, 100_000):
        rules = [Rule("block", f"h{i}.net", f"/p{i}/") for i in range(n)]
        judged = judge_urls(pages, rules)
        sizes.append(len(judged._jdf.queryExecution().optimizedPlan().toString()))
        assert judged.where("verdict = 'block'").count() == min(n, 20)
    assert sizes[1] < 2 * sizes[0]
