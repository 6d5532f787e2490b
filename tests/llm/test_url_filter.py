"""Rules by a plain reading, and trust over a small link graph by matrix iteration."""

import re

import pytest

from postlytics.llm import url_filter as uf
from postlytics.llm.queries import QUERIES
from postlytics.llm.statements import url_filter
from tests.conftest import SF_DIR

LOWER = {c: c + 32 for c in range(65, 91)}
PAGES = "page_id long, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    best = None
    for rule in uf.RULES:
        fits = (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
        if fits and (best is None or len(rule.pattern) > len(best.pattern)):
            best = rule
    return best


def plain_scores(edges, seeds, settings):
    degree = {}
    for src, _ in edges:
        degree[src] = degree.get(src, 0) + 1
    scores = dict.fromkeys(seeds, 1.0)
    for _ in range(settings.rounds):
        moved = dict.fromkeys(seeds, 1.0)
        for src, dst in edges:
            if src in scores:
                moved[dst] = moved.get(dst, 0.0) + settings.damping * scores[src] / degree[src]
        scores = moved
    return scores


def plain_verdicts(pages, settings=uf.Spread()):
    counts, edges = {}, set()
    for _, url, html in pages:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        own = counts.setdefault(host, {"all": 0, "allow": 0, "block": 0})
        own["all"] += 1
        if rule:
            own[rule.verdict] += 1
        for link in re.findall(r"""<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)""", html or "", re.I):
            other = plain_parts("http:" + link if link.startswith("//") else link)[0]
            if other and host and other != host:
                edges.add((host, other))
    seeds = {v: [h for h, c in counts.items() if h and 2 * c[v] > c["all"]] for v in ("allow", "block")}
    trust = plain_scores(sorted(edges), seeds["allow"], settings)
    distrust = plain_scores(sorted((b, a) for a, b in edges), seeds["block"], settings)
    out = []
    for page_id, url, _ in pages:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        bad = distrust.get(host, 0.0)
        verdict = rule.verdict if rule else "block" if bad >= settings.threshold and bad > trust.get(host, 0.0) else "allow"
        out.append((page_id, host, path, rule and rule.pattern, verdict))
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in frame.collect()), key=str)


def test_query_equals_plain_reading(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert rows(QUERIES["op2_url_filter"](spark, SF_DIR)) == plain_verdicts(pages)


LINKED = [
    (1, "http://bad.net/es/1", None),
    (2, "http://bad.net/en/1", None),
    (3, "http://bad.net/fr/1", ""),
    (4, "http://hub.org/a", '<a href="http://bad.net/x"> <A class=x HREF=//BAD.net/y>'),
    (5, "http://fine.org/a", "<a href='https://friend.org/'>"),
    (6, "http://good.com/a", '<a href="http://fine.org/"><a href="//hub2.org">'),
    (7, "http://hub2.org/a", "<a href=http://bad.net>"),
    (8, "http://friend.org", '<a href="/local">'),
    (9, "http://feeder.org/q", '<a href="http://hub.org/">'),
    (10, None, '<a href="http://bad.net">'),
    (11, "no scheme", None),
    (12, "http://WWW.Example.COM/en/x?y", None),
    (13, "http://example.com/en/", None),
    (14, "http://notcom/", None),
    (15, "http://x.com", None),
    (16, "http://x.com?a/b", None),
    (None, "http://hub.org/b#c", "<a href=http://bad.net>"),
    (None, "http://hub.org/b#c", "<a href=http://bad.net>"),
]


def test_trust_and_distrust_spread(spark):
    frame = spark.createDataFrame(LINKED, PAGES)
    assert rows(uf.url_verdicts(frame)) == plain_verdicts(LINKED)
    wary = uf.Spread(threshold=0.4)
    got = rows(uf.url_verdicts(frame, settings=wary))
    assert got == plain_verdicts(LINKED, wary)
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[2] == "block" and verdicts[4] == "block"  # the host itself, and who links to it
    assert verdicts[5] == verdicts[8] == verdicts[11] == "allow"


def test_statement_on_linked_pages(spark):
    """The query's SQL sees the same links, also where the given pages have none."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", LINKED)
    wary = uf.Spread(threshold=0.4)
    rows_of_sql = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter(settings=wary)})").fetchall()
    assert sorted(rows_of_sql, key=str) == plain_verdicts(LINKED, wary)


def test_scores_equal_iteration(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "e2")]
    frame = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("d",)], "host string")
    got = {r.host: r.score for r in uf.spread(frame, seeds).collect()}
    want = plain_scores(edges, ["a", "d"], uf.Spread())
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_long_html_clashes_and_empty_table(spark):
    frame = spark.createDataFrame(
        [(1, "http://a.org/" + "x" * 9000, "<a href=http://b.org>" * 20_000, "h", "v")], PAGES + ", host string, verdict string"
    )
    assert uf.url_verdicts(frame).first().verdict == "allow"
    assert uf.host_edges(frame).count() == 1
    assert uf.url_verdicts(frame.filter("page_id > 1")).count() == 0


def test_pages_of_open_tags_take_linear_time(spark):
    import time

    pages = [(1, "https://a.org/", "<a " * 1_000_000), (2, "https://b.org/", "<a href=" + " " * 1_000_000), (3, "https://c.org/", "<a href" * 300_000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    began = time.monotonic()
    assert len(uf.url_verdicts(frame).collect()) == 3
    assert time.monotonic() - began < 60
