"""URL rules against SQL and against a plain walk over all rules."""

import hypothesis.strategies as st
from hypothesis import given, settings

from tests.compare import connection, same
from ticketloom.llm import queries, url_rules

RULES = [*url_rules.RULES, ("a.b", "", "block"), ("b", "/x/y", "allow"), ("B", "/x/y", "block"), (None, "/", "block"), ("c", None, "block"), ("c", "/", None), ("a.b", "/x", "allow"), ("b", "/x/", "block")]


def plainly(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, v in rules:
        if None in (h, p, v):
            continue
        h = h.lower()
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, 0, ""), (len(h + p), len(h), v, h + p)[:4])
    return host, path, best[3] if best else None, best[2] if best else default


def judged(spark, urls, rules=RULES, **options):
    pages = spark.createDataFrame([(k, u, "kept", "old") for k, u in enumerate(urls)], "page_id long, url string, note string, host string")
    return url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), **options)


ODD = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://x.ORG/a?b#c", "http://example.org/es/1", "ftp://a.example.org/en/12", "http://badexample.org/es/", "http://org:80/", "http://org./", "http://a.b", "http://q.a.b/x/y/z", "http://b/x/y", "http://com/de", "http://com/de/", "http://a.com/fr/", "x://y://org/", "http://org?/x", "http://u@org/", "http://a\nb.org/\nx", "http://..org/", "http://c/"]


def test_contract(spark, sf):
    same(queries.QUERIES["op11_url_filter"](spark, sf), connection(sf), url_rules.OP11_SQL)


def test_odd_urls_with_and_without_broadcast(spark):
    urls = ODD * 2 + ["http://hot.org/" + "p" * 5000] * 50
    for most in (1 << 20, 0):
        rows = judged(spark, urls, broadcast_bytes=most).orderBy("page_id").collect()
        assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [plainly(u, RULES) for u in urls]
        assert all(r["note"] == "kept" for r in rows)


def test_no_rows_and_no_rules(spark):
    assert judged(spark, ODD).limit(0).count() == 0
    assert judged(spark, ODD).filter("page_id < 0").count() == 0
    assert {(r["rule"], r["verdict"]) for r in judged(spark, ODD, [(None, None, None)], default="block").collect()} == {(None, "block")}


def test_main_path_has_no_python(spark, sf):
    plan = queries.QUERIES["op11_url_filter"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"(https?|)(://)?([abc]\.){0,3}[abcABC]?(/[xy]{0,2}){0,3}(\?q)?", fullmatch=True), min_size=40, max_size=60))
def test_any_urls(spark, urls):
    rules = [("b", "/x", "allow"), ("a.b", "/", "block"), ("c.a.b", "/x/y", "allow"), ("c", "/xx", "block"), ("a", "", "block")]
    rows = judged(spark, urls, rules).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [plainly(u, rules) for u in urls]
