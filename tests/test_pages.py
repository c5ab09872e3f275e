"""Links of real pages, markup in blocks, and rows that are hostile to every Python function."""

import html
import html.entities
import random
import re
from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from tests.compare import connection, same
from ticketloom.functions import text as tx
from ticketloom.functions.urls import anchors, resolve_url
from ticketloom.operators import filters, joins, pages, replies, windows
from ticketloom.plans import queries_flow, registry

BASES = ["http://a/b/c/d;p?q", "https://h.example.com:8080/x/y/", "http://h", "http://h/", "HTTP://u@H/a//b/c?x=1#f", "http://h/a/b"]
REFS = "g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x . ./ .. ../ ../g ../.. ../../ ../../g ../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h http:g http://o/p/../q ftp://x/y mailto:a@b g?y/./x g#s/../x a//b /a//b// HTTPS://Z/%20 javascript:void(0) tel:1 //o:9/..//x ?".split(" ") + ["", "  g", "a b", "\tg\n", "ü/é?ß"]


def test_references_resolve_as_a_browser_would(spark):
    df = spark.createDataFrame([(b, r) for b in BASES for r in REFS], "base string, ref string")
    rows = df.select("base", "ref", resolve_url(F.col("base"), F.col("ref")).alias("got")).collect()
    wrong = [(r["base"], r["ref"], r["got"], urljoin(r["base"], r["ref"])) for r in rows if r["got"] != urljoin(r["base"], r["ref"])]
    assert wrong == []
    assert df.select(resolve_url(F.col("base"), F.lit(None).cast("string")).alias("x")).filter("x is not null").count() == 0


def test_anchors(spark):
    html = """<A HREF='/x?a=1&amp;b=2'>x</a><a class="k" href=plain>y</a><!-- <a href="/no"> --><script>"<a href='/no'>"</script><a name="n"><link href="/no"><a href="">"""
    assert sorted(spark.createDataFrame([(html,)], "h string").select(anchors(F.col("h"))).first()[0]) == ["", "/x?a=1&b=2", "plain"]
    assert spark.createDataFrame([(None,)], "h string").select(anchors(F.col("h"))).first()[0] == []


def test_link_graph_equals_a_walk_over_pages(spark, sf):
    same(registry.QUERIES["page_link_graph"](spark, sf), connection(sf), registry.ORACLE_SQL["page_link_graph"])
    rows = queries_flow.linked_pages(spark, sf).collect()
    of = {}
    for r in sorted(rows, key=lambda r: r["page_id"]):
        of.setdefault(r["url"], r["page_id"])
    want = set()
    for r in rows:
        for href in re.findall(r'<a [^>]*href="([^"]*)"', r["html"]):
            to = urljoin(r["url"], href.replace("&amp;", "&"))
            if to in of and urlsplit(to).netloc == urlsplit(r["url"]).netloc and not any(e in to.lower() for e in (".pdf", ".jpg", ".png", ".gif", ".zip", ".exe")):
                want.add((r["page_id"], of[to]))
    graph = pages.page_link_graph(queries_flow.linked_pages(spark, sf))
    assert {tuple(r) for r in graph.collect()} == want and len(want) > 10
    # depth by depth over the same links
    start = min(of.values())
    depth, frontier = {start: 0}, {start}
    for d in (1, 2, 3):
        frontier = {b for a, b in want if a in frontier} - depth.keys()
        depth |= dict.fromkeys(frontier, d)
    assert {(r["page"], r["depth"]) for r in pages.reachable_pages(graph, [start], 3).collect()} == set(depth.items())


def blocks(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
    out = {}
    for r in pages.markup_blocks(df).orderBy("page_id", "block_ord").collect():
        out.setdefault(r["page_id"], []).append((r["style"], r["content"] if r["content"] is not None else r["rows"] or r["src"]))
    return [out.get(k, []) for k in range(len(htmls))]


def test_markup_blocks(spark):
    got = blocks(
        spark,
        "Bare <b>bold</b> end<p> One <i>two</i>\n three &amp; <img src='a.png'> four </p><br><div><p>in</p><p>out</p></div>",
        "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li> </li>stray<li>d <b>e</b></li></ul><ol><li>1</li></ol>",
        "<pre>  x\n <b>y</b>\x07</pre><code>z</code><section><h2>head</h2><img src='b.png'><img></section>",
        "<table><tr><th>a</th><td>b <i>c</i></td></tr><tr></tr><tr><td> </td></tr><tr><td>d<table><tr><td>e</td></tr></table></td></tr></table>",
        "<p>not closed <ul><li>x",
        "<!-- no --><script>no()</script><style>p{}</style></div></p>",
        "",
        None,
    )
    assert got[0] == [("paragraph", "Bare "), ("paragraph", "bold"), ("paragraph", " end"), ("paragraph", "One two three & four"), ("image", "a.png"), ("blank", ""), ("paragraph", "in out")]
    assert got[1] == [("bullet", "a b c"), ("bullet", "d e"), ("number", "1")]
    assert got[2] == [("pre", "  x\n \ny\n"), ("pre", "z"), ("paragraph", "head"), ("image", "b.png")]
    assert got[3] == [("table", [["a", "b c"], ["d e", "e"], ["e", ""]])]
    assert got[4] == [("paragraph", "not closed x")] and got[5:] == [[], [], []]


def test_markup_of_deep_and_long_documents(spark):
    deep = "<span>" * 50_000 + "x" + "</p>" * 10 + "<li>" * 20_000
    got = blocks(spark, deep, "<p>" + "y " * 500_000)
    assert got[0] == [("paragraph", "x")] and len(got[1][0][1]) == 999_999


HOSTILE = ["http://[x", "//[", "[url=http://[x]y[/url]", "[img]//[a[/img]", '{"a":' + "[" * 60_000, "{" * 60_000, "&#xFFFFFFFF;&#1;&", "퟿￿", "<" * 5000, "[b]" * 5000, "**" * 4999, "```", "\x00\x1f", '{"ticket_id": "1", "date": ' + '{"k":' * 50_000, '<a href="http://[x?op=a">l</a>', '"' * 3000, None, ""]


@pytest.mark.parametrize("name", ["bbcode_to_markdown", "markdown_to_text", "unescape", "compatible", "title_case", "clean_html"])
def test_no_row_ends_a_job(spark, name):
    df = spark.createDataFrame([(t,) for t in HOSTILE], "t string")
    given = (F.col("t"), "http://[base") if name == "bbcode_to_markdown" else (F.col("t"),)
    assert df.select(getattr(tx, name)(*given).alias("x")).filter("length(x) >= 0 or x is null").count() == len(HOSTILE)


def test_no_page_and_no_reply_ends_a_job(spark):
    df = spark.createDataFrame([(k, t, "http://[x?op=[") for k, t in enumerate(HOSTILE)], "page_id long, html string, url string")
    for base in ("http://[", "https://base.example.com/"):
        assert pages.operation_catalog(df, base).count() == 1
    assert pages.page_elements(df).count() >= 0 and pages.page_titles(df).count() == len(HOSTILE)
    assert pages.markup_blocks(df).count() > 0 and pages.page_link_graph(df).count() == 0
    assert pages.rich_tree_to_text(df.select("page_id", "html"), "html").count() == len(HOSTILE)
    found = [replies.repair_reply(t or "") for t in HOSTILE]
    assert len(found) == len(HOSTILE)


def test_titles_and_paragraphs_read_references(spark):
    df = spark.createDataFrame([(1, "http://h/x", "<title>Q&amp;A &eacute;</title><p>a &lt;b&gt; &copy;</p>"), (2, "http://h/?op=a_b", "<h1>R&amp;D x</h1>")], "page_id long, url string, html string")
    assert {r["page_id"]: r["title"] for r in pages.page_titles(df).collect()} == {1: "Q&A é", 2: "A B - R&D x"}
    assert df.select(pages.inner_text("p", F.col("html")).alias("p")).first()["p"] == ["a <b> ©"]


def test_host_and_port_are_compared(spark):
    df = spark.createDataFrame([("http://h:80/x",), ("http://h/x",), ("http://H/x",), ("http://u@h/x",), ("ftp://h/",), ("http://h/a.PDF?x",), (None,)], "u string")
    assert [r["u"] for r in df.filter(filters.is_crawlable(F.col("u"), "h")).collect()] == ["http://h/x"]
    assert [r["u"] for r in df.filter(filters.is_crawlable(F.col("u"), "h:80")).collect()] == ["http://h:80/x"]


def test_rows_without_a_group_are_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "a"), (5, "a"), (6, "b")], "ord long, g string")
    got = windows.group_samples(df, "g", 2, 2, "ord").collect()
    assert {(r["ord"], r["g"], r["group_size"]) for r in got} == {(1, None, 3), (2, None, 3), (4, "a", 2), (5, "a", 2)}


def test_documents_without_extension(spark):
    docs = spark.createDataFrame([(1, "d", "report", None), (2, "d", "rep", ""), (3, "d", "other", None), (4, "e", "report", None), (5, "d", "repo", ".pdf"), (6, "d", "x", ".pdf"), (7, "d", "x", None)], "ord long, dir string, stem string, ext string")
    manifest = spark.createDataFrame([("d", "report_1", ".pdf")], "dir string, name string, ext string")
    assert sorted(r["ord"] for r in joins.drop_existing_files(docs, manifest).collect()) == [3, 4, 6]


def test_comment_dates_and_ids(spark):
    tickets = spark.createDataFrame([("t",)], "ticket_id string")
    comments = spark.createDataFrame([("t", "c1", 0, "a", None, "d1", "x"), ("t", "c2", 1, "a", "", "d2", "y"), ("t", "c3", 2, "a", "own", "d3", "z")], "ticket_id string, comment_id string, c_ord int, author string, created string, Date string, body string")
    none = spark.createDataFrame([], "owner_kind string, owner_id string, a_ord int, FileName string, Url string, Size long")
    assert [c["CommentDate"] for c in joins.assemble_tickets(tickets, comments, none).first()["kommentare"]] == ["d1", "d2", "own"]
    spelled = spark.createDataFrame([(None, "7", None), (" ", None, "8"), ("", None, "9"), ("5", "6", None)], f"CommentId string, Id string, note string, Attachments array<{joins.ATTACHMENT}>".replace(", Attachments", ", Attachments").split(", Attachments")[0])
    spelled = spelled.withColumn("Attachments", F.lit(None).cast(f"array<{joins.ATTACHMENT}>"))
    fetched = spark.createDataFrame([("7",), ("5",)], "comment_id string").withColumn("Attachments", F.array(F.struct(F.lit("f").alias("FileName"), F.lit("u").alias("Url"), F.lit(1).cast("long").alias("Size"))))
    rows = joins.fill_missing_attachments(spelled, fetched).collect()
    assert {(r["comment_id"], len(r["Attachments"])) for r in rows} == {("7", 1), (" ", 0), (None, 0), ("5", 1)}


def test_urls_of_attributes(spark):
    given = {' "http://h/a b" ': "http://h/a", "'x'": "x", "'x\"": "'x\"", '"': '"', "''": None, " ": None, "": None, "\u00a0a>b": "a", "<a": None, "' x'": "x", None: None}
    df = spark.createDataFrame([(k,) for k in given], "u string")
    assert {r["u"]: r["s"] for r in df.select("u", tx.strict_url(F.col("u")).alias("s")).collect()} == given
    roots = {"http://h/helpdesk/x": "http://h/helpdesk/api", "HTTP://H:8/a/HELPDESK?b": "http://H:8/helpdesk/api", "//h/x?/helpdesk": "https://h/api", "h/x": None, "": "s://h/api", None: "s://h/api"}
    df = spark.createDataFrame([(k,) for k in roots], "u string")
    assert {r["u"]: r["s"] for r in df.select("u", tx.api_root(F.col("u"), F.lit("s://h")).alias("s")).collect()} == roots


def test_character_references_are_those_of_the_standard(spark):
    rng = random.Random(5)
    names = list(html.entities.html5)
    numbers = ["0", "00", "9", "13", "128", "159", "x9F", "X80", "xA0", "xfffe", "xFDD0", "xfeff", "xd800", "x1F600", "x10FFFF", "x110000", "9" * 30, "x" + "f" * 30]
    kinds = [
        lambda: "&" + rng.choice(names),
        lambda: "&" + rng.choice(names)[:-1] + rng.choice(["", "x", "=", "\u00e9"]),
        lambda: "&#" + rng.choice(numbers) + rng.choice([";", ""]),
        lambda: rng.choice(["&", "&&", "&;", "&#", "&#x;", "& ", "a b", "\n", "\U0001f600", "&amp;lt;", "R&D"]),
    ]
    texts = ["".join(rng.choice(kinds)() for _ in range(rng.randint(1, 6))) for _ in range(2000)] + ["&" + n for n in names] + [None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.unescape(F.col("t")).alias("x")).collect()
    assert [r for r in rows if r["x"] != (None if r["t"] is None else html.unescape(r["t"]))] == []


def test_links_are_found_and_resolved_once(spark):
    """An expression that a filter or a branch repeats is computed again; references were resolved many times."""
    df = spark.createDataFrame([(1, "http://h/a", '<a href="b&amp;c">x</a>'), (2, "http://h/b&c", "")], "page_id long, url string, html string")
    graph = pages.page_link_graph(df)
    plan = graph._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--.*?-->") == plan.count(r"[\t\r\n]") == plan.count("[^/]+$") == 1
    assert graph.collect() == [(1, 2)]
