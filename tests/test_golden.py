import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.functions import text as tx
from ticketloom.functions.columns import with_ordinal
from ticketloom.operators import filters, generation, graph, images, joins, pages, replies, similarity, windows
from ticketloom.sources import files


def test_rich_tree(spark):
    tree = {"type": "doc", "content": [{"type": "heading", "content": [{"type": "text", "text": "Head"}]}, {"type": "list", "content": [{"type": "listItem", "content": [{"type": "paragraph", "content": [{"type": "text", "text": "one"}]}]}]}]}
    df = spark.createDataFrame([(1, json.dumps(tree)), (2, "no json"), (3, None)], "id int, body string")
    assert [r["body"] for r in pages.rich_tree_to_text(df, "body").orderBy("id").collect()] == ["Head\none", "", ""]


def one(spark, fn, *texts):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1).orderBy("i").select(fn(F.col("t"))).collect()]


def test_bbcode(spark):
    texts = [
        "a[quote]\nx\n\ny\n[/quote]b [B]c[/b]",
        "[code]\nif x:\n  y\n[/code]z",
        "[url=/a/b] see (this] [/url] [url]https://e.com[/url] [img] p.png [/img]",
        "[i]one[/i] [b]open [u]under[/u] shut[/b] [/b] [b]left",
        "[list]\n[*]  one\n[*]two[/LIST]<br/>x<!-- gone\nfor good -->\r\n\n \n\nend",
        "[url=]x[/url] [url=a]b",
        None,
    ]
    got = one(spark, lambda c: tx.bbcode_to_markdown(c, "https://kb.example.com"), *texts)
    assert got == [
        "a\n> x\n>\n> y\nb **c**",
        "```\nif x:\n  y\n```\nz",
        "[see (this\\]](https://kb.example.com/a/b) <https://e.com> ![](https://kb.example.com/p.png)",
        "_one_ **open <u>under</u> shut** [/b] [b]left",
        "- one\n- two\nx\n\nend",
        got[5],
        "",
    ]


def test_markdown_to_text(spark):
    got = one(
        spark,
        tx.markdown_to_text,
        "```json\n{}\n``` and ``` open",
        "  > quoted\n>x\n![alt](u.png) [t](https://e.com)",
        "## Head\n**bold** __strong__ _it_ *em* 2 * 3 a_b",
        "-    item\n* star\t\ttab   blank\n\n\n\nend <u>u</U>",
        "***both*** __a_b__ _x",
        None,
    )
    assert got == ["json\n{}\n and ``` open", "quoted\nx\nu.png t (https://e.com)", "Head\nbold strong it em 2 * 3 a_b", "- item\n* star tab blank\n\nend u", "both ab x", ""]


def test_html_and_entities(spark):
    assert one(spark, tx.clean_html, "<p>caf&eacute; &#8217;x&ouml</p><pre>a</pre>b<br>c <div class=x>d</div>") == ["café ’xö\n\na\nb\nc \nd"]
    assert one(spark, lambda c: tx.clean_html(c, "inline"), "<p>a&nbsp;b</p>c<BR/>d", None) == ["a\xa0bc\nd", ""]
    assert one(spark, tx.normalise_unicode, "“a” ‑ ﬁ…\x07\x7f ½", None) == ['"a" - fi...\x7f 1⁄2', None]


def test_similarity_noise(spark):
    got = spark.range(1).select(tx.similarity_text(F.lit("5 per 10 users NN12 https://x.y/z q"), F.lit("PERSNR: 123 pern#4 persn 7 per.493 per. 8"), F.lit(None).cast("string"))).first()[0]
    assert got == "5 per 10 users q . per. 8 ."


def test_attachment_and_image_links(spark):
    urls = {"https://h/a/b.webp": True, "https://h/img/7": True, "https://h/x.msg": False, "https://h/x?y=Download": True, "mailto:a@b.pdf": False, "https://file.example.com/x": False, "https://h/a.PDF;v=1": True, "/Attach": True, "https://h/kb/1": False}
    assert one(spark, filters.is_attachment_link, *urls) == list(urls.values())
    assert one(spark, lambda c: filters.is_attachment_link(c, ("kb",)), "https://h/kb/1") == [True]
    cases = [
        ("https://h/File/get/7", "", True, False), ("https://h/file/get/7", "x.csv", True, False), ("https://h/file/get/7.png", None, True, True), ("https://h/file/get/7", "x.JPG", True, True),
        ("https://t/rest/api/3/attachment/content/5", "", True, True), ("https://t/rest/api/3/attachment/content/5", "a.pdf", False, False), ("https://h/x.png?y", "", True, False), ("https://h/x", "", False, False), (None, "a.png", False, False),
    ]
    df = spark.createDataFrame([(i, u, n) for i, (u, n, _, _) in enumerate(cases)], "i int, u string, n string").coalesce(1).orderBy("i")
    rows = df.select(filters.is_image_link(F.col("u"), F.col("n")).alias("s"), filters.is_image_link(F.col("u"), F.col("n"), "refresh").alias("r")).collect()
    assert [(r["s"], r["r"]) for r in rows] == [(s, r) for _, _, s, r in cases]


def test_links_of_bbcode_bodies(spark):
    text = '[img] /a.png [/img][url=/file/1]x[/url] <a href="/b.pdf">b</a> see https://h/c.zip). [url]mailto:x@y.pdf[/url]'
    rows = tx.extract_links(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t", "https://b", bbcode=True).orderBy("ord").collect()
    assert [(r["FileName"], r["Url"]) for r in rows] == [("a.png", "https://b/a.png"), ("1", "https://b/file/1"), ("b.pdf", "https://b/b.pdf"), ("c.zip", "https://h/c.zip")]


def test_collisions_take_the_first_free_name(spark):
    names = ["a.pdf", "a.pdf", "a_1.pdf", "b.pdf", "a.pdf", "a_1.pdf", "b.pdf", None, "c", "c", "c_1"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "ord int, name string")
    got = [r["final_name"] for r in windows.number_collisions(df).orderBy("ord").collect()]
    assert got == ["a.pdf", "a_1.pdf", "a_1_1.pdf", "b.pdf", "a_2.pdf", "a_1_2.pdf", "b_1.pdf", None, "c", "c_1", "c_1_1"]
    two = spark.createDataFrame([(0, "x", "a.pdf"), (1, "y", "a.pdf"), (2, "x", "a.pdf")], "ord int, dir string, name string")
    assert [r["final_name"] for r in windows.number_collisions(two, folder="dir").orderBy("ord").collect()] == ["a.pdf", "a.pdf", "a_1.pdf"]


def test_names(spark):
    assert one(spark, lambda c: windows.safe_file_name(c, F.lit(7), F.lit("pdf")), "a/b:c ü.pdf", "???", None) == ["abc ü.pdf", "document_7.pdf", "document_7.pdf"]
    assert one(spark, lambda c: windows.strip_prefix(c, "X_"), "X_1X_2", "1X_2") == ["12", "1X_2"]
    df = spark.createDataFrame([("7", "a<b"), ("8", "c")], "ticket_id string, subject string")
    assert {r["file_name"] for r in windows.assign_batches(df, 1, ["ticket_id"]).collect()} == {"ticket_7_a_b.docx", "ticket_8_c.docx"}
    assert {r["file_name"] for r in windows.assign_batches(df, 2, ["ticket_id"]).collect()} == {"tickets_0001-0002_batch_001.docx"}


def test_work_slice(spark):
    df = spark.createDataFrame([(k, str(k), k % 3 == 0) for k in range(20)], "ord int, ticket_id string, relevant boolean")
    ords = lambda **o: sorted(r["ord"] for r in filters.work_slice(df, **o).collect())
    assert ords(start_index=4, limit_relevant=2) == list(range(4, 10)) and ords(max_calls=3) == [0, 1, 2]
    assert ords(start_index=18, limit_relevant=5) == [18, 19] and ords(only_id="7") == [7] and ords(limit_relevant=0) == [] and ords(max_calls=5, limit_relevant=2) == [0, 1, 2, 3]


def test_blocks_with_bold_runs_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a **b** c\nd\n\n- x\n* <b>y</b>\n2) z **open"), (1, "a"), (1, "a"), (2, " \n"), (3, None)], "id int, t string")
    rows = tx.text_to_blocks(df, "id", "t").collect()
    assert sorted((r["block_ord"], r["style"], r["content"]) for r in rows if r["id"] == 1) == [(0, "paragraph", "a"), (0, "paragraph", "a"), (0, "paragraph", "a **b** c d"), (1, "bullet", "x\n<b>y</b>"), (2, "number", "z **open")]
    runs = {r["content"]: [(x["text"], x["bold"]) for x in r["runs"]] for r in rows}
    assert runs["a **b** c d"] == [("a ", False), ("b", True), (" c d", False)] and runs["x\n<b>y</b>"] == [("x\n", False), ("y", True)] and runs["z **open"] == [("z **open", False)]
    assert [r["content"] for r in rows if r["id"] in (2, 3)] == ["(No content)"] * 2


def test_chapters(spark):
    rows = [("d", 1, "Normal", None, "lost"), ("d", 2, "Heading 1", None, "A"), ("d", 3, "Normal", None, "x"), ("d", 4, "Normal", None, " "), ("d", 5, "Überschrift 1", None, "B"), ("d", 6, "Normal", None, "y"), ("e", 1, "Heading 1", None, "T"), ("e", 2, "heading 2", None, "S"), ("e", 3, "n", 1, "R"), ("e", 4, "n", None, "z"), ("f", 1, None, None, "all")]
    df = spark.createDataFrame(rows, "doc string, ord int, style string, outline_level int, text string")
    got = sorted((r["doc"], r["index"], r["title"], r["content"], r["level"]) for r in pages.split_chapters(df).collect())
    assert got == [("d", 1, "A", "x", 1), ("d", 2, "B", "y", 1), ("e", 1, "S", "", 2), ("e", 2, "R", "z", 2), ("f", 1, "Document", "all", 1)]


def test_operation_catalog(spark):
    html = '<ul><li><a href="/s?op=Get_it">call  it</a> - returns <b>rows</b> -</li><li><a href="/s?op=b_c"></a></li></ul><p>x <a href="http://o/t?op=Get_it">again</a>'
    df = spark.createDataFrame([(1, html), (2, None), (3, "<a href='?op=z'>z</a>")], "page_id long, html string")
    got = {r["name"]: (r["page_id"], r["pos"], r["display_name"], r["url"], r["description"]) for r in pages.operation_catalog(df, "https://h/d/").collect()}
    assert got == {"Get_it": (1, 0, "again", "http://o/t?op=Get_it", "x"), "b_c": (1, 1, "B C", "https://h/s?op=b_c", ""), "z": (3, 0, "z", "https://h/d/?op=z", "")}


def test_page_titles(spark):
    df = spark.createDataFrame(
        [(1, "http://h/x?op=get_a1b", "<h2>Long head</h2>"), (2, "http://h/x?op=q", "<p>The following operations are supported here</p><p>This says what it does, at length.</p>"), (3, "http://h/x?op=q", "<p>The following operations are supported here</p>"), (4, "http://h/s?WSDL", ""), (5, "http://h/", "<title>Website</title><h1>Own</h1>"), (6, "http://h/", "x")],
        "page_id long, url string, html string",
    )
    assert [r["title"] for r in pages.page_titles(df).orderBy("page_id").collect()] == ["Get A1B - Long head", "Q API", "Q API Endpoint", "WSDL Service Description", "Own", "API Documentation"]


def test_page_elements_nested_div_and_regions(spark):
    html = '<body><nav><p>navigation text is dropped</p></nav><div role="main"><div>outer text here <div>inner text that repeats</div></div><h2>A heading of level two</h2></div><p>outside of the main region</p></body>'
    rows = pages.page_elements(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("elem_ord").collect()
    texts = [r["text"] for r in rows]
    assert "inner text that repeats" in texts and any("outer text here inner" in t for t in texts)
    assert not any("navigation" in t or "outside" in t for t in texts)
    assert [(r["type"], r["level"]) for r in rows if r["level"]] == [("h2", 2)]
    two = '<div class="content"><p>text of the class region</p></div><article><p>text of the first article</p></article><article><p>text of the second article</p></article>'
    rows = pages.page_elements(spark.createDataFrame([(1, two)], "page_id long, html string")).collect()
    assert [r["text"] for r in rows] == ["text of the first article"]
    assert pages.page_elements(spark.createDataFrame([(1, two)], "page_id long, html string"), "api").count() == 4


@pytest.mark.parametrize(
    "text,problem,reason",
    [
        ('```json\n{"ticket_id":"1","problem":"p","solution":"s"}\n```', "p", None),
        ('Sure: {"problem":"a } b","solution":"s"} bye', "a } b", None),
        ('{"problem":"p","solution":"s",}', "p", None),
        ("{“problem”:”p”,”solution”:”s”}", "p", None),
        ('{"77", "problem":"p","solution":"s"}', "p", None),
        ('{"problem":"p", "2024-01-02", "solution":"s"}', "p", None),
        ('{"problem":"p","solution":"s","3":"more"}', "p", None),
        ('{"problem":"p" "solution":"s"}', "p", None),
        ("nothing", None, "no object"),
        ("{broken}", None, "invalid object"),
        ("", None, "no object"),
    ],
)
def test_reply_repair(text, problem, reason):
    fields, why = replies.repair_reply(text)
    assert why == reason and (fields or {}).get("problem") == problem


def test_reply_numeric_keys_join_the_solution_of_broken_replies():
    assert replies.repair_reply('{"problem":"p","solution":"s","3":"more"}')[0]["solution"] == "s"
    assert replies.repair_reply('{12, "problem":"p","solution":"s","3":"more","4":"and"}')[0] == {"ticket_id": "12", "problem": "p", "solution": "s more and"}


def test_reply_bare_dates_and_salvage():
    fields, _ = replies.repair_reply('{"ticket_id": 1, 2024-01-02T10:00:00Z, "problem":"p","solution":"he said "no" to it"}')
    assert fields == {"ticket_id": "1", "date": "2024-01-02T10:00:00Z", "problem": "p", "solution": 'he said "no" to it'}
    assert replies.repair_reply('"problem": "p", "solution": "s", 2024-01-02T10:00:00Z')[0] == {"problem": "p", "solution": "s", "date": "2024-01-02T10:00:00Z"}
    assert replies.repair_reply('```\n{"problem":"cut of') == ({"problem": "cut of"}, None)


def test_replies_in_a_table(spark):
    rows = [(1, '{"problem":"p","solution":"s"}', None), (2, "no", None), (3, '{"problem":"Nicht relevant"}', None), (4, "{1, \"problem\":\"x\"}", None), (5, None, "timeout"), (6, "{'problem':'q'}", None)]
    df = spark.createDataFrame(rows, "ord int, reply string, call_error string")
    assert {r["ord"]: r["route"] for r in replies.route_replies(df).collect()} == {1: "summary", 2: "unparseable", 3: "not_relevant", 4: "summary", 5: "call_failed", 6: "unparseable"}


def test_each_prompt_reaches_the_model_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return ['{"problem":"p","solution":"s"}' for _ in texts]

    df = spark.createDataFrame([(str(i), "t") for i in range(20)], "ticket_id string, prompt string")
    routed = replies.route_replies(replies.score_prompts(df, model))
    assert routed.count() == 20 and routed.filter("route = 'summary'").count() == 20 and calls.value == 20


def test_summaries_keep_image_links_only(spark):
    parsed = spark.createDataFrame([("7", (None, " ", "p", None))], "ticket_id string, fields struct<ticket_id:string,date:string,problem:string,solution:string>")
    tickets = spark.createDataFrame([("7", "s", "d", "https://t/browse/X-1", ["https://h/a.png", "https://h/b", "https://h/file/get/1", "https://h/a.png", "/c.png"], ["", "b.pdf", "x.zip", "", ""])], "ticket_id string, subject string, issue_date string, url string, urls array<string>, filenames array<string>")
    r = replies.build_summaries(parsed, tickets, "HD-").first()
    assert (r["ticket_id"], r["date"], r["solution"], r["ticket_url"], r["image_urls"]) == ("HD-7", "d", "", "https://t/browse/HD-7", ["https://h/a.png"])


def test_generated_items(spark):
    good = '{"concepts":[{"title":"A","importance":9},{"title":"","importance":1},{"title":"C","importance":"x"}]}'
    rows = replies.parse_generated_items(spark.createDataFrame([(f"text {good} end",)], "reply string"), "concepts", 3).select("item.*").collect()
    assert [(r["title"], r["importance"]) for r in rows] == [("A", 3), ("C", 2)]
    q = '{"questions":[{"question":"q1","answer":"a"},{"question":"q2","answer":" "}]}'
    assert replies.parse_generated_items(spark.createDataFrame([(q,)], "reply string"), "questions", 5).count() == 1


def test_score_prompts_isolates_failures(spark):
    def fn(texts):
        if any("bad" in t for t in texts):
            raise ValueError("no")
        return [t.upper() for t in texts]

    df = spark.createDataFrame([("1", "a"), ("2", "bad"), ("3", "c")], "ticket_id string, prompt string").coalesce(1)
    rows = {r["ticket_id"]: r for r in replies.score_prompts(df, fn).collect()}
    assert rows["1"]["reply"] == "A" and rows["3"]["reply"] == "C" and rows["2"]["reply"] is None and "no" in rows["2"]["call_error"]


def test_quota_ties_and_caps(spark):
    rows = [("d", 1, 525), ("d", 2, 525), ("d", 3, 525), ("e", 1, 0), ("f", 1, 175)]
    df = spark.createDataFrame(rows, "doc string, chapter int, tokens long")
    got = {(r["doc"], r["chapter"]): r["quota"] for r in windows.allocate_quota(df, "doc", "chapter", "tokens", 30, 4).collect()}
    assert got[("d", 1)] == 1 and got[("d", 2)] == 1 and got[("d", 3)] == 2  # base 2 each, ties to the larger index
    assert got[("e", 1)] == 0 and got[("f", 1)] == 0


def test_split_quota_sums_to_n(spark):
    df = spark.createDataFrame([("a", k, 100, n) for n, ks in ((7, 3), (2, 5), (5, 5)) for k in range(ks) for n in [n]][:3], "doc string, chunk int, tokens long, n long")
    assert sum(r["quota"] for r in windows.split_quota_over_chunks(df).collect()) == 7
    few = spark.createDataFrame([("b", k, 100, 2) for k in range(5)], "doc string, chunk int, tokens long, n long")
    assert [r["quota"] for r in windows.split_quota_over_chunks(few).orderBy("chunk").collect()] == [0, 0, 0, 1, 1]
    floor = windows.split_quota_over_chunks(few, floor=1).collect()
    assert [r["quota"] for r in floor] == [1] * 5


def test_pack_chunks_rejoins(spark):
    text = "\n\n".join("w" * n for n in (3000, 3000, 9000, 40, 500, 100))
    rows = tx.pack_chunks(spark.createDataFrame([(1, text), (2, "  "), (3, None)], "id int, t string"), "id", "t", 1000).orderBy("chunk_ord").collect()
    assert "\n\n".join(r["content"] for r in rows) == text and {r["id"] for r in rows} == {1}


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4)], [(9, 1), (9, 2), (9, 3)], [(5, 6), (7, 8), (6, 8)], [(4, 3), (3, 4)]])
def test_components_do_not_depend_on_order(spark, edges):
    def run(e):
        return {(r["node"], r["component"]) for r in graph.connected_components(spark.createDataFrame(e, "a long, b long")).collect()}

    first = run(edges)
    assert first == run([(b, a) for a, b in reversed(edges)])
    assert all(c <= n for n, c in first)


def test_reachable_depths(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e")], "src string, dst string")
    assert {(r["page"], r["depth"]) for r in pages.reachable_pages(links, ["a"], 2).collect()} == {("a", 0), ("b", 1), ("c", 1), ("d", 2)}


def test_append_new_compares_text_and_keeps_repeats(spark):
    old = spark.createDataFrame([("1", "x")], "id string, v string")
    new = spark.createDataFrame([("1", "y"), ("2", "z"), ("2", "z")], "id string, v string")
    once = joins.append_new(old, new, "id")
    assert once.count() == 3 and joins.append_new(once, new, "id").count() == 3


def test_resolved_range(spark):
    rows = [("a", "2024-01-31T23:59:59+0000"), ("b", "2024-02-01T00:30:00+0200"), ("c", "2024-02-01T00:00:00Z"), ("d", "bad"), ("e", None), ("f", "2024-01-15T10:00:00")]
    df = spark.createDataFrame(rows, "k string, resolutiondate string")
    assert {r["k"] for r in filters.filter_resolved(df, True, "20240101", "2024-01-31").collect()} == {"a", "b", "f"}
    assert {r["k"] for r in filters.filter_resolved(df, False).collect()} == set("abcdef")
    with pytest.raises(ValueError):
        filters.filter_resolved(df, True, "20240201", "20240101")
    with pytest.raises(ValueError):
        filters.filter_resolved(df, True, "1.2.2024")


def test_scope_errors(spark):
    df = spark.range(5).withColumnRenamed("id", "ticket_id")
    assert filters.select_scope(df, "first", 0).count() == 5
    with pytest.raises(ValueError):
        filters.select_scope(df, "start", start_id=9)


def test_representative_and_review_ties(spark):
    m = spark.createDataFrame([(0, 5, "s", "pp", ""), (0, 3, "s", "pp", ""), (1, 1, "a", "", "xx"), (1, 2, "a", "", "xxx")], "cluster_id long, ord long, subject string, problem string, solution string")
    assert {r["cluster_id"]: r["representative_ord"] for r in windows.pick_representative(m).collect()} == {0: 3, 1: 2}
    pairs = spark.createDataFrame([(1, 4, 0.8, "review"), (1, 2, 0.8, "review"), (1, 3, 0.9, "merge")], "i long, j long, score double, kind string")
    t = spark.createDataFrame([(k, f"T{k}", "s" * 200) for k in range(1, 5)], "ord long, ticket_id string, subject string")
    r = similarity.review_pairs(pairs, t).collect()
    assert len(r) == 1 and r[0]["j"] == 2 and len(r[0]["subject_A"]) == 120


def test_similarity_blocks_agree_with_one_block_and_lsh(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id < 300").select(F.col("vec_id").alias("ord"), "embedding")
    key = lambda df: {(r["i"], r["j"]): round(r["score"], 9) for r in df.collect()}
    one, many = key(similarity.similarity_pairs(v, 0.3, 0.38, block=1000)), key(similarity.similarity_pairs(v, 0.3, 0.38, block=40))
    assert one == many and one
    lsh = key(similarity.similarity_pairs(v, 0.3, 0.38, mode="lsh"))
    assert set(lsh) <= set(one)


def test_images_greedy(spark):
    base = [0] * 32 + [255] * 32
    near = [255, 0] + base[2:]
    rows = [("t", 0, base), ("t", 1, near), ("t", 2, base[::-1]), ("u", 0, base)]
    df = spark.createDataFrame(rows, "ticket_id string, ord long, pixels array<int>")
    got = {(r["ticket_id"], r["ord"]): r["kept"] for r in images.near_duplicate_images(df).collect()}
    assert got == {("t", 0): True, ("t", 1): False, ("t", 2): True, ("u", 0): True}
    assert {r["ord"] for r in images.near_duplicate_images(df, "exact").filter("kept and ticket_id = 't'").collect()} == {0, 1, 2}


def test_ordinal_is_gapless(spark):
    df = with_ordinal(spark.range(1000).select((F.col("id") * 7 % 1009).alias("k")), ["k"], slots=7)
    assert [r["ord"] for r in df.orderBy("k").collect()] == list(range(1000))


def test_embed_with_counts(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "ord long, text string")
    assert {r["ord"]: r["embedding"] for r in similarity.embed_with(df, lambda t: [[len(x)] for x in t]).collect()} == {1: [2.0], 2: [0.0]}


def test_generation(spark):
    ch = spark.createDataFrame([("f", 1, "word " * 500, 625), ("f", 2, "", 1)], "source_file string, chapter long, content string, token_estimate long")
    rows = generation.generate_qa(ch, lambda t, n: [{"question": f"Q{k % 2}", "answer": "a"} for k in range(n)], 5).collect()
    assert {r["question"] for r in rows} == {"Q0", "Q1"}
    covered = generation.generate_until_covered(
        ch.filter("chapter = 1"), lambda t, n: [{"title": x, "importance": 2} for x in ("A", "a", "B", "C")][:n], lambda t, open_, n: [{"question": f"about {k}", "answer": "x", "covers": [k]} for k, _ in open_[:n]]
    ).collect()
    assert len(covered) == 3 and covered[0]["coverage"] == 1.0
    long = spark.createDataFrame([("f", 1, "\n\n".join("w" * 4000 for _ in range(6)))], "source_file string, chapter long, content string")
    rows = generation.extract_concepts(long, lambda t, n: [{"title": f"{len(t)}-{k}"} for k in range(n)], max_concepts=7, max_tokens=1000).collect()
    assert len(rows) == 2 and {r["concept_id"] for r in rows} == {"c1", "c2"}  # six chunks of one size share seven titles


def test_sources_round_trip(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"export_info": {"api_base_url": "https://b"}, "tickets": [{"ticket_id": 7, "Subject": "s", "Attachments": [], "kommentare": []}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"ticket_id": "SUP-1"}]))
    rows = files.read_tickets(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r["ord"], r["ticket_id"]) for r in rows] == [(0, "7"), (1, "SUP-1")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.json").write_text('{"other": 1}')
    with pytest.raises(Exception):  # noqa: B017
        files.read_tickets(spark, str(tmp_path / "c")).collect()
    pairs = spark.createDataFrame([("a", "b", 0.5, "s", "t")], "ticket_id_A string, ticket_id_B string, similarity double, subject_A string, subject_B string")
    files.write_review_csv(pairs, str(tmp_path / "out"))
    assert "a;b;0.5000;s;t" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))


def test_redaction_and_contacts(spark):
    df = spark.createDataFrame([("Bearer abc token=x password: y",)], "t string")
    assert df.select(tx.redact(F.col("t"))).first()[0] == "Bearer abc token=[REDACTED] password=[REDACTED]"
    assert one(spark, tx.redact, "authorization: bearer a.b c&d", "basic knowledge of the bearer of news", "Authorization:BASIC x monkey: y&z") == ["Authorization: Bearer [REDACTED] c&d", "basic knowledge of the bearer of news", "Authorization: Basic [REDACTED] monkey=[REDACTED]&z"]
    m = spark.createDataFrame([({"ApiKey": "1", "mode": "x"},)], "m map<string,string>")
    assert m.select(tx.redact_params(F.col("m"))).first()[0] == {"mode": "x"}


def test_json_is_normalised_at_every_depth(spark, tmp_path):
    df = spark.createDataFrame([("“x”", ["ﬁ"], (1, "a\u00a0b"), {"k": "–"})], "t string, l array<string>, s struct<n:int,v:string>, m map<string,string>")
    replies.write_json_normalised(df, str(tmp_path / "out"))
    line = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert json.loads(line) == {"t": '"x"', "l": ["fi"], "s": {"n": 1, "v": "a b"}, "m": {"k": "-"}}


def test_articles_chapters_exports_and_blocks(spark, tmp_path):
    (tmp_path / "kb").mkdir()
    (tmp_path / "kb" / "a.json").write_text(json.dumps({"export_info": {"api_base_url": "https://b"}, "articles": [{"ArticleId": 3, "Subject": "s", "Tags": ["x"]}]}))
    (tmp_path / "kb" / "b.json").write_text(json.dumps([{"ArticleId": 4}]))
    rows = files.read_articles(spark, str(tmp_path / "kb"), "https://d").orderBy("ord").collect()
    assert [(r["ArticleId"], r["base_url"]) for r in rows] == [(3, "https://b"), (4, "https://d")]
    (tmp_path / "ch").mkdir()
    (tmp_path / "ch" / "b.json").write_text(json.dumps({"source_file": "b", "chapters": [{"index": 1, "title": "t", "content": "c"}]}))
    (tmp_path / "ch" / "a.json").write_text(json.dumps({"source_file": "a", "chapters": [{"index": 1, "title": "u"}, {"index": 2}]}))
    (tmp_path / "ch" / "bad.json").write_text("{broken")
    (tmp_path / "ch" / "note.txt").write_text("no")
    assert [(r["source_file"], r["index"]) for r in files.read_chapter_dir(spark, str(tmp_path / "ch")).collect()] == [("a", 1), ("a", 2), ("b", 1)]
    tickets = spark.createDataFrame([("1", [("f", "u", 1)], [("d", "b", "n", [("g", "v", 2)])])], "ticket_id string, Attachments array<struct<FileName:string,Url:string,Size:bigint>>, kommentare array<struct<CommentDate:string,Body:string,UserName:string,Attachments:array<struct<FileName:string,Url:string,Size:bigint>>>>")
    files.write_export(tickets, str(tmp_path / "export"))
    info = spark.read.json(str(tmp_path / "export" / "export_info")).first()
    assert (info["total_tickets"], info["total_comments"], info["total_ticket_attachments"], info["total_comment_attachments"]) == (1, 1, 1, 1) and spark.read.parquet(str(tmp_path / "export" / "tickets")).count() == 1
    blocks = tx.text_to_blocks(spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string"), "id", "t").withColumn("doc_file", F.concat(F.lit("f"), "id"))
    files.write_blocks(blocks, str(tmp_path / "blocks"))
    assert {p.name for p in (tmp_path / "blocks").iterdir() if p.is_dir()} == {"doc_file=f1", "doc_file=f2"}


def test_refresh_of_image_links(spark):
    summaries = spark.createDataFrame([("HD_1", ["old"]), ("2", ["old"]), ("HD_3", ["old"])], "ticket_id string, image_urls array<string>")
    raw = spark.createDataFrame([(0, "1", [("a.png", "u1", 0)]), (1, "1", [("b.png", "u2", 0), ("b.png", "u2", 0), ("c.pdf", "u3", 0)]), (2, "2", [("c.pdf", "u4", 0)])], "ord int, ticket_id string, Attachments array<struct<FileName:string,Url:string,Size:bigint>>")
    out = joins.refresh_image_urls(summaries, raw, "HD_")
    assert {r["ticket_id"]: r["image_urls"] for r in out.collect()} == {"1": ["u2", "u2"], "2": ["old"], "3": ["old"]}
    assert tuple(joins.refresh_counts(out).first()) == (1, 2, 2)


def test_lsh_recall(spark, sf):
    """Links of the approximate mode against all pairs, on local text vectors at the default thresholds."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("ord"), "text")
    vectors = similarity.embed_texts(docs)
    pairs = lambda mode: {(r["i"], r["j"]) for r in similarity.similarity_pairs(vectors, 0.78, 0.84, mode=mode).collect()}
    exact, found = pairs("exact"), pairs("lsh")
    assert len(exact) > 20 and found <= exact and len(found) >= 0.9 * len(exact)


def test_index_mode_is_exact_and_compares_few_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("ord"), "text")
    vectors = similarity.embed_texts(docs, features=1 << 13)
    seen, real = {}, similarity.written

    def spy(df, name):
        out = real(df, name)
        seen[name] = out.count()
        return out

    similarity.written = spy
    try:
        index = {(r["i"], r["j"]): round(r["score"], 9) for r in similarity.similarity_pairs(vectors, 0.78, 0.84, mode="index").collect()}
    finally:
        similarity.written = real
    exact = {(r["i"], r["j"]): round(r["score"], 9) for r in similarity.similarity_pairs(vectors, 0.78, 0.84).collect()}
    n = docs.count()
    assert index == exact and seen["index-pairs"] < 0.3 * n * (n - 1) / 2
    odd = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (4, [1.0, 1.0]), (5, [-1.0, 0.0])], "ord long, embedding array<double>")
    assert {(r["i"], r["j"]) for r in similarity.similarity_pairs(odd, 0.7, 0.9, mode="index").collect()} == {(2, 3), (2, 4), (3, 4)}


def test_links_stand_for_all_pairs_in_few_rows(spark, sf):
    """Components and best review partners of the links are those of all pairs; copies give no pair each."""
    v = spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id < 150").select(F.col("vec_id").alias("ord"), "embedding")
    copies = v.filter("ord = 7").select(F.explode(F.sequence(F.lit(1000).cast("long"), F.lit(1099).cast("long"))).alias("ord"), "embedding")
    v = v.unionByName(copies)
    tickets = v.select("ord", F.col("ord").cast("string").alias("ticket_id"), F.lit("s").alias("subject"))
    pairs = similarity.similarity_pairs(v, 0.3, 0.38, block=40).cache()
    for block in (40, 1000):
        links = similarity.similarity_links(v, 0.3, 0.38, block=block).cache()
        parts = [{(r["node"], r["component"]) for r in similarity.connected_components(x.select(F.col("i").alias("a"), F.col("j").alias("b"))).collect()} for x in (links.filter("kind = 'link'"), pairs.filter("kind = 'merge'"), similarity.similarity_links(v, 0.38, 0.38, block=block))]
        assert parts[0] == parts[1] == parts[2] and parts[0]
        best = [{(r["i"], r["j"], r["similarity"]) for r in similarity.review_pairs(x, tickets).collect()} for x in (links, pairs)]
        assert best[0] == best[1] and best[0]
    assert links.count() < 2 * v.count() < pairs.count()


def test_blocks_are_bounded_in_number_and_bytes(spark, monkeypatch):
    """A row is copied once for each block, so many rows get few blocks until these are full."""
    v = spark.range(400).select(F.col("id").alias("ord"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"))
    sizes = lambda: {r["pair"]: r["count"] for r in similarity._dealt(v, 2, "ord", "embedding").count().collect()}
    assert sum(sizes().values()) == 400 * similarity.BLOCKS
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 320)
    assert sum(sizes().values()) == 400 * 20


def test_sparse_vectors_are_sent_without_zeros(spark, sf, monkeypatch):
    """Blocks are counted by what is not zero; links in one round, in several, and of whole vectors connect the same rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("ord"), F.substring("text", 1, 300).alias("text"))
    v = similarity.embed_texts(docs.filter("doc_id % 3 > 0").unionByName(spark.createDataFrame([(-1, ""), (-2, None)], "ord long, text string"))).localCheckpoint()
    n, full = v.count(), v.agg(F.sum(F.size(F.filter("embedding", lambda x: x != 0)))).first()[0]
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 1 << 11)
    sent = similarity._dealt(v, 2000, "ord", "embedding").count().collect()
    blocks = -(-6 * full // (1 << 11))
    assert blocks > similarity.BLOCKS and sum(r["count"] for r in sent) == n * blocks and 4 * blocks < n * 512 * 8 >> 11
    names, real = [], similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, name: names.append(name) or real(df, name))

    def parts(edges):
        root = {}
        for r in edges.filter("kind in ('link', 'merge')").collect():
            a, b = root.get(r["i"], {r["i"]}), root.get(r["j"], {r["j"]})
            root |= dict.fromkeys(a | b, a | b)
        return {frozenset(x) for x in root.values()}

    pairs = similarity.similarity_pairs(v, 0.5, 0.6).cache()
    rounds = similarity.similarity_links(v, 0.6, 0.6)
    assert names == ["links-of-round"] * -(-blocks // similarity.BLOCKS) and len(names) > 1
    assert parts(rounds) == parts(pairs) == parts(similarity.similarity_links(v, 0.6, 0.6, at_once=True)) == parts(similarity.similarity_links(v, 0.5, 0.6)) != set()
    whole = {r["ord"]: r["embedding"] for r in v.collect()}
    ids = sorted(whole)
    x = np.array([whole[k] for k in ids], np.float64)
    norm = np.sqrt((x * x).sum(1))[:, None]
    x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    product = x @ x.T
    want = {(ids[i], ids[j]): round(product[i, j], 9) for i, j in zip(*np.nonzero(np.triu(product >= 0.5, 1)), strict=True)}
    assert {(r["i"], r["j"]): round(r["score"], 9) for r in pairs.collect()} == want and len(want) > 20


def test_text_functions_bound_their_batches(spark):
    """Python gets few rows and bytes of text at a time, whatever ran in the session before."""
    for key, value in (("maxRecordsPerBatch", 10000), ("maxBytesPerBatch", 1 << 28)):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))
    tx.markdown_to_text(F.lit("x"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20
