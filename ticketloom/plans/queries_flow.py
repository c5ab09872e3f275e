"""The whole flows over the driver's tables, with rule-based stand-ins for models."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ticketloom.operators import mapping, pages
from ticketloom.plans import pipelines
from ticketloom.plans.common import Register, conversation_tickets, documents, page_links
from ticketloom.session import table, written

register = Register()
QUERIES, ORACLE_SQL = register.queries, register.sql


def rule_model(prompts: list[str]) -> list[str]:
    """A stand-in for a language model: the first and the last line of the prompt's text."""
    return [json.dumps({"ticket_id": "", "problem": p.split("\n")[5], "solution": f"{len(p)} characters"}) for p in prompts]


def rule_questions(content: str, n: int) -> list[dict]:
    sentences = [s.strip() for s in content.split(".") if s.strip()]
    return [{"question": f"What about {s}?", "answer": s} for s in sentences[:n]]


def rule_concepts(content: str, n: int) -> list[dict]:
    """A stand-in for concept extraction: the longest words of a text."""
    words = sorted({w.strip(".,").lower() for w in content.split()}, key=lambda w: (-len(w), w))
    return [{"title": w, "summary": w, "importance": 1 + len(w) % 3} for w in words[:n] if w]


def rule_covering(content: str, concepts: list[tuple[str, str]], n: int) -> list[dict]:
    return [{"question": f"What is {title}?", "answer": f"{title} has {len(title)} letters.", "covers": [k]} for k, title in concepts[:n]]


def _landed(keys, page_size, payload=None):
    """Keys (with payloads) as landed list pages of page_size, the last one short or empty."""
    rows = keys.select(F.lit("list").alias("source"), F.floor(col("n") / page_size).cast("int").alias("page_no"), "n", F.struct(col("key"), (payload if payload is not None else F.lit("")).alias("payload")).alias("item"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("n", "item"))), lambda x: x["item"])
    return rows.groupBy("source", "page_no").agg(packed.alias("items")).withColumn("is_last", F.lit(False))


@register("flow_helpdesk")
def flow_helpdesk(spark, d):
    tickets, comments, attachments = conversation_tickets(spark, d)
    i = col("ticket_id").cast("long")
    details = tickets.withColumns({"key": F.concat(F.lit("I"), "ticket_id"), "ord": i, "category": F.when(i % 4 == 0, "other").otherwise("support"), "status": F.when(i % 5 == 0, "open").otherwise("closed"), "load_error": F.when(i % 9 == 0, "HTTP 500"), "issue_date": F.lit("2024-01-01"), "url": F.concat(F.lit("https://t/"), "ticket_id")})
    landed = _landed(details.select("key", i.alias("n")), 50)
    blocks, rejected = pipelines.helpdesk_flow(landed, details, comments, attachments, "closed", ["support"], rule_model, page_size=1, mode="start", start_id=0)
    return blocks.select("doc_file", "ticket_id", "block_ord", "style", "content")


@register("flow_articles", """WITH a AS (SELECT c_custkey AS k, 'About ' || c_custkey AS subject, CASE WHEN c_custkey % 3 = 0 THEN 'listed ' || c_custkey ELSE '**Note** ' || c_custkey END AS body, n_name AS category FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT k AS "ArticleId", 0::BIGINT AS block_ord, CASE WHEN k % 3 = 0 THEN 'listed ' || k ELSE 'Note ' || k || ' see https://kb.example.com/x' END AS content, category AS doc_file FROM a""")
def flow_articles(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    key = col("c_custkey")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(key.alias("ArticleId"), key.alias("ord"), F.concat(F.lit("About "), key.cast("string")).alias("Subject"), F.concat(F.lit("listed "), key.cast("string")).alias("Body"), col("n_name").alias("CategoryName"), F.array(F.lit("t")).alias("Tags"))
    body = F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("[b]Note[/b] "), key.cast("string"), F.lit(" see [url]/x[/url]")))
    detail = c.select(key.alias("ArticleId"), F.lit("").alias("Subject"), body.alias("Body"), F.lit("").alias("CategoryName"), F.lit(None).cast("array<string>").alias("Tags"))
    out = pipelines.article_flow(rows.filter(key % 2 == 0), rows, detail, "https://kb.example.com")
    return out.select("ArticleId", "block_ord", F.translate("content", "<>", "").alias("content"), "doc_file")


@register("flow_tracker")
def flow_tracker(spark, d):
    docs = documents(spark, d)
    key = F.concat(F.lit("SUP-"), col("doc_id").cast("string"))
    day = F.concat(F.lit("2024-01-"), F.lpad((col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00+0200"))
    issues = docs.select(col("doc_id").alias("ord"), key.alias("key"), F.substring_index("text", ".", 1).alias("summary"), F.lit("Done").alias("status"), day.alias("created"), F.when(col("doc_id") % 7 > 0, day).alias("resolutiondate"), F.lit("Bug").alias("issuetype"), F.lit(None).cast("string").alias("description"), col("text").alias("rendered_description"))
    comments = table(spark, d, "labels").select(F.concat(F.lit("SUP-"), col("doc_id").cast("string")).alias("key"), F.lit(1).alias("c_ord"), F.lit("staff").alias("author"), F.when(col("toxic") == 1, "customer").alias("account_type"), F.lit("now").alias("created"), F.lit("seen").alias("rendered_body"), F.lit(None).cast("string").alias("body_tree"))
    existing = docs.filter("doc_id % 11 = 0").select(key.alias("ticket_id"))
    landed = _landed(docs.select(key.alias("key"), col("doc_id").alias("n")), 100)
    return pipelines.tracker_flow(landed, issues, comments, existing, rule_model, "https://t.example.com", page_size=1, after="20240105", before="2024-01-25")[1]


_CRM = """f AS (SELECT p_partkey AS ord, CASE WHEN p_size % 3 = 0 THEN '.pdf' ELSE '.docx' END AS ext, p_brand AS folder, trim(regexp_replace(p_name, '[^\\p{L}\\p{N} ._-]', '', 'g')) AS stem FROM part),
    k AS (SELECT *, folder IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21', 'Brand#22', 'Brand#23', 'Brand#31', 'Brand#32', 'Brand#33', 'Brand#41', 'Brand#42', 'Brand#43', 'Brand#51', 'Brand#52', 'Brand#53') AS kept FROM f),
    t AS (SELECT p_brand AS folder, '.pdf' AS ext, p_name || '_1' AS name, -1 AS at FROM part WHERE p_partkey % 40 = 0 UNION ALL SELECT folder, ext, stem, ord FROM k WHERE kept),
    n AS (SELECT k.* FROM k WHERE kept AND NOT EXISTS (SELECT 1 FROM t WHERE t.folder = k.folder AND t.ext = k.ext AND starts_with(t.name, k.stem) AND t.at < k.ord))"""


def _crm_flow(spark, d):
    p = table(spark, d, "part")
    payload = F.to_json(F.struct(col("p_partkey").alias("doc_id"), F.when(col("p_size") % 3 == 0, "PDF").otherwise(".docx").alias("extension"), col("p_brand").alias("folder"), col("p_name").alias("name")))
    landed = _landed(p.select(col("p_partkey").cast("string").alias("key"), col("p_partkey").alias("n"), payload.alias("payload")), 100, col("payload"))
    manifest = p.filter("p_partkey % 40 = 0").select(col("p_brand").alias("dir"), F.lit(".pdf").alias("ext"), F.concat("p_name", F.lit("_1")).alias("name"))
    folders = [f"Brand#{k}{n}" for k in range(1, 6) for n in range(1, 4)]
    return pipelines.crm_flow(landed, manifest, ["pdf", "docx"], folders, page_size=1)


# earlier rows of a batch count as existing, so that names of one folder are distinct already
@register("flow_crm", f"WITH {_CRM} SELECT ord, folder, stem || ext AS final_name FROM n")
def flow_crm(spark, d):
    return _crm_flow(spark, d)[0].select("ord", "folder", "final_name")


@register("flow_crm_report", f"WITH {_CRM} SELECT count(*) AS scanned, (SELECT count(*) FROM n) AS downloaded, sum(kept::BIGINT)::BIGINT - (SELECT count(*) FROM n) AS skipped_existing, sum((NOT kept)::BIGINT)::BIGINT AS skipped_other, 0::BIGINT AS failed FROM k")
def flow_crm_report(spark, d):
    return _crm_flow(spark, d)[1]


def _paragraphs(spark, d):
    return documents(spark, d).select(col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("ord", "text")).withColumn("style", F.when(col("ord") % 8 == 0, "Heading 1").otherwise("Normal")).withColumn("outline_level", F.lit(None).cast("int"))


@register("flow_qa")
def flow_qa(spark, d):
    return pipelines.qa_flow(_paragraphs(spark, d), rule_questions, 10, 20)[2].drop("runs")


@register("flow_qa_totals")
def flow_qa_totals(spark, d):
    return pipelines.qa_flow(_paragraphs(spark, d), rule_questions, 10, 20)[1]


@register("flow_covering_qa")
def flow_covering_qa(spark, d):
    return pipelines.covering_qa_flow(_paragraphs(spark, d), rule_concepts, rule_covering, max_concepts=12)[0]


def linked_pages(spark, d):
    """Pages with links to other pages of the same host written into them: relative to the root, to the folder, to
    the scheme, and whole; and links that lead nowhere."""
    p = table(spark, d, "pages").select("page_id", "url", "html")
    ends = p.select(col("page_id").alias("dst"), col("url").alias("to"))
    rest = F.regexp_extract("to", "^https?://[^/]*(.*)$", 1)
    k = col("src") % 5
    href = F.when(k == 0, rest).when(k == 1, F.concat(F.lit("../../../x/./.."), rest)).when(k == 2, F.concat(F.lit("//"), F.regexp_extract("to", "^https?://([^/]*)", 1), rest)).when(k == 3, col("to")).otherwise(F.concat(F.lit("../../../"), F.expr("substring(regexp_extract(to, '^https?://[^/]*(.*)$', 1), 2)")))
    place = lambda c: F.regexp_extract(c, "^(https?://[^/]*)", 1)
    href = F.when(place("url") == place("to"), href).otherwise(col("to"))  # another scheme or host needs the whole URL
    made = page_links(spark, d).join(ends, "dst").join(p.select(col("page_id").alias("src"), "url"), "src")
    tags = made.select("src", F.concat(F.lit('<a class="n" href="'), F.replace(href, F.lit("&"), F.lit("&amp;")), F.lit('">x</a><a href="mailto:a@b">m</a>')).alias("tag"))
    own = tags.groupBy(col("src").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list("tag")), "").alias("tags"))
    return p.join(own, "page_id", "left").select("page_id", "url", F.concat("html", F.coalesce("tags", F.lit(""))).alias("html"))


def _web(spark, d):
    """Starts at the first page of every host."""
    p = written(linked_pages(spark, d), "linked-pages")  # read for links, for URLs and for what is reached
    first = p.groupBy(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host")).agg(F.min("page_id").alias("page"))
    link = F.concat(F.lit('<ul><li><a href="/svc.asmx?op=Get_'), (col("page_id") % 50).cast("string"), F.lit('">call</a> - returns rows</li></ul>'))
    return pipelines.web_flow(p.withColumn("html", F.concat("html", link)), first.select("page"), "https://base.example.com/")


@register("page_link_graph", r"""WITH h AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages),
    n AS (SELECT page_id AS src, lead(page_id) OVER (PARTITION BY host ORDER BY page_id) AS dst FROM h)
    SELECT DISTINCT src, (SELECT min(page_id) FROM h b WHERE b.url = a.url) AS dst FROM (
      SELECT src, dst FROM n WHERE dst IS NOT NULL UNION SELECT x.page_id, y.page_id FROM h x JOIN h y ON y.page_id = 2 * x.page_id WHERE x.host = y.host) JOIN h a ON a.page_id = dst""")
def page_link_graph(spark, d):
    return pages.page_link_graph(linked_pages(spark, d))


@register("markup_blocks")
def markup_blocks(spark, d):
    return pages.markup_blocks(table(spark, d, "pages"))


@register("markup_list_items", r"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) AS n, item FROM (
    SELECT page_id, unnest(x) AS item, generate_subscripts(x, 1) AS k FROM (SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda i: trim(replace(replace(regexp_replace(i, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'))) AS x FROM pages)) WHERE item <> ''""")
def markup_list_items(spark, d):
    items = pages.markup_blocks(table(spark, d, "pages")).filter("style = 'bullet'")
    n = F.row_number().over(Window.partitionBy("page_id").orderBy("block_ord"))
    return items.select("page_id", n.alias("n"), col("content").alias("item"))


@register("flow_web")
def flow_web(spark, d):
    return _web(spark, d)[0]


@register("flow_web_operations")
def flow_web_operations(spark, d):
    return _web(spark, d)[2]


@register("issues_to_tickets", """WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY 1)
    SELECT o_orderkey AS ord, 'SUP-' || o_orderkey AS ticket_id, o_orderpriority AS "Subject", CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority || chr(10) || 'x' ELSE o_orderpriority END AS "Body", 'https://t.example.com/browse/SUP-' || o_orderkey AS "Url", coalesce(n, 0) AS n_comments
    FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def issues_to_tickets(spark, d):
    o = table(spark, d, "orders")
    tree = lambda t: F.concat(F.lit('{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":"'), t, F.lit('"}]}]}'))
    key = F.concat(F.lit("SUP-"), col("o_orderkey").cast("string"))
    issues = o.select(col("o_orderkey").alias("ord"), key.alias("key"), col("o_orderpriority").alias("summary"), col("o_orderstatus").alias("status"), col("o_orderdate").cast("string").alias("created"), F.lit("Bug").alias("issuetype"), tree(col("o_orderpriority")).alias("description"), F.when(col("o_orderkey") % 2 == 0, F.concat(F.lit("<p>"), "o_orderpriority", F.lit("<br>x</p>"))).alias("rendered_description"))
    line = table(spark, d, "lineitem")
    comments = line.select(F.concat(F.lit("SUP-"), col("l_orderkey").cast("string")).alias("key"), col("l_linenumber").alias("c_ord"), col("l_returnflag").alias("author"), F.when(col("l_linenumber") % 3 == 0, "customer").alias("account_type"), col("l_shipdate").cast("string").alias("created"), F.lit("").alias("rendered_body"), tree(col("l_linestatus")).alias("body_tree"))
    out = mapping.issues_to_tickets(issues, comments, "https://t.example.com")
    return out.select("ord", "ticket_id", "Subject", "Body", "Url", F.size("kommentare").alias("n_comments"))
