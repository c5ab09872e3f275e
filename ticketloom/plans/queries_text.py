"""Queries of text, link and page operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ticketloom.functions import text as tx
from ticketloom.operators import filters, pages, replies, reports
from ticketloom.plans.common import Register, documents, page_links, replaced
from ticketloom.session import table

register = Register()
QUERIES, ORACLE_SQL = register.queries, register.sql


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _entities(c: str) -> str:
    """What the pages hold of character references, the ampersand last."""
    return f"regexp_replace(replace(replace(replace({c}, '&middot;', '·'), '&copy;', '©'), '&quot;', chr(34)), '&amp;?', '&', 'g')"


_BREAKS = _entities(replaced("replace(html, '<!--html-->', '')", [(r"(?i)<br\s*/?>|</?(?:div|p)[^>]*>", "\n"), (r"<[^>]+>", "")]))
_BREAKS = _trim(replaced(_BREAKS, [(" {2,}", " "), (r"\n\s*\n\s*\n+", "\n\n")]))
_INLINE = _trim(replaced(_entities(replaced("html", [(r"(?i)<br\s*/?>", "\n"), (r"<[^>]+>", "")])), [(r"\n{3,}", "\n\n")]))


@register("clean_html", f"SELECT page_id, {_BREAKS} AS body FROM pages")
def clean_html(spark, d):
    return table(spark, d, "pages").select("page_id", tx.clean_html(col("html")).alias("body"))


@register("strip_html", f"SELECT page_id, {_INLINE} AS body FROM pages")
def strip_html(spark, d):
    return table(spark, d, "pages").select("page_id", tx.clean_html(col("html"), "inline").alias("body"))


_HOST = "regexp_extract(url, '//([^/?#]+)', 1)"


@register(
    "strict_urls",
    f"""SELECT page_id, CASE page_id % 6 WHEN 3 THEN NULL WHEN 4 THEN '"' WHEN 5 THEN url || '"' ELSE url END AS strict,
    CASE page_id % 5 WHEN 0 THEN split_part(url, '://', 1) || '://' || {_HOST} || '/api' WHEN 1 THEN split_part(url, '://', 1) || '://' || {_HOST} || '/helpdesk/api' WHEN 2 THEN 'https://spare.example.com:8080/helpdesk/api' WHEN 3 THEN 'https://' || {_HOST} || '/api' END AS api_root FROM pages""",
)
def strict_urls(spark, d):
    url, lit = col("url"), F.lit
    # as attributes hold them: in quotes, with something behind, none at all, and half quoted
    raws = [F.concat(lit(' "'), url, lit('" ')), F.concat(lit("'"), url, lit(" x'")), F.concat(url, lit("<br>")), lit("\t  "), F.concat(lit('" '), url, lit("\ny")), F.concat(url, lit('"'))]
    bases = [url, F.regexp_replace(url, r"^(\w+://[^/]+)", "$1/HelpDesk"), lit(""), F.regexp_replace(url, r"^\w+:", ""), lit("no host/helpdesk")]
    pick = lambda values: F.get(F.array(*values), (col("page_id") % len(values)).cast("int"))
    spare = lit("HTTPS://spare.example.com:8080/a/helpdesk;x?y")
    return table(spark, d, "pages").select("page_id", tx.strict_url(pick(raws)).alias("strict"), tx.api_root(pick(bases), spare).alias("api_root"))


# the documents hold no square bracket, so what the planted tags become can be spelled out
_QUOTE = r"array_to_string(list_transform(string_split(regexp_replace(substr(text, 41, 200), '^\n+|\n+$', '', 'g'), chr(10)), lambda x: CASE WHEN regexp_matches(x, '^\s*$') THEN '>' ELSE '> ' || x END), chr(10))"
_BB = rf"""'**' || substr(text, 1, 40) || '** [li\)n\]k](https://e.com/a) <https://kb.example.com/rel>' || chr(10) || '- one - two![](https://kb.example.com/x.png)' || chr(10) || chr(10) || {_QUOTE} || chr(10) || '_it_<u>un</u>[b]open' || chr(10) || '```' || chr(10) || 'code' || chr(10) || '```' || chr(10) || substr(text, 241)"""


@register("bbcode", f"SELECT doc_id, {_trim(replaced(_BB, [(r'(?i)<br' + chr(92) + r's*/?>', chr(10)), (r'(?s)<!--.*?-->', ''), (chr(92) + 'n' + chr(92) + 's*' + chr(92) + 'n' + chr(92) + 's*' + chr(92) + 'n+', chr(10) * 2)]))} AS body FROM documents")
def bbcode(spark, d):
    raw = F.concat(
        F.lit("[b]"), F.substring("text", 1, 40), F.lit("[/b] [URL=https://e.com/a] li)n]k [/url] [url] /rel [/url]\r\n[list][*] one [*]two[/list][img]/x.png[/img]\n[quote]"),
        F.substring("text", 41, 200), F.lit("[/quote][i]it[/I][u]un[/u][b]open[code]\ncode\n[/code]"), F.expr("substring(text, 241)"),
    )
    return documents(spark, d).select("doc_id", tx.bbcode_to_markdown(raw, "https://kb.example.com").alias("body"))


_MD_RULES = [(r"(?s)```\s*(.*?)\s*```", "\n\\1\n"), (r"(?m)^[ \t]*> ?", ""), (r"!\[[^\]]*\]\(([^)]+)\)", r"\1"), (r"\[([^\]]+)\]\(([^)]+)\)", r"\1 (\2)"), (r"(?i)</?u>", ""), (r"(?m)^\s{0,3}#{1,6}\s*", ""), (r"\*\*(.*?)\*\*", r"\1"), (r"__(.*?)__", r"\1"), (r"_(.*?)_", r"\1"), (r"\*(.*?)\*", r"\1"), (r"(?m)^-\s+", "- "), (r"[ \t]+", " "), (r"\n\s*\n\s*\n+", "\n\n")]
_MD = "'# Title' || chr(10) || '> quoted **bold** _x_ and [a](https://e.com) ![i](https://e.com/i.png)' || chr(10) || '-   item  * one' || chr(10) || '```sql' || chr(10) || 'select 1' || chr(10) || '```' || text || '__end__ ** _'"


@register("md_to_text", f"SELECT doc_id, {_trim(replaced(_MD, _MD_RULES))} AS body FROM documents")
def md_to_text(spark, d):
    raw = F.concat(F.lit("# Title\n> quoted **bold** _x_ and [a](https://e.com) ![i](https://e.com/i.png)\n-   item  * one\n```sql\nselect 1\n```"), col("text"), F.lit("__end__ ** _"))
    return documents(spark, d).select("doc_id", tx.markdown_to_text(raw).alias("body"))


_SIM = [(r"https?://\S+", " "), (r"\bfile/get/[0-9]+\b", " "), (r"\bnn[0-9]+\b", " "), (r"\bpers?nr?\s*[:#-]?\s*[0-9]+\b", " "), (r"\bper\.[0-9]+\b", " "), (r"[\s\x0B]+", " ")]
_SIM_TEXT = "lower(substr(text, 1, 40) || ' . ' || substr(text, 41) || ' . ' || ' see https://h.example/' || doc_id || ' persnr: ' || doc_id || ' pern#' || doc_id || ' 5 per 10 users per.' || doc_id || ' nn' || doc_id || ' ' || source)"


@register("similarity_text", f"SELECT doc_id, trim({replaced(_SIM_TEXT, _SIM)}) AS body FROM documents")
def similarity_text(spark, d):
    i = col("doc_id").cast("string")
    solution = F.concat(F.lit(" see https://h.example/"), i, F.lit(" persnr: "), i, F.lit(" pern#"), i, F.lit(" 5 per 10 users per."), i, F.lit(" nn"), i, F.lit(" "), col("source"))
    return documents(spark, d).select("doc_id", tx.similarity_text(F.substring("text", 1, 40), F.expr("substring(text, 41)"), solution).alias("body"))


@register("strip_controls", r"SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') || chr(34) || '...-fi ' || chr(127) AS body FROM documents")
def strip_controls(spark, d):
    return documents(spark, d).select("doc_id", tx.normalise_unicode(F.concat("text", F.lit("“\x07…–ﬁ \x7f"))).alias("body"))


_LOG = "text || chr(10) || 'token=' || doc_id || '&x password: p' || doc_id || ' authorization: bearer abc.' || doc_id || ' Authorization:Basic x basic knowledge of the bearer of news'"


def _redacted(c: str) -> str:
    c = replaced(c, [(r"(?i)authorization:\s*bearer\s+\S+", "Authorization: Bearer [REDACTED]"), (r"(?i)authorization:\s*basic\s+\S+", "Authorization: Basic [REDACTED]")])
    return replaced(c, [(rf"(?i){word}[=:]\s*[^\s&]+", f"{word}=[REDACTED]") for word in ("token", "key", "password", "secret")])


@register("redact_secrets", f"SELECT doc_id, {_redacted(_LOG)} AS body FROM documents")
def redact_secrets(spark, d):
    i = col("doc_id").cast("string")
    raw = F.concat(col("text"), F.lit("\ntoken="), i, F.lit("&x password: p"), i, F.lit(" authorization: bearer abc."), i, F.lit(" Authorization:Basic x basic knowledge of the bearer of news"))
    return documents(spark, d).select("doc_id", tx.redact(raw).alias("body"))


_LINKS = r"""l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)(?:href|src)=["'']([^"'']+)["'']', 1)) AS h, generate_subscripts(regexp_extract_all(html, '(?i)(?:href|src)=["'']([^"'']+)["'']', 1), 1) AS k FROM pages),
n AS (SELECT page_id, k, CASE WHEN regexp_matches(lower(trim(h)), '^https?://') THEN trim(h) ELSE 'https://base.example.com/' || regexp_replace(trim(h), '^/+', '') END AS url FROM l),
u AS (SELECT page_id, url, min(k) AS k FROM n GROUP BY 1, 2)"""


@register("normalise_urls", f"WITH {_LINKS} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INT) AS ord, url FROM u")
def normalise_urls(spark, d):
    return tx.all_links(table(spark, d, "pages"), "page_id", "html", "https://base.example.com/").select("page_id", "ord", col("Url").alias("url"))


_IS_ATTACHMENT = r"""(regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\.(png|jpe?g|gif|bmp|webp|svg|pdf|docx?|xlsx?|pptx?|zip|7z|rar|txt|log|csv)$')
    OR regexp_matches(regexp_replace(lower(regexp_replace(url, '#.*$', '')), '^https?://[^/?]*', ''), 'attach|download|file|upload|image|img'))"""
_ATTACH = """a AS (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '.webp' WHEN 1 THEN '?download=1' WHEN 2 THEN '.msg' ELSE '' END AS url FROM u)"""


@register("attachment_links", f"WITH {_LINKS}, {_ATTACH} SELECT page_id, url FROM a WHERE {_IS_ATTACHMENT}")
def attachment_links(spark, d):
    links = tx.all_links(table(spark, d, "pages"), "page_id", "html", "https://base.example.com/")
    tail = F.when(col("page_id") % 4 == 0, ".webp").when(col("page_id") % 4 == 1, "?download=1").when(col("page_id") % 4 == 2, ".msg").otherwise("")
    return links.select("page_id", F.concat("Url", tail).alias("url")).filter(filters.is_attachment_link(col("url")))


@register("extract_links", f"""WITH {_LINKS}, x AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INT) AS ord, url FROM (SELECT page_id, url, k FROM u UNION ALL SELECT page_id, 'https://base.example.com/file/get/' || page_id || '.png', 1000000 FROM pages))
    SELECT page_id, ord, split_part(regexp_replace(url, '[?#].*$', ''), '/', -1) AS "FileName", url AS "Url", 0::BIGINT AS "Size" FROM x WHERE {_IS_ATTACHMENT}""")
def extract_links(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.concat("html", F.lit('<img src="/file/get/'), col("page_id").cast("string"), F.lit('.png">')).alias("html"))
    return tx.extract_links(rows, "page_id", "html", "https://base.example.com/")


@register("file_ids", r"""WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://h/x?id=' || page_id WHEN 1 THEN 'https://h/file/' || page_id || '/' ELSE url END AS url FROM pages)
    SELECT page_id, CASE WHEN regexp_extract(url, '[?&]id=(\d+)', 1) <> '' THEN regexp_extract(url, '[?&]id=(\d+)', 1) WHEN regexp_extract(regexp_replace(url, '[?#].*$', ''), '/(\d+)/?$', 1) <> '' THEN regexp_extract(regexp_replace(url, '[?#].*$', ''), '/(\d+)/?$', 1) END AS file_id FROM u""")
def file_ids(spark, d):
    i = col("page_id")
    url = F.when(i % 3 == 0, F.concat(F.lit("https://h/x?id="), i.cast("string"))).when(i % 3 == 1, F.concat(F.lit("https://h/file/"), i.cast("string"), F.lit("/"))).otherwise(col("url"))
    return table(spark, d, "pages").select("page_id", tx.file_id_of(url).alias("file_id"))


@register("image_links", r"""WITH u AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN url || '/a.PNG' WHEN 1 THEN url || '/file/get/7' WHEN 2 THEN 'https://t/rest/api/3/attachment/content/5' WHEN 3 THEN url || '/File/Get/7.jpg' WHEN 4 THEN url || '/file/get/8.JPG' ELSE url END AS url,
      CASE page_id % 5 WHEN 0 THEN 'x.pdf' WHEN 1 THEN 'Y.JPG' WHEN 2 THEN 'z.csv' ELSE '' END AS name FROM pages),
    f AS (SELECT *, CASE WHEN regexp_matches(name, '(?i)\.(png|jpe?g|gif|bmp|webp|svg)$') THEN true WHEN regexp_matches(name, '(?i)\.(pdf|docx?|txt|xlsx?|zip|rar)$') THEN false END AS named FROM u)
    SELECT page_id, coalesce(named, regexp_matches(url, '(?i)\.(png|jpe?g|gif|bmp|webp|svg)') OR regexp_matches(regexp_replace(url, '[?#].*$', ''), '(?i)/file/get/|/rest/api/.*/attachment/content/')) AS in_summary,
      coalesce(named, url LIKE '%/rest/api/%' AND url LIKE '%/attachment/content/%' OR url LIKE '%/file/get/%' AND regexp_matches(url, '(?i)\.(png|jpe?g|gif|bmp|webp|svg)$')) AS in_refresh FROM f""")
def image_links(spark, d):
    i, u = col("page_id"), col("url")
    url = F.when(i % 7 == 0, F.concat(u, F.lit("/a.PNG"))).when(i % 7 == 1, F.concat(u, F.lit("/file/get/7"))).when(i % 7 == 2, "https://t/rest/api/3/attachment/content/5").when(i % 7 == 3, F.concat(u, F.lit("/File/Get/7.jpg"))).when(i % 7 == 4, F.concat(u, F.lit("/file/get/8.JPG"))).otherwise(u)
    name = F.when(i % 5 == 0, "x.pdf").when(i % 5 == 1, "Y.JPG").when(i % 5 == 2, "z.csv").otherwise("")
    return table(spark, d, "pages").select("page_id", filters.is_image_link(url, name).alias("in_summary"), filters.is_image_link(url, name, "refresh").alias("in_refresh"))


@register("crawlable_pages", r"""WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_replace(url, '^(https?://[^/]*)', '\1:8080') WHEN 1 THEN url || '.PDF' WHEN 2 THEN regexp_replace(url, '^https?', 'ftp') ELSE url END AS url FROM pages),
    h AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS home FROM pages GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)
    SELECT page_id, u.url FROM u, h WHERE regexp_extract(u.url, '^https?://([^/?#]*)', 1) = home AND NOT regexp_matches(lower(u.url), '\.(pdf|jpg|png|gif|zip|exe)')""")
def crawlable_pages(spark, d):
    i, u = col("page_id"), col("url")
    p = table(spark, d, "pages")
    host = p.groupBy(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("home")).count().agg(F.max_by("home", F.struct("count", "home")).alias("home"))  # one row
    url = F.when(i % 5 == 0, F.regexp_replace(u, "^(https?://[^/]*)", "$1:8080")).when(i % 5 == 1, F.concat(u, F.lit(".PDF"))).when(i % 5 == 2, F.regexp_replace(u, "^https?", "ftp")).otherwise(u)
    return p.select("page_id", url.alias("url")).join(F.broadcast(host)).filter(filters.is_crawlable(col("url"), col("home"))).select("page_id", "url")


def _inner(tag: str) -> str:
    return f"list_transform(regexp_extract_all(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1), lambda x: trim(regexp_replace({_entities("regexp_replace(x, '<[^>]*>', ' ', 'g')")}, '[ \\t\\r\\n]+', ' ', 'g')))"


@register("page_paragraphs", f"SELECT page_id, CAST(unnest(range(len({_inner('p')}))) AS INT) AS ord, unnest({_inner('p')}) AS text FROM pages")
def page_paragraphs(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(pages.inner_text("p", col("html"))).alias("ord", "text"))


@register("page_titles", f"""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '?op=get_it-em2' WHEN 1 THEN url || '/WSDL' ELSE url END AS url, {_inner('title')}[1] AS t, {_inner('h1')} AS h1, list_filter(list_concat({_inner('h1')}, {_inner('h2')}), lambda x: length(x) > 3)[1] AS head FROM pages)
    SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'Get It-Em2 - ' || head WHEN 1 THEN 'WSDL Service Description' ELSE coalesce(nullif(t, ''), nullif(h1[1], ''), 'API Documentation') END AS title FROM p""")
def page_titles(spark, d):
    url = F.when(col("page_id") % 4 == 0, F.concat("url", F.lit("?op=get_it-em2"))).when(col("page_id") % 4 == 1, F.concat("url", F.lit("/WSDL"))).otherwise(col("url"))
    return pages.page_titles(table(spark, d, "pages").withColumn("url", url))


@register("page_elements")
def page_elements(spark, d):
    return pages.page_elements(table(spark, d, "pages"))


@register("operation_catalog")
def operation_catalog(spark, d):
    link = F.concat(F.lit('<ul><li><a href="/svc.asmx?op=Get_'), (col("page_id") % 50).cast("string"), F.lit('">call</a> - returns rows</li></ul>'))
    rows = table(spark, d, "pages").select("page_id", F.concat("html", link).alias("html"))
    return pages.operation_catalog(rows, "https://base.example.com")


@register(
    "reachable",
    r"""WITH RECURSIVE h AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages), e AS (
    SELECT src, dst FROM (SELECT page_id AS src, lead(page_id) OVER (PARTITION BY host ORDER BY page_id) AS dst FROM h) WHERE dst IS NOT NULL
    UNION SELECT page_id, 2 * page_id FROM pages WHERE 2 * page_id IN (SELECT page_id FROM pages)),
    r(page, depth) AS (SELECT 1::BIGINT, 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.page WHERE r.depth < 5) SELECT page, min(depth) AS depth FROM r GROUP BY page""",
)
def reachable(spark, d):
    return pages.reachable_pages(page_links(spark, d), [1], 5)


@register("token_estimates", "SELECT doc_id, greatest(1, length(text) // 4) AS tokens, greatest(1, least(30, CAST(round_even(greatest(1, length(text) // 4) / 350.0, 0) AS INT))) AS target FROM documents")
def token_estimates(spark, d):
    tokens = tx.token_estimate(F.length("text"))
    return documents(spark, d).select("doc_id", tokens.alias("tokens"), tx.question_target(tokens, 30).alias("target"))


@register(
    "pack_chunks",
    r"""WITH RECURSIVE p AS (SELECT doc_id, trim(x, ' ' || chr(9) || chr(13) || chr(10)) AS part, k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)),
    q AS (SELECT doc_id, part, greatest(1, length(part) // 4) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM p WHERE part <> ''),
    r(doc_id, i, chunk, n) AS (SELECT doc_id, i, 0::BIGINT, t FROM q WHERE i = 1 UNION ALL SELECT q.doc_id, q.i, CASE WHEN r.n + q.t > 1000 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.n + q.t > 1000 THEN q.t ELSE r.n + q.t END FROM r JOIN q ON q.doc_id = r.doc_id AND q.i = r.i + 1),
    m AS (SELECT doc_id, max(chunk) AS last, arg_max(n, i) AS tail FROM r GROUP BY 1),
    g AS (SELECT r.doc_id, CASE WHEN chunk = last AND last > 0 AND tail < 200 THEN chunk - 1 ELSE chunk END AS chunk_ord, string_agg(part, chr(10) || chr(10) ORDER BY r.i) AS content FROM r JOIN m USING (doc_id) JOIN q ON q.doc_id = r.doc_id AND q.i = r.i GROUP BY 1, 2)
    SELECT doc_id, chunk_ord, content, greatest(1, length(content) // 4) AS tokens FROM g""",
)
def pack_chunks(spark, d):
    return tx.pack_chunks(documents(spark, d), "doc_id", "text", 1000, separator="\n")


@register(
    "text_blocks",
    r"""WITH l AS (SELECT doc_id, trim(x, ' ' || chr(9) || chr(13)) AS x, k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM (SELECT doc_id, text || chr(10) || chr(10) || '- one' || chr(10) || '* two' || chr(10) || '1. first' || chr(10) || 'end' AS t FROM documents))),
    c AS (SELECT doc_id, k, CASE WHEN x = '' THEN 'blank' WHEN regexp_matches(x, '^[-*•]\s+') THEN 'bullet' WHEN regexp_matches(x, '^\d+[.)]\s+') THEN 'number' ELSE 'paragraph' END AS style, x FROM l),
    s AS (SELECT *, (lag(style) OVER w IS DISTINCT FROM style)::INT AS st FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
    b AS (SELECT doc_id, k, style, x, sum(st) OVER (PARTITION BY doc_id ORDER BY k) - 1 AS block FROM s WHERE style <> 'blank'),
    y AS (SELECT doc_id, k, style, block, CASE style WHEN 'bullet' THEN regexp_replace(x, '^[-*•]\s+', '') WHEN 'number' THEN regexp_replace(x, '^\d+[.)]\s+', '') ELSE x END AS v FROM b)
    SELECT doc_id, CAST(block AS BIGINT) AS block_ord, style, CASE style WHEN 'paragraph' THEN string_agg(v, ' ' ORDER BY k) ELSE string_agg(v, chr(10) ORDER BY k) END AS content FROM y GROUP BY doc_id, block, style""",
)
def text_blocks(spark, d):
    rows = documents(spark, d).select("doc_id", F.concat("text", F.lit("\n\n- one\n* two\n1. first\nend")).alias("text"))
    return tx.text_to_blocks(rows, "doc_id", "text").drop("runs")


@register(
    "split_chapters",
    r"""WITH p AS (SELECT page_id AS doc, unnest(list_concat([('heading 1', regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1))], list_transform(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda x: ('normal', trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', chr(34)), '&middot;', chr(183)), '&copy;', chr(169)), '&amp;?', '&', 'g'), '[ \t\r\n]+', ' ', 'g')))))) AS r, generate_subscripts(list_concat([1], list_transform(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda x: 1)), 1) AS ord FROM pages),
    q AS (SELECT doc, ord, r[1] AS style, r[2] AS text FROM p),
    z AS (SELECT doc, 1::BIGINT AS index, max(text) FILTER (style = 'heading 1') AS title, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY ord) FILTER (style = 'normal' AND text <> ''), '') AS content FROM q GROUP BY doc)
    SELECT doc, index, title, content, length(content) AS char_count, greatest(1, length(content) // 4) AS token_estimate FROM z""",
)
def split_chapters(spark, d):
    html = col("html")
    head = F.struct(F.lit("heading 1").alias("style"), F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1).alias("text"))
    body = F.transform(pages.inner_text("p", html), lambda x: F.struct(F.lit("normal").alias("style"), x.alias("text")))
    rows = table(spark, d, "pages").select(col("page_id").alias("doc"), F.posexplode(F.concat(F.array(head), body)).alias("ord", "r"))
    return pages.split_chapters(rows.select("doc", "ord", "r.style", F.lit(None).cast("int").alias("outline_level"), "r.text")).drop("level")


@register("parse_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def parse_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k string")["k"].cast("bigint").alias("k"))


@register("parse_outcomes", "SELECT CASE WHEN event_id % 5 = 0 THEN 'FAIL' ELSE 'OK' END AS outcome, count(*) AS n FROM events GROUP BY 1")
def parse_outcomes(spark, d):
    reply = F.when(col("event_id") % 5 == 0, F.lit("no object here")).otherwise(F.to_json(F.struct(col("event_id").cast("string").alias("ticket_id"), F.lit("p").alias("problem"), F.lit("s").alias("solution"))))
    rows = table(spark, d, "events").select(col("event_id").alias("ord"), reply.alias("reply"))
    parsed, failed = replies.parse_model_replies(rows)
    return reports.parse_outcomes(parsed, failed).select("outcome", "n")


def _replies(spark, d):
    """One reply for each document, broken in a different way by residue class."""
    i = col("doc_id")
    flat = F.regexp_replace("text", "[^A-Za-z .]", "")
    problem = F.when(i % 9 == 8, F.lit("Nicht relevant")).otherwise(flat)
    good = F.to_json(F.struct(i.cast("string").alias("ticket_id"), F.lit("2024-01-02").alias("date"), problem.alias("problem"), F.lit("done").alias("solution")))
    k = i % 7
    reply = (
        F.when(k == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(k == 2, F.concat(F.lit("Here it is: "), good, F.lit(" Regards")))
        .when(k == 3, F.regexp_replace(good, r"\}$", ",}"))
        .when(k == 4, F.regexp_replace(good, '"', "”"))
        .when(k == 5, F.lit("nothing"))
        .otherwise(good)
    )
    return documents(spark, d).select(i.alias("ord"), reply.alias("reply"), F.when(i % 11 == 0, "timeout").alias("call_error"))


@register("route_replies", "SELECT doc_id AS ord, CASE WHEN doc_id % 11 = 0 THEN 'call_failed' WHEN doc_id % 7 = 5 THEN 'unparseable' WHEN doc_id % 9 = 8 THEN 'not_relevant' ELSE 'summary' END AS route FROM documents")
def route_replies(spark, d):
    return replies.route_replies(_replies(spark, d)).select("ord", "route")
