"""Queries of joins, similarity, clusters and assembly over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ticketloom.operators import images, joins, replies, reports, similarity
from ticketloom.plans.common import Register, conversation_tickets, documents
from ticketloom.session import table, written

register = Register()
QUERIES, ORACLE_SQL = register.queries, register.sql

#: Thresholds for the embeddings table, where no pair reaches the usual 0.84 / 0.78.
MERGE, REVIEW = 0.38, 0.30

_SCORES = f"""v AS (SELECT vec_id AS ord, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
pairs AS (SELECT a.ord AS i, b.ord AS j, list_dot_product(a.e, b.e) / (a.n * b.n) AS s FROM v a JOIN v b ON a.ord < b.ord WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {REVIEW})"""
_CLUSTERS = f"""{_SCORES}, edges AS (SELECT i AS a, j AS b FROM pairs WHERE s >= {MERGE} UNION ALL SELECT j, i FROM pairs WHERE s >= {MERGE}),
walk(node, label) AS (SELECT ord, ord FROM v UNION SELECT edges.b, walk.label FROM walk JOIN edges ON edges.a = walk.node),
roots AS (SELECT node, min(label) AS root FROM walk GROUP BY node)"""


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(col("vec_id").alias("ord"), "embedding")


def _pairs(spark, d):
    return similarity.similarity_pairs(_vectors(spark, d), REVIEW, MERGE)


def _vector_tickets(spark, d):
    i = col("vec_id")
    text = lambda n: F.repeat(F.lit("x"), (i % n).cast("int"))
    return table(spark, d, "embeddings").select(i.alias("ord"), F.concat(F.lit("T"), i.cast("string")).alias("ticket_id"), F.concat(F.lit("2024-01-"), F.lpad((i % 28 + 1).cast("string"), 2, "0")).alias("date"), F.concat(F.lit("Subject "), i.cast("string")).alias("subject"), text(5).alias("problem"), text(7).alias("solution"))


@register("similarity_pairs", f"WITH {_SCORES} SELECT i, j, round(s, 4) AS score, CASE WHEN s >= {MERGE} THEN 'merge' ELSE 'review' END AS kind FROM pairs")
def similarity_pairs(spark, d):
    return _pairs(spark, d).select("i", "j", F.round("score", 4).alias("score"), "kind")


@register(
    "review_pairs",
    f"""WITH {_SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS rn FROM pairs WHERE s < {MERGE})
    SELECT i, j, 'T' || i AS "ticket_id_A", 'T' || j AS "ticket_id_B", round(s, 4) AS similarity, 'Subject ' || i AS "subject_A", 'Subject ' || j AS "subject_B" FROM r WHERE rn = 1""",
)
def review_pairs(spark, d):
    return similarity.review_pairs(similarity.similarity_links(_vectors(spark, d), REVIEW, MERGE), _vector_tickets(spark, d))


def _clusters(spark, d, pairs=None):
    pairs = similarity.similarity_links(_vectors(spark, d), MERGE, MERGE) if pairs is None else pairs
    return similarity.cluster_duplicates(_vector_tickets(spark, d), pairs.filter("kind = 'link'"))


@register(
    "clusters",
    f"""WITH RECURSIVE {_CLUSTERS}, m AS (SELECT node AS ord, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM roots),
    x AS (SELECT *, max(ord % 7) OVER (PARTITION BY cluster_id) AS ms, max(ord % 5) OVER (PARTITION BY cluster_id) AS mp FROM m),
    r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY CASE WHEN ms > 0 THEN ord % 7 WHEN mp > 0 THEN ord % 5 ELSE length('Subject ' || ord) END DESC, ord) AS rn FROM x)
    SELECT cluster_id, max(ord) FILTER (rn = 1) AS representative_index, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS members, count(*) AS size FROM r GROUP BY cluster_id""",
)
def clusters(spark, d):
    found, _ = _clusters(spark, d)
    return found.select("cluster_id", "representative_index", F.array_join(F.transform("member_indices", lambda x: x.cast("string")), ",").alias("members"), "size").orderBy(F.desc("size"), "cluster_id")


@register(
    "canonical_tickets",
    f"""WITH RECURSIVE {_CLUSTERS}, m AS (SELECT node AS ord, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM roots),
    x AS (SELECT *, max(ord % 7) OVER (PARTITION BY cluster_id) AS ms, max(ord % 5) OVER (PARTITION BY cluster_id) AS mp FROM m),
    r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY CASE WHEN ms > 0 THEN ord % 7 WHEN mp > 0 THEN ord % 5 ELSE length('Subject ' || ord) END DESC, ord) AS rn FROM x),
    g AS (SELECT cluster_id, max(ord) FILTER (rn = 1) AS ord, count(*) AS size, list('T' || ord ORDER BY ord) AS names FROM r GROUP BY cluster_id)
    SELECT cluster_id, ord, 'T' || ord AS ticket_id, '2024-01-' || lpad(CAST(ord % 28 + 1 AS VARCHAR), 2, '0') AS date, 'Subject ' || ord AS subject, repeat('x', ord % 5) AS problem, repeat('x', ord % 7) AS solution, array_to_string(list_filter(names, lambda n: n <> 'T' || ord), ',') AS duplicates, size FROM g""",
)
def canonical_tickets(spark, d):
    from ticketloom.operators.windows import canonical_order

    return canonical_order(_clusters(spark, d)[1].withColumn("duplicates", F.array_join("duplicates", ",")))


@register("largest_clusters", f"WITH RECURSIVE {_CLUSTERS}, m AS (SELECT node AS ord, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM roots) SELECT cluster_id, count(*) AS size, string_agg('T' || ord, ',' ORDER BY ord) AS members FROM m GROUP BY 1 ORDER BY size DESC, cluster_id LIMIT 5")
def largest_clusters(spark, d):
    return reports.largest_clusters(_clusters(spark, d)[0]).select("cluster_id", "size", F.array_join("member_ticket_ids", ",").alias("members"))


@register(
    "dedupe_report",
    f"""WITH RECURSIVE {_CLUSTERS}, c AS (SELECT root, count(*) AS size FROM roots GROUP BY root),
    q AS (SELECT i, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS rn FROM pairs WHERE s < {MERGE})
    SELECT sum(size)::BIGINT AS input_rows, count(*) AS clusters, sum((size > 1)::BIGINT)::BIGINT AS clusters_of_several, max(size) AS largest, (SELECT count(*) FROM q WHERE rn = 1) AS review_pairs, count(*) AS canonical_rows, {MERGE}::DOUBLE AS merge_threshold, {REVIEW}::DOUBLE AS review_threshold FROM c""",
)
def dedupe_report(spark, d):
    pairs = written(similarity.similarity_links(_vectors(spark, d), REVIEW, MERGE), "pairs")
    found, _ = _clusters(spark, d, pairs)
    return reports.dedupe_report(found, similarity.review_pairs(pairs, _vector_tickets(spark, d)), MERGE, REVIEW)


_GRID = "g AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor((greatest(-1.0, least(1.0, x::DOUBLE)) + 1) * 127.5) AS BIGINT)) AS p FROM embeddings)"


def _grids(spark, d):
    pixel = lambda x: F.floor((F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double"))) + 1) * 127.5).cast("int")
    return table(spark, d, "embeddings").select(F.floor(col("vec_id") / 25).alias("ticket_id"), col("vec_id").alias("ord"), F.transform("embedding", pixel).alias("pixels"))


@register("mean_hash", f"WITH {_GRID}, b AS (SELECT vec_id, list_sum(p) / 64.0 AS m, p FROM g) SELECT vec_id AS ord, list_aggregate(list_transform(range(1, 65), lambda k: CASE WHEN p[k] >= m THEN 1 ELSE 0 END), 'sum')::BIGINT AS bits FROM b")
def mean_hash(spark, d):
    return _grids(spark, d).select("ord", F.bit_count(images.mean_hash(col("pixels"))).cast("long").alias("bits"))


_GREEDY = f"""WITH RECURSIVE {_GRID}, b AS (SELECT vec_id, list_sum(p) / 64.0 AS m, p FROM g),
h AS (SELECT vec_id // 25 AS ticket_id, vec_id, row_number() OVER (PARTITION BY vec_id // 25 ORDER BY vec_id) AS k, CAST(list_sum(list_transform(range(0, 64), lambda i: CASE WHEN p[i + 1] >= m THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END)) AS HUGEINT) AS hash FROM b),
w AS (SELECT DISTINCT ticket_id, 0::BIGINT AS k, NULL::BIGINT AS ord, []::HUGEINT[] AS found, false AS kept FROM h
  UNION ALL SELECT n.ticket_id, n.k, n.vec_id, CASE WHEN n.near THEN n.found ELSE list_append(n.found, n.hash) END, NOT n.near
  FROM (SELECT h.*, w.found, len(list_filter(w.found, lambda f: bit_count(xor(f, h.hash)) <= 20)) > 0 AS near FROM w JOIN h ON h.ticket_id = w.ticket_id AND h.k = w.k + 1) n)
SELECT ticket_id, ord, kept FROM w WHERE ord IS NOT NULL"""


@register("near_duplicate_images", _GREEDY)
def near_duplicate_images(spark, d):
    return images.near_duplicate_images(_grids(spark, d), "ahash", 20)


@register("embed_texts")
def embed_texts(spark, d):
    rows = documents(spark, d).select(col("doc_id").alias("ord"), "text")
    return similarity.embed_texts(rows).select("ord", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6).alias("squared_length"))


@register("resolve_ids", "SELECT o_orderkey, c_custkey AS ticket_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def resolve_ids(spark, d):
    listed = table(spark, d, "orders").select("o_orderkey", col("o_custkey").alias("key"))
    detail = table(spark, d, "customer").select(col("c_custkey").alias("key"), F.when(col("c_acctbal") > 0, col("c_custkey")).alias("ticket_id"))
    return joins.resolve_ids(listed, detail, "key", "ticket_id").select("o_orderkey", "ticket_id")


@register(
    "landed_pages",
    """WITH it AS (SELECT source, doc_id // 400 AS page_no, doc_id, lang FROM documents WHERE source IS NOT NULL),
    x AS (SELECT * FROM it WHERE NOT (source = 'src5' AND page_no = 1) UNION ALL SELECT source, 1, doc_id, lang FROM it WHERE source = 'src5' AND page_no = 0),
    p AS (SELECT source, page_no, count(*) AS n, min(doc_id) AS f, page_no >= 1 AND source IN ('src1', 'src2') AS is_last FROM x GROUP BY 1, 2),
    q AS (SELECT *, f = lag(f) OVER (PARTITION BY source ORDER BY page_no) AS rep FROM p),
    s AS (SELECT source, min(page_no) FILTER (n < 5 OR is_last) AS stop, min(page_no) FILTER (rep) AS cut FROM q GROUP BY 1)
    SELECT x.source, x.page_no, CAST(row_number() OVER (PARTITION BY x.source, x.page_no ORDER BY doc_id) - 1 AS INT) AS pos, CAST(doc_id AS VARCHAR) AS key, lang AS payload FROM x JOIN s USING (source) WHERE (stop IS NULL OR x.page_no <= stop) AND (cut IS NULL OR x.page_no < cut)""",
)
def landed_pages(spark, d):
    items = documents(spark, d).filter("source is not null").select("source", F.floor(col("doc_id") / 400).alias("page_no"), "doc_id", "lang")
    repeated = items.filter("source = 'src5' AND page_no = 0").withColumn("page_no", F.lit(1).cast("long"))
    rows = items.filter("NOT (source = 'src5' AND page_no = 1)").unionByName(repeated)
    packed = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "lang"))), lambda x: F.struct(x["doc_id"].cast("string").alias("key"), x["lang"].alias("payload")))
    pages = rows.groupBy("source", "page_no").agg(packed.alias("items")).withColumn("is_last", (col("page_no") >= 1) & col("source").isin("src1", "src2"))
    return joins.union_landed_pages(pages, 5)


@register("merge_fields", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE c_name END AS title, CASE WHEN c_custkey % 4 = 0 THEN n_name WHEN c_custkey % 4 = 1 THEN '' ELSE c_name END AS tags FROM customer JOIN nation ON c_nationkey = n_nationkey")
def merge_fields(spark, d):
    c, n, k = table(spark, d, "customer"), table(spark, d, "nation"), col("c_custkey")
    detail = c.select("c_custkey", F.when(k % 3 == 0, "").otherwise(col("c_name")).alias("title"), F.when(k % 4 == 0, None).when(k % 4 == 1, "").otherwise(col("c_name")).alias("tags"))
    overview = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", col("n_name").alias("title"), col("n_name").alias("tags"))
    return joins.merge_article_fields(detail, overview, "c_custkey", ["title"], ["tags"])


@register("union_first_wins", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'overview' ELSE 'category' END AS origin FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def union_first_wins(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return joins.union_first_wins(c.filter("c_custkey % 2 = 0").withColumn("origin", F.lit("overview")), c.filter("c_custkey % 3 = 0").withColumn("origin", F.lit("category")), "c_custkey", "c_custkey")


@register("merge_attachments", "SELECT l_orderkey AS owner_id, 'https://h/' || l_suppkey AS \"Url\", min(CASE WHEN l_linenumber <= 2 THEN 0 ELSE 1 END) AS rank FROM lineitem GROUP BY 1, 2")
def merge_attachments(spark, d):
    rows = table(spark, d, "lineitem").select(col("l_orderkey").alias("owner_id"), col("l_linenumber").alias("a_ord"), F.concat(F.lit("https://h/"), col("l_suppkey").cast("string")).alias("Url"), (col("l_linenumber") > 2).cast("int").alias("rank"))
    return joins.merge_attachments(rows.filter("rank = 0"), rows.filter("rank = 1")).select("owner_id", "Url", "rank")


@register("refresh_values", "WITH f AS (SELECT l_orderkey, arg_max(CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END, l_linenumber::BIGINT * 1000000000 + l_partkey) AS v FROM lineitem GROUP BY 1) SELECT o_orderkey, coalesce(v, '') <> '' AS updated, CASE WHEN coalesce(v, '') <> '' THEN v ELSE 'old' END AS url FROM orders LEFT JOIN f ON l_orderkey = o_orderkey")
def refresh_values(spark, d):
    fresh = table(spark, d, "lineitem").select(col("l_orderkey").alias("o_orderkey"), (col("l_linenumber") * F.lit(1_000_000_000).cast("long") + col("l_partkey")).alias("at"), F.when(col("l_linenumber") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(col("l_partkey").cast("string"))).alias("urls"))
    rows = table(spark, d, "orders").select("o_orderkey", F.array(F.lit("old")).alias("urls"))
    return joins.refresh_values(rows, fresh, "o_orderkey", "urls", "at").select("o_orderkey", "updated", F.array_join("urls", ",").alias("url"))


_REFRESH = """f AS (SELECT l_orderkey, arg_max([l_linenumber, l_partkey], l_linenumber::BIGINT * 1000000000 + l_partkey) AS v FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS prefixed, CASE WHEN v[1] % 4 = 0 THEN 'https://t/rest/api/3/attachment/content/' || v[2] WHEN v[1] % 4 = 1 THEN 'https://h/file/get/' || v[2] || '.png' END AS fresh FROM orders LEFT JOIN f ON l_orderkey = o_orderkey)"""


def _refreshed(spark, d):
    key, part = col("l_orderkey").cast("string"), col("l_partkey").cast("string")
    line = table(spark, d, "lineitem")
    url = F.when(col("l_linenumber") % 4 == 0, F.concat(F.lit("https://t/rest/api/3/attachment/content/"), part)).when(col("l_linenumber") % 4 == 1, F.concat(F.lit("https://h/file/get/"), part, F.lit(".png"))).otherwise(F.concat(F.lit("https://h/x.png?"), part))
    files = F.array(F.struct(F.lit("").alias("FileName"), url.alias("Url"), F.lit(0).cast("long").alias("Size")), F.struct(F.lit("a.pdf").alias("FileName"), url.alias("Url"), F.lit(0).cast("long").alias("Size")))
    raw = line.select((col("l_linenumber") * F.lit(1_000_000_000).cast("long") + col("l_partkey")).alias("ord"), key.alias("ticket_id"), files.alias("Attachments"))
    own = col("o_orderkey").cast("string")
    summaries = table(spark, d, "orders").select("o_orderkey", F.when(col("o_orderkey") % 2 == 0, F.concat(F.lit("HD_"), own)).otherwise(own).alias("ticket_id"), F.array(F.lit("old")).alias("image_urls"))
    return joins.refresh_image_urls(summaries, raw, "HD_")


@register("refresh_image_urls", f"WITH {_REFRESH} SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, prefixed AS prefix_removed, fresh IS NOT NULL AS updated, coalesce(fresh, 'old') AS image_urls FROM r")
def refresh_image_urls(spark, d):
    return _refreshed(spark, d).select("ticket_id", "prefix_removed", "updated", F.array_join("image_urls", ",").alias("image_urls"))


@register("refresh_counts", f"WITH {_REFRESH} SELECT count(fresh) AS updated, count(fresh) AS images, sum(prefixed::BIGINT)::BIGINT AS prefixes FROM r")
def refresh_counts(spark, d):
    return joins.refresh_counts(_refreshed(spark, d))


@register(
    "drop_existing",
    """WITH s AS (SELECT p_partkey AS ord, p_brand AS dir, p_name AS stem, CASE WHEN p_partkey % 6 <> 0 THEN '.pdf' END AS ext FROM part),
    t AS (SELECT p_brand AS dir, '.pdf' AS ext, p_name || '_1' AS name, -1 AS at FROM part WHERE p_partkey % 40 = 0 UNION ALL SELECT dir, ext, stem, ord FROM s)
    SELECT ord, dir, stem, ext FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.dir = s.dir AND t.at < s.ord AND CASE WHEN s.ext IS NULL THEN starts_with(t.name || coalesce(t.ext, ''), s.stem) ELSE t.ext = s.ext AND starts_with(t.name, s.stem) END)""",
)
def drop_existing(spark, d):
    p = table(spark, d, "part")
    ext = F.when(col("p_partkey") % 6 != 0, ".pdf")
    docs = p.select(col("p_partkey").alias("ord"), col("p_brand").alias("dir"), col("p_name").alias("stem"), ext.alias("ext"))
    manifest = p.filter("p_partkey % 40 = 0").select(col("p_brand").alias("dir"), F.lit(".pdf").alias("ext"), F.concat("p_name", F.lit("_1")).alias("name"))
    return joins.drop_existing_files(docs, manifest).select("ord", "dir", "stem", "ext")


def _coverage(spark, d):
    s = table(spark, d, "supplier")
    concepts = s.select(col("s_nationkey").alias("chapter"), col("s_suppkey").cast("string").alias("concept_id"), col("s_name").alias("title"), (col("s_suppkey") % 3 + 1).alias("importance"))
    answers = s.filter("s_suppkey % 3 = 0").select(col("s_nationkey").alias("chapter"), F.array(col("s_suppkey").cast("string"), F.lit("x")).alias("covers"))
    return joins.concept_coverage(concepts, answers)


@register("coverage", "SELECT s_nationkey AS chapter, count(*) AS total, sum((s_suppkey % 3 = 0)::BIGINT)::BIGINT AS covered, round(sum((s_suppkey % 3 = 0)::BIGINT) / count(*), 4) AS coverage FROM supplier GROUP BY 1")
def coverage(spark, d):
    return _coverage(spark, d)[0]


@register("uncovered", "SELECT * FROM (SELECT s_nationkey AS chapter, CAST(s_suppkey AS VARCHAR) AS concept_id, s_name AS title, s_suppkey % 3 + 1 AS importance, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey % 3 + 1 DESC, s_name DESC) AS INT) AS rank FROM supplier WHERE s_suppkey % 3 <> 0) WHERE rank <= 20")
def uncovered(spark, d):
    return _coverage(spark, d)[1]


_THREADS = """c AS (SELECT CAST(conv_id AS VARCHAR) AS ticket_id, turn, role, text, CASE WHEN turn % 3 = 1 THEN 1 ELSE 0 END AS files FROM conversations WHERE turn > 0)"""


@register("assemble_tickets", f"""WITH {_THREADS}, g AS (SELECT ticket_id, count(*) AS n, string_agg(role || ':' || turn || ':' || files, ',' ORDER BY turn) AS thread FROM c GROUP BY 1)
    SELECT CAST(conv_id AS VARCHAR) AS ticket_id, coalesce(n, 0) AS n_comments, coalesce(thread, '') AS thread, CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END AS n_attachments FROM conversations LEFT JOIN g ON g.ticket_id = CAST(conv_id AS VARCHAR) WHERE turn = 0""")
def assemble_tickets(spark, d):
    whole = joins.assemble_tickets(*conversation_tickets(spark, d))
    thread = F.array_join(F.transform("kommentare", lambda c: F.concat_ws(":", c["UserName"], c["c_ord"].cast("string"), F.size(c["Attachments"]).cast("string"))), ",")
    return whole.select("ticket_id", F.size("kommentare").cast("long").alias("n_comments"), thread.alias("thread"), F.size("Attachments").alias("n_attachments"))


@register("export_stats", "SELECT sum((turn = 0)::BIGINT)::BIGINT AS total_tickets, sum((turn > 0)::BIGINT)::BIGINT AS total_comments, sum((turn = 0 AND conv_id % 2 = 0)::BIGINT)::BIGINT AS total_ticket_attachments, sum((turn > 0 AND turn % 3 = 1)::BIGINT)::BIGINT AS total_comment_attachments FROM conversations")
def export_stats(spark, d):
    return reports.export_stats(joins.assemble_tickets(*conversation_tickets(spark, d)))


@register(
    "build_prompts",
    f"""WITH {_THREADS}, g AS (SELECT ticket_id, string_agg('- [turn ' || turn || '] ' || role || ': ' || text || CASE WHEN files = 1 THEN chr(10) || '  Attachments: log.txt (https://files.example.com/' || turn || ')' ELSE '' END, chr(10) ORDER BY turn) AS thread FROM c GROUP BY 1)
    SELECT CAST(conv_id AS VARCHAR) AS ticket_id, 'Ticket: ' || conv_id || chr(10) || 'Subject: Case ' || conv_id || chr(10) || 'Date: 2024-01-01' || chr(10) || 'Category: support' || chr(10) || 'Link: https://t/' || conv_id || chr(10) || 'Text: ' || text || coalesce(chr(10) || thread, '')
    || CASE WHEN conv_id % 2 = 0 THEN chr(10) || 'Attachments: shot.png (https://files.example.com/shot.png)' ELSE '' END || chr(10) || 'Answer with one JSON object.' AS prompt FROM conversations LEFT JOIN g ON g.ticket_id = CAST(conv_id AS VARCHAR) WHERE turn = 0""",
)
def build_prompts(spark, d):
    whole = joins.assemble_tickets(*conversation_tickets(spark, d))
    whole = whole.withColumns({"issue_date": F.lit("2024-01-01"), "category": F.lit("support"), "url": F.concat(F.lit("https://t/"), "ticket_id")})
    return replies.build_prompts(whole).select("ticket_id", "prompt")


@register("append_info", """SELECT count(*) FILTER (turn = 0) AS total_closed_tickets, 7 + count(*) FILTER (turn > 0 AND conv_id % 3 = 0) AS total_comments, 1 + count(*) FILTER (turn = 0 AND conv_id % 6 = 0) AS total_ticket_attachments, 2::BIGINT AS total_comment_attachments, 'resolved | project X' AS filter_criteria FROM conversations""")
def append_info(spark, d):
    whole = joins.assemble_tickets(*conversation_tickets(spark, d))
    old = whole.filter("CAST(ticket_id AS BIGINT) % 3 <> 0")
    info = spark.createDataFrame([(0, 7, 1, 2, "resolved")], "total_closed_tickets long, total_comments long, total_ticket_attachments long, total_comment_attachments long, filter_criteria string")
    return joins.append_info(info, old, whole, "ticket_id", "project X")
