"""Queries of filters, windows, reports and appends over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.operators import filters, joins, reports, replies, windows
from ticketloom.plans.common import TICKET_ROWS, Register, conversation_tickets, documents, ticket_rows
from ticketloom.session import table

register = Register()
QUERIES, ORACLE_SQL = register.queries, register.sql


@register("folder_report", "SELECT coalesce(nullif(source, ''), '(No folder)') AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percent, min(doc_id) AS first_at FROM documents GROUP BY 1")
def folder_report(spark, d):
    return reports.folder_report(documents(spark, d), "source", "doc_id")


@register(
    "group_samples",
    """WITH g AS (SELECT source, count(*) AS group_size, min(doc_id) AS f FROM documents GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 10),
    r AS (SELECT d.doc_id, d.source, group_size, row_number() OVER (PARTITION BY d.source ORDER BY doc_id) AS rn FROM documents d JOIN g USING (source))
    SELECT doc_id, source, group_size FROM r WHERE rn <= 3""",
)
def group_samples(spark, d):
    return windows.group_samples(documents(spark, d).select("doc_id", "source"), "source", 10, 3, "doc_id").select("doc_id", "source", "group_size")


_KINDS = """e AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN upper(lang) ELSE '.' || lang END AS extension FROM documents),
f AS (SELECT doc_id, extension, source, coalesce((CASE WHEN lower(trim(extension)) LIKE '.%' THEN lower(trim(extension)) ELSE '.' || lower(trim(extension)) END) IN ('.en', '.de') AND source IN ('src0', 'src1', 'src2', 'src3'), false) AS kept FROM e)"""


def _crm(spark, d):
    ext = F.when(F.col("doc_id") % 3 == 0, F.upper("lang")).otherwise(F.concat(F.lit("."), F.col("lang")))
    rows = documents(spark, d).select("doc_id", ext.alias("extension"), "source")
    return filters.filter_documents(rows, ["en", ".DE"], ["src0", "src1", "src2", "src3"], folder="source")


@register("filter_documents", f"WITH {_KINDS} SELECT doc_id, extension, source, kept FROM f")
def filter_documents(spark, d):
    return _crm(spark, d)


@register(
    "download_report",
    f"""WITH {_KINDS} SELECT count(*) AS scanned, sum((kept AND NOT doc_id % 5 = 0 AND NOT doc_id % 11 = 0)::BIGINT)::BIGINT AS downloaded, sum((kept AND doc_id % 5 = 0)::BIGINT)::BIGINT AS skipped_existing,
    sum((NOT kept)::BIGINT)::BIGINT AS skipped_other, sum((kept AND NOT doc_id % 5 = 0 AND doc_id % 11 = 0)::BIGINT)::BIGINT AS failed FROM f""",
)
def download_report(spark, d):
    return reports.download_report(_crm(spark, d).withColumn("exists_already", F.col("doc_id") % 5 == 0).withColumn("failed", F.col("doc_id") % 11 == 0))


@register("route_rejections", f"WITH {TICKET_ROWS} SELECT ticket_id, reason FROM marked")
def route_rejections(spark, d):
    kept, rejected = filters.route_rejections(ticket_rows(spark, d), "closed", ["en", "de"])
    return kept.select("ticket_id", F.lit(None).cast("string").alias("reason")).unionByName(rejected.select("ticket_id", "reason"))


@register(
    "rejection_report",
    f"""WITH {TICKET_ROWS}, s AS (SELECT 'status' AS section, status AS value, count(*) AS n FROM marked WHERE reason = 'status' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5),
    c AS (SELECT 'category' AS section, category AS value, count(*) AS n FROM marked WHERE reason = 'category' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
    SELECT 'reason' AS section, reason AS value, count(*) AS n FROM marked WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT * FROM s UNION ALL SELECT * FROM c""",
)
def rejection_report(spark, d):
    return reports.rejection_report(filters.route_rejections(ticket_rows(spark, d), "closed", ["en", "de"])[1])


@register("error_samples", f"WITH {TICKET_ROWS} SELECT ticket_id, load_error FROM marked WHERE reason = 'http' ORDER BY ord LIMIT 3")
def error_samples(spark, d):
    return reports.error_samples(filters.route_rejections(ticket_rows(spark, d), "closed", ["en", "de"])[1])


@register("download_log", f"WITH {_KINDS} SELECT doc_id, CASE WHEN NOT kept THEN 'skipped_other' WHEN doc_id % 5 = 0 THEN 'skipped_existing' WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'downloaded' END AS outcome FROM f")
def download_log(spark, d):
    rows = _crm(spark, d).withColumn("exists_already", F.col("doc_id") % 5 == 0).withColumn("failed", F.col("doc_id") % 11 == 0)
    return reports.download_log(rows).select("doc_id", "outcome")


@register(
    "tail_log",
    r"""WITH l AS (SELECT doc_id AS run_id, unnest(string_split(text || chr(10) || 'token=' || doc_id, chr(10))) AS line, generate_subscripts(string_split(text || chr(10) || 'token=' || doc_id, chr(10)), 1) - 1 AS line_no FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) AS k FROM l WHERE line_no >= 2)
    SELECT run_id, CAST(line_no AS INT) AS line_no, CASE WHEN starts_with(line, 'token=') THEN 'token=[REDACTED]' ELSE line END AS line FROM r WHERE k <= 10""",
)
def tail_log(spark, d):
    lines = documents(spark, d).select(F.col("doc_id").alias("run_id"), F.posexplode(F.split(F.concat("text", F.lit("\ntoken="), F.col("doc_id").cast("string")), "\n")).alias("line_no", "line"))
    return reports.tail_log(lines, 2, 10)


@register("scope_first", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25")
def scope_first(spark, d):
    return filters.select_scope(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "first", 25, id_col="o_orderkey")


@register("scope_start", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 500")
def scope_start(spark, d):
    return filters.select_scope(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "start", start_id=500, id_col="o_orderkey")


@register(
    "resolved_window",
    "SELECT 'SUP-' || o_orderkey AS key, CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+0200' END AS resolutiondate FROM orders WHERE o_orderstatus <> 'O' AND o_orderdate - INTERVAL 2 HOUR >= TIMESTAMP '1993-03-01' AND o_orderdate - INTERVAL 2 HOUR < TIMESTAMP '1995-07-02'",
)
def resolved_window(spark, d):
    date = F.when(F.col("o_orderstatus") != "O", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0200")))
    issues = table(spark, d, "orders").select(F.concat(F.lit("SUP-"), F.col("o_orderkey").cast("string")).alias("key"), date.alias("resolutiondate"))
    return filters.filter_resolved(issues, True, "19930301", "1995-07-01")


@register("staff_comments", "SELECT conv_id || '-' || turn AS comment_id, role AS author FROM conversations WHERE turn > 0 AND role IS DISTINCT FROM 'user'")
def staff_comments(spark, d):
    return filters.keep_staff_comments(conversation_tickets(spark, d)[1]).select("comment_id", "author")


@register(
    "work_slice",
    f"""WITH {TICKET_ROWS}, t AS (SELECT ord, ticket_id, coalesce(status = 'closed', false) AS relevant FROM ticket_rows WHERE ord >= 10 ORDER BY ord LIMIT 300),
    r AS (SELECT *, coalesce(sum(relevant::INT) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM t) SELECT ord, ticket_id, relevant FROM r WHERE f < 60""",
)
def work_slice(spark, d):
    rows = ticket_rows(spark, d).select("ord", "ticket_id", F.coalesce(F.col("status") == "closed", F.lit(False)).alias("relevant"))
    return filters.work_slice(rows, 10, max_calls=300, limit_relevant=60)


@register(
    "url_validity",
    r"""WITH e AS (SELECT 'url' AS kind, url AS v, '^https?://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?(\.[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?)+|localhost|\d{1,3}(\.\d{1,3}){3})(:\d+)?([/?#]\S*)?$' AS p FROM pages
    UNION ALL SELECT 'email', CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 4 = 1 THEN 'a.b' || page_id || '@mail.example.com' ELSE url END, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$' FROM pages)
    SELECT kind, sum((v IS NOT NULL AND trim(v) <> '' AND regexp_matches(trim(v), p))::BIGINT)::BIGINT AS valid, sum((v IS NOT NULL AND trim(v) <> '' AND NOT regexp_matches(trim(v), p))::BIGINT)::BIGINT AS invalid,
    sum((v IS NULL OR trim(v) = '')::BIGINT)::BIGINT AS missing, count(*) AS total FROM e GROUP BY kind""",
)
def url_validity(spark, d):
    email = F.when(F.col("page_id") % 4 == 0, None).when(F.col("page_id") % 4 == 1, F.concat(F.lit("a.b"), F.col("page_id").cast("string"), F.lit("@mail.example.com"))).otherwise(F.col("url"))
    return filters.contact_validity_report(table(spark, d, "pages").select("url", email.alias("email")), "url", "email")


@register("problem_unicode", "SELECT doc_id, regexp_matches(t, '[‘’‚“”„‑  –—]') AS t_problem FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' “x”' ELSE text END AS t FROM documents)")
def problem_unicode(spark, d):
    rows = documents(spark, d).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" “x”"))).otherwise(F.col("text")).alias("t"))
    return filters.flag_problem_unicode(rows, ["t"]).drop("t")


@register("canonical_id", r"""WITH i AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '00' || c_custkey WHEN 1 THEN 'SUP-' || c_custkey ELSE c_name END AS id FROM customer)
    SELECT c_custkey, CASE WHEN regexp_matches(id, '^\d+$') THEN 'HD-' || CAST(CAST(id AS BIGINT) AS VARCHAR) WHEN regexp_matches(id, '^[A-Z]+[_-]?\d+') THEN id ELSE 'HD-' || id END AS ticket_id FROM i""")
def canonical_id(spark, d):
    key = F.col("c_custkey")
    raw = F.when(key % 3 == 0, F.concat(F.lit("00"), key.cast("string"))).when(key % 3 == 1, F.concat(F.lit("SUP-"), key.cast("string"))).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", replies.canonical_id(raw, "HD-").alias("ticket_id"))


@register("repair_link", r"""WITH l AS (SELECT c_custkey, CASE c_custkey % 2 WHEN 0 THEN 'https://t.example.com//browse/OLD-1' ELSE 'https://t.example.com/x' END AS url, CASE c_custkey % 3 WHEN 0 THEN 'SUP-' || c_custkey ELSE c_name END AS id FROM customer)
    SELECT c_custkey, CASE WHEN contains(url, '/browse/') AND regexp_matches(id, '^[A-Z]+-\d+$') THEN rtrim(split_part(url, '/browse/', 1), '/') || '/browse/' || id ELSE url END AS ticket_url FROM l""")
def repair_link(spark, d):
    key = F.col("c_custkey")
    url = F.when(key % 2 == 0, "https://t.example.com//browse/OLD-1").otherwise("https://t.example.com/x")
    own = F.when(key % 3 == 0, F.concat(F.lit("SUP-"), key.cast("string"))).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", replies.repaired_link(url, own).alias("ticket_url"))


@register("strip_prefix", "SELECT c_custkey, CASE WHEN starts_with(c_name, 'Cust') THEN replace(c_name, 'Cust', '') ELSE c_name END AS id FROM customer")
def strip_prefix(spark, d):
    return table(spark, d, "customer").select("c_custkey", windows.strip_prefix(F.col("c_name"), "Cust").alias("id"))


@register("safe_names", r"""SELECT p_partkey, CASE WHEN trim(regexp_replace(p_name || '/a:' || p_partkey, '[^\p{L}\p{N} ._-]', '', 'g')) = '' THEN 'document_' || p_partkey || '.bin' ELSE trim(regexp_replace(p_name || '/a:' || p_partkey, '[^\p{L}\p{N} ._-]', '', 'g')) END AS file_name,
    substr(regexp_replace(p_name || '/a:' || p_partkey, '[<>:"/\\|?*]', '_', 'g'), 1, 50) AS ticket_file FROM part""")
def safe_names(spark, d):
    raw = F.concat("p_name", F.lit("/a:"), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", windows.safe_file_name(raw, F.col("p_partkey"), F.lit("bin")).alias("file_name"), windows.safe_subject(raw).alias("ticket_file"))


@register("assign_batches", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS position, count(*) OVER () AS n FROM documents) SELECT doc_id, position, (position - 1) // 50 + 1 AS batch, format('tickets_{:04d}-{:04d}_batch_{:03d}.docx', (position - 1) // 50 * 50 + 1, least(((position - 1) // 50 + 1) * 50, n), (position - 1) // 50 + 1) AS file_name FROM r")
def assign_batches(spark, d):
    return windows.assign_batches(documents(spark, d).select("doc_id"), 50, ["doc_id"]).select("doc_id", "position", "batch", "file_name")


@register(
    "allocate_quota",
    """WITH b AS (SELECT source, doc_id, greatest(0, least(30, CAST(round_even(greatest(1, length(text) // 4) / 350.0, 0) AS BIGINT))) AS base FROM documents),
    s AS (SELECT *, sum(base) OVER (PARTITION BY source) AS t FROM b), q AS (SELECT *, base * 40.0 / nullif(t, 0) AS share FROM s), f AS (SELECT *, floor(share) AS fl, round(share - floor(share), 9) AS frac FROM q),
    l AS (SELECT *, 40 - sum(fl) OVER (PARTITION BY source) AS left_over, row_number() OVER (PARTITION BY source ORDER BY frac DESC NULLS LAST, doc_id DESC) AS rk FROM f)
    SELECT source, doc_id, base, CAST(CASE WHEN t <= 40 THEN base ELSE fl + (rk <= left_over)::INT END AS BIGINT) AS quota FROM l""",
)
def allocate_quota(spark, d):
    rows = documents(spark, d).select("source", "doc_id", F.greatest(F.lit(1), F.floor(F.length("text") / 4)).alias("tokens"))
    return windows.allocate_quota(rows, "source", "doc_id", "tokens", 30, 40).select("source", "doc_id", "base", "quota")


@register("split_quota")
def split_quota(spark, d):
    rows = documents(spark, d).select(F.col("source").alias("doc"), F.col("doc_id").alias("chunk"), F.greatest(F.lit(1), F.floor(F.length("text") / 4)).alias("tokens"), F.lit(60).alias("n"))
    return windows.split_quota_over_chunks(rows).select("doc", "chunk", "tokens", "quota")


@register("first_wins", "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins(spark, d):
    rows = documents(spark, d).select("doc_id", "source", F.md5(F.lower("text")).alias("digest"))
    return windows.first_wins(rows, ["digest"], ["doc_id"]).drop("digest")


@register("number_collisions", "WITH r AS (SELECT p_partkey, p_name || '.pdf' AS name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS k FROM part) SELECT p_partkey, CASE WHEN k = 0 THEN name ELSE regexp_replace(name, '\\.pdf$', '') || '_' || k || '.pdf' END AS final_name FROM r")
def number_collisions(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(".pdf")).alias("name"))
    return windows.number_collisions(rows, "name", "p_partkey").select("p_partkey", "final_name")


@register(
    "split_quota",
    """WITH RECURSIVE c AS (SELECT l_orderkey AS doc, l_linenumber AS chunk, CAST(l_quantity AS BIGINT) AS tokens, CASE WHEN l_orderkey % 2 = 0 THEN 3 ELSE 17 END AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1),
    s AS (SELECT *, greatest(1, CAST(round_even(n * tokens / CAST(sum(tokens) OVER (PARTITION BY doc) AS DOUBLE), 0) AS BIGINT)) AS share, row_number() OVER (PARTITION BY doc ORDER BY chunk) - 1 AS i, count(*) OVER (PARTITION BY doc) AS k FROM c),
    g AS (SELECT doc, list(share ORDER BY i) AS shares, max(n) - sum(share) AS missing, max(k) AS k FROM s GROUP BY doc),
    w(doc, shares, missing, k, i) AS (SELECT doc, shares, missing, k, 0 FROM g
      UNION ALL SELECT doc, CASE WHEN missing > 0 THEN list_transform(shares, lambda x, j: CASE WHEN j - 1 = i THEN x + 1 ELSE x END) WHEN shares[i + 1] > 0 THEN list_transform(shares, lambda x, j: CASE WHEN j - 1 = i THEN x - 1 ELSE x END) ELSE shares END,
        CASE WHEN missing > 0 THEN missing - 1 WHEN shares[i + 1] > 0 THEN missing + 1 ELSE missing END, k, CAST((i + 1) % k AS INT) FROM w WHERE missing <> 0),
    f AS (SELECT doc, shares FROM w WHERE missing = 0)
    SELECT s.doc, s.chunk, f.shares[s.i + 1] AS quota FROM s JOIN f USING (doc)""",
)
def split_quota(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("chunk")).agg(F.min_by(F.col("l_quantity").cast("long"), F.struct("l_partkey", "l_suppkey")).alias("tokens"))
    rows = rows.withColumn("n", F.when(F.col("doc") % 2 == 0, 3).otherwise(17).cast("long"))
    return windows.split_quota_over_chunks(rows).select("doc", "chunk", "quota")


@register("keep_newest", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def keep_newest(spark, d):
    return windows.keep_newest(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), 50, [F.desc("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey")


@register("newest_first", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS ticket_id FROM customer")
def newest_first(spark, d):
    key = F.col("c_custkey")
    rows = table(spark, d, "customer").select("c_custkey", key.alias("ord"), F.when(key % 4 == 0, F.col("c_name")).otherwise(key.cast("string")).alias("ticket_id"))
    return windows.newest_first(rows).drop("ord")


@register("limit_per_group", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 7")
def limit_per_group(spark, d):
    return windows.limit_per_group(documents(spark, d).select("source", "doc_id"), ["source"], 7, ["doc_id"])


@register(
    "representatives",
    """WITH m AS (SELECT source AS cluster_id, doc_id AS ord, CASE WHEN source IN ('src1', 'src2') THEN '' ELSE substr(text, 1, doc_id % 90) END AS solution, CASE WHEN source = 'src2' THEN '' ELSE substr(text, 1, doc_id % 70) END AS problem, substr(text, 1, doc_id % 50) AS subject FROM documents),
    x AS (SELECT *, max(length(solution)) OVER (PARTITION BY cluster_id) AS ms, max(length(problem)) OVER (PARTITION BY cluster_id) AS mp FROM m),
    r AS (SELECT cluster_id, ord, row_number() OVER (PARTITION BY cluster_id ORDER BY CASE WHEN ms > 0 THEN length(solution) WHEN mp > 0 THEN length(problem) ELSE length(subject) END DESC, ord) AS rn FROM x)
    SELECT cluster_id, ord AS representative_ord FROM r WHERE rn = 1""",
)
def representatives(spark, d):
    i, part = F.col("doc_id"), lambda n: F.expr(f"substring(text, 1, cast(doc_id % {n} as int))")
    rows = documents(spark, d).select(F.col("source").alias("cluster_id"), i.alias("ord"), F.when(F.col("source").isin("src1", "src2"), "").otherwise(part(90)).alias("solution"), F.when(F.col("source") == "src2", "").otherwise(part(70)).alias("problem"), part(50).alias("subject"))
    return windows.pick_representative(rows)


_RUN = """ev AS (SELECT user_id AS run_id, event_id % 5 AS step, event_id AS seq, ts, CASE event_type WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'pending' END AS status FROM events),
st AS (SELECT run_id, step, min(ts) FILTER (status = 'running') AS start_time, min(ts) FILTER (status IN ('success', 'failed')) AS end_time, arg_max(status, seq) AS status, max(seq) AS last_seq FROM ev GROUP BY 1, 2)"""


def _step_events(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "view", "running").when(kind == "purchase", "success").when(kind == "error", "failed").when(kind == "signup", "skipped").otherwise("pending")
    return table(spark, d, "events").select(F.col("user_id").alias("run_id"), (F.col("event_id") % 5).alias("step"), F.col("event_id").alias("seq"), "ts", status.alias("status"), F.when(status == "failed", F.col("props")).alias("error"))


@register("run_status", f"WITH {_RUN} SELECT run_id, step, start_time, end_time, status, round(epoch_us(end_time) / 1e6 - epoch_us(start_time) / 1e6, 3) AS duration_seconds FROM st")
def run_status(spark, d):
    return reports.run_status(_step_events(spark, d))[0].select("run_id", "step", "start_time", "end_time", "status", "duration_seconds")


@register("run_rollup", f"WITH {_RUN} SELECT run_id, count(*) AS n_steps, sum((status IN ('success', 'skipped'))::BIGINT)::BIGINT AS n_done, CASE WHEN arg_max(status, last_seq) = 'failed' THEN 'failed' WHEN sum((status IN ('success', 'skipped'))::INT) = count(*) THEN 'completed' WHEN arg_max(status, last_seq) = 'running' THEN 'running' ELSE 'pending' END AS current_status FROM st GROUP BY 1")
def run_rollup(spark, d):
    return reports.run_status(_step_events(spark, d))[1]


@register("qa_totals", "SELECT n_regionkey::VARCHAR AS source_file, s_nationkey AS chapter, false AS is_total, count(*) AS question_count FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2 UNION ALL SELECT n_regionkey::VARCHAR, NULL, true, count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def qa_totals(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    items = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("s_nationkey").alias("chapter"))
    return reports.qa_totals(items)


@register("append_new", "SELECT doc_id, lang FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 = 0")
def append_new(spark, d):
    rows = documents(spark, d).select("doc_id", "lang")
    return joins.append_new(rows.filter("doc_id % 3 <> 0"), rows.filter("doc_id % 2 = 0").withColumn("lang", F.lit("new")), "doc_id")


@register("append_all", "SELECT doc_id, lang, NULL AS source FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, NULL, source FROM documents WHERE doc_id % 2 = 0")
def append_all(spark, d):
    rows = documents(spark, d)
    return joins.append_all(rows.filter("doc_id % 3 <> 0").select("doc_id", "lang"), rows.filter("doc_id % 2 = 0").select("doc_id", "source"))
