"""Registration of queries, and the tables that they derive from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import table


class Register:
    """``@register("name", sql)`` puts a query and its SQL into two dicts."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def put(fn: Callable[[SparkSession, str], DataFrame]):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return put


def replaced(column: str, rules: list[tuple[str, str]]) -> str:
    """DuckDB's form of chained regexp_replace."""
    for pattern, to in rules:
        quoted = pattern.replace("'", "''")
        to = to.replace("'", "''")
        column = f"regexp_replace({column}, '{quoted}', '{to}', 'g')"
    return column


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ticket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with labels as flat tickets: category = lang, status by quality; documents
    without a label have a load error in two residue classes."""
    d, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    error = F.when(F.col("quality").isNull() & (F.col("doc_id") % 7 == 0), "HTTP 404").when(F.col("quality").isNull() & (F.col("doc_id") % 7 == 1), "Exception: x")
    status = F.when(F.col("quality") == 1, "closed").when(F.col("quality") == 0, "open")
    joined = d.join(labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("ticket_id"), F.col("lang").alias("category"), status.alias("status"), error.alias("load_error"), "text", "source")


TICKET_ROWS = """
ticket_rows AS (
  SELECT d.doc_id AS ord, CAST(d.doc_id AS VARCHAR) AS ticket_id, lang AS category,
    CASE quality WHEN 1 THEN 'closed' WHEN 0 THEN 'open' END AS status,
    CASE WHEN quality IS NULL AND d.doc_id % 7 = 0 THEN 'HTTP 404' WHEN quality IS NULL AND d.doc_id % 7 = 1 THEN 'Exception: x' END AS load_error, text, source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), marked AS (
  SELECT *, CASE WHEN load_error LIKE '%HTTP%' THEN 'http' WHEN load_error LIKE '%Exception%' THEN 'exception' WHEN load_error IS NOT NULL OR status IS NULL THEN 'unknown'
    WHEN status <> 'closed' THEN 'status' WHEN coalesce(category NOT IN ('en', 'de'), true) THEN 'category' END AS reason FROM ticket_rows
)"""


def conversation_tickets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tickets, comments, attachments) from conversations: the first turn is the ticket, later ones are
    comments; every third comment and every second ticket has an attachment."""
    c = table(spark, sf_dir, "conversations")
    tickets = c.filter("turn = 0").select(F.col("conv_id").cast("string").alias("ticket_id"), F.concat(F.lit("Case "), F.col("conv_id").cast("string")).alias("subject"), F.col("text").alias("body"))
    later = c.filter("turn > 0")
    kind = F.when(F.col("role") == "user", "customer").when(F.col("role") == "assistant", "staff")
    comments = later.select(
        F.col("conv_id").cast("string").alias("ticket_id"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("comment_id"), F.col("turn").alias("c_ord"), F.col("role").alias("author"), kind.alias("account_type"), F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("created"), F.col("text").alias("body")
    )
    of_comment = later.filter("turn % 3 = 1").select(F.lit("comment").alias("owner_kind"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("owner_id"), F.lit(0).alias("a_ord"), F.lit("log.txt").alias("FileName"), F.concat(F.lit("https://files.example.com/"), F.col("turn").cast("string")).alias("Url"), F.length("text").cast("long").alias("Size"))
    of_ticket = c.filter("turn = 0 AND conv_id % 2 = 0").select(F.lit("ticket").alias("owner_kind"), F.col("conv_id").cast("string").alias("owner_id"), F.lit(0).alias("a_ord"), F.lit("shot.png").alias("FileName"), F.lit("https://files.example.com/shot.png").alias("Url"), F.lit(1).cast("long").alias("Size"))
    return tickets, comments, of_comment.unionByName(of_ticket)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link table over pages: the next page of the same host, and page_id -> 2 * page_id. The next page
    has the next ordinal by (host, page_id), so no host is gathered."""
    from ticketloom.functions.columns import with_ordinal

    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"))
    placed = with_ordinal(p, ["host", "page_id"], "place")
    after = placed.select((F.col("place") - 1).alias("place"), "host", F.col("page_id").alias("dst"))
    nxt = placed.join(after, ["place", "host"]).select(F.col("page_id").alias("src"), "dst")
    twice = p.select(F.col("page_id").alias("src"), (2 * F.col("page_id")).alias("dst"))
    known = p.select(F.col("page_id").alias("dst"))
    return nxt.unionByName(twice.join(known, "dst", "left_semi").select("src", "dst"))
