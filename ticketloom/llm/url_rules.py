"""URL filter: host-suffix and path-prefix expressions, matched by short hash prefixes.

A rule is a host, a path prefix and a verdict. It fits its host and all subdomains of it, for paths that
start with its path. Each distinct URL is expanded in two steps, so that it never gets more expressions
than rules could ask for: its host suffixes are joined with the hosts that have rules, which tells the
lengths of path prefixes that matter there; suffix and prefix together are joined with the rules. Both joins
are equi-joins on the first four bytes of a SHA-256; a hit counts only if the whole digest agrees. Of
several rules the longest expression wins, then the longer host; of equal ones, block.

All columns and joins are Spark's own. URLs meet rules as distinct (host, path) pairs; hits are
aggregated with map-side combine. Rules are broadcast up to ``broadcast_bytes``; beyond that the joins
shuffle, and what they read is written, so that Spark can split a host that most URLs share.

Cases: a null URL, or one without "://", has an empty host and path and fits no rule; a URL without
path fits only rules with an empty path; hosts are compared without A-Z, so "org." or "org:80" is another
host than "org"; repeated rows are judged each; rules with a null are left out; an empty table gives an
empty result; other columns stay, those named like a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import release, table, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values of the query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_of(url: Column) -> Column:
    """What follows the first "://" up to a slash, query, fragment or the end, A-Z lower-cased; "" if none."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a query, fragment or the end; "" if there is no host."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(*parts: Column) -> Column:
    """SHA-256 of a host, or of a host and a path; hosts hold no slash, and a path is set off by a space."""
    return F.unhex(F.sha2(F.concat_ws(" ", *parts), 256))


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 4)


def host_suffixes(host: Column) -> Column:
    """The host and what follows each of its full stops; none for an empty host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host != "", F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, k, n - k + 1), "."))).otherwise(F.array().cast("array<string>"))


def _matched(urls: DataFrame, rules: DataFrame, broadcast: bool) -> DataFrame:
    """(host, path, rule, verdict) of the urls(host, path), distinct ones, that a rule fits."""
    near = F.broadcast if broadcast else lambda df: df
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    hosts = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths")).withColumn("host_digest", _digest(F.col("rule_host")))
    hosts = hosts.select("lengths", "host_digest", _short(F.col("host_digest")).alias("short"))
    suffixes = urls.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix")).withColumn("digest", _digest(F.col("suffix"))).withColumn("short", _short(F.col("digest")))
    asked = suffixes.join(near(hosts), "short").filter("digest = host_digest").select("host", "path", "suffix", F.explode("lengths").alias("n")).filter(F.length("path") >= F.col("n"))
    whole = asked.select("host", "path", "suffix", F.expr("substring(path, 1, n)").alias("prefix")).withColumn("digest", _digest(F.col("suffix"), F.col("prefix"))).withColumn("short", _short(F.col("digest")))
    known = rules.withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", _short(F.col("rule_digest")))
    if not broadcast:
        whole, known = written(whole, "url-expressions"), written(known, "url-rules")  # so that the join can split a hot key
    hits = whole.join(near(known), "short").filter("digest = rule_digest")
    order = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "verdict")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("best"))
    out = written(best.select("host", "path", "best.rule", "best.verdict"), "url-hits")
    if not broadcast:
        release(whole, known)
    return out


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """pages with host, path, rule and verdict; rules(host, path, verdict 'allow'|'block'). rule is the host and
    path of the one that decides, null if none fits: then the verdict is ``default``."""
    rules = rules.select(F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), "path", "verdict").dropna().groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size = rules.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 200), F.lit(0)).alias("n")).first()["n"]
    url = F.col(url_col).cast("string")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    read = pages.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))
    urls = read.select("host", "path").filter("host != ''").distinct()
    found = _matched(urls, rules, size <= broadcast_bytes)
    return read.join(found, ["host", "path"], "left").select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).drop("url")


#: The contract: every rule is tried on every URL.
OP11_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), u AS (
  SELECT page_id, row_number() OVER () AS k,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), best AS (
  SELECT k, arg_max(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) AS b
  FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (k)
"""
