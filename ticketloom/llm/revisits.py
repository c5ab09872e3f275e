"""Not-modified revisit resolution: as-of join to the latest earlier full response.

A revisit record has no body. It is resolved against the latest full response of the same
canonical URL that is not later than it (same time: the response with the larger record id not
above the revisit's counts as earlier). Validators are checked: ETag by weak comparison if the
revisit has one, else Last-Modified; without either the payload digest must agree. The
resolved record has the response's body and headers, with those headers of the revisit merged in
that a not-modified answer may carry.

The as-of join does not gather all captures of a URL: captures are cut into time slots, each (URL,
slot) finds its own latest response, one row for each (URL, slot) carries the latest response on
to later slots. A URL with a third of all rows is so spread over its slots; ``slot_seconds`` is to be
chosen so that one URL's captures within a slot fit a task.

Cases: null URL, null time, null headers or null body stay null and match nothing (a revisit without
URL or time is ``no_response``); several responses at one time are ordered by record id; a repeated
revisit is resolved for each row, a repeated response counts once (of several bodies under one record id
the least is taken); of header names that differ in case only, the last in ASCII order counts; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.session import table, written

#: Headers that a 304 answer may carry and a cache updates (HTTP semantics, RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` dropped, host lower-cased, default port, fragment and slashes at the end of the path
    dropped; the query stays as it is. Other hosts, a mobile one included, are other resources."""
    bare = F.regexp_replace(url, r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    return F.concat(host, path, F.regexp_extract(bare, r"^[^?]*(.*)$", 1))


def _latest_before(captures: DataFrame, slot_seconds: int) -> DataFrame:
    """Adds ``base``: the latest full response not after each capture, null if there is none."""
    full = F.when(F.col("kind") == "response", F.struct("record_id", "captured", "etag", "last_modified", "digest", "headers"))
    slotted = captures.withColumn("slot", F.floor(F.col("captured").cast("long") / slot_seconds)).withColumn("full", full)
    order = ["captured", "record_id"]
    in_slot = Window.partitionBy("canonical", "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = slotted.withColumn("own", F.last("full", ignorenulls=True).over(in_slot))
    ends = slotted.groupBy("canonical", "slot").agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.struct(*order))).alias("end"))
    earlier = Window.partitionBy("canonical").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("canonical", "slot", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    return here.join(carried, ["canonical", "slot"], "left").withColumn("base", F.coalesce("own", "carried")).drop("own", "carried", "full", "slot")


def resolve_revisits(captures: DataFrame, slot_seconds: int = 3600) -> DataFrame:
    """captures(record_id, url, captured timestamp, kind 'response'|'revisit', etag, last_modified,
    digest, headers map<string,string>, body) -> one row for each revisit: record_id, canonical,
    base_id, status ('resolved', 'changed', 'no_response'), headers, body."""
    ready = captures.select("record_id", canonical_url(F.col("url")).alias("canonical"), "captured", "kind", "etag", "last_modified", "digest", "headers")
    found = _latest_before(ready.filter("canonical is not null and captured is not null"), slot_seconds).filter("kind = 'revisit'")

    def tag(c: Column) -> Column:
        return F.regexp_replace(c, "^W/", "")

    base = F.col("base")
    fits = (
        F.when(F.col("etag").isNotNull(), tag(F.col("etag")) == tag(base["etag"]))
        .when(F.col("last_modified").isNotNull(), F.col("last_modified") == base["last_modified"])
        .otherwise(F.col("digest") == base["digest"])
    )
    status = F.when(base.isNull(), "no_response").when(F.coalesce(fits, F.lit(False)), "resolved").otherwise("changed")

    def lowered(m: Column) -> Column:
        """Names in lower case; of several spellings of one name the last in ASCII order counts."""
        names = F.array_distinct(F.transform(F.map_keys(m), F.lower))
        entries = F.array_sort(F.map_entries(m))
        last = lambda name: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), -1)["value"]
        return F.map_from_arrays(names, F.transform(names, last))

    own = F.map_filter(lowered(F.col("headers")), lambda k, _: k.isin(*PERMITTED))
    before = lowered(base["headers"])
    merged = F.map_concat(F.map_filter(before, lambda k, _: ~F.array_contains(F.map_keys(own), k)), own)
    done = F.col("status") == "resolved"
    judged = found.withColumn("status", status).select(
        "record_id",
        "canonical",
        F.when(F.col("status") != "no_response", base["record_id"]).alias("base_id"),
        "status",
        F.when(done, F.coalesce(merged, before, own)).alias("headers"),
    )
    # null URLs would meet in the windows, but they match nothing
    nowhere = captures.filter("kind = 'revisit'").filter(canonical_url(F.col("url")).isNull() | F.col("captured").isNull())
    kinds = {f.name: f.dataType for f in judged.schema}
    nulls = {c: F.lit(None).cast(kinds[c]).alias(c) for c in ("base_id", "headers")}
    nowhere = nowhere.select("record_id", canonical_url(F.col("url")).alias("canonical"), nulls["base_id"], F.lit("no_response").alias("status"), nulls["headers"])
    judged = written(judged.unionByName(nowhere), "revisits")
    # bodies stay out of the as-of join: only resolved revisits meet them, by the record they rest on
    wanted = judged.filter("status = 'resolved'")
    bodies = captures.filter("kind = 'response'").select(F.col("record_id").alias("base_id"), "body").groupBy("base_id").agg(F.min("body").alias("body"))
    resolved = wanted.join(bodies, "base_id", "left")
    others = judged.filter("status != 'resolved'").withColumn("body", F.lit(None).cast(captures.schema["body"].dataType))
    return resolved.select(others.columns).unionByName(others)


def captures_of(pages: DataFrame) -> DataFrame:
    """A capture log from the pages table: each page is fetched at page_id minutes, each third one again
    with a changed body 60 minutes later, and asked for twice by a variant of its URL. Some revisits have a
    weak tag, a changed tag, only a date, only a digest, come before the response or between two."""
    page, again_html = F.col("page_id"), F.concat("html", F.lit("<!-- again -->"))
    minute = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + 60 * n)
    tag, day = F.concat(F.lit('"'), F.substring("digest", 1, 12), F.lit('"')), F.concat(F.lit("day "), (page % 28).cast("string"))

    def responses(df: DataFrame, k: int) -> DataFrame:
        return df.select(
            (4 * page + k).alias("record_id"),
            "url",
            minute(page + 20 * k).alias("captured"),
            F.lit("response").alias("kind"),
            tag.alias("etag"),
            day.alias("last_modified"),
            F.col("digest"),
            F.create_map(F.lit("ETag"), tag, F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), F.concat(F.lit("d"), page.cast("string"))).alias("headers"),
            F.col("html").alias("body"),
        )

    first = responses(pages.withColumn("digest", F.md5("html")), 0)
    second = responses(pages.filter(page % 3 == 0).withColumn("html", again_html).withColumn("digest", F.md5("html")), 3)
    k = F.col("k")
    at = F.when((page % 10 == 9) & (k == 1), page - 5).when((page % 4 == 0) & (k == 1), page + 30).otherwise(page + 90 * k)
    asked = pages.select("page_id", "url", F.md5("html").alias("old"), F.when(page % 3 == 0, F.md5(again_html)).alias("new"))
    asked = asked.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("at", at)
    asked = asked.withColumn("digest", F.when((page % 3 == 0) & (F.col("at") >= page + 60), F.col("new")).otherwise(F.col("old")))
    again = asked.select(
        (4 * page + k).alias("record_id"),
        F.concat(F.regexp_replace("url", "^https?://", "https://www."), F.lit("#again")).alias("url"),
        minute(F.col("at")).alias("captured"),
        F.lit("revisit").alias("kind"),
        F.when(page % 5 == 0, F.concat(F.lit("W/"), tag)).when(page % 5 == 1, F.lit('"other"')).when(page % 5 == 2, tag).alias("etag"),
        F.when(page % 5 == 3, day).alias("last_modified"),
        F.col("digest"),
        F.create_map(F.lit("Date"), F.concat(F.lit("r"), k.cast("string")), F.lit("Content-Length"), F.lit("0"), F.lit("Expires"), F.lit("soon")).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return first.unionByName(second).unionByName(again)


def op6_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each revisit; the body as length and MD5, the headers as sorted text."""
    found = resolve_revisits(captures_of(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    entry = lambda k: F.concat(k, F.lit("="), F.element_at("headers", k))
    return found.select(
        "record_id",
        "canonical",
        "base_id",
        "status",
        F.array_join(F.transform(F.array_sort(F.map_keys("headers")), entry), ";").alias("headers"),
        F.length("body").cast("long").alias("body_chars"),
        F.md5("body").alias("body_md5"),
    )


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, md5(html) AS digest FROM pages
  UNION ALL
  SELECT page_id, url, html || '<!-- again -->', md5(html || '<!-- again -->') FROM pages WHERE page_id % 3 = 0
), again AS (
  SELECT page_id, url, k, md5(html) AS old, md5(html || '<!-- again -->') AS new,
         CASE WHEN page_id % 10 = 9 AND k = 1 THEN page_id - 5 WHEN page_id % 4 = 0 AND k = 1 THEN page_id + 30 ELSE page_id + 90 * k END AS asked_at
  FROM pages, (SELECT unnest([1, 2]) AS k)
), asked AS (
  SELECT *, CASE WHEN page_id % 3 = 0 AND asked_at >= page_id + 60 THEN new ELSE old END AS digest FROM again
), captures AS (
  SELECT 4 * page_id + CASE WHEN ends_with(html, '<!-- again -->') THEN 3 ELSE 0 END AS record_id, url,
         1700000000 + 60 * (page_id + CASE WHEN ends_with(html, '<!-- again -->') THEN 60 ELSE 0 END) AS captured, 'response' AS kind,
         '"' || substr(digest, 1, 12) || '"' AS etag, 'day ' || (page_id % 28) AS last_modified, digest, page_id, NULL AS k, html AS body FROM p
  UNION ALL
  SELECT 4 * page_id + k, regexp_replace(url, '^https?://', 'https://www.') || '#again', 1700000000 + 60 * asked_at, 'revisit',
         CASE page_id % 5 WHEN 0 THEN 'W/"' || substr(digest, 1, 12) || '"' WHEN 1 THEN '"other"' WHEN 2 THEN '"' || substr(digest, 1, 12) || '"' END,
         CASE WHEN page_id % 5 = 3 THEN 'day ' || (page_id % 28) END, digest, page_id, k, NULL FROM asked
), bare AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM captures
), named AS (
  SELECT * EXCLUDE (b), regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
       || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') || regexp_extract(b, '^[^?]*(.*)$', 1) AS canonical FROM bare
), ranked AS (
  SELECT v.record_id, v.canonical, v.etag, v.last_modified, v.digest, v.k,
         r.record_id AS base_id, r.etag AS b_etag, r.last_modified AS b_modified, r.digest AS b_digest, r.page_id AS b_page, r.body,
         row_number() OVER (PARTITION BY v.record_id ORDER BY r.captured DESC NULLS LAST, r.record_id DESC) AS n
  FROM named v LEFT JOIN named r ON r.kind = 'response' AND r.canonical = v.canonical AND (r.captured < v.captured OR (r.captured = v.captured AND r.record_id <= v.record_id))
  WHERE v.kind = 'revisit'
), judged AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'no_response'
    WHEN coalesce(CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = b_etag
                       WHEN last_modified IS NOT NULL THEN last_modified = b_modified ELSE digest = b_digest END, false) THEN 'resolved' ELSE 'changed' END AS status
  FROM ranked WHERE n = 1
)
SELECT record_id, canonical, base_id, status,
  CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=r' || k || ';etag=' || b_etag || ';expires=soon' END AS headers,
  CASE WHEN status = 'resolved' THEN length(body) END AS body_chars, CASE WHEN status = 'resolved' THEN md5(body) END AS body_md5
FROM judged
"""
