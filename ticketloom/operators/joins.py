"""Assembly of nested tickets, appends, merges, and the anti-joins of the download step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.columns import filled, first_wins
from ticketloom.operators.filters import is_image_link
from ticketloom.operators.windows import strip_prefix

ATTACHMENT = "struct<FileName:string,Url:string,Size:bigint>"
COMMENT = f"struct<c_ord:bigint,CommentDate:string,Body:string,UserName:string,Attachments:array<{ATTACHMENT}>>"


def nested_attachments(attachments: DataFrame, owner_kind: str, owner: str) -> DataFrame:
    """One row for each owner with its attachments in order."""
    rows = attachments.filter(F.col("owner_kind") == owner_kind)
    packed = F.array_sort(F.collect_list(F.struct("a_ord", "FileName", "Url", F.col("Size").cast("long").alias("Size"))))
    return rows.groupBy(F.col("owner_id").alias(owner)).agg(F.transform(packed, lambda a: F.struct(a["FileName"].alias("FileName"), a["Url"].alias("Url"), a["Size"].alias("Size"))).alias("Attachments"))


def assemble_tickets(tickets: DataFrame, comments: DataFrame, attachments: DataFrame) -> DataFrame:
    """Tickets with ordered comments and attachments as nested arrays, empty where there are none. A comment without
    ``created`` has the date of its column ``Date``, if there is such a column."""
    empty = F.array().cast(f"array<{ATTACHMENT}>")
    c = comments.join(nested_attachments(attachments, "comment", "comment_id"), "comment_id", "left")
    made = F.coalesce(filled("created"), F.col("Date").cast("string")) if "Date" in comments.columns else F.col("created")
    body = F.struct(F.col("c_ord").cast("long").alias("c_ord"), made.alias("CommentDate"), F.col("body").alias("Body"), F.col("author").alias("UserName"), F.coalesce("Attachments", empty).alias("Attachments"))
    threads = c.groupBy("ticket_id").agg(F.array_sort(F.collect_list(body)).alias("kommentare"))
    out = tickets.join(threads, "ticket_id", "left").join(nested_attachments(attachments, "ticket", "ticket_id"), "ticket_id", "left")
    return out.withColumn("kommentare", F.coalesce("kommentare", F.array().cast(f"array<{COMMENT}>"))).withColumn("Attachments", F.coalesce("Attachments", empty))


#: How the id of a comment may be spelled, the first that is there counts.
COMMENT_IDS = ["CommentId", "CommentID", "Id", "ID"]


def comment_id(comments: DataFrame) -> DataFrame:
    """comments with ``comment_id``: as it is, or the first filled spelling among the columns."""
    spelled = [c for c in comments.columns for known in ["comment_id", *COMMENT_IDS] if c == known]
    ordered = sorted(spelled, key=["comment_id", *COMMENT_IDS].index)
    return comments.withColumn("comment_id", F.coalesce(*[filled(F.col(c).cast("string")) for c in ordered]))


def fill_missing_attachments(comments: DataFrame, by_comment: DataFrame) -> DataFrame:
    """The embedded list if it is there and not empty, else what was fetched for the comment. The id is
    ``comment_id``, or the first filled one of its spellings."""
    if "comment_id" not in comments.columns:
        comments = comment_id(comments)
    fetched = by_comment.select("comment_id", F.col("Attachments").alias("_fetched"))
    keep = F.coalesce(F.size("Attachments") > 0, F.lit(False))
    return comments.join(fetched, "comment_id", "left").withColumn("Attachments", F.when(keep, F.col("Attachments")).otherwise(F.coalesce("_fetched", F.array().cast(f"array<{ATTACHMENT}>")))).drop("_fetched")


def merge_attachments(api: DataFrame, html: DataFrame, owner: str = "owner_id") -> DataFrame:
    """API rows first, then links of the body that are new; empty URLs go."""
    both = api.withColumn("_rank", F.lit(0)).unionByName(html.withColumn("_rank", F.lit(1))).filter("Url is not null and Url != ''")
    return first_wins(both, [owner, "Url"], ["_rank", "a_ord"]).drop("_rank")


def union_first_wins(first: DataFrame, second: DataFrame, key: str, order: str) -> DataFrame:
    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)))
    return first_wins(both, [key], ["_rank", order]).drop("_rank")


def append_new(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """existing, and the rows of incoming whose id as text is not in it; incoming keeps its repeats."""
    known = existing.select(F.col(key).cast("string").alias("_id")).distinct()
    new = incoming.join(known, incoming[key].cast("string") == F.col("_id"), "left_anti")
    return existing.unionByName(new)


def append_info(info: DataFrame, existing: DataFrame, incoming: DataFrame, key: str, criteria: str) -> DataFrame:
    """The one-row export info after ``append_new``: the ticket total counts all rows, the other totals grow by
    what the new rows hold (attachments of comments are not counted here), criteria are joined."""
    known = existing.select(F.col(key).cast("string").alias("_id")).distinct()
    new = incoming.join(known, incoming[key].cast("string") == F.col("_id"), "left_anti")
    size = lambda c: F.coalesce(F.sum(F.greatest(F.size(c), F.lit(0)).cast("long")), F.lit(0))
    added = new.agg(F.count(F.lit(1)).alias("_rows"), size("kommentare").alias("_comments"), size("Attachments").alias("_files"))
    before = existing.agg(F.count(F.lit(1)).alias("_before"))
    plus = lambda c, d: F.coalesce(F.col(c), F.lit(0)).cast("long") + F.col(d)
    return info.join(F.broadcast(added)).join(F.broadcast(before)).select(
        (F.col("_before") + F.col("_rows")).alias("total_closed_tickets"),
        plus("total_comments", "_comments").alias("total_comments"),
        plus("total_ticket_attachments", "_files").alias("total_ticket_attachments"),
        F.coalesce("total_comment_attachments", F.lit(0)).cast("long").alias("total_comment_attachments"),
        F.concat(F.when(F.coalesce("filter_criteria", F.lit("")) != "", F.concat("filter_criteria", F.lit(" | "))).otherwise(""), F.lit(criteria)).alias("filter_criteria"),
    )


def append_all(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return existing.unionByName(incoming, allowMissingColumns=True)


def resolve_ids(listed: DataFrame, detail: DataFrame, key: str, true_id: str) -> DataFrame:
    """List rows with the id of their detail row, ascending; rows whose detail has none go."""
    return listed.join(detail.filter(F.col(true_id).isNotNull()), key).orderBy(true_id)


def union_landed_pages(pages: DataFrame, page_size: int) -> DataFrame:
    """Items of landed pages(source, page_no, is_last, items array<struct<key,payload>>) up to the
    first page that is empty, short or flagged last, and before a page that repeats the one before."""
    first = F.get("items", F.lit(0))["key"]
    w = Window.partitionBy("source").orderBy("page_no")
    seen = pages.withColumn("_repeat", F.coalesce(first == F.lag(first).over(w), F.lit(False)))
    ends = F.when(F.coalesce(F.size("items"), F.lit(0)) < page_size, F.col("page_no")).when(F.col("is_last"), F.col("page_no"))
    stop = seen.groupBy("source").agg(F.min(ends).alias("_stop"), F.min(F.when(F.col("_repeat"), F.col("page_no"))).alias("_cut"))
    kept = seen.join(stop, "source").filter((F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop"))) & (F.col("_cut").isNull() | (F.col("page_no") < F.col("_cut"))))
    return kept.select("source", "page_no", F.posexplode("items").alias("pos", "item")).select("source", "page_no", "pos", F.col("item.key").alias("key"), F.col("item.payload").alias("payload"))


def merge_article_fields(detail: DataFrame, overview: DataFrame, key: str, on_empty: list[str], on_null: list[str]) -> DataFrame:
    """Detail values, else those of the overview: where empty for on_empty, only where null for on_null."""
    o = overview.select(key, *[F.col(c).alias(f"_o_{c}") for c in [*on_empty, *on_null]])
    out = detail.join(o, key, "left")
    for c in on_empty:
        out = out.withColumn(c, F.coalesce(filled(c), f"_o_{c}"))
    for c in on_null:
        out = out.withColumn(c, F.coalesce(c, f"_o_{c}"))
    return out.drop(*[f"_o_{c}" for c in [*on_empty, *on_null]])


def refresh_values(rows: DataFrame, fresh: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Replaces value by that of the last fresh row of the key, if that is not an empty array."""
    last = fresh.groupBy(key).agg(F.max_by(value, order).alias("_new"))
    changed = F.coalesce(F.size("_new") > 0, F.lit(False))
    return rows.join(last, key, "left").withColumn("updated", changed).withColumn(value, F.when(F.col("updated"), F.col("_new")).otherwise(F.col(value))).drop("_new")


def refresh_image_urls(summaries: DataFrame, raw: DataFrame, prefix: str) -> DataFrame:
    """summaries(ticket_id, image_urls, …) with ids without prefix, and image_urls replaced by the image links
    among the attachments of the last raw(ord, ticket_id, Attachments) row of the ticket, if there are any.
    Adds ``prefix_removed`` and ``updated``; ``refresh_counts`` sums them up."""
    shown = F.filter("Attachments", lambda a: (F.coalesce(a["Url"], F.lit("")) != "") & is_image_link(a["Url"], a["FileName"], "refresh"))
    fresh = raw.select(F.col("ticket_id").cast("string").alias("ticket_id"), "ord", F.transform(shown, lambda a: a["Url"]).alias("image_urls"))
    own = F.col("ticket_id").cast("string")
    marked = summaries.withColumn("prefix_removed", F.coalesce(own.startswith(prefix), F.lit(False))).withColumn("ticket_id", strip_prefix(own, prefix))
    return refresh_values(marked, fresh, "ticket_id", "image_urls", "ord")


def refresh_counts(refreshed: DataFrame) -> DataFrame:
    one = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    images = F.when(F.col("updated"), F.size("image_urls")).otherwise(0)
    return refreshed.agg(one(F.col("updated")).alias("updated"), one(images).alias("images"), one(F.col("prefix_removed")).alias("prefixes"))


def _first_with_stem(docs: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, stem, first_at): the first of files(keys, name, at) whose name starts with the stem of a doc. Equal
    prefixes are an equi-join on the name's prefixes, so no two files are compared blindly."""
    lengths = docs.groupBy(*keys).agg(F.collect_set(F.length("stem")).alias("lengths"))
    cut = F.transform("lengths", lambda n: F.when(F.length("name") >= n, F.expr("name").substr(F.lit(1), n)))
    prefixes = files.join(lengths, keys).select(*keys, "at", F.explode(F.array_distinct(cut)).alias("stem"))
    return prefixes.filter("stem is not null").groupBy(*keys, "stem").agg(F.min("at").alias("first_at"))


def drop_existing_files(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """docs(ord, dir, stem, ext) without those whose directory holds a file, of the manifest(dir, name, ext) or of an
    earlier row, that starts with the stem and has the extension; for a doc without extension (null or empty)
    any file that starts with the stem."""
    there = manifest.select("dir", "ext", "name", F.lit(-1).cast("long").alias("at")).unionByName(docs.select("dir", "ext", F.col("stem").alias("name"), F.col("ord").cast("long").alias("at")))
    bare = filled("ext").isNull()
    named = docs.filter(~bare)
    whole = docs.filter(bare)
    in_full = there.select("dir", F.concat("name", F.coalesce("ext", F.lit(""))).alias("name"), "at")
    checked = named.join(_first_with_stem(named, there.filter(~bare), ["dir", "ext"]), ["dir", "ext", "stem"], "left")
    checked = checked.unionByName(whole.join(_first_with_stem(whole, in_full, ["dir"]), ["dir", "stem"], "left"))
    return checked.filter(F.col("first_at").isNull() | (F.col("first_at") >= F.col("ord"))).select(docs.columns)


def concept_coverage(concepts: DataFrame, answers: DataFrame, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """(chapter, total, covered, coverage) and the most important uncovered concepts of each chapter."""
    named = answers.select("chapter", F.explode("covers").alias("concept_id")).distinct().withColumn("_hit", F.lit(1))
    joined = concepts.join(named, ["chapter", "concept_id"], "left")
    report = joined.groupBy("chapter").agg(F.count(F.lit(1)).alias("total"), F.count("_hit").alias("covered"))
    report = report.withColumn("coverage", F.round(F.col("covered") / F.col("total"), 4))
    w = Window.partitionBy("chapter").orderBy(F.desc("importance"), F.desc("title"))
    left = joined.filter("_hit is null").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return report, left.select("chapter", "concept_id", "title", "importance", "rank")
