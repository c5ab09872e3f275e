"""Mapping of source records to unified tickets and attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.columns import filled
from ticketloom.functions.text import clean_html, file_name_of, normalise_url
from ticketloom.operators.filters import keep_staff_comments
from ticketloom.operators.joins import ATTACHMENT
from ticketloom.operators.pages import rich_tree_to_text


def pick_attachment_fields(df: DataFrame, col: str, base: str, url_fields: tuple[str, ...] = ("Url", "FileUrl", "DownloadUrl", "Link"), size_fields: tuple[str, ...] = ("Size",)) -> DataFrame:
    """An array of structs of differing field names -> array<struct<FileName, Url, Size>>. The URL is the
    first of url_fields that is not empty; the name falls back to the last path segment, the size to 0.
    Entries without a URL go."""
    names = [f.name for f in df.schema[col].dataType.elementType.fields]

    def one(a: Column) -> Column:
        url = F.coalesce(*[filled(a[f]) for f in url_fields if f in names], F.lit(""))
        name = filled(a["FileName"]) if "FileName" in names else F.lit(None).cast("string")
        size = F.coalesce(*[a[f].cast("long") for f in size_fields if f in names], F.lit(0).cast("long"))
        return F.struct(F.coalesce(name, file_name_of(url)).alias("FileName"), normalise_url(url, base).alias("Url"), size.alias("Size"))

    picked = F.filter(F.transform(col, one), lambda a: a["Url"] != "")
    return df.withColumn(col, F.coalesce(picked, F.array().cast(f"array<{ATTACHMENT}>")))


def readable_body(df: DataFrame, rendered: str, tree: str, out: str) -> DataFrame:
    """Rendered HTML cleaned; else the text of the rich tree; else the string as it is."""
    df = df.withColumn("_html", clean_html(F.col(rendered), "inline")).withColumn("_tree", F.col(tree))
    texts = rich_tree_to_text(df, "_tree")
    plain = F.when(~F.col(tree).rlike(r"^\s*\{"), F.col(tree))
    return texts.withColumn(out, F.coalesce(filled("_html"), filled("_tree"), plain, F.lit(""))).drop("_html", "_tree")


def issues_to_tickets(issues: DataFrame, comments: DataFrame, base: str) -> DataFrame:
    """issues(ord, key, summary, status, created, issuetype, description, rendered_description) and
    comments(key, c_ord, author, account_type, created, rendered_body, body_tree) -> unified tickets."""
    staff = readable_body(keep_staff_comments(comments), "rendered_body", "body_tree", "_text")
    packed = F.array_sort(F.collect_list(F.struct("c_ord", F.col("created").alias("CommentDate"), F.col("_text").alias("Body"), F.col("author").alias("UserName"))))
    none = F.array().cast(f"array<{ATTACHMENT}>")
    threads = staff.groupBy("key").agg(F.transform(packed, lambda c: F.struct(c["CommentDate"].alias("CommentDate"), c["Body"].alias("Body"), c["UserName"].alias("UserName"), none.alias("Attachments"))).alias("kommentare"))
    joined = readable_body(issues, "rendered_description", "description", "_text").join(threads, "key", "left")
    return joined.select(
        "ord",
        F.col("key").alias("ticket_id"),
        F.col("issuetype").alias("CategoryName"),
        F.col("created").alias("IssueDate"),
        F.col("summary").alias("Subject"),
        F.col("_text").alias("Body"),
        F.col("status").alias("Status"),
        F.concat(F.lit(base.rstrip("/") + "/browse/"), "key").alias("Url"),
        none.alias("Attachments"),
        F.coalesce("kommentare", F.array().cast(threads.schema["kommentare"].dataType)).alias("kommentare"),
    )
