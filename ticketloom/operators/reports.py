"""Aggregations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.text import redact


def export_stats(tickets: DataFrame) -> DataFrame:
    comments = F.coalesce(F.size("kommentare"), F.lit(0))
    of_comments = F.aggregate("kommentare", F.lit(0), lambda acc, c: acc + F.size(c["Attachments"]))
    return tickets.agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.sum(comments).alias("total_comments"),
        F.sum(F.size("Attachments")).alias("total_ticket_attachments"),
        F.sum(of_comments).alias("total_comment_attachments"),
    )


def rejection_report(rejected: DataFrame) -> DataFrame:
    """(section, value, n): counts of reasons, the five most frequent statuses, ten categories."""
    def counted(section: str, col: str, keep: int | None, rows: DataFrame) -> DataFrame:
        out = rows.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("section", F.lit(section))
        return out.orderBy(F.desc("n"), "value").limit(keep) if keep else out

    out = counted("reason", "reason", None, rejected)
    out = out.unionByName(counted("status", "status", 5, rejected.filter("reason = 'status'")))
    out = out.unionByName(counted("category", "category", 10, rejected.filter("reason = 'category'")))
    return out.select("section", "value", "n")


def error_samples(rejected: DataFrame, n: int = 3, reason: str = "http") -> DataFrame:
    """(ticket_id, load_error) of the first n rejected rows of a reason, by ord."""
    return rejected.filter(F.col("reason") == reason).orderBy("ord").limit(n).select("ticket_id", "load_error")


def folder_report(docs: DataFrame, col: str, order: str, missing: str = "(No folder)") -> DataFrame:
    """Count and share of each value, most frequent first, ties by first appearance."""
    label = F.coalesce(F.nullif(F.col(col), F.lit("")), F.lit(missing))
    counts = docs.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_at"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("label", "n", F.round(100 * F.col("n") / F.col("total"), 1).alias("percent"), "first_at").orderBy(F.desc("n"), "first_at")


def dedupe_report(clusters: DataFrame, pairs: DataFrame, merge: float, review: float) -> DataFrame:
    """One row: inputs, thresholds, clusters, clusters of several, canonical rows, review pairs."""
    c = clusters.agg(F.sum("size").alias("input_rows"), F.count(F.lit(1)).alias("clusters"), F.sum((F.col("size") > 1).cast("long")).alias("clusters_of_several"), F.max("size").alias("largest"))
    return c.crossJoin(pairs.agg(F.count(F.lit(1)).alias("review_pairs"))).withColumns({"canonical_rows": F.col("clusters"), "merge_threshold": F.lit(merge), "review_threshold": F.lit(review)})


def largest_clusters(clusters: DataFrame, n: int = 5) -> DataFrame:
    """(cluster_id, size, member_ticket_ids) of the n largest clusters, ties to the smaller id."""
    return clusters.orderBy(F.desc("size"), "cluster_id").limit(n).select("cluster_id", "size", "member_ticket_ids")


def run_status(events: DataFrame, declared: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """step_events(run_id, seq, ts, step, status, error) -> (steps, runs). A step starts with its first
    running event and ends with its first success or failure; steps that were not declared are
    marked. A run has failed if its latest event failed, is completed once all steps are success or
    skipped, else is running or pending."""
    at = lambda *s: F.min(F.when(F.col("status").isin(*s), F.col("ts")))
    steps = events.groupBy("run_id", "step").agg(
        at("running").alias("start_time"), at("success", "failed").alias("end_time"), F.max_by("status", "seq").alias("status"), F.max_by("error", F.when(F.col("error").isNotNull(), F.col("seq"))).alias("error"), F.max(F.struct("seq", "status")).alias("_last")
    )
    steps = steps.withColumn("duration_seconds", F.round(F.unix_micros(F.col("end_time").cast("timestamp")) / 1e6 - F.unix_micros(F.col("start_time").cast("timestamp")) / 1e6, 3))
    if declared is not None:
        steps = steps.withColumn("known", F.col("step").isin(*declared))
    runs = steps.groupBy("run_id").agg(F.max("_last").alias("_last"), F.count(F.lit(1)).alias("n_steps"), F.sum(F.col("status").isin("success", "skipped").cast("long")).alias("n_done"))
    last = F.col("_last.status")
    status = F.when(last == "failed", "failed").when(F.col("n_done") == F.col("n_steps"), "completed").when(last == "running", "running").otherwise("pending")
    return steps.drop("_last"), runs.select("run_id", "n_steps", "n_done", status.alias("current_status"))


def parse_outcomes(parsed: DataFrame, failed: DataFrame) -> DataFrame:
    """Counts of OK and FAIL with a preview of the first one by ord."""
    ok = parsed.select(F.lit("OK").alias("outcome"), "ord", F.substring("reply", 1, 120).alias("preview"))
    bad = failed.select(F.when(F.col("reason") == "read error", "READ_ERROR").otherwise("FAIL").alias("outcome"), "ord", F.substring("reply", 1, 120).alias("preview"))
    return ok.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.min_by("preview", "ord").alias("first_preview"))


def download_report(docs: DataFrame) -> DataFrame:
    """docs(kept, exists_already, failed) -> one row of counts."""
    one = lambda c: F.sum(c.cast("long"))
    kept, there, failed = F.col("kept"), F.col("exists_already"), F.col("failed")
    return docs.agg(
        F.count(F.lit(1)).alias("scanned"), one(kept & ~there & ~failed).alias("downloaded"), one(kept & there).alias("skipped_existing"), one(~kept).alias("skipped_other"), one(kept & ~there & failed).alias("failed")
    )


def download_log(docs: DataFrame) -> DataFrame:
    """docs with ``outcome``: downloaded, skipped_existing, skipped_other or failed, one for each row."""
    kept, there, failed = F.col("kept"), F.col("exists_already"), F.col("failed")
    return docs.withColumn("outcome", F.when(~kept, "skipped_other").when(there, "skipped_existing").when(failed, "failed").otherwise("downloaded"))


def tail_log(lines: DataFrame, offset: int = 0, n: int = 100) -> DataFrame:
    """lines(run_id, line_no, line) -> the last n redacted lines of each run from line number offset on. A
    limit for each run before the shuffle, so a long log is not gathered."""
    from ticketloom.operators.windows import limit_per_group

    last = limit_per_group(lines.filter(F.col("line_no") >= offset), ["run_id"], n, [F.desc("line_no")])
    return last.withColumn("line", redact(F.col("line")))


def qa_totals(items: DataFrame) -> DataFrame:
    """Questions by chapter and by document (chapter null) in one pass."""
    return items.rollup("source_file", "chapter").agg(F.count(F.lit(1)).alias("question_count"), F.grouping_id().alias("_g")).filter("_g in (0, 1)").select("source_file", "chapter", (F.col("_g") == 1).alias("is_total"), "question_count")
