"""Filters and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.text import url_part


def select_scope(df: DataFrame, mode: str, n: int | None = None, start_id: int | None = None, id_col: str = "ticket_id") -> DataFrame:
    """``all`` rows, the ``first`` n by id (10 where n is missing or not positive), or all ids from
    ``start`` on; no such id is an error."""
    if mode == "all":
        return df
    if mode == "first":
        return df.orderBy(id_col).limit(n if n and n > 0 else 10)
    if mode != "start" or start_id is None:
        raise ValueError(f"unknown scope {mode!r} or no start id")
    found = df.filter(F.col(id_col) >= start_id)
    if found.isEmpty():
        raise ValueError(f"no id from {start_id} on")
    return found


def rejection_reason(error: Column, status: Column, category: Column, closed: str, allowed: list[str]) -> Column:
    """The first reason that applies, or null."""
    return (
        F.when(error.contains("HTTP"), "http")
        .when(error.contains("Exception"), "exception")
        .when(error.isNotNull() | status.isNull(), "unknown")
        .when(status != closed, "status")
        .when(~F.coalesce(category.isin(*allowed), F.lit(False)), "category")
    )


def route_rejections(df: DataFrame, closed: str, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with ``reason``) of rows with load_error, status, category."""
    marked = df.withColumn("reason", rejection_reason(F.col("load_error"), F.col("status"), F.col("category"), closed, allowed))
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def _day(text: str | None) -> str | None:
    import re

    if not text:
        return None
    if re.fullmatch(r"\d{8}", text):
        text = f"{text[:4]}-{text[4:6]}-{text[6:]}"
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a date: {text!r}")
    return text


def filter_resolved(df: DataFrame, resolved_only: bool = True, after: str | None = None, before: str | None = None, col: str = "resolutiondate") -> DataFrame:
    """Rows resolved from the day ``after`` to the end of the day ``before``, in UTC. Bounds are
    YYYYMMDD or YYYY-MM-DD; a date that cannot be read fails any bound."""
    lo, hi = _day(after), _day(before)
    if lo and hi and lo > hi:
        raise ValueError("after is later than before")
    raw = F.col(col)
    when = raw if dict(df.dtypes)[col].startswith("timestamp") else F.expr(f"try_cast(`{col}` as timestamp)")
    keep = F.lit(True)
    if resolved_only:
        keep = keep & raw.isNotNull() & (raw.cast("string") != "")
    if lo:
        keep = keep & (when >= F.lit(lo).cast("timestamp"))
    if hi:
        keep = keep & (when < F.lit(hi).cast("timestamp") + F.expr("interval 1 day"))
    return df.filter(keep)


def keep_staff_comments(comments: DataFrame, col: str = "account_type") -> DataFrame:
    """Comments of customers go; a missing account type stays."""
    return comments.filter(~F.col(col).eqNullSafe(F.lit("customer")))


def normal_extension(ext: Column) -> Column:
    low = F.lower(F.trim(ext))
    return F.when(low.startswith("."), low).otherwise(F.concat(F.lit("."), low))


def filter_documents(df: DataFrame, extensions: list[str], folders: list[str], ext: str = "extension", folder: str = "folder") -> DataFrame:
    """Adds ``kept``: extension and folder are both listed. A null in either is not listed."""
    wanted = [e if e.startswith(".") else "." + e for e in map(str.lower, extensions)]
    return df.withColumn("kept", F.coalesce(normal_extension(F.col(ext)).isin(*wanted) & F.col(folder).isin(*folders), F.lit(False)))


def work_slice(df: DataFrame, start_index: int = 0, only_id: str | None = None, max_calls: int | None = None, limit_relevant: int | None = None) -> DataFrame:
    """Rows (ord, ticket_id, relevant) that a run works on: from start_index on, until max_calls rows
    were tried or limit_relevant relevant rows were found before.

    Both limits are top-k selections: max_calls takes the first rows in order, and the run ends with the
    limit_relevant-th relevant row of those, so no row is numbered.
    """
    rows = df.filter(F.col("ord") >= start_index)
    if only_id is not None:
        rows = rows.filter(F.col("ticket_id").cast("string") == only_id)
    if max_calls is not None:
        rows = rows.orderBy("ord").limit(max_calls)
    if limit_relevant is not None:
        if limit_relevant <= 0:
            return rows.limit(0)
        found = rows.filter("relevant").select("ord").orderBy("ord").limit(limit_relevant)
        last = found.agg(F.when(F.count(F.lit(1)) >= limit_relevant, F.max("ord")).alias("_last"))
        rows = rows.join(F.broadcast(last), F.col("_last").isNull() | (F.col("ord") <= F.col("_last"))).drop("_last")
    return rows


#: File name endings and words that mark a link as an attachment.
ATTACHMENT_ENDINGS = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".webp", ".svg", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".7z", ".rar", ".txt", ".log", ".csv"]
ATTACHMENT_WORDS = ["attach", "attachment", "download", "file", "upload", "uploads", "image", "img"]


def _ends_in(c: Column, endings: list[str]) -> Column:
    found = F.lit(False)
    for e in endings:
        found = found | c.endswith(e)
    return found


def _holds(c: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return found


def is_attachment_link(url: Column, extra_words: tuple[str, ...] = ()) -> Column:
    """The path ends like a file, or path or query holds a keyword."""
    path, query = F.lower(url_part(url, "path")), F.lower(url_part(url, "query"))
    words = [*ATTACHMENT_WORDS, *extra_words]
    return ~F.lower(url).rlike("^(mailto:|javascript:|#)") & (_ends_in(path, ATTACHMENT_ENDINGS) | _holds(path, words) | _holds(query, words))


#: Endings of images, and of names that are known not to be images.
IMAGE_ENDINGS = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".webp", ".svg"]
OTHER_ENDINGS = [".pdf", ".doc", ".docx", ".txt", ".xlsx", ".xls", ".zip", ".rar"]


def is_image_link(url: Column, name: Column, mode: str = "summary") -> Column:
    """Whether a link shows an image; the file name decides first. ``summary`` then takes an image
    ending anywhere in the URL and both kinds of file links; ``refresh`` takes tracker attachments, and
    help-desk files, in this case only, that end like an image. Null is no image."""
    low, file = F.lower(url), F.lower(F.coalesce(name, F.lit("")))
    by_name = F.when(url.isNull(), False).when(_ends_in(file, IMAGE_ENDINGS), True).when(_ends_in(file, OTHER_ENDINGS), False)
    if mode == "summary":
        path = url_part(low, "path")
        return by_name.otherwise(_holds(low, IMAGE_ENDINGS) | path.contains("/file/get/") | (path.contains("/rest/api/") & path.contains("/attachment/content/")))
    tracker = url.contains("/rest/api/") & url.contains("/attachment/content/")
    return by_name.when(tracker, True).otherwise(url.contains("/file/get/") & _ends_in(low, IMAGE_ENDINGS))


def is_crawlable(url: Column, domain: Column | str) -> Column:
    """Same host and port, as they are written, http(s), and no file ending that is not a page anywhere in the
    URL."""
    host = url_part(url, "authority")
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return F.coalesce((host == domain) & scheme.isin("http", "https") & ~F.lower(url).rlike(r"\.(pdf|jpg|png|gif|zip|exe)"), F.lit(False))


def flag_problem_unicode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``<col>_problem``: typographic quotes, non-breaking hyphen or spaces, dashes."""
    marks = "[\\u2018\\u2019\\u201A\\u201C\\u201D\\u201E\\u2011\\u00A0\\u202F\\u2013\\u2014]"
    return df.withColumns({f"{c}_problem": F.coalesce(F.col(c).rlike(marks), F.lit(False)) for c in cols})


def is_not_relevant(problem: Column) -> Column:
    return F.coalesce(F.lower(F.trim(problem)).isin("not relevant", "nicht relevant", "irrelevant"), F.lit(False))


URL_PATTERN = r"^https?://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?(\.[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?)+|localhost|\d{1,3}(\.\d{1,3}){3})(:\d+)?([/?#]\S*)?$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def contact_validity_report(df: DataFrame, url_col: str, email_col: str) -> DataFrame:
    """One row for each of url and email: valid, invalid, missing and total."""
    def row(kind: str, c: Column, pattern: str) -> list[Column]:
        there = c.isNotNull() & (F.trim(c) != "")
        good = there & F.coalesce(F.trim(c).rlike(pattern), F.lit(False))
        return [F.lit(kind).alias("kind"), good.cast("int").alias("valid"), (there & ~good).cast("int").alias("invalid"), F.coalesce(~there, F.lit(True)).cast("int").alias("missing")]

    both = df.select(F.explode(F.array(F.struct(*row("url", F.col(url_col), URL_PATTERN)), F.struct(*row("email", F.col(email_col), EMAIL_PATTERN)))).alias("r")).select("r.*")
    return both.groupBy("kind").agg(F.sum("valid").alias("valid"), F.sum("invalid").alias("invalid"), F.sum("missing").alias("missing"), F.count(F.lit(1)).alias("total"))
