"""Model calls over tables: prompts in, replies parsed, repaired, routed and counted."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.text import plain_text
from ticketloom.operators.filters import is_image_link, is_not_relevant
from ticketloom.session import bounded_batches, ship, written

FIELDS = ("ticket_id", "date", "problem", "solution")
REPLY = "struct<ticket_id:string,date:string,problem:string,solution:string>"


def build_prompts(tickets: DataFrame, suffix: str = "Answer with one JSON object.") -> DataFrame:
    """(ticket_id, prompt, urls, filenames) from assembled tickets. Our own wording; the order is
    id, subject, date, category, link, body, comments with their attachments, attachments."""
    def shown(a):
        return F.when(F.coalesce(a["FileName"], F.lit("")) == "", a["Url"]).when(F.coalesce(a["Url"], F.lit("")) == "", a["FileName"]).otherwise(F.concat(a["FileName"], F.lit(" ("), a["Url"], F.lit(")")))

    def line(label: str, c: str):
        return F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("")))

    def comment(c):
        head = F.concat(F.lit("- ["), F.coalesce(c["CommentDate"], F.lit("")), F.lit("] "), F.coalesce(c["UserName"], F.lit("")), F.lit(": "), F.coalesce(c["Body"], F.lit("")))
        files = F.concat(F.lit("  Attachments: "), F.array_join(F.transform(c["Attachments"], shown), ", "))
        return F.when(F.size(c["Attachments"]) > 0, F.array(head, files)).otherwise(F.array(head))

    own = F.when(F.size("Attachments") > 0, F.array(F.concat(F.lit("Attachments: "), F.array_join(F.transform("Attachments", shown), ", ")))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(
        F.array(line("Ticket", "ticket_id"), line("Subject", "subject"), line("Date", "issue_date"), line("Category", "category"), line("Link", "url"), line("Text", "body")),
        F.flatten(F.transform("kommentare", comment)),
        own,
        F.array(F.lit(suffix)),
    )
    everything = F.concat(F.flatten(F.transform("kommentare", lambda c: c["Attachments"])), F.col("Attachments"))
    linked = F.filter(everything, lambda a: F.coalesce(a["Url"], F.lit("")) != "")
    return tickets.select("ticket_id", F.array_join(lines, "\n").alias("prompt"), F.transform(linked, lambda a: a["Url"]).alias("urls"), F.transform(linked, lambda a: F.coalesce(a["FileName"], F.lit(""))).alias("filenames"))


def score_prompts(prompts: DataFrame, fn: Callable[[list[str]], list[str]], id_col: str = "ticket_id") -> DataFrame:
    """(id, reply, call_error): fn over batches; where a batch fails, row by row, so that a failing
    call costs only its own row. The answers are written before anything reads them, so each prompt reaches
    the model once however often they are used."""
    ship(prompts.sparkSession)
    kind = dict(prompts.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, errors = b.column(1).to_pylist(), [None] * b.num_rows
            try:
                replies = list(fn(texts))
            except Exception:
                replies = []
                for k, t in enumerate(texts):
                    try:
                        replies += fn([t])
                    except Exception as e:
                        replies.append(None)
                        errors[k] = f"{type(e).__name__}: {e}"
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(replies, pa.string()), pa.array(errors, pa.string())], [id_col, "reply", "call_error"])

    return written(prompts.select(id_col, "prompt").mapInArrow(run, f"{id_col} {kind}, reply string, call_error string"), "model-replies")


_DECODER = json.JSONDecoder()
_DATE_TIME = re.compile(r"[12]\d{3}-\d{2}-\d{2}T[0-9:.+\-Zz]+")


def unfenced(text: str) -> str:
    """What stands between the first and the last code fence, if the text starts with one."""
    body = text.strip()
    if not body.startswith("```"):
        return body
    lines = body.split("\n")
    if len(lines) == 1:
        return body.strip("`").strip()
    ends = [k for k, line in enumerate(lines) if k and line.startswith("```")]
    return "\n".join(lines[1 : ends[-1]]).strip() if ends else body


class _Loose:
    """Reads an object that is nearly JSON. A string ends at the first quote that a comma, a colon, a
    closing brace or bracket, the name of a field, or the end of the text follows, so quotes inside it
    need no escape and a comma may be missing."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _blank(self) -> None:
        while self.at < len(self.text) and (self.text[self.at].isspace() or self.text[self.at] == ","):
            self.at += 1

    def _string(self) -> str:
        start = self.at = self.at + 1
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "\\":
                self.at += 2
                continue
            if c == '"':
                rest = self.text[self.at + 1 :].lstrip()
                if not rest or rest[0] in ":}]" or re.match(r',\s*(["\d}\]]|$)|"(ticket_id|date|problem|solution)"\s*:', rest):
                    break
            self.at += 1
        raw, self.at = self.text[start : self.at], self.at + 1
        try:
            return json.loads(f'"{raw}"', strict=False)
        except ValueError:
            return raw.replace('\\"', '"')

    def _value(self) -> object:
        if self.text.startswith('"', self.at):
            return self._string()
        try:
            value, self.at = _DECODER.raw_decode(self.text, self.at)
            return value
        except (ValueError, RecursionError):
            bare = re.compile(r'[^,{}\[\]":]*').match(self.text, self.at)
            self.at = max(bare.end(), self.at + 1)
            return bare[0].strip()

    def members(self) -> list[tuple[str | None, object]]:
        """(key, value) in order; the key is null where a value stands alone."""
        self.at, found = self.text.index("{") + 1, []
        while True:
            self._blank()
            if self.at >= len(self.text) or self.text[self.at] == "}":
                return found
            stamp = _DATE_TIME.match(self.text, self.at)
            if stamp:
                self.at = stamp.end()
                found.append((None, stamp[0]))
                continue
            first = self._value()
            after = re.compile(r"\s*:\s*").match(self.text, self.at)
            if isinstance(first, str) and after and after.end() < len(self.text):
                self.at = after.end()
                found.append((first, self._value()))
            else:
                found.append((None, first))


def _text_of(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _fields(found: dict) -> dict[str, str]:
    return {k: _text_of(found[k]) for k in FIELDS if found.get(k) is not None}


def _salvaged(text: str) -> dict[str, str]:
    """The known fields, wherever they stand; a date and time by itself if there is no date field."""
    out: dict[str, str] = {}
    for name in FIELDS:
        if m := re.search(rf'"{name}"\s*:\s*(?=["\d])', text):
            reader = _Loose(text)
            reader.at = m.end()
            out[name] = _text_of(reader._value()).strip()
    if "date" not in out and (stamp := _DATE_TIME.search(text)):
        out["date"] = stamp[0]
    return out


def repair_reply(text: str) -> tuple[dict[str, str] | None, str | None]:
    """(fields, reason of failure) of a model's reply. The first object is taken as it is if it is strict
    JSON; else it is read loosely: plain marks, a number alone at the start is the id, a date and time
    alone is the date, texts under numeric keys are added to the solution. At last the fields are looked for
    one by one, which needs no object."""
    body = unfenced(text)
    start = body.find("{")
    if start >= 0:
        try:
            value, _ = _DECODER.raw_decode(body, start)
            return _fields(value), None
        except (ValueError, RecursionError):  # also an object that is nested too deep
            pass
        plain = plain_text(body[start:]).replace("\r", " ").replace("\n", " ")
        out: dict[str, object] = {}
        more: list[str] = []
        for k, (key, value) in enumerate(_Loose(plain).members()):
            if key is None and k == 0 and re.fullmatch(r"[A-Z]*-?\d+", _text_of(value)):
                out["ticket_id"] = value
            elif key is None and isinstance(value, str) and (_DATE_TIME.fullmatch(value) or re.fullmatch(r"\d{4}-\d{2}-\d{2}", value)):
                out.setdefault("date", value)
            elif key is not None and key.isdigit() and isinstance(value, str):
                more.append(value)
            elif key is not None:
                out.setdefault(key, value)
        if more:
            out["solution"] = " ".join([x for x in [_text_of(out.get("solution") or "")] if x] + [x for x in more if x])
        fields = _fields(out)
        if fields.get("problem") or fields.get("solution"):
            return fields, None
    saved = _salvaged(plain_text(body))
    if "problem" in saved or "solution" in saved:
        return {"problem": "", "solution": ""} | saved, None
    return None, "no object" if start < 0 else "invalid object"


def parse_model_replies(replies: DataFrame, col: str = "reply") -> tuple[DataFrame, DataFrame]:
    """(parsed with ``fields``, failed with ``reason``). The input is read once: strict JSON is parsed in the
    JVM, only what it cannot read is repaired in Python, and the result is written before it is split."""
    bounded_batches(replies.sparkSession)
    strict = F.from_json(F.trim(F.col(col)), REPLY, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    clean = F.trim(F.col(col)).rlike(r"(?s)^\{.*\}$") & (strict["ticket_id"].isNotNull() | strict["problem"].isNotNull() | strict["solution"].isNotNull())
    at, names = replies.columns.index(col), replies.columns
    marked = replies.withColumn("fields", F.when(F.coalesce(clean, F.lit(False)), strict))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(k, pa.string()) for k in FIELDS])
        for b in batches:
            done = b.column(len(names)).to_pylist()
            found = [(f, None) if f else repair_reply(t) if t else (None, "no object") for t, f in zip(b.column(at).to_pylist(), done, strict=True)]
            columns = [b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f for f, _ in found], kind), pa.array([r for _, r in found], pa.string())], [*names, "fields", "reason"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in replies.schema.fields)
    every = written(marked.mapInArrow(run, f"{ddl}, fields {REPLY}, reason string"), "parsed-replies")
    return every.filter("fields is not null").drop("reason"), every.filter("fields is null").drop("fields")


CONCEPTS = "struct<concepts:array<struct<title:string,summary:string,importance:string>>>"
QUESTIONS = "struct<questions:array<struct<question:string,answer:string,covers:array<string>>>>"


def parse_generated_items(replies: DataFrame, kind: str, max_items: int, col: str = "reply") -> DataFrame:
    """(…, item) for each valid concept or question. Cut to max_items before validation; concepts
    need a title, importance is clamped to 1..3 (2 if it is no number); questions need both texts."""
    inner = F.regexp_extract(col, r"(?s)(\{.*\})", 1)
    if kind == "concepts":
        items = F.slice(F.from_json(inner, CONCEPTS)["concepts"], 1, max_items)
        good = F.filter(items, lambda x: F.btrim(F.coalesce(x["title"], F.lit(""))) != "")
        level = lambda x: F.greatest(F.lit(1), F.least(F.lit(3), F.coalesce(x["importance"].try_cast("int"), F.lit(2))))
        good = F.transform(good, lambda x: F.struct(F.btrim(x["title"]).alias("title"), F.btrim(F.coalesce(x["summary"], F.lit(""))).alias("summary"), level(x).alias("importance")))
    else:
        items = F.slice(F.from_json(inner, QUESTIONS)["questions"], 1, max_items)
        good = F.filter(items, lambda x: (F.btrim(F.coalesce(x["question"], F.lit(""))) != "") & (F.btrim(F.coalesce(x["answer"], F.lit(""))) != ""))
        good = F.transform(good, lambda x: F.struct(F.btrim(x["question"]).alias("question"), F.btrim(x["answer"]).alias("answer"), F.coalesce(x["covers"], F.array().cast("array<string>")).alias("covers")))
    return replies.withColumn("item", F.explode(good))


def route_replies(replies: DataFrame) -> DataFrame:
    """Adds ``route``: call_failed, unparseable, not_relevant or summary."""
    parsed, failed = parse_model_replies(replies.withColumn("_called", F.col("call_error").isNull()))
    verdict = F.when(~F.col("_called"), "call_failed").when(is_not_relevant(F.col("fields.problem")), "not_relevant").otherwise("summary")
    bad = failed.withColumn("route", F.when(~F.col("_called"), "call_failed").otherwise("unparseable")).withColumn("fields", F.lit(None).cast(REPLY)).drop("reason")
    return parsed.withColumn("route", verdict).unionByName(bad).drop("_called")


def canonical_id(c, prefix: str):
    """Digits get the prefix and lose leading zeros; tracker keys stay; anything else gets the prefix."""
    return F.when(c.rlike(r"^\d+$"), F.concat(F.lit(prefix), F.regexp_replace(c, r"^0+(?=\d)", ""))).when(c.rlike(r"^[A-Z]+[_-]?\d+"), c).otherwise(F.concat(F.lit(prefix), c))


def repaired_link(url, ticket_id):
    root = F.regexp_replace(F.substring_index(url, "/browse/", 1), "/+$", "")
    return F.when(url.contains("/browse/") & ticket_id.rlike(r"^[A-Z]+-\d+$"), F.concat(root, F.lit("/browse/"), ticket_id)).otherwise(url)


def build_summaries(parsed: DataFrame, tickets: DataFrame, prefix: str = "HD-") -> DataFrame:
    """Ids, subject and link of the ticket; date of the reply if it is not blank, else of the ticket; the
    image links among tickets' urls and filenames (parallel arrays), first occurrence first."""
    own_fields = ["subject", "issue_date", "url", "urls", "filenames"]
    known = tickets if "filenames" in tickets.columns else tickets.withColumn("filenames", F.transform("urls", lambda _: F.lit("")))
    joined = parsed.select(F.col("ticket_id").cast("string").alias("ticket_id"), "fields").join(known.select(F.col("ticket_id").cast("string").alias("ticket_id"), *own_fields), "ticket_id")
    own = canonical_id(F.col("ticket_id"), prefix)
    linked = F.transform("urls", lambda u, i: F.struct(u.alias("url"), F.coalesce(F.get("filenames", i), F.lit("")).alias("name")))
    shown = F.filter(linked, lambda a: a["url"].rlike("^https?://") & is_image_link(a["url"], a["name"]))
    return joined.select(
        own.alias("ticket_id"),
        F.coalesce(F.nullif(F.btrim("fields.date"), F.lit("")), "issue_date").alias("date"),
        "subject",
        F.coalesce("fields.problem", F.lit("")).alias("problem"),
        F.coalesce("fields.solution", F.lit("")).alias("solution"),
        repaired_link(F.col("url"), own).alias("ticket_url"),
        F.array_distinct(F.transform(shown, lambda a: a["url"])).alias("image_urls"),
    )


def write_json_normalised(df: DataFrame, path: str) -> None:
    """Every string in plain Unicode, also inside arrays, structs and map values; then JSON lines."""
    bounded_batches(df.sparkSession)

    def plain(value: object) -> object:
        if isinstance(value, str):
            return plain_text(value)
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        if isinstance(value, list):
            return [plain(v) for v in value]
        return (value[0], plain(value[1])) if isinstance(value, tuple) and len(value) == 2 else value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([plain(v) for v in c.to_pylist()], c.type) for c in b.columns], names=b.schema.names)

    df.mapInArrow(run, df.schema).write.json(path)
