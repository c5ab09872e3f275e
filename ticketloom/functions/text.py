"""Cleaning and parsing of text columns as column expressions.

Python takes part in three places only, in Arrow batches: Unicode compatibility forms, capitals, and the two markup
languages.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from html.entities import html5
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.columns import held
from ticketloom.session import bounded_batches

#: White space, Unicode's and the four separators that are control characters.
_SPACE = r"[\s\x1C-\x1F]"
_SPACES = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def let(c: Column, fn: Callable[[Column], Column]) -> Column:
    """fn of a value that is computed once, however often fn reads it."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def _text_function(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        bounded_batches(spark)  # also ships this module, whose functions executors read

    def run(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


#: What may be a character reference, all else up to the next one, and an ampersand that is none.
_REFERENCES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]++|&"


def _character(code: Column) -> Column:
    """The character of a code point, which has 4 bytes behind a byte order mark."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")


def _numbered(digits: Column, base: int) -> Column:
    """A numeric reference by its digits. Small numbers are those of an old code page, surrogates and what is beyond
    the last code point become a replacement character, code points that are no characters go."""
    digits = F.regexp_replace(digits, "^0+", "")
    small = F.array(*[F.lit(html.unescape(f"&#{n};")) for n in range(0xA0)])

    def of(code: Column) -> Column:
        # what is no character: the last two of each plane, and 32 within the first
        none = (code.bitwiseAND(0xFFFE) == 0xFFFE) | code.between(0xFDD0, 0xFDEF)
        lost = code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
        return F.when(code < 0xA0, F.get(small, code)).when(lost, "�").when(none, "").otherwise(_character(code))

    long = F.length(digits) > 7  # beyond any code point
    code = F.when(long, 0x110000).when(digits == "", 0).otherwise(F.conv(digits, base, 10).cast("int"))
    return F.get(F.transform(F.array(code), of), F.lit(0))


def once(use: Callable[[Column], Column], **values: Column) -> Column:
    """use(a struct of the values), where each value is computed once however often it is used: an expression
    that is written twice is computed twice, in branches and filters always, and twice again in what uses it."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use), F.lit(0))


def unescape(c: Column) -> Column:
    """Named and numeric character references as characters. Names with a semicolon are looked up whole; of others
    the longest name that may go without one counts, and what follows it stays. Texts without "&" pass as they are."""
    common = ["amp;", "lt;", "gt;", "quot;", "nbsp;"]
    whole = common + sorted(n for n in html5 if n.endswith(";") and n not in common)
    named = F.str_to_map(F.lit("\x01".join(f"{n}\x02{html5[n]}" for n in whole)), F.lit("\x01"), F.lit("\x02"))
    bare = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    started = F.str_to_map(F.lit("\x01".join(f"{n}\x02{html5[n]}" for n in bare)), F.lit("\x01"), F.lit("\x02"))

    def read(t: Column) -> Column:
        name = F.regexp_extract(t, f"^&({'|'.join(bare)})", 1)
        listed = F.when(t.endswith(";"), F.try_element_at(named, F.substr(t, F.lit(2))))
        begun = F.when(name != "", F.concat(F.try_element_at(started, name), F.substr(t, F.length(name) + 2)))
        hexed, decimal = F.regexp_extract(t, "^&#[xX]([0-9a-fA-F]+)", 1), F.regexp_extract(t, "^&#([0-9]+)", 1)
        number = F.when(hexed != "", _numbered(hexed, 16)).when(decimal != "", _numbered(decimal, 10))
        return F.when(~t.startswith("&") | (t == "&"), t).when(t.startswith("&#"), F.coalesce(number, t)).otherwise(F.coalesce(listed, begun, t))

    parts = F.regexp_extract_all(c, F.lit(_REFERENCES), F.lit(0))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, read), "")).otherwise(c)


def compatible(c: Column) -> Column:
    """NFKC."""
    form = unicodedata.normalize
    return _text_function(lambda t: t if t.isascii() else form("NFKC", t))(c)


def title_case(c: Column) -> Column:
    """Each letter behind something that is no letter as a capital, the others small."""
    return _text_function(str.title)(c)


def clean_html(c: Column, style: str = "breaks") -> Column:
    """``breaks``: br, div and p start new lines; ``inline``: only br does. Null gives "" inline."""
    rx = F.regexp_replace
    if style == "inline":
        out = rx(F.coalesce(c, F.lit("")), r"(?i)<br\s*/?>", "\n")
        return stripped(rx(unescape(rx(out, r"<[^>]+>", "")), r"\n{3,}", "\n\n"))
    out = F.replace(c, F.lit("<!--html-->"), F.lit(""))
    out = rx(out, r"(?i)<br\s*/?>", "\n")
    out = rx(out, r"(?i)</?(div|p)[^>]*>", "\n")
    out = unescape(rx(out, r"<[^>]+>", ""))
    return stripped(fewer_blank_lines(rx(out, r" +", " ")))


def fewer_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\n{_SPACE}*\n{_SPACE}*\n+", "\n\n")


def _between(text: str, opening: str, closing: str, shown: Callable[[str], str]) -> str:
    """Each stretch from an opening mark to the next closing one, both given as patterns, becomes ``shown``
    of what is between. The text is cut at the closing marks; each piece but the last is looked through for
    its first opening mark, so nothing is tried twice. A mark without its other half stays."""
    pieces, out = re.split(f"(?i)({closing})", text), []
    for piece, mark in zip(pieces[:-1:2], pieces[1::2], strict=True):
        found = re.search(f"(?i){opening}", piece)
        out += [piece[: found.start()], shown(piece[found.end() :])] if found else [piece, mark]
    return "".join(out) + pieces[-1]


def joined_url(base: str, url: str) -> str:
    """url against base; what cannot be read as a URL stays as it is."""
    try:
        return urljoin(base, url)
    except ValueError:
        return url


def _absolute(url: str, base: str) -> str:
    url = url.strip()
    if not url or url.lower().startswith(("http:", "https:")):
        return url
    return joined_url(base.rstrip("/") + "/", url.lstrip("/"))


def _quoted(inner: str) -> str:
    """Lines that start with "> ", a bare ">" where a line is blank."""
    return "\n" + "\n".join(f"> {x}" if x.strip() else ">" for x in inner.strip("\n").split("\n")) + "\n"


def _fewer_blank_lines(text: str) -> str:
    return re.sub(r"\n\s*\n\s*\n+", "\n\n", text).strip()


def _markdown_of(text: str, base: str) -> str:
    def link(inner: str) -> str:
        """``inner`` starts behind "[url="; a target is at least one character and ends at the next "]"."""
        end = inner.find("]", 1)
        if end < 0 or "\n" in inner[:end]:
            return f"[url={inner}[/url]"
        label = inner[end + 1 :].strip().replace("]", "\\]").replace(")", "\\)")
        return f"[{label}]({_absolute(inner[:end], base)})"

    shapes: dict[str, Callable[[str], str]] = {
        "b": "**{}**".format,
        "i": "_{}_".format,
        "u": "<u>{}</u>".format,
        "code": lambda x: "\n```\n" + x.strip("\n") + "\n```\n",
        "quote": _quoted,
        "img": lambda x: f"![]({_absolute(x, base)})",
        "url": lambda x: f"<{_absolute(x, base)}>",
    }
    text = text.replace("\r\n", "\n")
    for tag, shown in shapes.items():
        text = _between(text, rf"\[{tag}\]", rf"\[/{tag}\]", shown)
    text = _between(text, r"\[url=", r"\[/url\]", link)
    for gone, instead in ((r"\[\*\]\s*", "- "), (r"(?i)\[/?list\]", ""), (r"(?i)<br\s*/?>", "\n"), (r"(?s)<!--.*?-->", "")):
        text = re.sub(gone, instead, text)
    return _fewer_blank_lines(text)


def bbcode_to_markdown(c: Column, base: str = "") -> Column:
    """Bold, italic, underline, code, quotes, images, links, lists and breaks of BBCode in Markdown; targets
    are made absolute. Null gives ""."""
    read = _markdown_of
    return _text_function(lambda t: read(t, base))(F.coalesce(c, F.lit("")))


def _without_pairs(line: str, mark: str) -> str:
    """A line without the marks that stand in pairs; an odd last one stays."""
    parts = line.split(mark)
    return "".join(parts) if len(parts) % 2 else "".join(parts[:-1]) + mark + parts[-1]


def _text_of_markdown(text: str) -> str:
    """The patterns below are fixed values, in this order. In Python, as the same rules took longer in the JVM."""
    parts = text.replace("\r\n", "\n").split("```")  # every second part is inside a fence, if another fence follows
    last = len(parts) - 1
    text = "".join(x if k % 2 == 0 else f"\n{x.strip()}\n" if k < last else f"```{x}" for k, x in enumerate(parts))
    text = "\n".join(re.sub(r"^[ \t]*> ?", "", x) for x in text.split("\n"))
    text = re.sub(r"!\[[^\]]*\]\(([^)]+)\)", r"\1", text)
    text = re.sub(r"\[([^\]]+)\]\(([^)]+)\)", r"\1 (\2)", text)
    text = re.sub(r"(?m)^\s{0,3}#{1,6}\s*", "", re.sub(r"(?i)</?u>", "", text))  # blank lines around a heading's mark go with it
    lines = text.split("\n")
    for mark in ("**", "__", "_", "*"):
        lines = [_without_pairs(x, mark) if mark in x else x for x in lines]
    return _fewer_blank_lines(re.sub(r"[ \t]+", " ", re.sub(r"(?m)^-\s+", "- ", "\n".join(lines))))


def markdown_to_text(c: Column) -> Column:
    """Code without fences, quotes without marks, images as URL, links as "text (url)", headings and
    emphasis without marks, one blank where there are several. Null gives ""."""
    read = _text_of_markdown
    return _text_function(lambda t: read(t))(F.coalesce(c, F.lit("")))


#: What a text for similarity goes without, in this order, in lower case, behind what a text must
#: hold for it.
SIMILARITY_NOISE = [
    ("http", r"https?://[^\s]+"),
    ("file/get/", r"\bfile/get/\d+\b"),
    ("nn", r"\bnn\d+\b"),
    ("per", r"\bpers?nr?\s*[:#-]?\s*\d+\b"),
    ("per.", r"\bper\.\d+\b"),
]


def _without(mark: str, pattern: str) -> Callable[[Column], Column]:
    return lambda x: F.when(F.contains(x, F.lit(mark)), F.regexp_replace(x, f"(?U){pattern}", " ")).otherwise(x)


def similarity_text(subject: Column, problem: Column, solution: Column) -> Column:
    """Lower-cased ``subject . problem . solution`` without links, file ids and person numbers."""
    out = F.lower(F.concat_ws(" . ", *[F.coalesce(c, F.lit("")) for c in (subject, problem, solution)]))
    for mark, pattern in SIMILARITY_NOISE:
        out = let(out, _without(mark, pattern))
    return F.btrim(F.regexp_replace(out, rf"(?U){_SPACE}+", " "))


#: Typographic characters and their plain forms.
PLAIN = {"\u2011": "-", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u202f": " ", "\u00a0": " ", "\u2013": "-", "\u2014": "-"}


def plain_marks(c: Column) -> Column:
    """Plain quotes, dashes and spaces, three full stops for an ellipsis."""
    return F.replace(F.translate(c, "".join(PLAIN), "".join(PLAIN.values())), F.lit("\u2026"), F.lit("..."))


def without_controls(c: Column) -> Column:
    """Without control characters but line end, tab and return."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def normalise_unicode(c: Column) -> Column:
    """Plain marks, then NFKC, then no control characters."""
    return without_controls(compatible(plain_marks(c)))


def plain_text(t: str) -> str:
    """``normalise_unicode`` of one text, for values inside nested columns and broken replies."""
    for mark, plain in PLAIN.items():
        t = t.replace(mark, plain)
    t = unicodedata.normalize("NFKC", t.replace("\u2026", "..."))
    return "".join(x for x in t if x >= " " or x in "\n\t\r")


def normalise_url(c: Column, base: str) -> Column:
    out = stripped(F.coalesce(c, F.lit("")))
    joined = F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(out, "^/+", ""))
    return F.when(out == "", "").when(F.lower(out).rlike("^https?://"), out).otherwise(joined)


def strict_url(c: Column) -> Column:
    """Without a pair of equal quotes around it, up to the first white space or angle bracket; null if nothing is
    left."""
    bare = F.regexp_replace(stripped(c), r"(?s)^(?:\"(.*)\"|'(.*)')\z", "$1$2")
    return F.nullif(F.regexp_extract(bare, rf"(?U)^{_SPACE}*([^\s\x1C-\x1F<>]*)", 1), F.lit(""))


def api_root(base: Column, spare: Column) -> Column:
    """Where the API of a base URL is: in the help desk, if the URL's path names one, else at the host's root.
    ``spare`` counts where base is null or empty; without a host null. A URL without scheme is one of https."""
    url = F.coalesce(F.nullif(base, F.lit("")), F.nullif(spare, F.lit("")))
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    start = F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), url_part(url, "authority"))
    desk = F.contains(F.lower(url_part(url, "path")), F.lit("/helpdesk"))
    return F.when(url_part(url, "authority") != "", F.concat(start, F.when(desk, "/helpdesk/api").otherwise("/api")))


def url_part(url: Column, part: str) -> Column:
    """``authority`` (user, host and port, as written), ``path`` (without parameters behind a semicolon of its last
    segment) or ``query``; "" if there is none."""
    if part == "authority":
        return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    if part == "query":
        return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), r";[^/]*\z", "")


def file_name_of(url: Column) -> Column:
    return F.element_at(F.split(url_part(url, "path"), "/"), -1)


def file_id_of(url: Column) -> Column:
    """Digits of ``id=`` in the query, else a last path segment of digits, else null."""
    query = F.regexp_extract(url, r"[?&]id=(\d+)", 1)
    last = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"/(\d+)/?$", 1)
    return F.when(query != "", query).when(last != "", last)


#: What is replaced in logs, in this order, whatever the case.
SECRET_RULES = [
    (r"Authorization:\s*Bearer\s+[^\s]+", "Authorization: Bearer [REDACTED]"),
    (r"Authorization:\s*Basic\s+[^\s]+", "Authorization: Basic [REDACTED]"),
    (r"token[=:]\s*[^\s&]+", "token=[REDACTED]"),
    (r"key[=:]\s*[^\s&]+", "key=[REDACTED]"),
    (r"password[=:]\s*[^\s&]+", "password=[REDACTED]"),
    (r"secret[=:]\s*[^\s&]+", "secret=[REDACTED]"),
]


def redact(c: Column) -> Column:
    for pattern, to in SECRET_RULES:
        c = F.regexp_replace(c, f"(?iU){pattern}", to)
    return c


def redact_params(c: Column) -> Column:
    """A string map without keys that name a secret."""
    return F.map_filter(c, lambda k, _: ~F.lower(k).rlike("token|key|password|secret"))


def token_estimate(chars: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(chars / 4).cast("long"))


def question_target(tokens: Column, most: int, tokens_per_question: int = 350) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(most), F.bround(tokens / tokens_per_question, 0).cast("int")))


_ATTRIBUTE = r"(?i)(?:href|src)=[\"']([^\"']+)[\"']"


def link_candidates(text: Column, bbcode: bool = False) -> Column:
    """Targets of href and src; with ``bbcode`` those of [img], [url] and [url=] before them and bare
    http(s) addresses behind them. An array, in the order of the text for each kind."""
    found = F.regexp_extract_all(text, F.lit(_ATTRIBUTE), F.lit(1))
    if not bbcode:
        return found
    tagged = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in (r"(?is)\[img\](.*?)\[/img\]", r"(?is)\[url\](.*?)\[/url\]", r"(?i)\[url=(.+?)\](?s:.*?)\[/url\]")]
    bare = F.transform(F.regexp_extract_all(text, F.lit(r"(?iU)(https?://[^\s\])]+)"), F.lit(1)), lambda u: F.regexp_replace(u, r"[).,;\"']+\z", ""))
    return F.transform(F.concat(*tagged, found, bare), stripped)


def extract_links(df: DataFrame, id_col: str, html_col: str, base: str, bbcode: bool = False) -> DataFrame:
    """(id, ord, FileName, Url, Size) of attachment links, first occurrence first; ord counts all links."""
    from ticketloom.operators.filters import is_attachment_link

    usable = F.filter(link_candidates(F.col(html_col), bbcode), lambda u: (u != "") & ~F.lower(u).rlike("^(mailto:|javascript:|#)"))
    urls = F.array_distinct(F.transform(usable, lambda u: normalise_url(u, base)))
    rows = df.select(F.col(id_col), F.posexplode(urls).alias("ord", "Url"))
    return rows.filter(is_attachment_link(F.col("Url"), ("kb",) if bbcode else ())).select(id_col, "ord", file_name_of(F.col("Url")).alias("FileName"), "Url", F.lit(0).cast("long").alias("Size"))


def all_links(df: DataFrame, id_col: str, html_col: str, base: str) -> DataFrame:
    """(id, ord, Url) of every href and src, first occurrence first."""
    urls = F.array_distinct(F.transform(link_candidates(F.col(html_col)), lambda u: normalise_url(u, base)))
    return df.select(F.col(id_col), F.posexplode(urls).alias("ord", "Url"))


def bold_runs(c: Column) -> Column:
    """array<struct<text, bold>>: stretches between ** marks, or between <b> and </b>, are bold; a mark
    without its other half, or around nothing, stays."""
    marked = F.regexp_replace(c, r"(?is)<b>(.*?)</b>", "**$1**")
    # what is bold gets marks that texts do not hold, so that one cut suffices
    cut = F.split(F.regexp_replace(marked, r"\*\*(.+?)\*\*", "\x02$1\x02"), "\x02", -1)
    runs = F.transform(cut, lambda x, i: F.struct(x.alias("text"), (i % 2 == 1).alias("bold")))
    return F.filter(runs, lambda r: r["text"] != "")


def text_to_blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, block_ord, style, content, runs): runs of bullets, runs of numbered lines, and paragraphs up to a
    blank line or a list; blank text is one "(No content)" paragraph. Done inside each row, so rows that
    share an id stay apart and nothing is shuffled."""
    def line(raw: Column) -> Column:
        x = F.btrim(raw, F.lit(" \t\r"))
        bullet, number = r"^[-*•]\s+", r"^\d+[.)]\s+"
        kind = F.when(x == "", "blank").when(x.rlike(bullet), "bullet").when(x.rlike(number), "number").otherwise("paragraph")
        return F.struct(kind.alias("kind"), F.when(kind == "bullet", F.regexp_replace(x, bullet, "")).when(kind == "number", F.regexp_replace(x, number, "")).otherwise(x).alias("body"))

    text = F.regexp_replace(without_controls(F.coalesce(F.col(text_col), F.lit(""))), r"\r\n?", "\n")
    lines = held(df, [id_col], lines=F.transform(F.split(text, "\n"), line))
    # each line that is not blank starts a block unless it goes on with the kind of the line before
    begins = F.transform("lines", lambda x, i: F.when((x["kind"] != "blank") & ((i == 0) | (F.get("lines", i - 1)["kind"] != x["kind"])), i))
    ends = F.transform("lines", lambda x, i: F.when((x["kind"] != "blank") & F.coalesce(F.get("lines", i + 1)["kind"] != x["kind"], F.lit(True)), i))
    placed = held(lines, [id_col, "lines"], begins=F.array_compact(begins), ends=F.array_compact(ends))

    def block(begin: Column, k: Column) -> Column:
        kind = F.get("lines", begin)["kind"]
        bodies = F.transform(F.slice("lines", begin + 1, F.get("ends", k) - begin + 1), lambda x: x["body"])
        return F.struct(kind.alias("style"), F.when(kind == "paragraph", F.array_join(bodies, " ")).otherwise(F.array_join(bodies, "\n")).alias("content"))

    none = F.array(F.struct(F.lit("paragraph").alias("style"), F.lit("(No content)").alias("content")))
    blocks = placed.select(id_col, F.when(F.size("begins") == 0, none).otherwise(F.transform("begins", block)).alias("blocks"))
    rows = blocks.select(id_col, F.posexplode("blocks").alias("block_ord", "b"))
    return rows.select(id_col, F.col("block_ord").cast("long").alias("block_ord"), "b.style", "b.content", bold_runs(F.col("b.content")).alias("runs"))


def pack_chunks(df: DataFrame, id_col: str, text_col: str, max_tokens: int = 3500, separator: str = r"\n\s*\n", joiner: str = "\n\n") -> DataFrame:
    """(id, chunk_ord, content, tokens): parts packed greedily up to max_tokens, a tail below a fifth
    merged into the chunk before. A fold inside each row; nothing is shuffled."""
    limit = max(1000, max_tokens) if max_tokens >= 1000 else max_tokens
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), separator), lambda p: F.btrim(p, F.lit(" \t\r\n"))), lambda p: p != "")
    kind = "struct<begins:array<int>,at:int,n:bigint>"

    def step(acc: Column, t: Column) -> Column:
        """Keeps where chunks begin; the array grows only with chunks."""
        new = (acc["at"] == 0) | (acc["n"] + t > limit)
        begins = F.when(new, F.concat(acc["begins"], F.array(acc["at"]))).otherwise(acc["begins"])
        return F.struct(begins.alias("begins"), (acc["at"] + 1).alias("at"), F.when(new, t).otherwise(acc["n"] + t).alias("n")).cast(kind)

    start = F.struct(F.array().cast("array<int>").alias("begins"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("n")).cast(kind)
    cut = held(df, [id_col], parts=parts)
    folded = held(cut, [id_col, "parts"], f=F.aggregate(F.transform("parts", lambda p: token_estimate(F.length(p))), start, step))
    small_tail = (F.size("f.begins") > 1) & (F.col("f.n") < limit * 0.2)
    begins = F.when(small_tail, F.slice("f.begins", 1, F.size("f.begins") - 1)).otherwise(F.col("f.begins"))
    ready = held(folded, [id_col, "parts"], begins=begins)
    content = F.transform("begins", lambda b, k: F.array_join(F.slice("parts", b + 1, F.coalesce(F.get("begins", k + 1), F.size("parts")) - b), joiner))
    rows = ready.select(id_col, F.posexplode(content).alias("chunk_ord", "content"))
    return rows.select(id_col, F.col("chunk_ord").cast("long").alias("chunk_ord"), "content", token_estimate(F.length("content")).alias("tokens"))
