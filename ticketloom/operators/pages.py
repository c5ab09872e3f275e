"""Web pages: content elements, titles, operation catalogue, links and reachability; chapters."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.text import joined_url, once, title_case, token_estimate, unescape, url_part, without_controls
from ticketloom.functions.urls import anchors, resolve_url
from ticketloom.operators.filters import is_crawlable
from ticketloom.session import bounded_batches, written

_DROPPED = {"script", "style", "nav", "footer", "header"}
_VOID = {"br", "img", "hr", "meta", "link", "input", "col", "area", "base", "source", "wbr", "embed", "param", "track"}
_WANTED = {"site": {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "div"}, "api": {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "div", "pre", "code"}}
_LEAST = {"site": 10, "api": 5}


def _region(tag: str, attrs: dict[str, str | None]) -> int | None:
    """The rank of a main region; the first of the best rank is the page's."""
    classes = (attrs.get("class") or "").split()
    marks = (tag == "main", tag == "article", "content" in classes, attrs.get("id") == "content", "main-content" in classes, "post-content" in classes, tag == "div" and attrs.get("role") == "main")
    return marks.index(True) if any(marks) else None


class _Elements(HTMLParser):
    """Elements with their text; a div repeats the text of what is inside it."""

    def __init__(self, profile: str):
        super().__init__(convert_charrefs=True)
        self.wanted, self.least, self.profile = _WANTED[profile], _LEAST[profile], profile
        self.stack: list[tuple[str, int, int]] = []  # tag, index of its element or -1, its region or -1
        self.found: list[tuple[str, list[str], tuple[int, ...]]] = []  # tag, texts, regions around it
        self.regions: list[int] = []  # ranks, in order of appearance
        self.inside: tuple[int, ...] = ()
        self.dropped = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            return
        at = region = -1
        if tag in ("p", "li"):  # an open one of the same kind ends here
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    self._close(k)
                    break
                if self.stack[k][0] in ("div", "article", "main", "ul", "ol", "section", "body"):
                    break
        if tag in self.wanted and not self.dropped:
            at = len(self.found)
            self.found.append((tag, [], self.inside))
        rank = None if self.dropped else _region(tag, dict(attrs))
        if rank is not None:
            region = len(self.regions)
            self.regions.append(rank)
            self.inside += (region,)
        self.stack.append((tag, at, region))
        self.dropped += tag in _DROPPED

    def _close(self, k: int) -> None:
        for tag, _, region in self.stack[k:]:
            self.dropped -= tag in _DROPPED
            if region >= 0:
                self.inside = tuple(r for r in self.inside if r != region)
        del self.stack[k:]

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._close(k)
                return

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            for _, at, _ in self.stack:
                if at >= 0:
                    self.found[at][1].append(data)

    def rows(self) -> list[tuple[str, str, int]]:
        main = min(range(len(self.regions)), key=self.regions.__getitem__) if self.regions and self.profile == "site" else None
        out = []
        for tag, parts, inside in self.found:
            text = " ".join("".join(parts).split())
            if len(text) > self.least and (main is None or main in inside):
                out.append((tag, text, int(tag[1]) if tag[0] == "h" and tag[1:].isdigit() else 0))
        return out


def page_elements(pages: DataFrame, profile: str = "site", key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, elem_ord, type, text, level) in document order: type is the tag, level the digit of a
    heading, else 0. The ``site`` profile reads the first of the best main regions only, ``api`` the page."""
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = _Elements(profile)
                parser.feed(source or "")
                parser.close()
                out += [(k, i, *row) for i, row in enumerate(parser.rows())]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "elem_ord", "type", "text", "level"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, elem_ord int, type string, text string, level int")


_MARK = "\uffff"


def inner_text(tag: str, html: Column) -> Column:
    """Texts of all simple elements of one tag: tags inside removed, character references read, white space
    collapsed."""
    raw = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    bare = F.transform(raw, lambda x: F.regexp_replace(x, "<[^>]*>", " "))
    # all elements of a page are read in one go; no text holds the mark between them, a noncharacter
    read = F.split(unescape(F.array_join(bare, _MARK)), _MARK, -1)
    return F.when(F.size(bare) > 0, F.transform(read, lambda x: F.btrim(F.regexp_replace(x, r"[ \t\r\n]+", " ")))).otherwise(F.array().cast("array<string>"))


#: How the paragraph begins that tells nothing of an operation, and two titles.
BOILERPLATE = "The following operations are supported"
WSDL_TITLE, DEFAULT_TITLE = "WSDL Service Description", "API Documentation"


def page_titles(pages: DataFrame, site_name: str = "Website") -> DataFrame:
    """(page_id, url, title): operation pages by operation and heading, WSDL pages by a fixed label,
    others by title, else h1, else a fixed default. The site's own name is no title."""
    html, url = F.col("html"), F.col("url")
    heads = F.filter(F.concat(inner_text("h1", html), inner_text("h2", html)), lambda x: (F.length(x) > 3) & (x != site_name))
    paragraphs = F.filter(inner_text("p", html), lambda x: F.length(x).between(21, 199) & ~x.startswith(BOILERPLATE))
    operation = title_case(F.replace(F.element_at(F.split(url, r"\?op="), -1), F.lit("_"), F.lit(" ")))
    of_operation = F.when(F.size(heads) > 0, F.concat(operation, F.lit(" - "), F.get(heads, F.lit(0)))).when(F.size(paragraphs) > 0, F.concat(operation, F.lit(" API"))).otherwise(F.concat(operation, F.lit(" API Endpoint")))
    first = lambda tag: F.nullif(F.nullif(F.get(inner_text(tag, html), F.lit(0)), F.lit("")), F.lit(site_name))
    title = F.when(url.contains("?op="), of_operation).when(url.contains("WSDL"), WSDL_TITLE).otherwise(F.coalesce(first("title"), first("h1"), F.lit(DEFAULT_TITLE)))
    return pages.select("page_id", "url", title.alias("title"))


class _Operations(HTMLParser):
    """Links with ?op= and the text of the element around each; every piece of text is kept once."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.open: list[tuple[str, int, list[list], list | None]] = [("", 0, [], None)]  # tag, first piece, links right inside, itself as a link
        self.links: list[list] = []  # href, link text, text around

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            return
        href = dict(attrs).get("href") or "" if tag == "a" else ""
        own = None
        if "?op=" in href:
            own = [href, "", ""]
            self.links.append(own)
            self.open[-1][2].append(own)
        self.open.append((tag, len(self.pieces), [], own))

    def _close(self, k: int) -> None:
        for _, start, links, own in reversed(self.open[k:]):
            text = " ".join("".join(self.pieces[start:]).split()) if links or own else ""
            if own:
                own[1] = text
            for link in links:
                link[2] = text
        del self.open[k:]

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                self._close(k)
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)

    def close(self) -> None:
        super().close()
        self._close(0)


def _operations(html: str, base: str) -> list[tuple[str, str, str, str]]:
    """(name, label, url, description) of each link; description is what the element around says besides."""
    if "?op=" not in html:
        return []
    parser = _Operations()
    parser.feed(html)
    parser.close()
    out = []
    for href, label, around in parser.links:
        name = href.split("?op=")[-1]
        about = around.replace(label, "").strip(" \t\r\n-") if len(around) > len(label) else ""
        out.append((name, label or name.replace("_", " ").title(), joined_url(base, href), about))
    return out


def operation_catalog(pages: DataFrame, base: str) -> DataFrame:
    """(name, page_id, pos, display_name, url, description) of links with ?op=, parsed once in Arrow batches.
    A repeated name keeps its first place and its last values."""
    bounded_batches(pages.sparkSession)
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, i, *x) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, x in enumerate(_operations(t or "", base))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [batch.schema.field(0).type, pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["page_id", "pos", "name", "display_name", "url", "description"])

    found = pages.select("page_id", "html").mapInArrow(run, f"page_id {kind}, pos int, name string, display_name string, url string, description string")
    found = found.withColumn("at", F.struct("page_id", "pos"))
    last = found.groupBy("name").agg(F.min("at").alias("at"), F.max_by(F.struct("display_name", "url", "description"), "at").alias("v"))
    return last.select("name", F.col("at.page_id").alias("page_id"), F.col("at.pos").alias("pos"), "v.display_name", "v.url", "v.description")


def reachable_pages(links: DataFrame, start: list | DataFrame, max_depth: int = 3, src: str = "src", dst: str = "dst") -> DataFrame:
    """(page, depth) of everything reachable from start (a list, or a table with column ``page``) within
    max_depth links, at minimum depth. Each
    level is one join of the frontier with the links and one anti-join with what was seen; levels are
    written to the shared folder, so the plan stays short."""
    spark = links.sparkSession
    kind = dict(links.dtypes)[src]
    first = start.select(F.col("page").cast(kind).alias("page")) if isinstance(start, DataFrame) else spark.createDataFrame([(s,) for s in start], f"page {kind}")
    seen = first.distinct().withColumn("depth", F.lit(0))
    edges = written(links.select(F.col(src).alias("_s"), F.col(dst).alias("_d")).distinct(), "reach-links")  # read by each level
    frontier = seen
    for depth in range(1, max_depth + 1):
        step = frontier.join(edges, frontier.page == edges._s).select(F.col("_d").alias("page")).distinct()
        frontier = written(step.join(seen.select("page"), "page", "left_anti").withColumn("depth", F.lit(depth)), "reach")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def page_link_graph(pages: DataFrame) -> DataFrame:
    """(src, dst) page ids of the links that pages(page_id, url, html) hold: targets of <a href>, resolved against the
    page's own URL, that can be crawled from it and are a known page's URL. URLs that differ in the fragment
    are different; of several pages with one URL the first counts."""
    followed = F.transform(F.array_distinct(anchors(F.col("html"))), lambda href: resolve_url(F.col("url"), href))
    of_host = once(lambda v: F.filter(v["urls"], lambda u: is_crawlable(u, v["home"])), urls=F.array_distinct(followed), home=url_part(F.col("url"), "authority"))
    wanted = pages.select(F.col("page_id").alias("src"), F.explode(of_host).alias("url")).distinct()
    known = pages.groupBy("url").agg(F.min("page_id").alias("dst"))
    return wanted.join(known, "url").select("src", "dst").distinct()


class _Blocks(HTMLParser):
    """Blocks of a document: (style, content, rows of a table, source of an image). One element at a time is
    read as a block; inside of it, tags only say where its items and cells begin and end."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple] = []
        self.stack: list[str] = []
        self.text: list[str] = []  # of the string that is being read
        self.depth = -1  # of the element that is the block, -1 outside of any
        self.items: list[list[str]] = []  # strings of the block, of each item, or of each cell
        self.images: list[str] = []
        self.rows: list[list[list[str]]] = []
        self.open_rows: list[list[list[str]]] = []
        self.open_cells: list[list[str]] = []
        self.in_item = False

    def _put(self, style: str, content: str | None, rows: list | None = None, src: str | None = None) -> None:
        self.blocks.append((style, content, rows, src))

    def _string(self) -> None:
        """A whole string between two tags."""
        text, self.text = "".join(self.text), []
        if not text or "script" in self.stack or "style" in self.stack:
            return
        if self.depth < 0:
            if text.strip():
                self._put("paragraph", text)
            return
        kind = self.stack[self.depth]
        if kind in ("pre", "code"):
            self.items[0].append(text)
        elif text := text.strip():
            if kind in ("p", "div"):
                self.items[0].append(text)
            elif kind in ("ul", "ol") and self.in_item:
                self.items[-1].append(text)
            for cell in self.open_cells:
                cell.append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._string()
        outside, kind = self.depth < 0, self.stack[self.depth] if self.depth >= 0 else ""
        if tag == "img" and (src := dict(attrs).get("src")):
            if outside:
                self._put("image", None, None, src)
            elif kind in ("p", "div"):
                self.images.append(src)
        if tag == "br" and outside:
            self._put("blank", "")
        if tag in _VOID:
            return
        self.stack.append(tag)
        if outside and tag in ("p", "div", "ul", "ol", "pre", "code", "table"):
            self.depth, self.items, self.images, self.rows = len(self.stack) - 1, [] if tag in ("ul", "ol") else [[]], [], []
        elif kind in ("ul", "ol") and tag == "li" and len(self.stack) == self.depth + 2:
            self.items.append([])
            self.in_item = True
        elif kind == "table" and tag == "tr":
            self.rows.append([])
            self.open_rows.append(self.rows[-1])
        elif kind == "table" and tag in ("td", "th"):
            self.open_cells.append([])
            for row in self.open_rows:
                row.append(self.open_cells[-1])

    def _leave(self, tag: str) -> None:
        at = len(self.stack)  # the place that was left
        if at == self.depth + 1 and tag == "li":
            self.in_item = False
        elif tag == "tr" and self.open_rows:
            self.open_rows.pop()
        elif tag in ("td", "th") and self.open_cells:
            self.open_cells.pop()
        if at != self.depth:
            return
        self.depth, self.in_item, self.open_rows, self.open_cells = -1, False, [], []
        if tag in ("ul", "ol"):
            for item in self.items:
                if item:
                    self._put("number" if tag == "ol" else "bullet", " ".join(item))
        elif tag == "table":
            rows = [[" ".join(cell) for cell in row] for row in self.rows]
            rows = [row for row in rows if any(row)]
            if rows:
                width = max(map(len, rows))
                self._put("table", None, [row + [""] * (width - len(row)) for row in rows])
        elif tag in ("pre", "code"):
            if text := "\n".join(self.items[0]):
                self._put("pre", text)
        else:
            if self.items[0]:
                self._put("paragraph", " ".join(self.items[0]))
            for src in self.images:
                self._put("image", None, None, src)

    def handle_endtag(self, tag: str) -> None:
        self._string()
        if tag in self.stack:
            while True:
                left = self.stack.pop()
                self._leave(left)
                if left == tag:
                    return

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def handle_comment(self, data: str) -> None:
        self._string()

    def close(self) -> None:
        super().close()
        self._string()
        while self.stack:
            self._leave(self.stack.pop())


def markup_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, block_ord, style, content, rows, src) of HTML in document order: ``paragraph`` (p, div, or bare text),
    ``blank`` (br between blocks), ``bullet`` and ``number`` (an item of a list, with the text of lists
    inside it), ``pre``, ``table`` (rows of equal width, empty ones left out) and ``image``. Comments, scripts
    and styles are no content; null and empty text gives no blocks; what is not closed ends with the text."""
    bounded_batches(pages.sparkSession)
    grid = pa.list_(pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = _Blocks()
                parser.feed(source or "")
                parser.close()
                out += [(k, i, *block) for i, block in enumerate(parser.blocks)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), grid, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "block_ord", "style", "content", "rows", "src"])

    kind = dict(pages.dtypes)[key]
    found = pages.select(key, html).mapInArrow(run, f"{key} {kind}, block_ord int, style string, content string, rows array<array<string>>, src string")
    return found.withColumn("content", without_controls(F.col("content"))).withColumn("rows", F.transform("rows", lambda r: F.transform(r, without_controls)))


def is_heading(style: Column, outline: Column, level: int) -> Column:
    low = F.lower(F.coalesce(style, F.lit("")))
    named = F.lit(False)
    for word in ("heading", "überschrift"):
        named = named | low.contains(f"{word} {level}") | low.contains(f"{word}{level}")
    return named | F.coalesce(outline == level - 1, F.lit(False))


def split_chapters(paragraphs: DataFrame, level: int = 1) -> DataFrame:
    """paragraphs(doc, ord, style, outline_level, text) -> chapters. Text before the first heading goes,
    unless there is none at all. Documents with at most one chapter take, of levels 1 to 3, the first
    with most chapters. Rows of one doc and ord count each, in any order.

    Two passes: how many headings each level has decides on the level of a document (an aggregation with
    map-side combine); then running counts over that level alone number the chapters."""
    levels = list(dict.fromkeys([level, 1, 2, 3]))
    heads = F.array(*[is_heading(F.col("style"), F.col("outline_level"), k) for k in levels])
    marked = paragraphs.select("doc", "ord", "text", heads.alias("heads"))
    counts = marked.groupBy("doc").agg(F.array(*[F.sum(F.get("heads", F.lit(i)).cast("int")) for i in range(len(levels))]).alias("n"))
    # a document without headings of a level is one chapter there
    size = lambda i: F.greatest(F.lit(1), F.get("n", F.lit(i)))
    order = {k: F.struct(size(i).alias("n"), F.lit(-k).alias("low"), F.lit(i).alias("at")) for i, k in enumerate(levels) if k in (1, 2, 3)}
    chosen = counts.select("doc", F.when(size(0) > 1, 0).otherwise(F.greatest(*order.values())["at"]).alias("at"), "n")
    placed = marked.join(chosen, "doc").select("doc", "ord", "text", F.get("heads", F.col("at")).alias("head"), (F.get("n", F.col("at")) > 0).alias("any"), F.get(F.array(*map(F.lit, levels)), F.col("at")).alias("level"))
    w = Window.partitionBy("doc").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("index", F.sum(F.col("head").cast("int")).over(w).cast("long")).filter((F.col("index") > 0) | ~F.col("any"))
    body = F.array_sort(F.collect_list(F.when(~F.col("head") & (F.btrim("text") != ""), F.struct("ord", "text"))))
    rows = numbered.groupBy("doc", "index", "level").agg(F.max(F.when(F.col("head"), F.col("text"))).alias("title"), body.alias("body"))
    content = F.array_join(F.transform("body", lambda p: p["text"]), "\n\n")
    out = rows.select("doc", F.greatest("index", F.lit(1)).alias("index"), F.coalesce("title", F.lit("Document")).alias("title"), content.alias("content"), "level")
    return out.select("doc", "index", "title", "content", F.length("content").cast("long").alias("char_count"), token_estimate(F.length("content")).alias("token_estimate"), "level")


def rich_tree_to_text(df: DataFrame, col: str) -> DataFrame:
    """A column of JSON trees {type, text, content[]} as text, in Arrow batches: the depth of a tree has
    no fixed schema. Paragraphs, headings and list items end a line; what cannot be read gives ""."""
    import json
    import re

    bounded_batches(df.sparkSession)
    at = df.columns.index(col)

    def text_of(source: str | None) -> str:
        out: list[str] = []

        def walk(node: object) -> None:
            if isinstance(node, list):
                for x in node:
                    walk(x)
            elif isinstance(node, dict):
                if node.get("type") == "text":
                    out.append(str(node.get("text", "")))
                walk(node.get("content", []))
                if node.get("type") in ("paragraph", "heading", "listItem"):
                    out.append("\n")

        try:
            walk(json.loads(source or ""))
        except (ValueError, RecursionError):
            return ""
        return re.sub(r"\n{3,}", "\n\n", "".join(out)).strip()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            trees = columns[at].dictionary_encode()  # equal trees of a batch are parsed once
            texts = pa.array([text_of(t) for t in trees.dictionary.to_pylist()], pa.string())
            columns[at] = texts.take(trees.indices).fill_null("")
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)
