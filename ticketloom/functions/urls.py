"""Resolution of references against a page's URL, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.functions.text import once, unescape

#: The five parts of a reference (RFC 3986, appendix B).
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_HIERARCHICAL = ("http", "https", "ftp")


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def _without_dots(segments: Column) -> Column:
    """Segments after "." and ".." have been followed; a path that ends in one of them ends in a slash."""
    start = F.array().cast("array<string>")
    kept = F.aggregate(segments, start, lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.array_append(acc, s)))
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)


def resolve_url(base: Column, ref: Column) -> Column:
    """A reference as a reader of the page at ``base`` would follow it. References of another scheme stay as they
    are; of the same scheme, or none, what they lack is taken from base: authority, then folder, then query.
    Empty segments inside a joined path go. An empty reference is the page itself; null gives null."""
    cleaned = F.regexp_replace(F.regexp_replace(ref, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return once(_resolved, base=base, ref=cleaned)


def _resolved(v: Column) -> Column:
    """From base and ref: their parts."""
    base, ref = v["base"], v["ref"]
    with_authority = ref.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]")
    of_base = {"base_scheme": F.lower(_part(base, 1)), "base_authority": _part(base, 2), "base_path": _part(base, 3), "base_query": _part(base, 4)}
    of_ref = {"scheme": F.lower(_part(ref, 1)), "authority": _part(ref, 2), "path": _part(ref, 3), "query": _part(ref, 4), "fragment": _part(ref, 5)}
    return once(_built, base=base, ref=ref, with_authority=with_authority, **of_base, **of_ref)


def _built(v: Column) -> Column:
    base_scheme, path = v["base_scheme"], v["path"]
    elsewhere = (v["scheme"] != "") & (v["scheme"] != base_scheme)
    merged = F.when(path == "", v["base_path"]).otherwise(once(lambda j: F.when(j["joined"] == "", "/").otherwise(j["joined"]), joined=_joined_path(v["base_path"], path)))
    rooted = lambda p: F.when((p != "") & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p)  # noqa: E731  behind an authority
    own = once(lambda o: rooted(o["path"]), path=F.when(v["with_authority"], path).otherwise(merged))
    asked = F.when((path == "") & (v["query"] == "") & ~v["with_authority"], v["base_query"]).otherwise(v["query"])
    authority = F.when(v["with_authority"], v["authority"]).otherwise(v["base_authority"])
    put = lambda mark, part: F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")
    built = F.concat(base_scheme, F.lit("://"), authority, own, put("?", asked), put("#", v["fragment"]))
    return F.when(v["ref"] == "", v["base"]).when(elsewhere | ~base_scheme.isin(*_HIERARCHICAL), v["ref"]).otherwise(built)


def _joined_path(base_path: Column, path: Column) -> Column:
    """A path behind the folder of another, dots followed."""
    folder = F.split(F.regexp_replace(base_path, r"[^/]+$", ""), "/", -1)  # "/a/b" -> ["", "a", ""]
    behind = lambda f: F.concat(F.when(F.element_at(f["folder"], -1) == "", F.slice(f["folder"], 1, F.size(f["folder"]) - 1)).otherwise(f["folder"]), F.split(path, "/", -1))
    without_empty = lambda w: F.filter(w["all"], lambda s, i: (s != "") | (i == 0) | (i == F.size(w["all"]) - 1))
    segments = F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(once(without_empty, all=once(behind, folder=folder)))
    return F.array_join(once(lambda s: _without_dots(s["segments"]), segments=segments), "/")


def anchors(html: Column) -> Column:
    """The targets of <a href>, character references read; not those in comments and scripts."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<script\b.*?</script>", "")
    tag = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"
    found = lambda v: F.concat(*[F.regexp_extract_all(v["shown"], F.lit(tag + value), F.lit(1)) for value in ('"([^"]*)"', "'([^']*)'", r"([^\s\"'>]+)")])
    mark = "￿"
    read = lambda v: F.when(F.size(v["found"]) > 0, F.split(once(lambda t: unescape(t["all"]), all=F.array_join(v["found"], mark)), mark, -1)).otherwise(F.array().cast("array<string>"))
    return once(read, found=once(found, shown=shown))
