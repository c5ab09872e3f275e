"""Element-wise reading of huge JSON arrays: one file is read by as many tasks as it has splits.

Spark's text reader cuts a file anywhere; with "}" as the line end, also where there are no lines. What a split
does to the state of a parser is a small function of the state it is entered in: whether that is inside a
string, and how deep. A first pass finds these functions, the driver chains them (a row for each
split, some 128 MB), and with its entry state known each split is cut into elements on its own. Elements that reach over the
end of a split are put together by their first split; all others are never shuffled.

Cases: a file is an array, or an object that holds an array under one of ``keys``; others are an error, or give
nothing where ``strict`` is off; so are empty files, which Spark's reader does not show. White space, line ends and
brackets inside strings do not matter; elements may have any type and size; compressed files are one split. What
is no JSON inside an element is a null item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.session import bounded_batches, written

_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*+("?)', re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+("?)|[\[\]{},]', re.DOTALL)
_KEY = re.compile(r"\s*:\s*")

#: Entry state of a split: (inside a string, depth, whether the array that is read is open).
State = tuple[bool, int, bool]


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """(file, start, text) of each split of a task; rows (file, start, piece) come in the order of the file."""
    now, held = None, []
    for batch in batches:
        for file, start, piece in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if (file, start) != now:
                if held:
                    yield (*now, "}".join(held) + "}")
                now, held = (file, start), []
            held.append(piece)
    if held:
        yield (*now, "}".join(held) + "}")


def _tokens(text: str, in_string: bool) -> Iterator[tuple[int, int, str, bool]]:
    """(begin, end, first character, is whole) of strings and structural characters."""
    at = 0
    if in_string:
        m = _REST_OF_STRING.match(text)
        at = m.end()
        yield -1, at, '"', bool(m[1])
    for m in _TOKEN.finditer(text, at):
        yield m.start(), m.end(), m[0][0], m[0][0] != '"' or bool(m[1])


def effect(text: str, in_string: bool) -> tuple[bool, int]:
    """(inside a string, change of depth) behind a text that is entered inside a string or not."""
    depth, inside = 0, in_string
    for _, _, c, whole in _tokens(text, in_string):
        inside = c == '"' and not whole
        depth += (c in "[{") - (c in "]}")
    return inside, depth


def cut(text: str, state: State, level: int, keys: tuple[str, ...]) -> tuple[list[tuple[str, bool, bool]], bool]:
    """(fragments (text, begins here, ends here) of elements, whether the array is open at the end). Elements
    are what is at depth ``level`` inside the array; at level 2 the array is the value of one of the keys."""
    in_string, depth, is_open = state
    out: list[tuple[str, bool, bool]] = []
    begin, fresh, last_string = 0, False, None  # of the element that is being read

    def close(end: int) -> None:
        if text[begin:end].strip() or not fresh:
            out.append((text[begin:end], fresh, True))

    for a, z, c, whole in _tokens(text, in_string):
        if c == '"':
            last_string = (text[a + 1 : z - 1], z) if whole and a >= 0 else None
        elif c in "[{":
            depth += 1
            if c == "[" and depth == level and not is_open and (level == 1 or (last_string and last_string[0] in keys and _KEY.fullmatch(text, last_string[1], a))):
                is_open, begin, fresh = True, z, True
        elif c in "]}":
            depth -= 1
            if is_open and depth == level - 1:
                close(a)
                is_open = False
        elif is_open and depth == level:
            close(a)
            begin, fresh = z, True
    if is_open and (text[begin:].strip() or not fresh):
        out.append((text[begin:], fresh, False))
    return out, is_open


def _chained(effects: list, firsts: dict[str, str], keys: tuple[str, ...]) -> dict[tuple[str, int], tuple[bool, int]]:
    """Entry (inside a string, depth) of each split, in the order of the file."""
    entry: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    for r in effects:
        if r["file"] != file:
            file, inside, depth = r["file"], False, 0
        entry[r["file"], r["start"]] = (inside, depth)
        now = r["within" if inside else "outside"]
        inside, depth = now["inside"], depth + now["depth"]
    return entry


_EFFECT = "struct<inside:boolean,depth:int>"


def read_json_array(spark: SparkSession, path: str, item: T.StructType, keys: tuple[str, ...] = ("tickets", "data"), strict: bool = True) -> DataFrame:
    """(file, split, pos, item.*) of all elements, in order by the first three."""
    bounded_batches(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, text in _splits(batches):
            both = [dict(zip(("inside", "depth"), effect(text, s), strict=True)) for s in (False, True)]
            kind = pa.struct([("inside", pa.bool_()), ("depth", pa.int32())])
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start], pa.int64()), pa.array([text.lstrip("﻿ \t\r\n")[:1]]), pa.array(both[:1], kind), pa.array(both[1:], kind)], ["file", "start", "first", "outside", "within"])

    found = pieces.mapInArrow(effects, f"file string, start long, first string, outside {_EFFECT}, within {_EFFECT}").orderBy("file", "start").collect()  # a row for each split
    firsts: dict[str, str] = {}
    for r in found:
        firsts.setdefault(r["file"], r["first"])
    entry = _chained(found, firsts, keys)
    level = {f: 1 if c == "[" else 2 for f, c in firsts.items()}

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, text in _splits(batches):
            ends = [cut(text, (*entry[file, start], was), level[file], keys)[1] for was in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start], pa.int64()), pa.array(ends[:1]), pa.array(ends[1:]), pa.array([bool(cut(text, (*entry[file, start], False), level[file], keys)[0])])], ["file", "start", "closed", "open", "any"])

    states = pieces.mapInArrow(opened, "file string, start long, closed boolean, open boolean, any boolean").orderBy("file", "start").collect()
    full: dict[tuple[str, int], State] = {}
    file, is_open, with_items = None, False, set()
    for r in states:
        is_open = is_open and r["file"] == file
        file = r["file"]
        full[file, r["start"]] = (*entry[file, r["start"]], is_open)
        if is_open or r["any"] or r["closed"]:
            with_items.add(file)
        is_open = r["open" if is_open else "closed"]
    # an empty array is a list too: its opening bracket was met, or nothing but it
    lacking = sorted(f for f, c in firsts.items() if f not in with_items and not (c == "[") and not _holds_empty(spark, f, keys))
    if strict and lacking:
        raise ValueError(f"no list of items in {lacking[0]}")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, text in _splits(batches):
            fragments, _ = cut(text, full[file, start], level[file], keys)
            for at in range(0, len(fragments), 1000):
                part = fragments[at : at + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(part)), pa.array([start] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int64()), pa.array([p[0] for p in part]), pa.array([p[1] for p in part]), pa.array([p[2] for p in part])],
                    ["file", "split", "pos", "text", "begins", "ends"],
                )

    cuts = written(pieces.mapInArrow(elements, "file string, split long, pos long, text string, begins boolean, ends boolean"), "json-elements")
    whole = cuts.filter("begins and ends").select("file", "split", "pos", "text")
    # what reaches over splits goes to the split and place where it begins; at most two rows a split
    rest = cuts.filter("not (begins and ends)")
    begun = {(r["file"], r["split"]): r["pos"] for r in rest.filter("begins").select("file", "split", "pos").collect()}
    owners, last = [], None
    for file, start in full:  # in the order of files and splits
        owners.append((file, start, False, *(last[1:] if last and last[0] == file else (None, None))))
        if (file, start) in begun:
            last = (file, start, begun[file, start])
            owners.append((file, start, True, start, begun[file, start]))
    known = spark.createDataFrame(owners, "file string, split long, begins boolean, owner long, owner_pos long")
    owned = rest.join(known, ["file", "split", "begins"])
    stitched = owned.groupBy("file", F.col("owner").alias("split"), F.col("owner_pos").alias("pos")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("split").alias("s"), "text"))), lambda x: x["text"]), "").alias("text"))
    return whole.unionByName(stitched).select("file", "split", "pos", F.from_json("text", item).alias("item")).select("file", "split", "pos", "item.*")


def _holds_empty(spark: SparkSession, file: str, keys: tuple[str, ...]) -> bool:
    """Whether a file without elements has an empty array under one of the keys; such files are small."""
    schema = T.StructType([T.StructField(k, T.ArrayType(T.StringType())) for k in keys])
    row = spark.read.option("wholetext", True).text(file).select(F.from_json("value", schema).alias("v")).first()
    return row is not None and row["v"] is not None and any(row["v"][k] is not None for k in keys)
