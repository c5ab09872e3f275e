"""Repeated-passage removal by suffix automata over reference shards.

A window is ``width`` consecutive words. A word goes if a window that covers it also starts in a
document with a smaller id; windows are judged on the input.

1. Each window has an anchor: the ``gram``-word run in it with the least hash (long runs are seldom
   shared by chance). Equal windows have equal anchors at equal places, so only anchors that occur in
   several documents matter: one aggregation with map-side combine, kept as a bitmap of bounded size.
2. Texts stream past the bitmap and give up their repeated passages: for each anchor that it passes,
   the stretch of windows that share it (at most ``2 * width - gram`` words).
3. Each distinct passage, with the smallest document that has it, goes to a reference shard by its
   anchor; a shard holds about ``shard_words`` words, however large the corpus is. An anchor with more than an
   eighth of a shard to itself is dealt window by window instead, equal windows combined before. A task builds the suffix
   automata of its shard, one for each anchor, documents in ascending order, so that each state knows the smallest document
   that contains it; every passage of the shard is streamed through as it is added, and the state of
   each of its windows gives the smallest document in which it starts.
4. A document loses the words under those of its windows that start in a smaller one.

The automata are not broadcast: the number of shards grows with the repeated part of the corpus, and a
broadcast of one after another to all documents would cost their product. A passage meets the one
shard that can hold its windows instead, so the work is linear.

Cases: null text has no words; fewer than ``width`` words lose nothing; rows with the same id count
as the same document and do not remove each other's words; a null id neither removes nor loses
anything; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.words import hashed_words, mix, only, rolling, runs, signed, text_bytes
from ticketloom.session import IdFilter, bounded_batches, release, table, written


class SuffixAutomaton:
    """Of several word sequences, added in ascending order of their document."""

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def add(self, words: Sequence[Hashable], doc: int, width: int | None = None) -> list[int]:
        """Online construction; a word that is there already is followed, so sequences share states. A clone
        is made where a state holds longer contexts than the one that is needed.

        With ``width``: for each window of so many words the smallest document in which it occurs. Documents come
        in ascending order, so that is known as soon as the window has been added."""
        next_, link, length, first = self.next, self.link, self.length, self.first
        last, out, end = 0, [], len(words) if width is None else width - 1
        for i, c in enumerate(words):
            if i > end:  # the window that the word before has ended
                state = last
                while length[link[state]] >= width:
                    state = link[state]
                out.append(first[state])
            p, q = last, next_[last].get(c)
            if q is None:
                new = len(length)
                next_.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(doc)
                while q is None:
                    next_[p][c] = new
                    p = link[p]
                    if p < 0:
                        break
                    q = next_[p].get(c)
                last = new
                if p < 0:
                    continue
            else:
                new = -1
            if length[p] + 1 < length[q]:
                clone = len(length)
                next_.append(next_[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(first[q])
                link[q] = clone
                while p >= 0 and next_[p].get(c) == q:
                    next_[p][c] = clone
                    p = link[p]
                q = clone
            if new < 0:
                last = q
            else:
                link[new] = q
        if width is not None and len(words) >= width:
            state = last
            while length[link[state]] >= width:
                state = link[state]
            out.append(first[state])
        return out

    def earliest(self, words: Sequence[Hashable], width: int) -> list[int | None]:
        """For each width-word window, the smallest document in which it occurs, None if there is none.
        The matching length is kept at width at most, so the state is that of the window itself."""
        next_, link, length, first = self.next, self.link, self.length, self.first
        state, size, out = 0, 0, []
        for i, c in enumerate(words):
            while state and c not in next_[state]:
                state = link[state]
                size = length[state]
            to = next_[state].get(c)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            if size >= width:
                size = width
                while length[link[state]] >= width:
                    state = link[state]
            if i >= width - 1:
                out.append(first[state] if size == width else None)
        return out


def anchors(sizes: list[int], hashes: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of several texts of ``sizes`` words, one after another: (text, anchor hash, first window, number of
    windows) for each stretch of windows whose least ``gram``-word run is the same. Stretches have at most
    width - gram + 1 windows; longer ones, of a repeated run, are cut."""
    reach = width - gram + 1
    least = rolling(hashes, gram)
    none = np.zeros(0, np.int64)
    if len(least) < reach:
        return none, none.view(np.uint64), none, none
    have = 1  # the least of 1, 2, 4 ... neighbours
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + width <= ends[text])  # those that stay in their text
    if not len(windows):
        return none, none.view(np.uint64), none, none
    value = least[windows]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (windows[1:] != windows[:-1] + 1)])
    begin = np.flatnonzero(new)
    in_run = np.arange(len(windows)) - np.repeat(begin, np.diff(np.append(begin, len(windows))))
    at = np.flatnonzero(in_run % reach == 0)
    return text[windows[at]], value[at], windows[at], np.diff(np.append(at, len(windows)))


def _row_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _anchors(width: int, gram: int):
    """(text) -> one row for each distinct anchor of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in batches:
            sizes, _, _, _, hashes = hashed_words([t or b"" for t in text_bytes(batch.column(0))])
            text, anchor, _, _ = anchors(sizes, hashes, width, gram)
            _, once = np.unique(mix(anchor ^ mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(anchor[once]))], ["anchor"])

    return run


_STRETCH = "anchor long, print long, doc_id long, row_key long, start int, n int, part binary"


def _stretches(shared: IdFilter, width: int, gram: int, seen_most: int = 200_000):
    """(doc_id, text) -> the stretches of the anchors that the filter passes: fingerprint, place, and the
    words themselves, which are left out where this task has given them before. Equal stretches have equal
    anchors, so a stretch is known by its anchor and fingerprint, 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        seen: set[int] = set()
        for batch in batches:
            texts = [t or b"" for t in text_bytes(batch.column(1))]
            sizes, joined, begins, ends, hashes = hashed_words(texts)
            text, anchor, first, n = anchors(sizes, hashes, width, gram)
            at = np.flatnonzero(shared.has_hash(signed(anchor)))
            text, last = text[at], first[at] + n[at] + width - 2
            prints, parts = signed(runs(hashes, first[at], n[at] + width - 1)).tolist(), []
            for mark, a, z in zip(prints, begins[first[at]].tolist(), ends[last].tolist(), strict=True):
                if mark in seen:
                    parts.append(None)
                else:
                    seen.add(mark)
                    parts.append(b" ".join(joined[a:z].split()))
            owner = pa.array(text)
            keys = pa.array([_row_key(t) for t in texts], pa.int64())
            start = first[at] - (np.cumsum([0, *sizes])[:-1])[text]
            columns = [pa.array(signed(anchor[at])), pa.array(prints, pa.int64()), batch.column(0).take(owner), keys.take(owner), pa.array(start.astype(np.int32)), pa.array(n[at].astype(np.int32)), pa.array(parts, pa.binary())]
            if len(seen) > seen_most:
                seen.clear()
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _STRETCH.split(", ")])

    return run


_FIRSTS = "anchor long, print long, at int, firsts array<long>"


def _through_automaton(width: int):
    """The passages of a shard -> for each of their windows the smallest document that has it."""

    def run(group: pa.Table) -> pa.Table:
        docs, keys, parts = group["doc_id"].to_pylist(), group["anchor"].to_pylist(), group["part"].to_pylist()
        found: list = [None] * len(docs)
        gc.disable()  # an automaton is many small tables without reference cycles
        try:
            anchor, automaton = None, SuffixAutomaton()
            for i in np.lexsort((group["doc_id"].to_numpy(), group["anchor"].to_numpy())).tolist():
                if keys[i] != anchor:  # equal windows have equal anchors
                    anchor, automaton = keys[i], SuffixAutomaton()
                found[i] = automaton.add(parts[i].split(b" "), docs[i], width)
            firsts = pa.array(found, pa.list_(pa.int64()))
        finally:
            gc.enable()
        return group.select(["anchor", "print", "at"]).append_column("firsts", firsts)

    return run


def _counted(words: list[bytes]) -> tuple[int, str]:
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def _untouched(touched: IdFilter):
    """(doc_id, text, slot) -> what is left of the rows that the filter does not pass: all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~touched.has(batch.column(2).to_numpy())))
            rows = [_counted((t or b"").split()) for t in text_bytes(batch.column(1))]
            n = len(rows)
            columns = [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * n, pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def _touched_rows(touched: IdFilter):
    """(doc_id, text, slot) -> rows that the filter passes, with their row key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(touched.has(batch.column(2).to_numpy())))
            keys = [_row_key(t or b"") for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), batch.column(1)], ["doc_id", "row_key", "text"])

    return run


def _remaining(width: int):
    """(doc_id, text, spans) -> what is left of each row; spans of windows, null if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, spans in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                if not spans:
                    n, sha = _counted(words)
                    rows.append((n, 0, sha, None))
                    continue
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, [s["start"] for s in spans], 1)
                np.add.at(step, [s["start"] + s["n"] + width - 1 for s in spans], -1)
                out = np.cumsum(step[:-1]) > 0
                kept = b" ".join(w for w, x in zip(words, out.tolist(), strict=True) if not x)
                rows.append((len(words), int(out.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def first_documents(stretches: DataFrame, width: int, shard_words: int) -> DataFrame:
    """(anchor, print, at, firsts) for each distinct stretch: the smallest document that has the window,
    for the windows from ``at`` on."""
    passages = written(stretches.groupBy("anchor", "print").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("part", ignorenulls=True).alias("part")), "repeat-passages")
    words = F.sum(F.col("n") + width - 1)
    shards = max(1, -(-(passages.agg(words).first()[0] or 0) // shard_words))
    crowded = written(passages.groupBy("anchor").agg(words.alias("words")).filter(F.col("words") > shard_words // 8).select("anchor", F.lit(True).alias("hot")), "repeat-hot")
    marked = passages.join(crowded, "anchor", "left")
    whole = marked.filter("hot is null").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "print", F.lit(0).alias("at"), "doc_id", "part")
    single = marked.filter("hot").select("anchor", "print", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"), "doc_id", F.split(F.decode("part", "ISO-8859-1"), " ").alias("words"))
    single = single.withColumn("part", F.encode(F.array_join(F.slice("words", F.col("at") + 1, width), " "), "ISO-8859-1"))
    window = [F.xxhash64("part").alias("window"), F.xxhash64(F.lit(1), "part").alias("again")]
    single = written(single.select("anchor", "print", "at", "doc_id", "part", *window), "repeat-single")
    # equal windows are combined before they are dealt, so a window with many surroundings is one row of its shard
    combined = single.groupBy("window", "again").agg(F.min("doc_id").alias("doc_id"), F.first("part").alias("part"))
    combined = combined.select(F.pmod("window", F.lit(shards)).alias("shard"), F.col("window").alias("anchor"), F.col("again").alias("print"), F.lit(-1).alias("at"), "doc_id", "part")
    through = written(whole.unionByName(combined).groupBy("shard").applyInArrow(_through_automaton(width), _FIRSTS), "repeat-through")
    of_window = through.filter("at < 0").select(F.col("anchor").alias("window"), F.col("print").alias("again"), "firsts")
    placed = single.join(of_window, ["window", "again"]).select("anchor", "print", "at", "firsts")
    firsts = written(through.filter("at >= 0").unionByName(placed), "repeat-firsts")
    release(single, through)
    release(passages, crowded)
    return firsts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, gram: int = 7, shard_words: int = 1 << 17) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for every row of docs; kept_text (words
    joined by one space) is null where nothing was removed."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = source.filter("doc_id is not null")
    places = named.select("text").mapInArrow(_anchors(width, gram), "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    shared = written(places.filter("n > 1").select("anchor"), "repeat-anchors")
    found = IdFilter.of(shared, "anchor", shared.count(), hashed=True)
    stretches = written(named.mapInArrow(_stretches(found, width, gram), _STRETCH), "repeat-stretches")
    firsts = first_documents(stretches, width, shard_words)

    # windows of a document that start in a smaller one, as (first window, number of windows)
    met = stretches.drop("part", "n").join(firsts, ["anchor", "print"]).filter(F.array_min("firsts") < F.col("doc_id"))
    begin = F.col("start") + F.col("at")
    each = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.struct((begin + i).alias("start"), F.lit(1).alias("n")))), lambda x: x.isNotNull())
    spans = F.when(F.array_max("firsts") < F.col("doc_id"), F.array(F.struct(begin.alias("start"), F.size("firsts").alias("n")))).otherwise(each)
    gone = written(met.select("doc_id", "row_key", spans.alias("spans")).groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("spans")).alias("spans")), "repeat-spans")

    release(shared, stretches, firsts)
    touched = IdFilter.of(gone, "doc_id", gone.count())
    rows = source.select("doc_id", "text", touched.slot("doc_id").alias("slot"))
    reduced = rows.mapInArrow(_touched_rows(touched), "doc_id long, row_key long, text string").join(gone, ["doc_id", "row_key"], "left")
    return rows.mapInArrow(_untouched(touched), _KEPT).unionByName(reduced.select("doc_id", "text", "spans").mapInArrow(_remaining(width), _KEPT))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


#: The contract, stated over windows as texts.
OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), win AS (
  SELECT doc_id, k, array_to_string(list_slice(words, k, k + 12), ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS k FROM w)
), firsts AS (
  SELECT doc_id, k, min(doc_id) OVER (PARTITION BY run) AS first_doc FROM win
), hit AS (
  SELECT DISTINCT doc_id, k + unnest(range(0, 13)) AS place FROM firsts WHERE first_doc < doc_id
), gone AS (
  SELECT doc_id, list(place) AS places FROM hit GROUP BY doc_id
), left_over AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END AS kept
  FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over
"""
