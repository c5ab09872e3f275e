"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after numbers and names (capitalised words inside a
sentence) are replaced by typed placeholders, whose values are kept as slots; other words are
lower-cased and stripped of punctuation. Four kinds of windows are looked up: from each token the
shortest template window of ``width`` tokens or more with ``literals`` words of its own; ``width`` raw
words (verbatim copies, however many slots); items shorter than ``width`` as raw words; and items
dense in slots (or short) as one template of ``least`` literals or more, also without a capitalised
first word, which may be a name. The tasks drop windows that no benchmark item has
(a sorted array of the benchmark's window hashes, sent in blocks of at most ``block`` hashes = 8 *
block bytes), the rest are hash-joined with the benchmark's windows.

Windows that many items share would join documents with all of those items. So candidates come from each
item's rarest windows: as many as it takes for the others to cover less than ``coverage`` of it, for then
no match can do without one of them. Only pairs of a document and a candidate meet all windows.

Matched windows are grouped by occurrence: the place in the document where the item would start. A
document matches an item if in any occurrence the matched windows cover ``coverage`` of the item's
tokens and either those with equal slot values do so alone (a copy), or the slots are consistent: each
item value stands for one document value and the other way round (else a re-parameterised question).
An occurrence is one such place, the windows nearest to it (words were put in or left out), or all
windows of the document (the item is in pieces).

Cases: null and empty texts match nothing; items shorter than ``width`` are one window; items with
fewer than ``least`` literals are found as verbatim copies only; repeated rows match together; a
null doc_id or item_id is dropped; very long texts are read whole, one at a time; empty tables give an
empty result; other columns are ignored. The pipeline stage goes by texts, so null and repeated ids are
judged like others, each row by its own text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.words import REMEMBERED, WordHashes, mix, only, signed
from ticketloom.session import bounded_batches, release, table, written

_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‚‘’¡¿…"
_ENDS = (".", "!", "?", ":", ";", ".\"", ".”")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
_MEASURE = re.compile(r"([+-]?\d[\d.,]*)([^\W\d_]+|%|°[CF]?)")

#: Units that become a placeholder after a number.
UNITS = frozenset(
    "mm cm m km inch inches ft feet mi mile miles g mg kg lb lbs oz t ton tons ml l litre litres liter liters s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent % degrees mph kmh kg. km. stunden tage jahre heures jours ans horas días años".split()
)

NUMBER, UNIT, NAME = (np.uint64(xxhash.xxh3_64_intdigest(x)) & ~np.uint64(15) for x in (b"<number>", b"<unit>", b"<name>"))
_IS_NUMBER, _IS_UNIT, _IS_CAPITAL, _ENDS_SENTENCE = 1, 2, 4, 8


class TemplateWords(WordHashes):
    """raw word -> 60-bit hash of its canonical form, with four flags in the low bits; 0: no word."""

    def __missing__(self, raw: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        word = raw.strip(_EDGE)
        flags = _ENDS_SENTENCE if raw.endswith(_ENDS) else 0
        if not word:
            value = 0
        else:
            if _NUMBER.fullmatch(word) or _MEASURE.fullmatch(word):
                flags |= _IS_NUMBER
            elif word.lower() in UNITS:
                flags |= _IS_UNIT
            elif word[0].isupper():
                flags |= _IS_CAPITAL
            value = xxhash.xxh3_64_intdigest(word.lower().encode()) & ~15 | flags
        self[raw] = value
        return value


_WORDS = TemplateWords()
REMEMBERED.append(_WORDS)


def template(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(token hashes, hashes of the words themselves, slot kind of each token, words): kind 0 is literal."""
    words = text.split()
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if not codes.all():
        keep = codes != 0
        codes, words = codes[keep], [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    flags = (codes & np.uint64(15)).astype(np.uint8)
    number = flags & _IS_NUMBER > 0
    starts = np.concatenate([[True], flags[:-1] & _ENDS_SENTENCE > 0])[: len(flags)]
    kinds = np.zeros(len(flags), np.uint8)
    kinds[flags & _IS_CAPITAL > 0] = 3
    kinds[starts] = 0
    kinds[(flags & _IS_UNIT > 0) & np.concatenate([[False], number[:-1]])[: len(flags)]] = 2
    kinds[number] = 1
    tokens = np.array([0, NUMBER, UNIT, NAME], np.uint64)[kinds]
    raw = codes & ~np.uint64(15)
    return np.where(kinds == 0, raw, tokens), raw, kinds, words


_P = 0x9E3779B97F4A7C15
_HEAD = 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Runs:
    """Hashes of runs of any length in one text, each in constant time."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        self.up = _powers(_P, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * _powers(pow(_P, -1, 1 << 64), n), dtype=np.uint64, out=self.sums[1:])

    def hashes(self, at: np.ndarray, widths: np.ndarray | int) -> np.ndarray:
        ends = at + widths
        return signed(mix((self.sums[ends] - self.sums[at]) * self.up[ends - 1]))


def windows(kinds: np.ndarray, width: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, width) of the shortest window of ``width`` tokens or more with enough literal tokens from each token."""
    n = len(kinds)
    sums = np.concatenate([[0], np.cumsum(kinds == 0)])
    at = np.arange(max(0, n - width + 1))
    ends = np.maximum(at + width, np.searchsorted(sums, sums[at] + literals))
    fits = ends <= n
    return at[fits], (ends - at)[fits]


def _slotted(kinds: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows of ``width`` tokens that have a slot."""
    sums = np.concatenate([[0], np.cumsum(kinds > 0)])
    return np.flatnonzero(sums[width:] > sums[:-width])


def _slots(kinds: np.ndarray, words: list[str], start: int, width: int) -> list[str]:
    return [f"{k}:{words[start + i].strip(_EDGE).lower()}" for i, k in enumerate(kinds[start : start + width].tolist()) if k]


_FOUND = pa.schema(
    [("row", pa.int64()), ("hash", pa.int64()), ("start", pa.int32()), ("width", pa.int32()), ("n_tokens", pa.int32()), ("raw", pa.bool_()), ("head", pa.int64()), ("slots", pa.list_(pa.string()))]
)
_FOUND_DDL = "row long, hash long, start int, width int, n_tokens int, raw boolean, head long, slots array<string>"


def _item_windows(tokens: np.ndarray, raw: np.ndarray, kinds: np.ndarray, capital: bool, width: int, literals: int, least: int) -> list[tuple]:
    """(hash, start, width, is raw, hash of its first tokens if it is a whole item) of the windows of an item."""
    n = len(tokens)
    runs, raw_runs = Runs(tokens), Runs(raw)
    if n < width:
        whole, out = True, [(int(raw_runs.hashes(np.array([0]), n)[0]), 0, n, True, None)]
    else:
        at, widths = windows(kinds, width, literals)
        whole = len(at) < n - width + 1 or bool((widths > width).any())
        out = [(h, a, w, False, None) for h, a, w in zip(runs.hashes(at, widths).tolist(), at.tolist(), widths.tolist(), strict=True)]
        at = _slotted(kinds, width)
        out += [(h, a, width, True, None) for h, a in zip(raw_runs.hashes(at, width).tolist(), at.tolist(), strict=True)]
    for start in (0, 1) if whole and capital else (0,) if whole else ():
        if (kinds[start:] == 0).sum() >= least and kinds.any():
            at = np.array([start])
            out.append((int(runs.hashes(at, n - start)[0]), start, n - start, False, int(runs.hashes(at, _HEAD)[0])))
    return out


def _items(width: int, literals: int, least: int):
    """All windows of (id, text) rows of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(_WORDS)
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if row is None or not text:
                    continue
                tokens, raw, kinds, words = template(text)
                if len(tokens):
                    capital = kinds[0] == 0 and words[0].strip(_EDGE)[0].isupper()
                    found = _item_windows(tokens, raw, kinds, capital, width, literals, least)
                    out += [(row, h, a, w, len(tokens), r, head, _slots(kinds, words, a, w)) for h, a, w, r, head in found]
            yield _batch(out)

    return run


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [[]] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _is_in(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _found(width: int, literals: int, short: list[int], whole: list[int], known: np.ndarray, heads: np.ndarray):
    """The known windows of (id, text) rows. short, whole: widths of short items and of whole items;
    heads: hashes of the first tokens of whole items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(_WORDS)
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if row is None or not text:
                    continue
                tokens, raw, kinds, words = template(text)
                n = len(tokens)
                if not n:
                    continue
                runs, raw_runs = Runs(tokens), Runs(raw)
                tries: list[tuple] = []
                if n >= width:
                    tries = [(False, runs, *windows(kinds, width, literals)), (True, raw_runs, _slotted(kinds, width), width)]
                tries += [(True, raw_runs, np.arange(n - w + 1), w) for w in short if w <= n]
                if len(heads) and n >= _HEAD:
                    at = np.arange(n - _HEAD + 1)
                    at = at[_is_in(heads, runs.hashes(at, _HEAD))]
                    tries += [(False, runs, at[at + w <= n], w) for w in whole if len(at)]
                for is_raw, of, at, widths in tries:
                    hashes = of.hashes(at, widths)
                    hit = _is_in(known, hashes)
                    if hit.any():
                        widths = np.broadcast_to(widths, at.shape)[hit].tolist()
                        out += [(row, h, a, w, n, is_raw, None, _slots(kinds, words, a, w)) for h, a, w in zip(hashes[hit].tolist(), at[hit].tolist(), widths, strict=True)]
            yield _batch(out)

    return run


def _rarest(coverage: float):
    """The windows (hash, start, width, n_tokens, n_items) of one item -> the rarest of them, as many as
    it takes for the others to cover too little of the item."""

    def run(group: pa.Table) -> pa.Table:
        enough = coverage * max(group["n_tokens"].to_pylist()) - 1e-9
        rows = sorted(zip(group["n_items"].to_pylist(), group["hash"].to_pylist(), group["width"].to_pylist(), group["start"].to_pylist(), strict=True))
        # windows of one hash are found together; the shortest such beginning of the list, by bisection
        ends = [k for k in range(1, len(rows) + 1) if k == len(rows) or rows[k][:3] != rows[k - 1][:3]]
        lo, hi = 0, len(ends) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            if _covered([(0, r[3], r[2]) for r in rows[ends[mid] :]]) < enough:
                hi = mid
            else:
                lo = mid + 1
        kept = sorted({r[1:3] for r in rows[: ends[lo]]})
        return pa.table({"item": pa.array([group["row"][0].as_py()] * len(kept), pa.int64()), "hash": pa.array([k[0] for k in kept], pa.int64()), "width": pa.array([k[1] for k in kept], pa.int32())})

    return run


_LEAK_DDL = "doc_id long, item_id long, coverage double, reparameterised boolean"


def _covered(hits: list[tuple]) -> int:
    """Item tokens that are in a window; hits are (own start, start, width, pairs)."""
    last = n = 0
    for start, end in sorted((h[1], h[1] + h[2]) for h in hits):
        n += max(0, end - max(start, last))
        last = max(last, end)
    return n


def _fits(hits: list[tuple], enough: float) -> tuple[bool, int] | None:
    """(re-parameterised, covered tokens) of one occurrence, None if it does not match."""
    n = _covered(hits)
    if n < enough:
        return None
    pairs = {p for h in hits for p in h[3]}
    changed = any(item != own for item, own in pairs)
    if not changed or len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs}):
        return changed, n
    return (True, n) if _covered([h for h in hits if all(item == own for item, own in h[3])]) >= enough else None


def occurrence(hits: list[tuple], n_tokens: int, coverage: float) -> tuple[bool, int] | None:
    """The best occurrence of an item among its hits in a document: copies first, then coverage."""
    enough, fits = coverage * n_tokens - 1e-9, []
    if _covered(hits) < enough:
        return None
    hits = sorted(hits, key=lambda h: h[0] - h[1])
    places = [h[0] - h[1] for h in hits]
    for place in sorted(set(places)):
        fits.append(_fits(hits[bisect_left(places, place) : bisect_right(places, place)], enough))
        nearest: dict[int, list[tuple]] = {}
        for h in sorted(hits[bisect_left(places, place - n_tokens // 2) : bisect_right(places, place + n_tokens // 2)], key=lambda h: abs(h[0] - h[1] - place)):
            same = nearest.setdefault(h[1], [])
            if not same or same[0][0] == h[0]:
                same.append(h)
        fits.append(_fits([h for same in nearest.values() for h in same], enough))
    fits.append(_fits(hits, enough))
    return min((f for f in fits if f), key=lambda f: (f[0], -f[1]), default=None)


def _judged(coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, item, n_tokens, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                best = occurrence([(h["own_start"], h["start"], h["width"], tuple(zip(h["item"], h["own"], strict=True))) for h in hits], n_tokens, coverage)
                if best:
                    rows.append((doc, item, best[1] / n_tokens, best[0]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "coverage", "reparameterised"])

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    width: int = 8,
    literals: int = 5,
    coverage: float = 0.6,
    block: int = 1 << 21,
    least: int = 3,
) -> DataFrame:
    """(doc_id, item_id, coverage, reparameterised) for every document and item that match."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    item_windows = written(items.mapInArrow(_items(width, literals, least), _FOUND_DDL), "leak-items")
    # at most ``width`` short widths, and as many whole ones as items have lengths
    short = [r["width"] for r in item_windows.filter(F.col("raw") & (F.col("width") < width)).select("width").distinct().collect()]
    blocks = -(-item_windows.select("hash").distinct().count() // block)
    parts = []
    for k in range(blocks):
        part = item_windows.filter(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == k)
        known = np.sort(part.select("hash").distinct().toArrow()["hash"].to_numpy())
        heads = np.sort(part.filter("head is not null").select("head").distinct().toArrow()["head"].to_numpy())
        whole = [r["width"] for r in part.filter("head is not null").select("width").distinct().collect()]
        if len(known):
            parts.append(written(source.mapInArrow(_found(width, literals, short, whole, known, heads), _FOUND_DDL), "leak-windows"))
    if not parts:
        return spark.createDataFrame([], _LEAK_DDL)
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    spread = item_windows.groupBy("hash", "width").agg(F.count_distinct("row").alias("n_items"))
    rare = item_windows.select("row", "hash", "start", "width", "n_tokens").join(spread, ["hash", "width"]).groupBy("row").applyInArrow(_rarest(coverage), "item long, hash long, width int")
    pairs = written(hits.join(rare, ["hash", "width"]).select(F.col("row").alias("doc"), "item").distinct(), "leak-pairs")
    # a pair takes the windows of its item along, at most an item's length; neither a document that holds the
    # whole benchmark nor a window that all items share makes more rows than pairs times windows
    b = item_windows.select(F.col("row").alias("item"), "hash", "width", "n_tokens", F.col("start").alias("item_start"), F.col("raw").alias("item_raw"), F.col("slots").alias("item_slots"))
    a = hits.select(F.col("row").alias("doc"), "hash", "width", "start", "raw", "slots")
    own = F.when(F.col("raw") | F.col("item_raw"), F.col("item_slots")).otherwise(F.col("slots"))
    hit = F.struct(F.col("start").alias("own_start"), F.col("item_start").alias("start"), "width", F.col("item_slots").alias("item"), own.alias("own"))
    met = pairs.join(b, "item").join(a, ["doc", "hash", "width"]).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_tokens", hit.alias("hit"))
    grouped = met.groupBy("doc_id", "item_id").agg(F.max("n_tokens").alias("n_tokens"), F.collect_set("hit").alias("hits"))
    found = written(grouped.mapInArrow(_judged(coverage), _LEAK_DDL), "leaks")
    release(item_windows, pairs, *parts)
    return found


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text holds a benchmark item go, whatever their id. Rows are told apart by
    a 64-bit hash of the text; rows of one text share its verdict, null texts stay."""
    keyed = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string")))
    found = contaminated(keyed.select("_text_hash", "text"), table(spark, sf_dir, "benchmark"), id_col="_text_hash")
    return keyed.join(found.select(F.col("doc_id").alias("_text_hash")).distinct(), "_text_hash", "left_anti").select(docs.columns)
