"""Best-fit packing of documents into sequences, with swap-based local search.

Documents become pieces of at most ``capacity`` tokens (only longer documents are cut). Full pieces
are sequences of their own. The others are dealt at random into buckets of about ``bucket / 4``
sequences' tokens (of at most ``32 * bucket`` pieces); each bucket is packed by best fit, and then
local search works on its underfull bins: a piece moves, or one or two pieces change places with a
smaller one of a fuller bin, whenever that raises the sum of squared fills, until the lower bound is
met or no underfull bin has such a step. No task ever holds more than a bucket's lengths.

Cases: null text is an empty document (its end id alone); repeated rows and null ids are packed as
they come; very long texts give many pieces; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.tokens import encoder, vocabulary
from ticketloom.session import bounded_batches, table, written


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the open bin with the least room that is enough."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set where a bin has room r
    for i in order:
        fits = rooms >> lengths[i]
        if fits:
            room = lengths[i] + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            at, room = len(bins), capacity
            bins.append([i])
        left = room - lengths[i]
        if left:
            by_room.setdefault(left, []).append(at)
            rooms |= 1 << left
    return bins


class LocalSearch:
    """Empties the least filled bins into the others. The pieces of underfull bins are held in order
    of length, with the room and the fill of their bins beside them; full bins never change."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity = capacity
        self.lengths = lengths
        self.bins = [set(b) for b in bins]
        self.fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
        self._index()

    def _index(self) -> None:
        under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity)).tolist()
        order = sorted((self.lengths[i], i, b) for b in under for i in self.bins[b])
        self.sizes = np.array([n for n, _, _ in order], np.int64)
        self.pieces = [i for _, i, _ in order]
        self.place = {i: k for k, i in enumerate(self.pieces)}
        self.home = np.array([b for _, _, b in order], np.int64)
        self.home_fill = self.fill[self.home]
        self.under = np.array(under, np.int64)
        self.most_room = self.capacity - int(self.fill[self.under].min()) if under else 0

    def _put(self, source: int, target: int, out: list[int], back: list[int]) -> None:
        self.bins[source].difference_update(out)
        self.bins[source].update(back)
        self.bins[target].difference_update(back)
        self.bins[target].update(out)
        change = sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in back)
        self.fill[source] -= change
        self.fill[target] += change
        self.most_room = max(self.most_room, self.capacity - int(self.fill[source]))
        for b in (source, target):
            at = [self.place[i] for i in self.bins[b]]
            self.home[at] = b
            self.home_fill[at] = self.fill[b]

    def _give(self, source: int, out: list[int]) -> bool:
        """Move ``out`` into a fuller bin, or change it for the one piece there that fills it most.
        Squared fill rises by 2 * gain * (fill of target - fill of source + gain)."""
        size, own = sum(self.lengths[i] for i in out), int(self.fill[source])
        best, target, back = 0, -1, []
        fills = self.fill[self.under]
        fits = (fills > 0) & (fills <= self.capacity - size) & (self.under != source)
        if fits.any():
            k = int(np.argmax(np.where(fits, fills, -1)))
            best, target = size * (int(fills[k]) - own + size), int(self.under[k])
        lo, hi = np.searchsorted(self.sizes, [size - self.most_room, size])
        gain, fills = size - self.sizes[lo:hi], self.home_fill[lo:hi]
        rise = np.where((gain <= self.capacity - fills) & (self.home[lo:hi] != source), gain * (fills - own + gain), 0)
        k = int(np.argmax(rise)) if len(rise) else -1
        if k >= 0 and rise[k] > best:
            best, target, back = int(rise[k]), int(self.home[lo + k]), [self.pieces[lo + k]]
        if best <= 0:
            return False
        self._put(source, target, out, back)
        return True

    def _empty(self, source: int) -> bool:
        """Every step that helps, singles first, then pairs; False if there is none."""
        any_moved, moved = False, True
        while moved and self.bins[source]:
            moved, tried = False, set()
            for x in sorted(self.bins[source], key=lambda i: (-self.lengths[i], i)):
                if self.lengths[x] not in tried and self._give(source, [x]):
                    moved = True
                tried.add(self.lengths[x])
            if not moved:
                tried, items = set(), sorted(self.bins[source], key=lambda i: (self.lengths[i], i))
                for a, b in combinations(items, 2):
                    size = self.lengths[a] + self.lengths[b]
                    if size not in tried and self._give(source, [a, b]):
                        moved = True
                        break
                    tried.add(size)
            any_moved |= moved
        return any_moved

    def run(self) -> list[list[int]]:
        least, moved = -(-int(self.fill.sum()) // self.capacity), True
        used = int((self.fill > 0).sum())
        while moved and used > least:  # the sum of squared fills rises with every step, so this ends
            moved = False
            self._index()
            for source in self.under[np.argsort(self.fill[self.under], kind="stable")].tolist():
                if 0 < self.fill[source] < self.capacity and self._empty(source):
                    moved = True
                    used -= not self.bins[source]
                    if used <= least:
                        break
        return [sorted(b, key=lambda i: (self.lengths[i], i)) for b in self.bins if b]


def _pieces(path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, serial = encoder(path), 0
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), spell.ids([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    serial += 1
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), serial))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "serial"])

    return run


def _packed(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("serial", "ascending")])
        lengths = group["length"].to_pylist()
        bins = LocalSearch(best_fit(lengths, capacity), lengths, capacity).run()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        first = group["bucket"][0].as_py() << 32
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                sequence[i], offset[i] = first + k, at
                at += lengths[i]
        out = group.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1, capacity: int = 4096, bucket: int = 8192
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, serial long"
    pieces = written(source.mapInArrow(_pieces(tokenizer or vocabulary("word_bpe_49k.json"), end_id, capacity), schema), "pack-pieces")
    part = pieces.filter(F.col("length") < capacity)
    n_pieces, n_tokens = part.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    buckets = max(1, -(-n_tokens // -(-bucket * capacity // 4)), -(-n_pieces // (32 * bucket)))
    dealt = part.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "serial"), F.lit(buckets)))
    packed = dealt.groupBy("bucket").applyInArrow(_packed(capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    full = pieces.filter(F.col("length") >= capacity).drop("serial").withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return full.unionByName(packed)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the pieces of all documents and their places."""
    return pack_documents(docs)
