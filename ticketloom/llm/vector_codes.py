"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

Components are scaled to integers, so that everything is exact. A task deals its vectors into chunks. In
a chunk and for each part position, the parts are sorted along a Hilbert curve and stored as flat
blocks of ``block`` parts, with the box around each block (least and greatest components) and its sum.
Chunks are written once; each round reads them, never the vectors.

In a round, the distances of a block's box to all entries give its shortlist: entries whose least distance to
the box is not above the smallest greatest distance of any entry. No other entry can be nearest to a part in
the box, ties included. With one entry on the list the block's sum is all that is needed; else an
integer kernel evaluates the block against the list. A task returns sums and counts for each entry it used;
Spark adds them up, and the driver gets as many rows as there are entries. Vectors are never shuffled.

Cases: vectors that are null, empty, hold a null, NaN or infinite component, or one so large that a sum of
squares would not fit a long (2^19 at 64 dimensions), are left out; so are those whose size is not that of
the kept vector with the smallest id. A null id comes last among ids, and ids that repeat are ordered by
their vectors; each row gets its code. Fewer rows than entries make a smaller codebook. Labels may be
null, those are equal to each other. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StringType, StructField, StructType

from ticketloom.session import bounded_batches, release, table, written

#: Rows of a label table that is small enough for a broadcast.
_FEW_LABELS = 100_000


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (rows of integers below 2^bits) on a Hilbert curve, by Skilling's transform
    ("Programming the Hilbert curve", 2004) of coordinates into the bits of the index."""
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    zero = np.uint64(0)
    for level in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(x)):
            upper = (x[i] & q) != zero
            swap = np.where(upper, zero, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(upper, low, swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & np.uint64(1 << level)) != zero, np.uint64((1 << level) - 1), zero)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << np.uint64(1)) | (((axis ^ turn) >> np.uint64(level)) & np.uint64(1))
    return index


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Rows of integer points in the order of a Hilbert curve through the box around them. Of very many axes
    the first 62 count."""
    axes = points[:, :62]
    bits = max(1, min(8, 62 // axes.shape[1]))
    low = axes.min(axis=0)
    span = np.maximum(axes.max(axis=0) - low, 1)
    return np.argsort(hilbert_index((axes - low) * ((1 << bits) - 1) // span, bits), kind="stable")


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box (rows of low and high), which entries can be nearest to a point in it."""
    least, greatest = np.zeros((2, len(low), len(entries)), np.int64)
    for d in range(low.shape[1]):
        below, above = low[:, d, None] - entries[:, d], entries[:, d] - high[:, d, None]
        least += np.maximum(np.maximum(below, above), 0) ** 2
        greatest += np.minimum(below, above) ** 2  # both are minus the distance to a far side
    return least <= greatest.min(axis=1)[:, None]


def nearest(points: np.ndarray, candidates: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point among the candidates, indexes in ascending order; of equal
    distances the first."""
    listed = entries[candidates]
    squares = np.zeros((len(points), len(listed)), np.int64)
    for d in range(points.shape[1]):  # an axis at a time: short inner sums are slow
        apart = points[:, d, None] - listed[:, d]
        squares += apart * apart
    best = squares.argmin(axis=1)
    return candidates[best], squares[np.arange(len(points)), best]


def _struct(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


class _Chunk:
    """The blocks of one chunk, as stored: parts x n x width integers and parts x blocks x width boxes."""

    def __init__(self, row: dict, parts: int, width: int, block: int):
        self.n, self.block = row["n"], block
        self.points = np.frombuffer(row["points"], np.int32).reshape(parts, self.n, width).astype(np.int64)
        boxes = np.frombuffer(row["boxes"], np.int32).reshape(2, parts, -1, width).astype(np.int64)
        self.low, self.high = boxes
        self.sums = np.frombuffer(row["sums"], np.int64).reshape(parts, -1, width)

    def blocks(self, part: int, entries: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
        """(number, rows, shortlist) of each block of a part position."""
        lists = shortlists(self.low[part], self.high[part], entries)
        for k in range(len(lists)):
            yield k, slice(k * self.block, min(self.n, (k + 1) * self.block)), np.flatnonzero(lists[k])


def _built(parts: int, width: int, chunk: int, block: int, names: list[str]):
    def flat(vectors: np.ndarray) -> list[pa.Array]:
        n = len(vectors)
        by_part = vectors.reshape(n, parts, width).transpose(1, 0, 2)
        orders = [hilbert_order(p.astype(np.int64)) for p in by_part]
        points = np.stack([p[o] for p, o in zip(by_part, orders, strict=True)])
        starts = np.arange(0, n, block)
        boxes = np.stack([np.minimum.reduceat(points, starts, axis=1), np.maximum.reduceat(points, starts, axis=1)])
        sums = np.add.reduceat(points.astype(np.int64), starts, axis=1)
        return [pa.array([n], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (np.stack(orders).astype(np.int32), points, boxes, sums)]]

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        vectors = whole.column(2).chunk(0).flatten().to_numpy().astype(np.int32).reshape(-1, parts * width)
        listed = [pa.ListArray.from_arrays(np.array([0, len(vectors)], np.int32), whole.column(k).chunk(0)) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*listed, *flat(vectors)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while rows + len(batch) >= chunk:
                take = chunk - rows
                yield packed([*held, batch.slice(0, take)])
                batch, held, rows = batch.slice(take), [], 0
            if len(batch):
                held.append(batch)
                rows += len(batch)
        if held:
            yield packed(held)

    return run


def _summed(books: np.ndarray, block: int):
    parts, n_entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, n_entries), np.int64), np.zeros((parts, n_entries, width), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, parts, width, block)
                for p in range(parts):
                    for k, rows, listed in chunk.blocks(p, books[p]):
                        if len(listed) == 1:  # the whole block belongs to one entry
                            counts[p, listed[0]] += rows.stop - rows.start
                            sums[p, listed[0]] += chunk.sums[p, k]
                        else:
                            own = chunk.points[p, rows]
                            codes, _ = nearest(own, listed, books[p])
                            counts[p] += np.bincount(codes, minlength=n_entries)
                            np.add.at(sums[p], codes, own)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), *[pa.array(sums[p, e, d]) for d in range(width)]], ["part", "entry", "n", *[f"s{d}" for d in range(width)]])

    return run


def _coded(books: np.ndarray, block: int, names: list[str]):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.select(["n", "places", "points", "boxes", "sums"]).to_pylist()):
                chunk = _Chunk(row, parts, width, block)
                places = np.frombuffer(row["places"], np.int32).reshape(parts, chunk.n)
                codes, error = np.zeros((chunk.n, parts), np.uint8), np.zeros(chunk.n, np.int64)
                for p in range(parts):
                    for _, rows, listed in chunk.blocks(p, books[p]):
                        found, squares = nearest(chunk.points[p, rows], listed, books[p])
                        codes[places[p, rows], p] = found
                        error[places[p, rows]] += squares
                text = codes.tobytes().hex()
                step = 2 * parts
                own = [batch.column(c).slice(k, 1).flatten() for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([text[i : i + step] for i in range(0, len(text), step)]), pa.array(error)], names)

    return run


def compress_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, chunk: int = 1 << 15, block: int = 64
) -> tuple[DataFrame, list[list[list[int]]]]:
    """(rows, codebooks): rows (id, label, code, error) of every kept vector, code with two hex digits a part (so at
    most 256 entries); codebooks as parts x entries x components."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    source = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    id_type, label_type = (source.schema[c].dataType for c in ("id", "label"))
    out_type = _struct(id=id_type, label=label_type, code=StringType(), error=LongType())

    def kept(dim: int | None) -> DataFrame:
        """Vectors of dim components, or of any size that can be cut, as integers."""
        size = F.size("v")
        fits = (size == dim) if dim else (size > 0) & (size % parts == 0)
        # the largest components whose differences have a sum of squares that fits a long
        most = min(float(2**30), math.isqrt(2**61 // (dim or parts))) / scale
        good = F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < most, F.lit(False)))
        return source.filter(F.col("v").isNotNull() & fits).filter(good).withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("int")))

    first = kept(None).orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return spark.createDataFrame([], out_type), []
    dim = len(first[0]["v"])
    width, rows = dim // parts, kept(dim)
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not start:  # that one vector alone can be too large for its own size
        return spark.createDataFrame([], out_type), []
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    stored = _struct(ids=ArrayType(id_type), labels=ArrayType(label_type), n=IntegerType(), places=BinaryType(), points=BinaryType(), boxes=BinaryType(), sums=BinaryType())
    blocks = written(rows.mapInArrow(_built(parts, width, chunk, block, stored.names), stored), "vector-blocks")
    sums = _struct(part=IntegerType(), entry=IntegerType(), n=LongType(), **{f"s{d}": LongType() for d in range(width)})
    for _ in range(rounds):
        partial = blocks.select("n", "points", "boxes", "sums").mapInArrow(_summed(np.ascontiguousarray(books), block), sums)
        total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{d}").cast("decimal(20,0)")).alias(f"s{d}") for d in range(width)])
        for r in total.collect():  # a row for each entry at most
            books[r["part"], r["entry"]] = [int(r[f"s{d}"]) // r["n"] for d in range(width)]
    coded = written(blocks.mapInArrow(_coded(np.ascontiguousarray(books), block, out_type.names), out_type), "vector-codes")
    release(blocks)
    return coded, books.tolist()


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded with label_error, the errors of equal labels added up; nulls are equal to each other."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-label-errors")
    small = F.broadcast(sums) if sums.count() <= _FEW_LABELS else sums
    return coded.join(small, coded["label"].eqNullSafe(sums["label"])).drop(sums["label"])


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers with commas between them."""
    return hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _assigned(k: int) -> str:
    return f"""a{k} AS (
  SELECT r, part, min(struct_pack(d := (p.x[1] - c.x[1]) ** 2 + (p.x[2] - c.x[2]) ** 2 + (p.x[3] - c.x[3]) ** 2 + (p.x[4] - c.x[4]) ** 2, e := entry)) AS b
  FROM p JOIN c{k} c USING (part) GROUP BY r, part
)"""


def _moved(k: int) -> str:
    down = ", ".join(f"((sum(x[{d}]) - ((sum(x[{d}]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT" for d in range(1, 5))
    return f"""m{k} AS (
  SELECT part, b.e AS entry, [{down}] AS x FROM p JOIN a{k} USING (r, part) GROUP BY part, b.e
), c{k + 1} AS (
  SELECT part, entry, coalesce(m{k}.x, c{k}.x) AS x FROM c{k} LEFT JOIN m{k} USING (part, entry)
)"""


#: The contract for vectors of 64 components: every part meets every entry.
OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64
), p AS (
  SELECT r, part, v[4 * part + 1 : 4 * part + 4] AS x FROM kept, range(16) t(part)
), c0 AS (
  SELECT part, r - 1 AS entry, x FROM p WHERE r <= 64
), {_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)}, coded AS (
  SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error FROM a2 GROUP BY r
), errors AS (
  SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (r) GROUP BY label
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2
)
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM coded JOIN kept USING (r) JOIN errors ON errors.label IS NOT DISTINCT FROM kept.label, books
"""
