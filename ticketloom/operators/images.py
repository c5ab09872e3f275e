"""Mean hashes of images and their near duplicates within a ticket."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ticketloom.functions.columns import first_wins
from ticketloom.operators.windows import limit_per_group
from ticketloom.session import bounded_batches, release, ship, written

SIDE = 8


def mean_hash(pixels: Column) -> Column:
    """64 bits of an 8 x 8 luminance grid: bit i is set where pixel i is at least the mean."""
    mean = F.aggregate(pixels, F.lit(0).cast("long"), lambda acc, p: acc + p) / F.size(pixels)
    bits = F.transform(pixels, lambda p, i: F.when(p >= mean, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(b))


def _weights(size: int) -> np.ndarray:
    """(8, size): what each pixel of a line gives to each of 8, a triangle as wide as one of the 8 on each side."""
    scale = max(size / SIDE, 1.0)
    centre = (np.arange(SIDE)[:, None] + 0.5) * size / SIDE
    w = np.maximum(0.0, 1 - np.abs(np.arange(size)[None, :] + 0.5 - centre) / scale)
    return w / w.sum(axis=1, keepdims=True)


def _luminance(data: bytes) -> list[int] | None:
    """An uncompressed image (binary PGM or PPM, 8 bits a sample) as an 8 x 8 grid; None for anything else."""
    head: list[bytes] = []
    at = 0
    while len(head) < 4:  # mark, width, height, largest value; comments run to the end of a line
        while at < len(data) and data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.find(b"\n", at) % (len(data) + 1)
            continue
        end = at
        while end < len(data) and end - at < 12 and not data[end : end + 1].isspace():
            end += 1
        if end == at:
            return None
        head.append(data[at:end])
        at = end
    samples = {b"P5": 1, b"P6": 3}.get(head[0])
    if samples is None or not all(x.isdigit() for x in head[1:]) or head[3] != b"255":
        return None
    width, height = int(head[1]), int(head[2])
    size = width * height * samples
    if not size or len(data) - at - 1 < size:
        return None
    grid = np.frombuffer(data, np.uint8, size, at + 1).reshape(height, width, samples).astype(np.int64)
    grey = grid[..., 0] if samples == 1 else (grid @ np.array([19595, 38470, 7471]) + 0x8000) >> 16
    lines = np.floor(grey @ _weights(width).T + 0.5)
    return np.floor(_weights(height) @ lines + 0.5).astype(np.int64).ravel().tolist()


def luminance_grids(images: DataFrame, content: str = "content", name: str = "pixels") -> DataFrame:
    """images with ``pixels``: the 8 x 8 luminance grid of its bytes, as ``spark.read.format("binaryFile")`` reads
    them. Bytes that are no uncompressed image, too few, or null have a null grid."""
    bounded_batches(images.sparkSession)
    schema = images.withColumn(name, F.lit(None).cast("array<int>")).schema
    place = images.columns.index(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grids = [None if x is None else _luminance(x) for x in (v.as_py() for v in b.column(place))]
            columns = [*b.columns, pa.array(grids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, name])

    return images.mapInArrow(run, schema)


def _masks(threshold: int) -> list[int]:
    """Sets of bits, one of which two hashes share if they differ in at most ``threshold`` bits: of threshold + c
    segments c at least are equal, so each choice of c segments is a mask. c is 3 for small thresholds, so that a
    mask has some 24 bits; 64 masks at most, or one for each segment."""
    c = max((c for c in (1, 2, 3) if threshold + c <= 64 and comb(threshold + c, c) <= 64), default=1)
    n = threshold + c
    ends = [64 * k // n for k in range(n + 1)]
    segments = [((1 << (b - a)) - 1) << a for a, b in zip(ends, ends[1:])]
    return [sum(x) for x in combinations(segments, c)]


def _signed(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def _near(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    """(_t, lo, hi) of hashes of a and of b of one ticket that differ in at most ``threshold`` bits, lo before hi. Hashes
    meet where a mask leaves them equal; a pair that several masks bring together counts under the first."""
    masks = _masks(threshold)
    keyed = lambda df: df.select("_t", "ord", "hash", F.posexplode(F.array(*[F.col("hash").bitwiseAND(_signed(m)) for m in masks])).alias("mask", "part"))
    x, y = keyed(a).alias("x"), keyed(b).alias("y")
    differ = F.col("x.hash").bitwiseXOR(F.col("y.hash"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(_signed(m)) == 0, k) for k, m in enumerate(masks)])
    met = (F.col("x._t") == F.col("y._t")) & (F.col("x.mask") == F.col("y.mask")) & (F.col("x.part") == F.col("y.part"))
    met &= (F.col("x.ord") < F.col("y.ord")) & (F.bit_count(differ) <= threshold)
    return x.join(y, met).filter(first == F.col("x.mask")).select("x._t", F.col("x.ord").alias("lo"), F.col("y.ord").alias("hi"))


def _one_by_one(threshold: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("ord")
        found, n, kept = np.zeros(len(ordered), np.int64), 0, []
        for h in ordered["hash"].to_numpy():
            keep = not n or bool((np.bitwise_count((found[:n] ^ h).view(np.uint64)) > threshold).all())
            if keep:
                found[n] = h
                n += 1
            kept.append(keep)
        return ordered.assign(kept=kept)[["_t", "ord", "hash", "kept"]]

    return run


def _in_rounds(nodes: DataFrame, threshold: int) -> DataFrame:
    """(_t, ord) of hashes that are dropped. A hash that no open pair has as its later one is kept, and drops its later
    ones; pairs with a dropped hash are closed. This is the rule of going through them one by one, as each
    hash is decided once all that are before it and near it are. Each round is written, and decides at least
    the first open hash of each ticket."""
    seen = Observation()
    opened = written(_near(nodes, nodes, threshold).observe(seen, F.count(F.lit(1)).alias("n")), "image-pairs")
    left, gone = seen.get["n"], []
    while left:
        later = opened.select("_t", F.col("hi").alias("lo")).distinct()
        kept = opened.select("_t", "lo").distinct().join(later, ["_t", "lo"], "left_anti")
        dropped = written(opened.join(kept, ["_t", "lo"], "left_semi").select("_t", F.col("hi").alias("ord")).distinct(), "image-dropped")
        as_lo, as_hi = dropped.withColumnRenamed("ord", "lo"), dropped.withColumnRenamed("ord", "hi")
        seen = Observation()
        rest = opened.join(as_lo, ["_t", "lo"], "left_anti").join(as_hi, ["_t", "hi"], "left_anti").select("_t", "lo", "hi")
        rest = written(rest.observe(seen, F.count(F.lit(1)).alias("n")), "image-pairs")
        left = seen.get["n"]
        release(opened)
        opened = rest
        gone.append(dropped)
    release(opened)
    out = nodes.select("_t", "ord").limit(0)
    for part in gone:
        out = out.unionByName(part)
    out = written(out, "image-dropped")
    release(*gone)
    return out


def near_duplicate_images(images: DataFrame, mode: str = "ahash", threshold: int = 5, at_once: int = 4096) -> DataFrame:
    """images(ticket_id, ord, pixels array<int> or content binary) -> (ticket_id, ord, kept), ord unique in a ticket.

    ``exact`` keeps the first of equal images (of equal bytes, if there are bytes). ``ahash`` keeps an image whose
    hash differs in more than threshold bits from every one kept before in its ticket. Images without a grid (null,
    or bytes that are no uncompressed image) are kept; images without ticket are a ticket.

    The first ``at_once`` distinct hashes of a ticket are judged in one task, one by one. What is left of larger
    tickets loses the hashes near one that was kept, by an equi-join on parts of the hashes, and is then decided
    in rounds over the pairs that are near each other (``_in_rounds``), whatever the size of the ticket.
    """
    whole = "content" in images.columns
    ticket = F.struct("ticket_id").alias("_t")  # equal for null too
    if mode == "exact":
        same = F.sha2("content", 256) if whole else F.sha2(F.to_json("pixels"), 256)
        rows = images.select("ticket_id", "ord", ticket, F.coalesce(same, F.concat(F.lit("-"), F.col("ord").cast("string"))).alias("same"))
        first = first_wins(rows.select("_t", "ord", "same"), ["_t", "same"], ["ord"]).select("_t", "ord", F.lit(True).alias("kept"))
        return rows.join(first, ["_t", "ord"], "left").select("ticket_id", "ord", F.coalesce("kept", F.lit(False)).alias("kept"))
    ship(images.sparkSession)
    grids = luminance_grids(images.select("ticket_id", "ord", "content")) if whole and "pixels" not in images.columns else images
    hashed = written(grids.select("ticket_id", F.col("ord").cast("long").alias("ord"), F.when(F.size("pixels") > 0, mean_hash(F.col("pixels"))).alias("hash"), ticket), "image-hashes")
    # only the first of equal hashes can be kept, so the others need no comparison
    first = written(first_wins(hashed.filter("hash is not null").select("_t", "ord", "hash"), ["_t", "hash"], ["ord"]), "image-first")
    kind = first.schema["_t"].dataType.simpleString()
    one_by_one = lambda df: df.groupBy("_t").applyInPandas(_one_by_one(threshold), f"_t {kind}, ord long, hash long, kept boolean")
    placed = lambda df: hashed.join(df.select("_t", "ord", "kept"), ["_t", "ord"], "left").select("ticket_id", "ord", F.coalesce("kept", F.col("hash").isNull()).alias("kept"))
    largest = first.groupBy("_t").count().agg(F.max("count")).first()[0] or 0
    if largest <= at_once:
        return placed(one_by_one(first))
    judged = written(one_by_one(limit_per_group(first, ["_t"], at_once, ["ord"])), "image-judged")
    kept = judged.filter("kept").select("_t", "ord", "hash")
    others = written(first.join(judged.select("_t", "ord"), ["_t", "ord"], "left_anti"), "image-others")
    taken = _near(kept, others, threshold).select("_t", F.col("hi").alias("ord")).distinct()
    open_ = written(others.join(taken, ["_t", "ord"], "left_anti").select("_t", "ord", "hash"), "image-open")
    dropped = _in_rounds(open_, threshold)
    chosen = kept.select("_t", "ord").unionByName(open_.select("_t", "ord").join(dropped, ["_t", "ord"], "left_anti")).withColumn("kept", F.lit(True))
    out = written(placed(chosen), "image-kept")
    release(hashed, first, judged, others, open_, dropped)
    return out
