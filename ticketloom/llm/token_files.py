"""Token-id files with a shared zstandard dictionary.

A file is a Parquet table of shards, so that any store Spark reaches can hold it. A shard is a run
of documents in ascending doc_id order, cut at ``shard_bytes``:

- ``bucket``, ``shard``: order of shards; documents of a bucket precede those of the next;
- ``n_docs``, ``n_tokens``, ``id_bytes`` (2 or 4 bytes per id, little-endian);
- ``dictionary``: SHA-256 of the zstandard dictionary (empty string: none), whose bytes are in the
  table ``dictionary`` beside it;
- ``doc_ids``: array of the ids; ``offsets``: n_docs + 1 unsigned 64-bit places in ``data``;
- ``data``: each document's ids compressed by itself, so that one document is read by seeking its
  shard (first_doc / last_doc statistics prune shards) and its two offsets.

Buckets are ranges of (doc_id, hash of the frame), so an id that many rows share, null included, is
spread over several. Texts are tokenized once, their compressed frames are written, and only those
are dealt into ranges, about ``bucket_docs`` to each. Prefix sums of token counts run inside buckets
and then over bucket totals in two levels, never over all documents in one task.

Ids are those of plain library calls: the string of a special token in a text becomes that token's
id, unless ``special_as_text`` is set.

The dictionary is trained on about ``sample_rows`` documents (never more than twice that) of at most
``sample_chars`` characters, drawn by a hash of their id; it changes sizes, never contents.

Cases: null text is empty (end id alone); rows with one id follow each other, by the hash of their
frames; null ids come first; very long texts are one frame each; an empty table gives an empty file;
other columns are ignored. ``read_document`` gives each row of a repeated or null id, none of an absent one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.llm.tokens import encoder, vocabulary
from ticketloom.llm.words import only
from ticketloom.session import bounded_batches, new_path, release, table, written

SHARD_SCHEMA = (
    "bucket int, shard int, first_doc long, last_doc long, n_docs long, n_tokens long, id_bytes int, dictionary string, doc_ids array<long>, offsets binary, data binary"
)


def _with_end(ids: bytes, end: bytes, narrow: bool) -> bytes:
    both = np.frombuffer(ids + end, "<u4")
    return both.astype("<u2").tobytes() if narrow else both.tobytes()


def _serialized(path: str, end_id: int, narrow: bool, special_as_text: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encoder(path, special_as_text).ids([t or "" for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([_with_end(x, end, narrow) for x in ids], pa.binary())], ["ids"])

    return run


def train_dictionary(
    docs: DataFrame, tokenizer: str, end_id: int, narrow: bool, size: int = 32 << 10, sample_rows: int = 2000, sample_chars: int = 8192, special_as_text: bool = False
) -> bytes:
    """A dictionary of about ``size`` bytes, or b"" where there is too little to train on."""
    import zstandard

    short = docs.filter(F.length("text").between(1, sample_chars))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = short.filter(draw < share).select("text").limit(2 * sample_rows)
    rows = sample.mapInArrow(_serialized(tokenizer, end_id, narrow, special_as_text), "ids binary").toArrow()["ids"].to_pylist()
    try:
        return zstandard.train_dictionary(size, rows, k=256, d=8, steps=1).as_bytes() if len(rows) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def _frames(path: str, end_id: int, narrow: bool, dictionary: bytes, level: int, special_as_text: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=level, dict_data=shared)
        for batch in batches:
            ids = [_with_end(x, end, narrow) for x in encoder(path, special_as_text).ids([t or "" for t in batch.column(1).to_pylist()])]
            counts = pa.array([len(x) // (2 if narrow else 4) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array([press.compress(x) for x in ids], pa.binary())], ["doc_id", "n", "frame"])

    return run


def _shards(shard_bytes: int, id_bytes: int, dictionary_hash: str):
    """Sorted frames -> shards, a new one at each bucket and after shard_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        bucket, shard, docs, sizes, frames, tokens, held = None, 0, [], [0], [], 0, 0

        def out() -> pa.RecordBatch:
            row = (bucket, shard, docs[0], docs[-1], len(docs), tokens, id_bytes, dictionary_hash, docs, np.cumsum(sizes, dtype="<u8").tobytes(), b"".join(frames))
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for b, doc, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (b != bucket or held >= shard_bytes):
                    yield out()
                    shard = shard + 1 if b == bucket else 0
                    docs, sizes, frames, tokens, held = [], [0], [], 0, 0
                elif b != bucket:
                    shard = 0
                bucket = b
                docs.append(doc)
                sizes.append(len(frame))
                frames.append(frame)
                tokens, held = tokens + n, held + len(frame)
        if docs:
            yield out()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    bucket_docs: int = 16384,
    shard_bytes: int = 2 << 20,
    level: int = 3,
    special_as_text: bool = False,
) -> None:
    """Write docs as token files under path (tables ``shards`` and ``dictionary``)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    narrow = max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dictionary = train_dictionary(source, tokenizer, end_id, narrow, special_as_text=special_as_text)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else ""
    spark.createDataFrame([(digest, bytearray(dictionary))], "dictionary string, content binary").coalesce(1).write.parquet(f"{path}/dictionary")

    frames = written(source.mapInArrow(_frames(tokenizer, end_id, narrow, dictionary, level, special_as_text), "doc_id long, n long, frame binary"), "token-frames")
    n = max(1, -(-frames.count() // bucket_docs))
    ordered = frames.withColumn("tie", F.xxhash64("frame")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select(F.spark_partition_id().alias("bucket"), "doc_id", "n", "frame")
    ordered.mapInArrow(_shards(shard_bytes, 2 if narrow else 4, digest), SHARD_SCHEMA).write.parquet(f"{path}/shards")
    release(frames)


def _decoded(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        only()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        open_frame = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for start, width, docs, offsets, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = np.frombuffer(offsets, "<u8").tolist()
                starts, counts, sums, raw = [], [], [], []
                for a, z in zip(places, places[1:], strict=False):
                    ids = np.frombuffer(open_frame.decompress(data[a:z]), f"<u{width}").astype("<u4").tobytes()
                    starts.append(start)
                    counts.append(len(ids) // 4)
                    sums.append(zlib.crc32(ids))
                    raw.append(ids)
                    start += len(ids) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(raw, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document; start counts the ids of all
    documents before it, ids are little-endian unsigned 32-bit."""
    bounded_batches(spark)
    shards = spark.read.parquet(f"{path}/shards")
    held = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(held["content"]) if held["dictionary"] else b""
    if hashlib.sha256(dictionary).hexdigest() != held["dictionary"] and dictionary:
        raise ValueError("the dictionary's hash is not the one in its table")
    totals = shards.groupBy("bucket").agg(F.sum("n_tokens").alias("total")).withColumn("region", F.floor(F.col("bucket") / 512))
    regions = totals.groupBy("region").agg(F.sum("total").alias("region_total"))  # one row for 512 * bucket_docs documents
    regions = regions.select("region", F.coalesce(F.sum("region_total").over(Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("region_start"))
    in_region = Window.partitionBy("region").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = totals.join(regions, "region").select("bucket", (F.col("region_start") + F.coalesce(F.sum("total").over(in_region), F.lit(0))).alias("bucket_start"))
    in_bucket = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    narrow = shards.select("bucket", "shard", F.coalesce(F.sum("n_tokens").over(in_bucket), F.lit(0)).alias("shard_start")).join(buckets, "bucket")
    starts = narrow.select("bucket", "shard", (F.col("bucket_start") + F.col("shard_start")).alias("start"))
    return (
        shards.join(starts, ["bucket", "shard"])
        .select("start", "id_bytes", "doc_ids", "offsets", "data")
        .mapInArrow(_decoded(dictionary), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    )


def read_document(spark: SparkSession, path: str, doc_id: int | None) -> DataFrame:
    """The rows of one document: Parquet statistics prune shards, its offsets pick its frame."""
    bounded_batches(spark)
    shards = spark.read.parquet(f"{path}/shards")
    if doc_id is None:  # nulls come first
        shards = shards.filter("first_doc is null")
    else:
        shards = shards.filter((F.col("last_doc") >= doc_id) & (F.col("first_doc").isNull() | (F.col("first_doc") <= doc_id)))
    held = spark.read.parquet(f"{path}/dictionary").first()
    one = shards.select(F.posexplode("doc_ids").alias("at", "doc"), "id_bytes", "offsets", "data").filter(F.col("doc").eqNullSafe(F.lit(doc_id)))
    framed = one.select(F.lit(0).cast("long").alias("start"), "id_bytes", F.array("doc").alias("doc_ids"), F.expr("substring(offsets, 8 * at + 1, 16)").alias("offsets"), "data")
    return framed.mapInArrow(_decoded(bytes(held["content"]) if held["dictionary"] else b""), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary").drop("start")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).drop("ids")
