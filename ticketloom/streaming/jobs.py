"""Incremental runs of the batch operators with Structured Streaming."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticketloom.functions.text import redact
from ticketloom.session import ship


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of streams in RocksDB: a batch reads and writes the keys that it meets, and state need not fit
    memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _unseen(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """All rows of an id in the batch that brings it first; nothing later."""
    known = state.exists
    if not known:
        state.update((True,))
    for part in parts:
        yield part.iloc[:0] if known else part


def stream_tickets(spark: SparkSession, landing: str, store: str, checkpoint: str, schema: T.StructType, key: str = "ticket_id", files_per_trigger: int = 100) -> StreamingQuery:
    """Appends tickets of new landed JSON-lines files whose id was in no batch before; rows of one id in one
    batch all stay, and null ids are an id. Which ids were seen is keyed state, so a batch reads nothing of the
    store. The store is partitioned by batch id and a replayed batch overwrites its own partition, so a restart
    repeats nothing. A store that was there before the first batch is read once, for its ids."""
    keep_state_on_disk(spark)
    ship(spark)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(landing)
    new = source.withColumn("_id", F.col(key).cast("string")).groupBy("_id").applyInPandasWithState(_unseen, T.StructType([*schema.fields, T.StructField("_id", T.StringType())]), "seen boolean", "append", GroupStateTimeout.NoTimeout).drop("_id")
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{store}/batch_id=-1")  # the store is there from the start
    stored = T.StructType([schema[key], T.StructField("batch_id", T.LongType())])

    def append(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            known = batch.sparkSession.read.schema(stored).parquet(store).filter("batch_id != 0").select(F.col(key).cast("string").alias("_id")).distinct()
            batch = batch.join(known, batch[key].cast("string") == F.col("_id"), "left_anti")
        batch.write.mode("overwrite").parquet(f"{store}/batch_id={batch_id}")

    return new.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def checkpointed_process(source: DataFrame, process, out: str, checkpoint: str) -> StreamingQuery:
    """process(DataFrame) -> DataFrame over each micro-batch, results saved batch by batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return source.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    """Redacted lines of log files as they arrive; the checkpoint keeps the offset."""
    return spark.readStream.text(folder).select(redact(F.col("value")).alias("line"))


def _last_lines(n: int):
    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The last n lines so far; of a batch's lines no more than n are held at a time."""
        kept = list(zip(*state.get, strict=True)) if state.exists else []
        for part in parts:
            kept = heapq.nlargest(n, [*kept, *zip(part["line_no"], part["line"], strict=True)], key=lambda x: x[0])
        numbers, lines = [int(k[0]) for k in kept], [k[1] for k in kept]
        state.update((numbers, lines))
        yield pd.DataFrame({"run_id": [key[0]] * len(kept), "line_no": numbers, "line": lines})

    return run


def stream_tail(lines: DataFrame, out: str, checkpoint: str, offset: int = 0, n: int = 100) -> StreamingQuery:
    """The last n redacted lines of each run of a stream lines(run_id, line_no, line), from line number offset
    on. State holds n lines a run; a batch writes the tails of the runs that it meets, ``read_tail`` gives the
    latest of each. However lines are cut into batches, it is what ``tail_log`` gives for all of them."""
    spark = lines.sparkSession
    keep_state_on_disk(spark)
    ship(spark)
    ready = lines.filter(F.col("line_no") >= offset).select("run_id", F.col("line_no").cast("long").alias("line_no"), redact(F.col("line")).alias("line"))
    kind = T.StructType([lines.schema["run_id"], T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType())])
    spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{out}/batch_id=-1")
    tails = ready.groupBy("run_id").applyInPandasWithState(_last_lines(n), kind, "numbers array<long>, lines array<string>", "update", GroupStateTimeout.NoTimeout)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return tails.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_tail(spark: SparkSession, out: str) -> DataFrame:
    """(run_id, line_no, line) of the latest tail of each run."""
    every = spark.read.parquet(out)
    last = every.groupBy("run_id").agg(F.max("batch_id").alias("batch_id"))
    same = every["run_id"].eqNullSafe(last["run_id"]) & (every["batch_id"] == last["batch_id"])
    return every.join(last, same, "left_semi").select("run_id", "line_no", "line")


def stream_run_status(events: DataFrame) -> DataFrame:
    """Latest status, start and end of each step, updated as events arrive."""
    at = lambda *s: F.min(F.when(F.col("status").isin(*s), F.col("ts")))
    return events.groupBy("run_id", "step").agg(at("running").alias("start_time"), at("success", "failed").alias("end_time"), F.max_by("status", "seq").alias("status"))
