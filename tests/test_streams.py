import json

from pyspark.sql import types as T

from ticketloom.operators.reports import run_status
from ticketloom.streaming import jobs

SCHEMA = T.StructType([T.StructField("ticket_id", T.StringType()), T.StructField("v", T.LongType())])


def land(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"ticket_id": str(i), "v": i}) for i in ids))


def test_stream_append_equals_batch(spark, tmp_path):
    land(tmp_path / "in", "a.json", [1, 2, 3])
    run = lambda: jobs.stream_tickets(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "cp"), SCHEMA).awaitTermination(60)
    run()
    land(tmp_path / "in", "b.json", [3, 4])
    run()
    run()  # a restart without new files adds nothing
    assert sorted(r["ticket_id"] for r in spark.read.parquet(str(tmp_path / "store")).collect()) == ["1", "2", "3", "4"]


def test_checkpointed_process_goes_on_after_a_crash(spark, tmp_path):
    """A run that dies in its third batch; the next one does the rest, and no batch is there twice."""
    import pytest

    for k in range(5):
        land(tmp_path / "in", f"{k}.json", [2 * k, 2 * k + 1])
    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    seen = []

    def process(batch):
        seen.append(batch.count())
        if len(seen) == 3:
            raise RuntimeError("killed")
        return batch

    run = lambda: jobs.checkpointed_process(source(), process, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    with pytest.raises(Exception):  # noqa: B017
        run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    run()
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(10)) and len(seen) == 6


def test_stream_status_equals_batch(spark, tmp_path):
    events = spark.createDataFrame([(1, s, k, None, st) for k, (s, st) in enumerate([("a", "running"), ("a", "success"), ("b", "running"), ("b", "failed")])], "run_id long, step string, seq long, ts timestamp, status string")
    events.write.json(str(tmp_path / "ev"))
    stream = spark.readStream.schema(events.schema).json(str(tmp_path / "ev"))
    q = jobs.stream_run_status(stream).writeStream.format("memory").queryName("steps").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r["step"], r["status"]) for r in spark.table("steps").collect()}
    from pyspark.sql import functions as F

    steps, runs = run_status(events.withColumn("error", F.lit(None).cast("string")), declared=["a"])
    assert got == {(r["step"], r["status"]) for r in steps.collect()} == {("a", "success"), ("b", "failed")}
    assert runs.first()["current_status"] == "failed" and not steps.filter("step = 'b'").first()["known"]


def test_stream_log_redacts(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.txt").write_text("x token=abc\nplain")
    q = jobs.stream_log(spark, str(tmp_path / "log")).writeStream.format("memory").queryName("loglines").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r["line"] for r in spark.table("loglines").collect()} == {"x token=[REDACTED]", "plain"}
