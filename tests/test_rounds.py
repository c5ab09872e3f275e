"""Streams with state, publishing, rounds of questions, and file names, against plain re-computations."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators import generation, reports, windows
from ticketloom.sources import files
from ticketloom.streaming import jobs

SCHEMA = T.StructType([T.StructField("ticket_id", T.StringType()), T.StructField("v", T.LongType())])
LINES = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType())])


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_ids_are_remembered_by_the_stream_and_the_store_is_not_read(spark, tmp_path):
    store = tmp_path / "store"
    run = lambda: jobs.stream_tickets(spark, str(tmp_path / "in"), str(store), str(tmp_path / "cp"), SCHEMA).awaitTermination(120)
    land(tmp_path / "in", "a.json", [{"ticket_id": "1", "v": 1}, {"ticket_id": "1", "v": 2}, {"ticket_id": None, "v": 3}])
    run()
    # what earlier batches wrote is out of reach: a batch that read it would fail
    (store / "batch_id=0").rename(tmp_path / "away")
    (store / "batch_id=0").mkdir()
    (store / "batch_id=0" / "part-0.parquet").write_text("not parquet")
    land(tmp_path / "in", "b.json", [{"ticket_id": "1", "v": 4}, {"ticket_id": "2", "v": 5}, {"ticket_id": None, "v": 6}])
    run()
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "away")).collect()) == [1, 2, 3]
    assert [r["v"] for r in spark.read.parquet(str(store / "batch_id=1")).collect()] == [5]


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_tail_equals_the_tail_of_all_lines(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [{"run_id": f"r{rng.randint(0, 2)}", "line_no": k, "line": f"line {k} token=abc{k}"} for k in range(160)]
    rng.shuffle(rows)
    stream = lambda: jobs.stream_tail(spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), 5, 20).awaitTermination(120)
    cuts = sorted(rng.sample(range(1, 160), 3))
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, 160], strict=True)):
        land(tmp_path / "in", f"{k}.json", rows[a:b])
        if k != 1:
            stream()  # and a restart from the checkpoint each time
    want = reports.tail_log(spark.createDataFrame([(r["run_id"], r["line_no"], r["line"]) for r in rows], LINES), 5, 20)
    got = jobs.read_tail(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("run_id", "line_no", "line").collect()))


def test_publish_names_only_what_is_whole(spark, tmp_path):
    path = str(tmp_path / "pub")
    df = spark.createDataFrame([(1, "a“b”", ["x…"]), (2, None, None)], "id int, t string, l array<string>")
    first = files.publish_json(df, path)
    assert [tuple(r) for r in files.read_published(spark, path).orderBy("id").collect()] == [(1, 'a"b"', ["x..."]), (2, None, None)]
    real = files.check_published

    def corrupt(spark_, folder, schema, rows):
        part = next((tmp_path / "pub" / folder.rsplit("/", 1)[1]).glob("part-*.json"))
        part.write_text(part.read_text() + '{"id": 3, "t": "cut o')
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
        real(spark_, folder, schema, rows)

    files.check_published = corrupt
    try:
        with pytest.raises(files.PublishError):
            files.publish_json(df.limit(1), path)
    finally:
        files.check_published = real
    assert files.read_published(spark, path).count() == 2  # readers keep the version before
    second = files.publish_json(df.union(df), path)
    assert files.read_published(spark, path).count() == 4 and first != second
    for part in (tmp_path / "pub" / second).glob("part-*.json"):
        part.write_text("")
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(files.PublishError):
        files.read_published(spark, path)


def plain_rounds(concepts, qa_fn, content, threshold, rounds, cap):
    left, seen, out = dict(concepts), set(), []
    for _ in range(rounds):
        if not concepts or 1 - len(left) / len(concepts) >= threshold or len(out) >= cap:
            break
        ask = min(max(3, round(len(left) / 3)), cap - len(out))
        first = sorted(left, key=lambda k: left[k], reverse=True)[:20]
        new = [q for q in qa_fn(content, [(k, left[k][1]) for k in first], ask)[:ask] if q["question"].casefold() not in seen]
        if not new:
            break
        for q in new:
            seen.add(q["question"].casefold())
            out.append(q)
            for k in q.get("covers", []):
                left.pop(k, None)
    return [(q["question"], q["answer"], tuple(q.get("covers", []))) for q in out], 1 - len(left) / len(concepts) if concepts else 1.0


def name_concepts(content, n):
    return [{"title": w, "summary": "", "importance": len(w) % 3 + 1} for w in dict.fromkeys(content.split())][:n]


def stubborn(content, open_concepts, n):
    """Covers every second open concept, repeats itself, and gives up on texts with a stop word."""
    if "stop" in content:
        return [{"question": "Same?", "answer": "x", "covers": []}, {"question": "SAME?", "answer": "y"}]
    return [{"question": f"What is {t}?", "answer": t, "covers": [k, "unknown"] if i % 2 == 0 else []} for i, (k, t) in enumerate(open_concepts)][: n + 2]


@pytest.mark.parametrize(("threshold", "cap"), [(0.85, 60), (0.5, 60), (1.0, 7)])
def test_rounds_over_all_chapters_equal_one_chapter_at_a_time(spark, threshold, cap):
    contents = {(f"f{k}", k): " ".join(f"w{j}{'x' * (j % 4)}" for j in range(3 * k)) + (" stop" if k == 3 else "") for k in range(6)}
    df = spark.createDataFrame([(f, c, t) for (f, c), t in contents.items()], "source_file string, chapter long, content string")
    got = {}
    for r in generation.generate_until_covered(df, name_concepts, stubborn, threshold, cap=cap).collect():
        got.setdefault((r["source_file"], r["chapter"]), []).append((r["question"], r["answer"], tuple(r["covers"]), round(r["coverage"], 9)))
    for key, text in contents.items():
        found = {f"c{i + 1}": (c["importance"], c["title"]) for i, c in enumerate(name_concepts(text, 50))}
        rows, share = plain_rounds(found, stubborn, text, threshold, 8, cap)
        assert sorted(got.get(key, [])) == sorted((*r, round(share, 9)) for r in rows)


def test_a_failed_round_goes_on(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def counted(content, open_concepts, n):
        import uuid

        (calls / uuid.uuid4().hex).write_text(str(len(open_concepts)))
        if (calls.parent / "broken").exists() and len(open_concepts) < 12:
            raise RuntimeError("model is down")
        return stubborn(content, open_concepts, n)

    df = spark.createDataFrame([("f", 1, " ".join(f"w{j}" for j in range(12)))], "source_file string, chapter long, content string")
    (tmp_path / "broken").write_text("")
    run = lambda state: generation.generate_until_covered(df, name_concepts, counted, state=state).select("question", "coverage").collect()
    with pytest.raises(Exception):  # noqa: B017
        run(str(tmp_path / "state"))
    (tmp_path / "broken").unlink()
    before = sum(x.read_text() == "12" for x in calls.iterdir())
    got = run(str(tmp_path / "state"))
    assert sum(x.read_text() == "12" for x in calls.iterdir()) == before == 1  # the first round was not asked again
    assert sorted(got) == sorted(run(str(tmp_path / "another")))


def plain_names(rows):
    taken, out = {}, []
    for folder, name in rows:
        if name is not None and name in taken.setdefault(folder, set()):
            head, dot, tail = name.rpartition(".")
            head, tail = (head, dot + tail) if dot else (name, "")
            i = 1
            while f"{head}_{i}{tail}" in taken[folder]:
                i += 1
            name = f"{head}_{i}{tail}"
        if name is not None:
            taken[folder].add(name)
        out.append(name)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_file_names_equal_a_walk_in_order(spark, seed):
    rng = random.Random(seed)
    pool = ["a.pdf", "a_1.pdf", "a_1_1.pdf", "a_2.pdf", "a_02.pdf", "_1.pdf", ".pdf", "b_7", "b", "b_7_1", "scan_1.pdf", "scan_2.pdf", "scan_3.pdf", "c.d.e", "c.d_1.e", None, "_", "__1"]
    rows = [(rng.choice(["x", "y"]), rng.choice(pool)) for _ in range(70)] + [("z", f"scan_{k}.pdf") for k in range(40)]
    df = spark.createDataFrame([(k, f, n, "own") for k, (f, n) in enumerate(rows)], "ord int, dir string, name string, final string")
    got = windows.number_collisions(df, folder="dir").orderBy("ord").collect()
    assert [r["final_name"] for r in got] == plain_names(rows) and got[0].asDict().keys() == {"ord", "dir", "name", "final", "final_name"}


def test_numbered_names_without_a_repeat_are_no_family(spark):
    df = spark.range(2000).select(F.col("id").alias("ord"), F.concat(F.lit("scan_"), F.col("id").cast("string"), F.lit(".pdf")).alias("name"))
    seen, real = [], windows.written

    def spy(out, name):
        out = real(out, name)
        if name == "name-roots":
            seen.append(out.count())
        return out

    windows.written = spy
    try:
        assert windows.number_collisions(df).filter("name = final_name").count() == 2000
    finally:
        windows.written = real
    assert seen == [0]


def test_tracker_writes_links_and_not_all_pairs(spark, sf, monkeypatch):
    """Clusters need no pair of each two similar tickets, and tickets are made once for prompts and summaries."""
    from ticketloom.plans import pipelines, queries_flow

    seen, real = {}, pipelines.written

    def spy(df, name):
        seen[name] = real(df, name)
        return seen[name]

    monkeypatch.setattr(pipelines, "written", spy)
    assert queries_flow.flow_tracker(spark, sf).count() > 0
    assert {"tickets", "links"} <= set(seen) and "pairs" not in seen
    assert seen["links"].count() < seen["placed"].count()


def test_quotas_are_shared_without_texts(spark, monkeypatch):
    from ticketloom.operators import generation

    seen, real = [], generation.split_quota_over_chunks
    monkeypatch.setattr(generation, "split_quota_over_chunks", lambda df, **k: seen.append(df.columns) or real(df, **k))
    rows = spark.createDataFrame([("d", 1, "a. b. c", 700), ("e", 1, "x. y", 350)], "source_file string, chapter long, content string, token_estimate long")
    ask = lambda t, n: [{"question": s.strip(), "answer": "z"} for s in t.split(".")[:n]]
    got = {(r["source_file"], r["question"]) for r in generation.generate_qa(rows, ask, 10).collect()}
    assert got == {("d", "a"), ("d", "b"), ("e", "x")} and "content" not in seen[0]
