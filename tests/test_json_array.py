"""Element-wise reading of JSON arrays, cut into splits anywhere, against a plain parser."""

import json
import random

import pytest
from pyspark.sql import types as T

from ticketloom.sources import files, json_array

ITEM = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.StructType([T.StructField("c", T.StringType())])))])


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "90", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def made(rng):
    text = lambda: "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "x", "\n", "tickets", " "]) for _ in range(rng.randint(0, 30)))
    return {"a": text(), "z": {"tickets": [1, {"k": [2]}]}, "b": [{"c": text()} for _ in range(rng.randint(0, 3))]}


@pytest.mark.parametrize("seed", range(3))
def test_any_split_gives_all_elements_in_order(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    want = []
    for k in range(4):
        items = [made(rng) for _ in range(rng.randint(0, 25))]
        whole = {0: items, 1: {"export_info": {"tickets": 3, "x": ["}"]}, "tags": [{"a": 1}], "tickets": items, "after": [{"a": "no"}]}, 2: {"data": items}, 3: items}[k]
        (tmp_path / f"{k}.json").write_text(json.dumps(whole, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5))
        want += [(f"{k}.json", x["a"], [c["c"] for c in x["b"]]) for x in items]
    read = json_array.read_json_array(spark, str(tmp_path), ITEM)
    rows = read.orderBy("file", "split", "pos").collect()
    assert [(r["file"].rsplit("/", 1)[1], r["a"], [c["c"] for c in r["b"]]) for r in rows] == want
    assert len({(r["file"], r["split"]) for r in rows}) > 5  # many tasks share a file


def test_shapes(spark, tmp_path, tiny_splits):
    for k, (text, n) in enumerate([("[]", 0), ('{"tickets": []}', 0), (' [ 1, "}", {"a": "x"}, null ] ', 4), ('{"data":[{"a":"x"}]}', 1), ("[" + "{}," * 200 + "{}]", 201)]):
        folder = tmp_path / str(k)
        folder.mkdir()
        (folder / "x.json").write_text(text)
        assert json_array.read_json_array(spark, str(folder), ITEM).count() == n
    for k, text in enumerate(['{"other": [1]}', '"x"', '{"tickets": 3}', '{"a": {"tickets": [1]}}']):
        folder = tmp_path / f"bad{k}"
        folder.mkdir()
        (folder / "x.json").write_text(text)
        with pytest.raises(ValueError):
            json_array.read_json_array(spark, str(folder), ITEM)
        assert json_array.read_json_array(spark, str(folder), ITEM, strict=False).count() == 0


def test_tickets_of_one_long_file(spark, tmp_path, tiny_splits):
    (tmp_path / "t.json").write_text(json.dumps({"tickets": [{"ticket_id": k, "Subject": f"s}} {k}", "Attachments": []} for k in range(120)]}))
    rows = files.read_tickets(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r["ord"], r["ticket_id"]) for r in rows] == [(k, str(k)) for k in range(120)]
