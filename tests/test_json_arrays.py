"""JSON arrays by pieces against a whole-file parser, with splits that cut strings, escapes and brackets."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import json_arrays, readers

ODD = ["", "plain", "}", "{", '"', "\\", '\\"', "}]", '[{"', ', {"', '", "data": [{', '"questions": [ {', "ü{é}", "a\nb", "\\\\", "]}]}", "}" * 5, '{"q": "}"}']


def entry(rng, k):
    e = {"id": str(k), "question": rng.choice(ODD) + rng.choice(ODD)}
    if rng.random() < 0.4:
        e["more"] = {rng.choice(ODD): [rng.choice(ODD), {"deep": {"er": rng.choice(ODD)}}], "n": [1, [2, []]]}
    if rng.random() < 0.3:
        e["answer"] = rng.choice(ODD) * 3
    return e


@pytest.fixture
def small_splits(spark):
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for c, v in keep.items():
        spark.conf.set(c, v)


def got(spark, path, wrappers=()):
    return [(r.position, json.loads(r.text)) for r in json_arrays.texts(spark, path, wrappers).orderBy("position").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_lists(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    rows = [entry(rng, k) for k in range(rng.choice([1, 40, 90]))]
    at = tmp_path / "a.json"
    at.write_text(json.dumps(rows, ensure_ascii=seed % 2 == 0, indent=seed % 3 or None), encoding="utf-8")
    assert json_arrays._pieces(spark, f"file://{at}").rdd.getNumPartitions() >= min(3, at.stat().st_size // 701)
    assert got(spark, f"file://{at}") == list(enumerate(rows))


WRAPPED = [
    lambda a, b: {"questions": a},
    lambda a, b: {"info": {"x": {"y": {"z": '"data": [{'}}, "questions": [3, {}]}, "n": 3, "data": a},
    lambda a, b: {"s": '{"questions": [{"no": 1}]}', "other": b, "empty": [], "data": a, "tail": [1, {"q": 2}]},
    lambda a, b: {"data": b, "list": [[1], [[2]]], "questions": a},
    lambda a, b: {"x": [[{"k": 1}]], "questions": a, "data": b},
]


@pytest.mark.parametrize("kind", range(len(WRAPPED)))
def test_wrapped(spark, tmp_path, small_splits, kind):
    rng = random.Random(kind)
    a, b = [entry(rng, k) for k in range(60)], [entry(rng, 1000 + k) for k in range(7)]
    at = tmp_path / "w.json"
    at.write_text(json.dumps(WRAPPED[kind](a, b), indent=kind % 2 or None))
    assert got(spark, f"file://{at}", ("questions", "data")) == list(enumerate(a))


@pytest.mark.parametrize(("text", "want"), [("[]", []), ("", []), ('{"questions": [], "data": [{"id": "1"}]}', []), ('{"data": []}', []), ('{"a": 1}', []), (' [ {"id": "x"} ] ', ["x"]), ('{"data": [{"id": "1"}], "questions": []}', [])])
def test_small_files(spark, tmp_path, text, want):
    at = tmp_path / "s.json"
    at.write_text(text)
    assert [r.id for r in json_arrays.read(spark, f"file://{at}", readers.QUESTION, ("questions", "data")).collect()] == want


def test_several_files_and_fields(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"p{k}.json").write_text(json.dumps([{"id": f"{k}-{j}", "question": "q", "unknown": {"x": 1}} for j in range(5)]))
    rows = json_arrays.read(spark, f"file://{tmp_path}", readers.QUESTION).filter(F.col("question") == "q").collect()
    assert sorted((r.position, r.id) for r in rows) == sorted((j, f"{k}-{j}") for k in range(3) for j in range(5))
