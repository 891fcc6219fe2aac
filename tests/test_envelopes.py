"""The splitting reader against Python's JSON reader, with splits of a few dozen bytes."""

import json
import random

import pytest
from pyspark.sql import types as T

from lumora import schemas
from lumora.sources import gallery as sources
from lumora.sources.envelopes import BrokenEnvelope, read_array

LONGS = T.ArrayType(T.LongType())
ELEMENT = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("n", T.StructType([
    T.StructField("a", LONGS), T.StructField("m", T.MapType(T.StringType(), T.StringType()))]))])
HEADER = T.StructType([T.StructField("before", T.StringType()), T.StructField("other", T.StructType([
    T.StructField("x", LONGS), T.StructField("y", T.StringType())])), T.StructField("after", T.LongType())])
TRICKY = ['"', "\\", "}", "{", "]", "[", '\\"}', "},{", '"items":[{', "é🎉 ", "\\\\", "", " , ", 'a"b\\"c}', "\n\t", "items"]


def tricky(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(TRICKY) for _ in range(r.randint(0, 4)))
    return [{"id": i, "s": word(), "n": {"a": list(range(r.randint(0, 3))), "m": {word() + str(k): word() for k in range(r.randint(0, 2))}}}
            for i in range(n)]


def envelope(items, head_first=True):
    other = {"x": [1, 2], "y": '}],"items":[{"id":-1}]'}
    first = {"before": 'a "quoted\\" } ] name', "other": other}
    return {**first, "items": items, "after": 7} if head_first else {"items": items, **first, "after": 7}


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")


@pytest.fixture
def splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    yield lambda size: small_splits(spark, size)
    for n in [*names, "spark.sql.files.minPartitionNum"]:
        spark.conf.unset(n)


def read(spark, path):
    rows, head = read_array(spark, str(path), "items", ELEMENT, HEADER)
    got = [r.asDict(recursive=True) for r in rows.orderBy("pos").collect()]
    assert [r.pop("pos") for r in got] == list(range(len(got)))
    return got, [r.asDict(recursive=True) for r in head.orderBy("part").collect()]


@pytest.mark.parametrize(("size", "indent", "first"), [(37, None, True), (64, 2, False), (500, None, False), (10**7, 1, True)])
def test_equals_the_whole_reader(spark, tmp_path, splits, size, indent, first):
    splits(size)
    doc = envelope(tricky(size, 40), first)
    (tmp_path / "e.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=size == 64), encoding="utf-8")
    got, head = read(spark, tmp_path / "e.json")
    assert got == doc["items"]
    assert head == [{"part": 0, "before": doc["before"], "other": doc["other"], "after": 7}]


def test_objects_longer_than_splits(spark, tmp_path, splits):
    splits(50)
    doc = envelope([{"id": 0, "s": "}" * 700, "n": None}, {"id": 1, "s": "x", "n": {"a": [1], "m": {"{": "}" * 300}}}])
    (tmp_path / "e.json").write_text(json.dumps(doc) + "\n\n")
    assert read(spark, tmp_path / "e.json")[0] == doc["items"]


def test_several_parts_count_as_one(spark, tmp_path, splits):
    splits(100)
    parts = [envelope(tricky(k, 5)) for k in range(4)]
    folder = tmp_path / "e.json"
    folder.mkdir()
    (folder / "part-0.json").write_text("\n".join(json.dumps(p) for p in parts[:3]) + "\n")
    (folder / "part-1.json").write_text(json.dumps(parts[3]))
    (folder / "part-2.json").write_text("")
    got, head = read(spark, folder)
    assert got == [i for p in parts for i in p["items"]] and len(head) == 4


def test_empty_array_and_no_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(envelope([])))
    assert read(spark, tmp_path / "a.json") == ([], [{"part": 0, "before": 'a "quoted\\" } ] name', "other": envelope([])["other"], "after": 7}])
    (tmp_path / "b.json").write_text('{"after": 3}')
    assert read(spark, tmp_path / "b.json") == ([], [{"part": 0, "before": None, "other": None, "after": 3}])


@pytest.mark.parametrize("text", ["", '{"items":[{"id":1}', '{"items":[{"id":1}]', '{"items":[{"id":1', '{"items":["a"]}', '{"items":[{"id":1},[2]]}', '{"items":[{"id":1}]}}',
                                  '{"after":x,"items":[]}', '{"items":[{"id":"x}]}'])
def test_broken_envelopes_fail(spark, tmp_path, splits, text):
    splits(8)
    (tmp_path / "e.json").write_text(text)
    with pytest.raises(Exception) as error:
        read(spark, tmp_path / "e.json")
    assert isinstance(error.value, BrokenEnvelope) or "BrokenEnvelope" in str(error.value) or "MALFORMED" in str(error.value)


def test_values_of_another_type_fail(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"items":[{"id":"one"}]}')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|BAD_RECORD|PARSE"):
        read(spark, tmp_path / "e.json")


def test_one_large_envelope_is_read_by_many_tasks(spark, tmp_path, splits):
    """A single line with 3,000 vectors: many splits, the same rows as in one."""
    splits(200_000)
    r = random.Random(1)
    rows = [{"id": i, "v": [round(r.uniform(-1, 1), 5) for _ in range(40)]} for i in range(3000)]
    doc = {"model": "m", "dtype": "f", "dim": 40, "normalized": True, "count": len(rows), "embeddings": rows}
    (tmp_path / "embeddings.json").write_text(json.dumps(doc))
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "embeddings.json")).rdd.getNumPartitions() > 3
    vectors, head = sources.read_embeddings(spark, str(tmp_path / "embeddings.json"))
    assert [(x.id, x.v) for x in vectors.orderBy("pos").collect()] == [(x["id"], x["v"]) for x in rows]
    assert head.first().asDict() == {k: doc[k] for k in ("model", "dtype", "dim", "normalized", "count")}
    whole = spark.read.schema(schemas.EMBEDDINGS).option("multiLine", True).json(str(tmp_path / "embeddings.json"))
    assert whole.selectExpr("size(embeddings) AS n").first().n == vectors.count()
