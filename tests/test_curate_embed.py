import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lumora import schemas
from lumora.operators import curate, embed, joins
from lumora.plans import jobs
from lumora.sources import gallery as sources
from lumora.sources import sinks
from lumora.standins import byte_histogram, word_hash


def hit(category, pos, **over):
    row = dict(category=category, pos=pos, thumbnail="t", url="u", title="Title", creator="Me",
               license="by", license_version="2.0", license_url="http://l",
               foreign_landing_url="http://f", provider="p", mature=False, status_ok=True,
               mime="image/jpeg", length=5000)
    row.update(over)
    return tuple(row[f.name] for f in schemas.CANDIDATE)


def frame(spark, hits):
    return spark.createDataFrame(hits, schemas.CANDIDATE)


def test_eligibility(spark):
    hits = frame(spark, [
        hit("dog", 0), hit("dog", 1, license="by-nc"), hit("dog", 2, license="BY-NC-SA"),
        hit("dog", 3, mature=True), hit("dog", 19, mature=None), hit("dog", 4, license=None),
        *[hit("cat", i, license="by-nc" if i == 7 else "by") for i in range(30)]])
    got = [(r.category, r.pos) for r in curate.eligible(hits, 20).collect()]
    assert sorted(p for c, p in got if c == "dog") == [0, 4, 19]
    assert sorted(p for c, p in got if c == "cat") == [i for i in range(21) if i != 7]


def test_first_valid_skips_bad_hits(spark):
    hits = frame(spark, [
        hit("dog", 0, thumbnail="", url=None), hit("dog", 1, mime="text/html"),
        hit("dog", 2, length=2999), hit("dog", 3, status_ok=False), hit("dog", 4, thumbnail=""),
        hit("dog", 5, mime="IMAGE/PNG"), hit("dog", 6, mime=None), hit("dog", 7, length=3000),
        hit("dog", 8), hit("cat", 1)])
    got = sorted((r.category, r.pos, r.src) for r in curate.first_valid(hits).collect())
    assert got == [("cat", 1, "t"), ("dog", 4, "u"), ("dog", 5, "t"), ("dog", 7, "t")]
    plan = curate.first_valid(hits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_metadata(spark):
    hits = frame(spark, [
        hit("dog", 0, title="  Padded﻿", creator=None, license="by-sa", license_version=None),
        hit("dog", 1, title=" \t", creator=" X ", foreign_landing_url=None, license_url=None, provider=None),
        hit("dog", 2, title="é" * 130, foreign_landing_url=None, url=None, license=None, license_version=None),
        hit("dog", 3, title=None, foreign_landing_url="", creator="")])
    got = [tuple(r) for r in curate.clean_metadata(hits).orderBy("pos").select(
        "title", "creator", "license", "licenseUrl", "source", "provider").collect()]
    assert got == [
        ("Padded", "Unknown", "BY-SA", "http://l", "http://f", "p"),
        ("Untitled", "X", "BY 2.0", "", "u", ""),
        ("é" * 120, "Me", "", "http://l", "", "p"),
        ("Untitled", "", "BY 2.0", "http://l", "", "p")]


def test_file_names_grow_past_three_digits(spark):
    from lumora.fixed_values import FILE_NAME_FORMAT
    df = spark.createDataFrame([(7,), (999,), (1000,), (1234,)], "id long")
    assert [r[0] for r in df.select(F.format_string(FILE_NAME_FORMAT, "id")).collect()] == [
        "gallery/img/007.jpg", "gallery/img/999.jpg", "gallery/img/1000.jpg", "gallery/img/1234.jpg"]


def landed_pages(tmp_path):
    def page(category, n):
        names = [f.name for f in schemas.CANDIDATE][2:]
        return {"category": category, "results": [
            dict(zip(names, hit(category, i, title=f"{category} {i}")[2:])) for i in range(n)]}
    folder = tmp_path / "hits"
    folder.mkdir()
    for i, (c, n) in enumerate([("cat", 5), ("dog", 2), ("beach", 0), ("unplanned", 4)]):
        (folder / f"{i}.json").write_text(json.dumps(page(c, n)))
    (folder / "none.json").write_text(json.dumps({"category": "car", "results": None}))
    return str(folder)


def test_curation_job(spark, tmp_path):
    hits = sources.read_candidates(spark, landed_pages(tmp_path))
    report = jobs.curation_job(hits, sources.category_plan(spark), str(tmp_path))
    counts = {r.category: (r.kept, r.under_filled) for r in report.collect()}
    assert len(counts) == 12 and counts["dog"] == (2, True) and counts["cat"] == (3, False)
    assert counts["car"] == (0, True)
    items, head = sources.read_table(spark, f"{tmp_path}/manifest")
    rows = items.orderBy("id").collect()
    assert [(r.id, r.title, r.file) for r in rows] == [
        (0, "dog 0", "gallery/img/000.jpg"), (1, "dog 1", "gallery/img/001.jpg"),
        (2, "cat 0", "gallery/img/002.jpg"), (3, "cat 1", "gallery/img/003.jpg"),
        (4, "cat 2", "gallery/img/004.jpg")]
    assert head.first()["count"] == 5 and head.first()["builtAt"].endswith("Z")


def test_three_jobs_end_to_end(spark, tmp_path):
    hits = sources.read_candidates(spark, landed_pages(tmp_path))
    jobs.curation_job(hits, sources.category_plan(spark), str(tmp_path))
    images = tmp_path / "web"
    (images / "gallery" / "img").mkdir(parents=True)
    with pytest.raises(Exception):
        jobs.embedding_job(spark, str(tmp_path), str(images), byte_histogram(16))
    for i in range(5):
        (images / "gallery" / "img" / f"{i:03d}.jpg").write_bytes(bytes([i, i + 1, 200 - i]) * 50)
    head = jobs.embedding_job(spark, str(tmp_path), str(images), byte_histogram(16)).first()
    (images / "gallery" / "img" / "004.jpg").unlink()
    with pytest.raises(FileNotFoundError, match="1 items"):
        jobs.embedding_job(spark, str(tmp_path), str(images), byte_histogram(16))
    assert (head.model, head.dim, head.normalized, head["count"]) == ("byte-histogram", 16, True, 5)
    text = word_hash(16)
    same = embed.Encoder("byte-histogram", text.dtype, 16, text.load)
    total = jobs.evaluation_job(spark, str(tmp_path), sources.evaluation_prompts(spark), same).first()
    assert (total.queries, total.gallerySize) == (12, 5)
    with pytest.raises(ValueError):
        jobs.evaluation_job(spark, str(tmp_path), sources.evaluation_prompts(spark), text)
    loaded = sources.load_gallery(spark, str(tmp_path), "/base/")
    first = loaded.items.orderBy("id").first()
    assert first.src == "/base/gallery/img/000.jpg" and first.isUpload is False and len(first.v) == 16
    assert loaded.evaluation.count() == 12 and loaded.aggregate.first().gallerySize == 5


def test_envelopes(spark, tmp_path):
    item = {f.name: "x" for f in schemas.ITEM} | {"id": 4}
    (tmp_path / "manifest.json").write_text(json.dumps(
        {"builtAt": "2026-01-01", "count": 2, "items": [item, item | {"id": 1, "title": "é"}]}, indent=2))
    (tmp_path / "embeddings.json").write_text(json.dumps(
        {"model": "m", "dtype": "q8", "dim": 2, "normalized": True, "count": 3, "embeddings": [
            {"id": 4, "v": [0.5, 1]}, {"id": 4, "v": [0.25, 0]}, {"id": 9, "v": [1, 0]}]}))
    (tmp_path / "eval.json").write_text(json.dumps(
        {"model": "m", "evaluatedAt": "t", "aggregate": {
            "queries": 1, "gallerySize": 2, "mAP": 1, "mrr": 1, "pAt": {"1": 1, "3": 0.944}},
         "perQuery": [{"query": "q", "category": "c", "nRelevant": 1, "pAt": {"1": 1}, "rr": 1, "ap": 0.5,
                       "topIds": [4, 1]}]}))
    g = sources.load_gallery(spark, str(tmp_path))
    assert [(r.id, r.pos, list(r.v)) for r in g.items.orderBy("pos").collect()] == [(4, 0, [0.25, 0.0]), (1, 1, [])]
    assert g.header.first().asDict() == {"model": "m", "dtype": "q8", "dim": 2, "normalized": True, "count": 3}
    assert g.evaluation.first().topIds == [4, 1] and g.aggregate.first().pAt == {"1": 1.0, "3": 0.944}
    (tmp_path / "eval.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        sources.load_gallery(spark, str(tmp_path))
    (tmp_path / "eval.json").unlink()
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        sources.load_gallery(spark, str(tmp_path))


def test_vectors_left_join_items_keeps_repeats(spark):
    vectors = spark.createDataFrame(
        [(1, 0, [1.0]), (2, 1, [2.0]), (1, 2, [3.0]), (5, 3, [4.0])], "id long, pos long, v array<float>")
    items = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "b"), (2, 2, "a"), (7, 3, "a")], "id long, pos long, category string")
    got = joins.relevance(vectors, items, "b").orderBy("pos").collect()
    assert [(r.id, list(r.v), r.category, r.rel) for r in got] == [
        (1, [3.0], "b", 1), (2, [2.0], "a", 0), (1, [3.0], "b", 1), (5, [4.0], None, 0)]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_hot_ids_are_joined_apart(spark, hot_rows):
    items = spark.createDataFrame(
        [(7, i) for i in range(50)] + [(None, i) for i in range(20)] + [(i, 0) for i in range(5)],
        "id long, n int")
    vectors = spark.createDataFrame(
        [(7, 0, [1.0]), (7, 1, [2.0]), (3, 2, [3.0]), (9, 3, [4.0])], "id long, pos long, v array<float>")
    got = joins.join_items_vectors(items, vectors, hot_rows).collect()
    assert len(got) == 75
    for r in got:
        assert list(r.v) == {7: [2.0], 3: [3.0]}.get(r.id, [])


def test_long_lookup_list(spark):
    """Ids that are broadcast and ids that are not."""
    from lumora.operators import search
    gallery = spark.createDataFrame([(7, 5, "b"), (7, 2, "a"), (8, 1, "c"), (9, 0, "d")], "id long, pos long, t string")
    ids = spark.createDataFrame([(7,), (7,), (8,), (1,)], "id long")
    short = sorted(search.lookup_many(gallery, ids).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(search.lookup_many(gallery, ids).collect()) == short == [(7, 2, "a"), (8, 1, "c")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encoder_loads_once_and_bad_input(spark, tmp_path):
    marker = str(tmp_path / "loads")

    def load():
        with open(marker, "a") as f:
            f.write("x")
        return byte_histogram(8).load()

    enc = embed.Encoder("m", "f", 8, load)
    df = spark.createDataFrame([(i, bytearray([i + 1] * 4)) for i in range(200)], "id long, content binary").coalesce(1)
    assert embed.embed(df, "content", enc, batch_size=10).count() == 200
    out = embed.embed(df, "content", enc, batch_size=10).collect()
    assert {len(r.v) for r in out} == {8} and len(open(marker).read()) <= 2
    bad = df.unionByName(spark.createDataFrame([(900, bytearray())], "id long, content binary"))
    with pytest.raises(PySparkException, match="undecodable"):
        embed.embed(bad, "content", enc).select(F.sum(F.size("v"))).collect()
    good, rest = embed.split_bad(embed.embed(bad, "content", enc, on_bad="keep"))
    assert good.count() == 200 and [r.id for r in rest.collect()] == [900]


def test_query_cleanup_header_and_checks(spark):
    q = spark.createDataFrame([(0, "  "), (1, " a b\t"), (2, None)], "qid long, query string")
    assert [tuple(r) for r in embed.clean_query_text(q).collect()] == [(1, "a b")]
    v = spark.createDataFrame([(0, [0.6, 0.8]), (1, [1.0, 0.0])], "id long, v array<double>")
    h = embed.header(v, word_hash(2))
    assert h.first().normalized and h.first().dim == 2
    embed.check_comparable(h, h)
    with pytest.raises(ValueError, match="model"):
        embed.check_comparable(h, embed.header(v, byte_histogram(2)))
    with pytest.raises(ValueError, match="dimension"):
        embed.check_uniform(v.unionByName(spark.createDataFrame([(2, [1.0])], v.schema)), 2)


def test_text_search(spark):
    enc = word_hash(32)
    docs = spark.createDataFrame([(0, 0, "red car"), (1, 1, "blue sea"), (2, 2, "red rose red")],
                                 "id long, pos long, title string")
    gallery = embed.embed(docs, "title", enc)
    queries = spark.createDataFrame([(0, "  blue sea "), (1, " ")], "qid long, query string")
    got = jobs.text_search(gallery, queries, enc, 2).orderBy("rank").collect()
    assert (got[0].qid, got[0].id, got[0].query) == (0, 1, "blue sea") and len(got) == 2
    from lumora.operators.search import with_items
    named = with_items(jobs.text_search(gallery, queries, enc, 1), gallery).first()
    assert named.title == "blue sea" and np.isclose(named.score, 1.0)


def test_stored_vectors_come_back_exactly(spark, tmp_path):
    x = np.random.default_rng(0).normal(size=(50, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = spark.createDataFrame([(i, i, r.tolist()) for i, r in enumerate(x)], "id long, pos long, v array<double>")
    sinks.write_embeddings(v, embed.header(v, word_hash(8)), str(tmp_path / "e"))
    rows, head = sources.read_table(spark, str(tmp_path / "e"))
    got = np.array([r.v for r in sinks.restore(rows).orderBy("id").collect()])
    assert (got == np.floor(x * 1e5 + 0.5) / 1e5).all() and head.first()["count"] == 50


def test_only_named_files_are_embedded(spark, tmp_path):
    """A thousand other files beside them, none of which the encoder could take."""
    items = [(i, i, f"img/{i} é.jpg") for i in range(5)]
    (tmp_path / "web" / "img").mkdir(parents=True)
    for _, i, name in items:
        (tmp_path / "web" / name).write_bytes(bytes([i + 1]) * 300)
    for i in range(1000):
        (tmp_path / "web" / "img" / f"stray{i}.jpg").write_bytes(b"STRAY")

    def load():
        count = byte_histogram(16).load()

        def run(payloads):
            assert not any(p == b"STRAY" for p in payloads)
            return count(payloads)
        return run

    blank = {f: F.lit("") for f in ("category", "title", "creator", "license", "licenseUrl", "source", "provider")}
    sinks.write_manifest(spark.createDataFrame(items, "id long, pos long, file string").withColumns(blank), f"{tmp_path}/manifest")
    head = jobs.embedding_job(spark, str(tmp_path), str(tmp_path / "web"), embed.Encoder("m", "f", 16, load), partitions=2)
    assert head.first()["count"] == 5
    named = sources.with_images(spark.createDataFrame([(f"img/{n}",) for n in ("0 é.jpg", "none.jpg", "stray3.jpg")], "file string"),
                                f"file:{tmp_path}/web")
    assert {r.file: r.content and len(r.content) for r in named.collect()} == {"img/0 é.jpg": 300, "img/none.jpg": None, "img/stray3.jpg": 5}


def test_files_are_written_by_tasks_and_need_no_folder_each(spark, tmp_path):
    import os

    from lumora.sources import sinks

    lines = [(i, f"page {i}") for i in range(300)] + [(7, "second line"), (301, None), (302, "é\nx")]
    root = str(tmp_path / "files")
    files = [r.file for r in sinks.write_files(spark.createDataFrame(lines, "name long, text string").repartition(5), root).collect()]
    assert len(files) == len(set(files)) == 302
    assert sorted(files) == sorted(os.path.relpath(os.path.join(at, f), root) for at, _, found in os.walk(root) for f in found)
    assert sum(len(folders) for _, folders, _ in os.walk(root)) <= sinks.FOLDERS
    read = {f.split("=")[1]: open(os.path.join(root, f), encoding="utf-8", newline="").read() for f in files}
    assert sorted(read["7.txt"].splitlines()) == ["page 7", "second line"] and read["12.txt"] == "page 12\n"
    assert read["301.txt"] == "\n" and read["302.txt"] == "é\nx\n"
