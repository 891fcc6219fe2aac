import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumora.operators import embed as emb
from lumora.operators import projection, search
from lumora.operators.embed import Encoder
from lumora.functions.spaces import DifferentSpaces, marked, space_of
from lumora.plans.freeze import freeze
from lumora.plans import numbering
from lumora.plans.jobs import text_search
from lumora.standins import byte_histogram, word_hash
from lumora.streaming import state as states
from lumora.streaming.arrivals import Arrivals, count_originals, image_stream

DIM = 16


def setup(spark, seed=0):
    rng = np.random.default_rng(seed)
    x = np.abs(rng.normal(size=(30, DIM))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base = spark.createDataFrame([(i, i, f"c{i % 3}", v.tolist()) for i, v in enumerate(x)],
                                 "id long, pos long, category string, v array<float>")
    q = np.abs(rng.normal(size=(3, DIM)))
    queries = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(q)], "qid long, v array<double>")
    return base, queries, rng


def drop(folder, name, payload, at):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(payload)
    os.utime(path, (at, at))


def picky():
    """Refuses payloads that start with BROKEN."""
    def load():
        count = byte_histogram(DIM).load()

        def run(payloads):
            out = count(payloads)
            out[[p[:6] == b"BROKEN" for p in payloads]] = np.nan
            return out
        return run
    return Encoder("picky", "f", DIM, load)


def full(run, queries, k):
    top = search.top_k(run.gallery(), queries, k)
    return sorted((r.qid, r.rank, r.id, r.score) for r in top.collect())


def running(run):
    return sorted((r.qid, r.rank, r.id, r.score) for r in run.top().collect())


def test_batches_ids_ranking_and_restart(spark, tmp_path):
    base, queries, rng = setup(spark)
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    os.mkdir(folder)
    labels = base.limit(4).selectExpr("id AS label_pos", "concat('l', id) AS label", "v")
    run = Arrivals(state, base, queries, 5, byte_histogram(DIM), labels=labels, projection_dim=DIM)
    run.prepare()
    assert run.last_batch() == -1 and run.gallery().count() == 30
    now = time.time() - 1000
    for i in range(6):
        drop(folder, f"p{i}.{'png' if i != 3 else 'txt'}", rng.bytes(400), now + i)
    drop(folder, "copy.jpg", open(os.path.join(folder, "p0.png"), "rb").read(), now + 9)
    run.start(image_stream(spark, folder, 1)).awaitTermination()
    up = {r.id: r for r in run.uploads().collect()}
    names = [up[-n].title for n in range(1, 7)]
    assert names == ["p0.png", "p1.png", "p2.png", "p4.png", "p5.png", "copy.jpg"]
    assert {r.category for r in up.values()} == {"upload"} and all(r.isUpload for r in up.values())
    order = [r.id for r in run.gallery().orderBy("pos").select("id").collect()]
    assert order == [-6, -5, -4, -3, -2, -1, *range(30)]       # newest batch first
    assert running(run) == full(run, queries, 5)
    assert count_originals(run.gallery()).first().originals == 30
    assert run.tags().count() == 6 * 4
    whole = projection.fit(projection.moments(run.gallery(), DIM), DIM)
    assert projection.fit(run.moments(), DIM).pc1 == pytest.approx(whole.pc1)

    before, last = running(run), run.last_batch()
    run.start(image_stream(spark, folder, 1)).awaitTermination()       # restart: nothing new
    assert (running(run), run.last_batch(), run.uploads().count()) == (before, last, 6)
    again = spark.read.format("binaryFile").load(os.path.join(folder, "copy.jpg"))
    run.process(again, last)                                           # replay of the last batch
    assert running(run) == before and run.uploads().count() == 6

    drop(folder, "b.png", rng.bytes(400), now + 20)
    drop(folder, "a.png", rng.bytes(400), now + 20)
    run.start(image_stream(spark, folder)).awaitTermination()          # two in one batch
    top = run.gallery().orderBy("pos").limit(2).collect()
    assert [(r.id, r.title) for r in top] == [(-7, "a.png"), (-8, "b.png")]
    assert running(run) == full(run, queries, 5)


def test_bad_file_fails_whole_batch_or_is_set_aside(spark, tmp_path):
    base, queries, rng = setup(spark, 1)
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    drop(folder, "ok.png", rng.bytes(100), 1000)
    drop(folder, "broken.png", b"BROKEN bytes", 1001)
    strict = Arrivals(str(tmp_path / "s1"), base, queries, 3, picky())
    strict.prepare()
    before = running(strict)
    query = strict.start(image_stream(spark, folder))
    with pytest.raises(Exception, match="undecodable"):
        query.awaitTermination()
    assert strict.last_batch() == -1 and running(strict) == before
    assert strict.gallery().count() == 30

    lenient = Arrivals(str(tmp_path / "s2"), base, queries, 3, picky(), on_bad="quarantine")
    lenient.prepare()
    lenient.start(image_stream(spark, folder)).awaitTermination()
    assert [r.title for r in lenient.uploads().collect()] == ["ok.png"]
    bad = lenient.quarantine()
    assert [os.path.basename(r.path) for r in bad.collect()] == ["broken.png"]


def test_no_active_query_and_no_images(spark, tmp_path):
    base, _, _ = setup(spark, 2)
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    drop(folder, "notes.txt", b"abc", 1000)
    enc = Encoder("m", "f", DIM, byte_histogram(DIM).load)
    run = Arrivals(str(tmp_path / "s"), base, encoder=enc)
    run.prepare()
    run.start(image_stream(spark, folder)).awaitTermination()
    assert run.last_batch() == 0 and run.uploads().count() == 0 and run.gallery().count() == 30


def vectors_batch(spark, rng, n, name):
    x = np.abs(rng.normal(size=(n, DIM)))
    return spark.createDataFrame([(None, f"in/{name}{i:03d}.png", v.tolist()) for i, v in enumerate(x)],
                                 "modificationTime timestamp, path string, v array<double>")


def test_queries_change_while_arrivals_run(spark, tmp_path):
    base, queries, rng = setup(spark, 3)
    run = Arrivals(str(tmp_path / "s"), base, queries, 4)
    run.prepare()
    batches = [vectors_batch(spark, rng, 7, f"b{i}-") for i in range(3)]
    run.process(batches[0], 0)
    late = spark.createDataFrame([(9, rng.normal(size=DIM).tolist()), (1, rng.normal(size=DIM).tolist())], "qid long, v array<double>")
    version = run.change_queries(add=late, drop=queries.filter("qid = 0").select("qid"))
    now = queries.filter("qid = 2").unionByName(late)
    assert running(run) == full(run, now, 4)                            # back-filled over base and uploads
    assert {r.qid: r.since for r in run.active_queries().collect()} == {1: version, 2: 0, 9: version}
    run.process(batches[1], 1)
    assert running(run) == full(run, now, 4)                            # merged since
    before = running(run)
    run.process(batches[1], 1)                                          # a replay changes nothing
    assert running(run) == before and run.uploads().count() == 14

    again = Arrivals(str(tmp_path / "s"), base, queries, 4)             # taken up by another process: its queries hold
    again.prepare()
    assert running(again) == before
    again.process(batches[2], 2)
    assert running(again) == full(again, now, 4) and again.uploads().count() == 21
    again.change_queries(drop=now.select("qid"))
    assert again.top().count() == 0 and again.active_queries().count() == 0
    with pytest.raises(ValueError, match="nothing to change"):
        again.change_queries()


def test_searches_may_begin_with_none_active(spark, tmp_path):
    base, queries, rng = setup(spark, 4)
    run = Arrivals(str(tmp_path / "s"), base, k=3)
    run.prepare()
    run.process(vectors_batch(spark, rng, 5, "a"), 0)
    assert run.change_queries(drop=queries.select("qid")) == 1          # nothing to drop: no new version
    run.change_queries(add=queries)
    assert running(run) == full(run, queries, 3)


@pytest.mark.parametrize("table", ["uploads", "done"])
def test_a_batch_that_dies_leaves_nothing(spark, tmp_path, monkeypatch, table):
    base, queries, rng = setup(spark, 5)
    run = Arrivals(str(tmp_path / "s"), base, queries, 3, projection_dim=DIM)
    run.prepare()
    first, second = vectors_batch(spark, rng, 6, "a"), vectors_batch(spark, rng, 6, "b")
    run.process(first, 0)
    before, axes = running(run), run.axes()
    write, commit = states.StateLog.write, states.StateLog.commit

    def dies(self, df, name, *rest, **options):
        out = write(self, df, name, *rest, **options)
        if name == table:
            raise OSError("killed")
        return out

    def no_commit(self, manifest):
        raise OSError("killed")

    monkeypatch.setattr(states.StateLog, "write", dies)
    if table == "done":
        monkeypatch.setattr(states.StateLog, "commit", no_commit)
    with pytest.raises(OSError, match="killed"):
        run.process(second, 1)
    monkeypatch.setattr(states.StateLog, "write", write)
    monkeypatch.setattr(states.StateLog, "commit", commit)
    assert run.last_batch() == 0 and running(run) == before and run.axes() == axes
    assert run.uploads().count() == 6 and run.gallery().count() == 36

    again = Arrivals(str(tmp_path / "s"), base, queries, 3, projection_dim=DIM)
    again.prepare()                                                     # sweeps what was left
    kept = {f"{t}/{n}" for t in os.listdir(tmp_path / "s/data") for n in os.listdir(tmp_path / "s/data" / t)}
    versions = sorted(os.listdir(tmp_path / "s/manifest"))
    live = set().union(*[again.log._read(int(v[:12])).folders() for v in versions if v.endswith(".json")])
    assert kept == live
    again.process(second, 1)
    assert sorted(r.id for r in again.uploads().collect()) == list(range(-12, 0))
    assert running(again) == full(again, queries, 3)


def test_two_hundred_batches_leave_few_folders(spark, tmp_path):
    log = states.StateLog(spark, str(tmp_path / "s"))
    m = log.commit(states.Manifest(0, -1, 0))
    bound = states.FAN * 3
    for b in range(200):
        run, back = log.write(spark.range(b, b + 1, 1, 1), "t", b, rows=1)
        m = log.compact(log.commit(m.next(batch=b).extended("t", run, back.schema)))
        assert len(m.runs["t"]) <= bound
        if b % 20 == 19:
            log.sweep()
    log.sweep()
    assert sorted(r.id for r in log.read(log.current(), "t").collect()) == list(range(200))
    assert [(r.first, r.last) for r in m.runs["t"]][0][0] == 0 and all(a.last + 1 == b.first for a, b in zip(m.runs["t"], m.runs["t"][1:]))
    assert len(os.listdir(tmp_path / "s/data/t")) <= bound + states.FAN * states.KEEP
    assert len([n for n in os.listdir(tmp_path / "s/manifest") if n.endswith(".json")]) <= states.KEEP
    with pytest.raises(states.Conflict):
        log.commit(m)


def test_numbering_moves_no_vectors(spark, tmp_path):
    base, _, rng = setup(spark, 6)
    run = Arrivals(str(tmp_path / "s"), base)
    landed = freeze(vectors_batch(spark, rng, 40, "a").withColumn("__row", F.monotonically_increasing_id()))
    plan = run._numbered(landed, 40)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "BroadcastHashJoin" in plan
    assert sorted((r.n, r.path) for r in run._numbered(landed, 40).collect()) == [(i + 1, f"in/a{i:03d}.png") for i in range(40)]


def test_a_large_batch_keeps_every_row(spark, tmp_path, monkeypatch):
    """Numbers of a batch of any size go back to the rows they belong to."""
    monkeypatch.setattr(numbering, "RANGE_ROWS", 30_000)
    base, *_ = setup(spark)
    run, n = Arrivals(str(tmp_path / "state"), base), 100_003
    place = (F.col("id") * 7919) % n
    landed = spark.range(0, n, 1, 5).select(
        F.monotonically_increasing_id().alias("__row"), F.lit(None).cast("timestamp").alias("modificationTime"),
        F.format_string("%012d", place).alias("path"), (place + 1).alias("want"))
    got = run._numbered(landed, n)
    assert got.count() == n and got.filter(F.col("n") != F.col("want")).count() == 0


def test_map_of_an_earlier_batch(spark, tmp_path):
    """Axes are kept per batch; the map as of a batch shows what had arrived by then."""
    base, queries, rng = setup(spark, 7)
    run = Arrivals(str(tmp_path / "s"), base, projection_dim=DIM)
    run.prepare()
    for b in range(3):
        run.process(vectors_batch(spark, rng, 5, f"b{b}-"), b)
    for b in (-1, 0, 2):
        expected = projection.galaxy(run.gallery(b), DIM, queries).collect()
        got = run.galaxy(queries, b).collect()
        assert len(got) == 30 + 5 * (b + 1) + 3
        key = lambda rows: sorted((r.isQuery, r.id, r.x, r.y) for r in rows)
        assert np.allclose(np.array(key(got), float), np.array(key(expected), float), atol=1e-6)
    assert run.axes().used == 45 and run.axes(-1).used == 30


def test_models_are_not_mixed(spark, tmp_path):
    texts = spark.createDataFrame([(i, i, f"w{i} a b") for i in range(5)], "id long, pos long, text string")
    one, other = word_hash(DIM), Encoder("other", "float32", DIM, word_hash(DIM).load)
    g = freeze(emb.embed(texts, "text", one)).select("id", "pos", "v")
    assert space_of(g) == one.space and space_of(g.filter("id > 1").join(texts.select("id"), "id")) == one.space
    asked = texts.select(F.col("id").alias("qid"), F.col("text").alias("query"))
    assert text_search(g, asked, one, 2).count() == 10
    wrong = emb.embed(asked, "query", other)
    for attempt in (lambda: text_search(g, asked, other, 2), lambda: search.top_k(g, wrong, 2), lambda: search.score_pairs(g, wrong),
                    lambda: Arrivals(str(tmp_path / "a"), g, wrong, 2).prepare()):
        with pytest.raises(DifferentSpaces, match="model"):
            attempt()
    with pytest.raises(DifferentSpaces):
        Arrivals(str(tmp_path / "b"), g, encoder=other).prepare()
    run = Arrivals(str(tmp_path / "c"), g, encoder=one)
    run.prepare()
    with pytest.raises(DifferentSpaces):
        run.change_queries(add=wrong)
    unmarked = wrong.select("qid", marked(F.transform("v", lambda x: x), None))
    assert search.top_k(g, unmarked, 2).count() == 10


def test_documents_in_one_file_or_a_folder_of_files_arrive(spark, tmp_path):
    import workload

    base, _, rng = setup(spark)
    vectors = base.selectExpr("id AS vec_id", "transform(sequence(1, 64), i -> cast(v[i % 16] AS float)) AS embedding", "cast(id % 3 AS int) AS label")
    docs = spark.createDataFrame([(i, f"word{i} word{i % 4}") for i in range(1, 21)], "doc_id long, text string")
    for name in ("folder", "file"):
        vectors.write.parquet(str(tmp_path / name / "embeddings.parquet"))
    docs.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    docs.toPandas().to_parquet(tmp_path / "file" / "documents.parquet")
    got = {}
    for name in ("folder", "file"):
        joined = workload.arrivals_gallery(spark, str(tmp_path / name)).collect()
        tagged = workload.arrivals_tags(spark, str(tmp_path / name)).collect()
        assert len(joined) == 50 and len(tagged) == 20 * 3
        got[name] = sorted((r.title, r.digest) for r in joined)
    assert got["folder"] == got["file"]


def test_tables_can_be_read_before_anything_arrives(spark, tmp_path):
    base, queries, _ = setup(spark)
    labels = base.limit(4).selectExpr("id AS label_pos", "concat('l', id) AS label", "v")
    run = Arrivals(str(tmp_path / "state"), base, queries, 5, labels=labels)
    run.prepare()
    assert run.uploads().count() == 0 and run.tags().count() == 0
    assert run.gallery().select("title", "src").count() == 30
    empty = {name: run._table(name).schema for name in ("uploads", "tags")}
    batch = base.limit(2).selectExpr("cast(null AS timestamp) AS modificationTime", "concat('a/', id) AS path", "v")
    run.process(batch, 0)
    for name, schema in empty.items():
        assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in run._table(name).schema]
