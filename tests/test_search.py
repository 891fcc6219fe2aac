import numpy as np
import pytest
from pyspark.sql import functions as F

from lumora.functions.kernels import QueryVectors, TopK, sequential_dots
from lumora.operators import search
from lumora.plans import blocks
from lumora.plans.freeze import freeze

DIM = 16


def make(seed=0, n=400, m=12, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, DIM)).astype(np.float32)
    if copies:
        x[: n // 3] = x[0]          # a third of the gallery is one vector
    q = rng.normal(size=(m, DIM))
    return x, q


def brute(x, q, k, exclude=None):
    s = sequential_dots(x.astype(np.float64), q)
    out = []
    for j in range(len(q)):
        order = [i for i in np.lexsort((np.arange(len(x)), -s[:, j]))
                 if exclude is None or i != exclude[j]]
        out += [(j, int(i), r + 1) for r, i in enumerate(order[:k])]
    return sorted(out)


def frames(spark, x, q, parts=5):
    gallery = spark.createDataFrame(
        [(i, i, [float(c) for c in v], f"c{i % 4}") for i, v in enumerate(x)],
        "id long, pos long, v array<float>, category string").repartition(parts)
    queries = spark.createDataFrame(
        [(j, [float(c) for c in v], f"c{j % 4}", f"q{j}") for j, v in enumerate(q)],
        "qid long, v array<double>, category string, query string")
    return gallery, queries


def got(df):
    return sorted((r.qid, r.id, r.rank) for r in df.collect())


@pytest.mark.parametrize("m", [1, 12])
@pytest.mark.parametrize("k", [3, 20])
def test_top_k_equals_brute_force(spark, m, k):
    x, q = make(m=m)
    gallery, queries = frames(spark, x, q)
    assert got(search.top_k(gallery, queries, k)) == brute(x, q, k)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_partitioning_does_not_matter(spark, parts):
    x, q = make(seed=3)
    gallery, queries = frames(spark, x, q, parts)
    assert got(search.top_k(gallery, queries, 7)) == brute(x, q, 7)


@pytest.mark.parametrize("options", [{"tile_bytes": 700}, {"block_rows": 5}, {"block_rows": 1}])
def test_tiles_and_blocks_equal_packed(spark, options):
    x, q = make(seed=1)
    gallery, queries = frames(spark, x, q)
    tiled = search.top_k(gallery, queries, 5, max_packed=3, **options)
    assert got(tiled) == brute(x, q, 5)
    a = search.score_pairs(gallery, queries, ("category",))
    b = search.score_pairs(gallery, queries, ("category",), max_packed=3, **options)
    assert a.count() == len(x) * len(q)
    assert sorted(a.collect()) == sorted(b.select(a.columns).collect())


def test_find_similar_leaves_out_the_target(spark):
    x, _ = make(seed=2)
    gallery, _ = frames(spark, x, x[:1])
    targets = [0, 5, 399]
    ids = spark.createDataFrame([(t,) for t in targets], "id long")
    expected = brute(x, x[targets].astype(np.float64), 6, exclude=targets)
    expected = sorted((targets[j], i, r) for j, i, r in expected)
    assert got(search.find_similar(gallery, ids, 6)) == expected
    assert got(search.find_similar(gallery, ids, 6, max_packed=1, tile_bytes=4000)) == expected
    assert got(search.find_similar(gallery, ids, 6, max_packed=1, block_rows=2)) == expected


def test_blocks_leave_the_gallery_where_it_is(spark, monkeypatch):
    """No exchange below the scan of the gallery, several stretches a task, several passes, and still the same rows."""
    x, q = make(seed=6, m=40)
    gallery, queries = frames(spark, x, q)
    gallery = freeze(gallery)
    monkeypatch.setattr(blocks, "STRETCH_BYTES", 8 * DIM * 50)
    written = blocks.write_blocks(queries, block_rows=8)
    assert written.count == 5 and sorted(i for b in range(5) for i in written.load(b).qids) == list(range(40))
    items = gallery.select("id", "pos", "v")
    plan = blocks.top_k_scan(items, written, 7, search.HIT)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan
    monkeypatch.setattr(blocks, "KEPT_ROWS", 7 * 8 * 2)
    assert [list(p) for p in written.passes(7)] == [[0, 1], [2, 3], [4]]
    assert got(search.top_k(gallery, queries, 7, max_packed=0, block_rows=8)) == brute(x, q, 7)
    assert search.top_k(gallery, queries.limit(0), 7, max_packed=-1).count() == 0

def test_ranking_order_and_numbers(spark):
    x, q = make(seed=4, m=1)
    gallery, _ = frames(spark, x, q)
    expected = [i for _, i, _ in sorted(brute(x, q, len(x)), key=lambda r: r[2])]
    assert [r.id for r in search.rank(gallery, q[0].tolist()).collect()] == expected
    numbered = search.rank_numbered(gallery, q[0].tolist())
    assert [r.id for r in numbered.orderBy("rank").collect()] == expected
    assert [r["rank"] for r in numbered.orderBy("rank").collect()] == list(range(1, len(x) + 1))


def test_missing_short_and_nan_vectors(spark):
    rows = [(0, 0, None), (1, 1, []), (2, 2, [2.0]), (3, 3, [1.0, 1.0]),
            (4, 4, [float("nan"), 1.0]), (5, 5, [-1.0, 0.0]), (6, 6, [3.0, 0.0, 9.0])]
    gallery = spark.createDataFrame(rows, "id long, pos long, v array<float>")
    ranked = search.rank(gallery, [1.0, 0.5]).select("id", "score").collect()
    assert [(r.id, r.score) for r in ranked] == [
        (6, 3.0), (2, 2.0), (3, 1.5), (0, 0.0), (1, 0.0), (5, -1.0), (4, None)]
    q = spark.createDataFrame([(0, [1.0, 0.5])], "qid long, v array<double>")
    for options in ({}, {"max_packed": 0, "tile_bytes": 40}, {"max_packed": 0, "block_rows": 1}):
        top = search.top_k(gallery, q, 7, **options).orderBy("rank").collect()
        assert [(r.id, r.score) for r in top] == [(r.id, r.score) for r in ranked]


def test_screening_is_exact_for_near_ties():
    rng = np.random.default_rng(5)
    base = rng.normal(size=DIM)
    x = np.repeat(base[None, :], 3000, axis=0)
    x += rng.integers(-2, 3, size=x.shape) * np.spacing(x)        # last-bit differences
    q = rng.normal(size=(20, DIM))
    top = TopK(QueryVectors(range(20), q), 9)
    import pyarrow as pa
    for at in range(0, 3000, 700):
        part = x[at:at + 700]
        top.update(np.arange(at, at + len(part)), np.arange(at, at + len(part)), pa.array(part.tolist()))
    s = sequential_dots(x, q)
    for j in range(20):
        expected = np.lexsort((np.arange(3000), -s[:, j]))[:9]
        assert top.id[top.q == j].tolist() == expected.tolist()


def test_browse_and_lookup(spark):
    x, q = make()
    gallery, _ = frames(spark, x, q)
    rows = search.browse(gallery).collect()
    assert [r.id for r in rows] == list(range(len(x))) and {r.score for r in rows} == {0.0}
    assert search.lookup(gallery, 7).first().pos == 7
    twice = gallery.unionByName(gallery.withColumn("pos", F.col("pos") + 1000))
    found = search.lookup_many(twice, spark.createDataFrame([(7,), (9,), (7,)], "id long"))
    assert sorted((r.id, r.pos) for r in found.collect()) == [(7, 7), (9, 9)]


def test_plans(spark):
    x, q = make()
    gallery, queries = frames(spark, x, q)
    plan = search.top_k(gallery, queries, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    shuffled = [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning" in line]
    assert shuffled and all("v#" not in line for line in shuffled)
