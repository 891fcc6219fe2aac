"""Hard negatives against brute force: all windows are complete."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumora.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract over a list of (vec_id, embedding, label), one pair after the other."""
    kept = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label
        kept.append((n, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    last = lambda i: (i is None, i or 0)
    out = []
    for n, i, label, v in kept:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), last(j), m, j, other) for m, j, other, w in kept if m != n]
        scored.sort()
        for s, _, _, j, _ in [x for x in scored if x[4] == label][:5]:
            fits = [(-t, k) for t, _, _, k, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, rank, k, -s, t) for rank, (t, k) in enumerate(fits[:3], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"rid": F.lit("x"), "__rid": F.lit("y"), "score": F.lit(1), "shard": F.lit("z")})
    got = hard_negatives.mine(df.repartition(3), **options).collect()
    return sorted([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got], key=str)


def vectors(n, dim, seed, clusters=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    if clusters:
        x = r.normal(size=(clusters, dim))[r.integers(0, clusters, n)] + 0.2 * x
    return x / np.linalg.norm(x, axis=1, keepdims=True) if dim > 1 else x


@pytest.mark.parametrize(("clusters", "dim", "per_shard", "per_cell"), [(0, 8, 64, 8), (12, 7, 40, 4), (5, 1, 1000, 16), (3, 16, 7, 400)])
def test_equals_brute_force(spark, clusters, dim, per_shard, per_cell):
    x, r = vectors(400, dim, dim, clusters), random.Random(dim)
    rows = [(i * 5, x[i].tolist(), r.randint(0, 3)) for i in range(400)]
    got = mined(spark, rows, per_shard=per_shard, per_cell=per_cell)
    assert got == brute(rows) and len(got) > 100


def test_ties_and_a_very_common_vector(spark):
    """A third of all rows are one vector, under several labels: cells and answers end within ties."""
    x, r = vectors(300, 6, 1), random.Random(1)
    rows = [(i, (x[0] if i % 3 == 0 else x[i]).tolist(), r.randint(0, 2)) for i in range(300)]
    assert mined(spark, rows, per_shard=32, per_cell=8) == brute(rows)


def test_each_shard_has_a_task_of_its_own(spark):
    """Of rows of which a third are one vector, too: no task searches two shards, none is left without one."""
    x, r = vectors(600, 6, 4), random.Random(4)
    rows = [(i, (x[0] if i % 3 == 0 else x[i]).tolist(), r.randint(0, 2)) for i in range(600)] + [(None, x[1].tolist(), 1), (7, None, 1), (8, [], None)]
    index = hard_negatives.build(hard_negatives.whole_rows(spark.createDataFrame(rows, SCHEMA)), per_shard=32, per_cell=8)
    numbers = F.array(*[F.lit(int(k)) for k in index.shards[:, 0]])
    asked = index.rows.filter("rid % 20 = 0").select("rid", "label", "v", numbers.alias("shards"), F.expr(
        f"array(array({hard_negatives.LEAST + 1}L, {-hard_negatives.LEAST - 1}L, {hard_negatives.LEAST + 1}L))").alias("windows"))
    found = index._visit(asked, False, 3).withColumn("task", F.spark_partition_id())
    met = found.join(index.rows.select(F.col("rid").alias("found"), "shard"), F.col("rid") == F.col("found")).select("task", "shard").distinct().collect()
    assert len(index.shards) > 12 and len(met) == len({m.shard for m in met}) == len({m.task for m in met}) == len(index.shards)


def test_awkward_rows(spark):
    x = vectors(60, 4, 2)
    rows = [(i * 10, x[i].tolist(), i % 3) for i in range(60)]
    rows += [(50, x[7].tolist(), 0), (50, x[7].tolist(), 0), (None, x[8].tolist(), 1), (None, x[9].tolist(), None), (601, None, 1), (602, [], 1),
             (603, [0.5, 0.5], 0), (604, [0.5, None, 0.1, 0.2], 0), (605, [float("nan"), 0.0, 0.0, 0.0], 0), (606, [float("inf"), 0.0, 0.0, 0.0], 0), (607, [-0.5] * 6, 2),
             (650, [], 0), (700, [0.0] * 4, -5), (750, [100.0, -3.0, 2.0, 1.0], 1), (751, [0.75, 0.0, 0.0, 0.0], None)]
    assert mined(spark, rows, per_shard=16, per_cell=4) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(50, None, 1), (100, [1.0], None)]) == []
    assert mined(spark, [(50, [1.0], 1)]) == [] and mined(spark, [(50, [], 1), (51, [], 1), (52, [], 2)]) == brute([(50, [], 1), (51, [], 1), (52, [], 2)])


def test_products_beyond_doubles(spark):
    """Integer arithmetic where sums pass 2**53: at the edge of the window every unit counts."""
    big = 2.0 ** 22
    rows = [(50, [big, big, 1.0], 1), (51, [big, 1.0, 1.0], 1), (52, [big, -big / 4, 1.0], 2), (53, [big / 4, big / 4, -1.0], 3)]
    assert mined(spark, rows) == brute(rows)


def test_certified_search_stops_early():
    """On clustered rows most cells are never visited, and the answer is still the whole one."""
    x = np.floor(256 * vectors(2000, 8, 5, clusters=20)).astype(np.int64)
    books = hard_negatives.Codebooks(8, (hard_negatives._words(x[:, :4].astype(float), 12), hard_negatives._words(x[:, 4:].astype(float), 12)))
    first, second, far_first, far_second = books.assign(x.astype(float))
    radius = lambda at, far: np.array([far[at == k].max(initial=0) for k in range(12)])
    books.radii = (radius(first, far_first), radius(second, far_second))
    table = pa.table({"rid": np.arange(2000), "vec_id": np.arange(2000), "label": np.zeros(2000, np.int64), "first": first.astype(np.int32),
                      "second": second.astype(np.int32), "v": pa.array(list(x))})
    shard = hard_negatives.Shard(table, books)
    visited = []
    for q in range(0, 2000, 50):
        query = hard_negatives.Query(q, 0, x[q].astype(float), True, 5, [(hard_negatives.LEAST, -hard_negatives.LEAST - 1, hard_negatives.LEAST)])
        bounds = books.bounds(x[q:q + 1].astype(float))
        assert (x @ x[q] <= bounds[0][0][first] + bounds[1][0][second]).all()
        visited.append(shard.search(query, bounds[0][0], bounds[1][0]))
        score = x @ x[q]
        order = [r for r in np.lexsort((np.arange(2000), -score)) if r != q][:5]
        assert [(-s, r) for s, _, _, r in query.best[0]] == [(score[r], r) for r in order]
    assert np.mean(visited) < 0.6 * len(shard.cells)


def test_query_on_given_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.op12_hard_negatives(spark, sf).collect()
    assert sorted([tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got], key=str) == brute(rows)
