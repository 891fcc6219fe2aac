import math
import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumora import fixed_values as fv
from lumora.functions.kernels import sequential_dots
from lumora.operators import evaluate
from lumora.plans.freeze import freeze
from lumora.plans.numbering import number_rows

# A known ranking's five best ids per category (three items per
# category, ids dense in plan order) and the figures published for it.
TOP_IDS = [
    [1, 2, 0, 5, 26], [5, 4, 3, 21, 19], [6, 7, 11, 33, 8], [10, 9, 11, 34, 33],
    [12, 13, 14, 30, 31], [15, 16, 17, 30, 19], [20, 19, 18, 21, 30], [21, 22, 23, 34, 29],
    [25, 24, 26, 28, 29], [29, 28, 27, 34, 33], [30, 31, 32, 6, 10], [34, 33, 9, 35, 10],
]
AP = [1, 1, 0.867, 1, 1, 1, 1, 1, 1, 1, 1, 0.917]
P3 = [1, 1, 0.667, 1, 1, 1, 1, 1, 1, 1, 1, 0.667]


def golden(spark):
    rows = []
    for qid, top in enumerate(TOP_IDS):
        order = top + [i for i in range(36) if i not in top]
        rows += [(qid, i, i, 1.0 - place / 100, i // 3 == qid) for place, i in enumerate(order)]
    return spark.createDataFrame(rows, "qid long, id long, pos long, score double, rel boolean")


def test_published_metrics(spark):
    metrics = freeze(evaluate.query_metrics(evaluate.ranked_relevance(golden(spark))))
    rows = metrics.orderBy("qid").collect()
    assert [r.topIds for r in rows] == TOP_IDS
    assert [r.ap for r in rows] == AP and {r.rr for r in rows} == {1.0}
    assert [round(r.pAt["3"], 3) for r in rows] == P3
    assert {r.nRelevant for r in rows} == {3} and {r.pAt["5"] for r in rows} == {0.6}
    total = evaluate.aggregate(metrics, 36)
    t = total.first()
    assert (t.queries, t.gallerySize, t.mAP, t.mrr) == (12, 36, 0.982, 1.0)
    assert t.pAt == {"1": 1.0, "3": 0.944, "5": 0.6}
    assert [tuple(r) for r in evaluate.report(total).collect()] == [
        ("mean AP", "0.982"), ("MRR", "1.00"), ("Precision@1", "1.00"), ("Precision@3", "0.94")]


def brute(x, cats, q, targets):
    s = sequential_dots(x.astype(np.float64), q)
    out = []
    for j, target in enumerate(targets):
        order = np.lexsort((np.arange(len(x)), -s[:, j]))
        rel = [cats[i] == target for i in order]
        hits, total = 0, 0.0
        for place, r in enumerate(rel, 1):
            if r:
                hits += 1
                total += hits / place
        first = rel.index(True) + 1 if True in rel else None
        out.append((sum(rel), {str(k): sum(rel[:k]) / k for k in (1, 3, 5)},
                    1 / first if first else 0.0, total / hits if hits else 0.0,
                    [int(i) for i in order[:5]]))
    return out


@pytest.mark.parametrize("n,options", [
    (900, {}), (900, {"max_packed": 2, "tile_bytes": 2000}), (900, {"max_packed": 2, "block_rows": 1}), (2, {})])
def test_evaluate_equals_brute_force(spark, n, options):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    x[: n // 3] = x[0]                                     # one score for a third of the gallery
    cats = [None if i % 11 == 0 else f"c{i % 3}" for i in range(n)]
    q = rng.normal(size=(5, 8))
    targets = ["c0", "c1", "c2", "c0", "absent"]
    gallery = spark.createDataFrame(
        [(i, i, c, v.tolist()) for i, (c, v) in enumerate(zip(cats, x))],
        "id long, pos long, category string, v array<float>").repartition(6)
    queries = spark.createDataFrame(
        [(j, f"q{j}", t, v.tolist()) for j, (t, v) in enumerate(zip(targets, q))],
        "qid long, query string, category string, v array<double>")
    rows = evaluate.evaluate(gallery, queries, **options).orderBy("qid").collect()
    items = gallery.select("id", "pos", "category").filter("category IS NOT NULL")
    older = items.withColumn("pos", F.col("pos") - 10_000).withColumn("category", F.lit("c0"))
    joined = evaluate.evaluate(gallery.drop("category"), queries, items=items.unionByName(older), **options)
    for a, b in zip(joined.orderBy("qid").collect(), rows, strict=True):
        assert (a.qid, a.nRelevant, a.topIds, a.pAt) == (b.qid, b.nRelevant, b.topIds, b.pAt)
        assert a.ap_exact == pytest.approx(b.ap_exact) and a.rr_exact == b.rr_exact
    for row, (found, p_at, rr, ap, top) in zip(rows, brute(x, cats, q, targets), strict=True):
        assert row.nRelevant == found and row.topIds == top
        assert row.pAt == pytest.approx(p_at) and row.rr_exact == pytest.approx(rr)
        assert row.ap_exact == pytest.approx(ap)


def test_interleaved_queries(spark, monkeypatch):
    """Queries whose sort prefixes collide share runs; the metrics must not care."""
    monkeypatch.setattr(evaluate, "_sort_prefix", lambda: F.floor((1 - F.col("score")) * 50).cast("long"))
    metrics = evaluate.query_metrics(evaluate.ranked_relevance(golden(spark))).orderBy("qid").collect()
    assert [r.topIds for r in metrics] == TOP_IDS and [r.ap for r in metrics] == AP


def test_no_window_over_a_whole_gallery(spark):
    ranked = evaluate.ranked_relevance(golden(spark))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("rows", [None, 2000])
def test_number_rows_equals_window(spark, groups, rows):
    df = spark.range(2000).select(
        "id", F.when(F.col("id") < 700, None).otherwise(F.col("id") % 3).alias("g"),
        (F.col("id") % 5).alias("s"))
    order = [F.col("s").desc(), F.col("id").asc()]
    got = {r.id: r.n for r in number_rows(df, order, "n", groups, rows).collect()}
    seen: dict = {}
    for r in sorted(df.collect(), key=lambda r: (-r.s, r.id)):
        key = r.g if groups else 0
        seen[key] = seen.get(key, 0) + 1
        assert got[r.id] == seen[key]


@pytest.mark.parametrize("rows", [None, 300, 200_000])
def test_number_rows_leaves_other_columns_alone(spark, rows):
    """Whatever size is told, and whatever the columns are called."""
    names = ("__row", "__part", "__n", "__first", "__SHIFT")
    df = spark.range(300).select("id", *[((F.col("id") * k) % 300).alias(c) for k, c in zip((7, 11, 13, 17, 19), names)])
    got = number_rows(df, [F.col("__row").desc()], "n", rows=rows).collect()
    want = sorted(df.collect(), key=lambda r: -r["__row"])
    assert [tuple(r) for r in sorted(got, key=lambda r: r.n)] == [(*r, i) for i, r in enumerate(want, 1)]


def test_report_cutoffs():
    assert fv.PRECISION_CUTOFFS == (1, 3, 5)


def test_means_are_summed_in_query_order(spark):
    """Forty values whose mean lies next to a tie: added up in another order it rounds the other way."""
    r = random.Random(18)
    values = [r.randint(0, 1000) / 1000 for _ in range(40)]
    total = 0.0
    for x in values:
        total += x
    expected = float(Decimal(total / 40).quantize(Decimal("0.001"), ROUND_HALF_UP))
    assert expected != float(Decimal(math.fsum(values) / 40).quantize(Decimal("0.001"), ROUND_HALF_UP))
    rows = [(q, x, x, x, x, {"1": x, "3": x, "5": x}) for q, x in enumerate(values)]
    schema = "qid long, ap double, rr double, ap_exact double, rr_exact double, pAt map<string,double>"
    for parts in (1, 3, 13):
        t = evaluate.aggregate(spark.createDataFrame(rows, schema).orderBy(F.rand(parts)).repartition(parts), 7).first()
        assert (t.queries, t.gallerySize, t.mAP, t.mrr) == (40, 7, expected, expected)
        assert set(t.pAt.values()) == {expected} and t.mAP_exact == total / 40
    none = evaluate.aggregate(spark.createDataFrame([], schema), 7).first()
    assert (none.queries, none.gallerySize, none.mAP, none.mrr) == (0, 7, None, None)


def test_tasks_follow_the_number_of_pairs(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lumora.operators import evaluate as ev

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    items = spark.createDataFrame([(i, i, f"c{i % 3}") for i in range(300)], "id long, pos long, category string")
    vectors = spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "id long, pos long, v array<double>")
    queries = spark.createDataFrame([(j, f"q{j}", f"c{j % 3}", rng.normal(size=4).tolist()) for j in range(20)],
                                    "qid long, query string, category string, v array<double>")
    columns = ["qid", "nRelevant", "rr_exact", "ap_exact", "topIds"]
    plain = [tuple(r) for r in ev.evaluate(vectors, queries, items=items).select(columns).orderBy("qid").collect()]
    sizes, ranked = [], ev.ranked_relevance

    def watched(scored, *args, **kwargs):
        sizes.extend(r["count"] for r in scored.groupBy(F.spark_partition_id()).count().collect())
        return ranked(scored, *args, **kwargs)

    monkeypatch.setattr(ev, "PAIRS_PER_TASK", 200)
    monkeypatch.setattr(ev, "ranked_relevance", watched)
    got = [tuple(r) for r in ev.evaluate(vectors, queries, items=items).select(columns).orderBy("qid").collect()]
    assert got == plain and sum(sizes) == 6000
    assert max(sizes) <= 3 * 200
