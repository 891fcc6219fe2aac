import numpy as np
import pytest
from pyspark.sql import functions as F

from lumora.operators import projection, relevance, tags

DIM = 12


def gallery(spark, x, parts=5):
    return spark.createDataFrame(
        [(i, i, f"c{i % 3}", v.tolist()) for i, v in enumerate(x)],
        "id long, pos long, category string, v array<float>").repartition(parts)


def vectors(n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, DIM)) * np.linspace(2, 0.5, DIM) + 0.3
    return x.astype(np.float32)


@pytest.mark.parametrize("options", [{}, {"max_packed": 4, "tile_bytes": 900}])
@pytest.mark.parametrize("k", [8, 30])
def test_tags_equal_brute_force(spark, options, k):
    x = vectors() / 4
    x[:100] = x[0]
    labels = vectors(20, 1) / 4
    labels[7] = labels[3]                                  # a tie, broken by vocabulary order
    vocab = spark.createDataFrame(
        [(i, f"l{i}", v.tolist()) for i, v in enumerate(labels)],
        "label_pos long, label string, v array<float>")
    s = x.astype(float) @ labels.astype(float).T
    s[:, 7] = s[:, 3]
    e = np.exp((s - s.max(1, keepdims=True)) * 25)
    p = e / e.sum(1, keepdims=True)
    got = tags.zero_shot_tags(gallery(spark, x), vocab, k, **options).collect()
    assert len(got) == len(x) * min(k, 20)
    by_item = {}
    for r in sorted(got, key=lambda r: (r.id, r["rank"])):
        by_item.setdefault(r.id, []).append((r.label_pos, r.score))
        assert r.label == f"l{r.label_pos}"
    for i, found in by_item.items():
        order = np.lexsort((np.arange(20), -s[i]))[:k]
        assert [f[0] for f in found] == order.tolist()
        assert [f[1] for f in found] == pytest.approx(p[i, order].tolist())
    if k > 20:
        assert sum(f[1] for f in by_item[5]) == pytest.approx(1.0)


def test_moments_and_exact_axes(spark):
    x = vectors()
    m = projection.moments(gallery(spark, x).unionByName(spark.createDataFrame(
        [(900, 900, "c", []), (901, 901, "c", None), (902, 902, "c", [1.0])],
        "id long, pos long, category string, v array<float>")), DIM)
    p = projection.fit(m, DIM, "exact")
    d = x.astype(float)
    c = np.cov(d.T, bias=True) * len(d)
    assert p.used == len(x) and p.mean == pytest.approx(d.mean(0).tolist())
    _, axes = np.linalg.eigh(c)
    assert abs(np.dot(p.pc1, axes[:, -1])) == pytest.approx(1)
    assert abs(np.dot(p.pc2, axes[:, -2])) == pytest.approx(1)
    got = {(r.i, r.j): r.value for r in projection.covariance(m, DIM).collect()}
    assert np.array([[got[i, j] for j in range(DIM)] for i in range(DIM)]) == pytest.approx(c, abs=1e-9)
    mean = projection.mean_vector(gallery(spark, x)).orderBy("dim").collect()
    assert [r["mean"] for r in mean] == pytest.approx(d.mean(0).tolist())


def test_seeded_axes_follow_the_fixed_steps(spark):
    """Matrix-free power iteration over the centred rows, 60 steps, as a cross-check."""
    x = vectors(seed=4)
    p = projection.fit(projection.moments(gallery(spark, x), DIM), DIM)
    d = x.astype(float) - x.astype(float).mean(0)
    axes = []
    for _ in range(2):
        v = np.fmod(np.sin((np.arange(DIM) + 1) * 12.9898) * 43758.5453, 1)
        v /= np.linalg.norm(v)
        for _ in range(60):
            w = d.T @ (d @ v)
            for a in axes:
                w -= (w @ a) * a
            v = w / np.linalg.norm(w)
        axes.append(v)
    assert p.pc1 == pytest.approx(axes[0].tolist(), abs=1e-9)
    assert p.pc2 == pytest.approx(axes[1].tolist(), abs=1e-9)
    assert projection.seed_vector(3)[0] == pytest.approx(
        np.fmod(np.sin(12.9898) * 43758.5453, 1)) and (projection.seed_vector(40) < 0).any()


def test_moments_add_up(spark):
    x = vectors()
    whole = projection.fit(projection.moments(gallery(spark, x), DIM), DIM)
    parts = projection.combine_moments(projection.moments(gallery(spark, x[:100]), DIM),
                                       projection.moments(gallery(spark, x[100:]), DIM))
    assert projection.fit(parts, DIM).pc1 == pytest.approx(whole.pc1)


def test_projection_of_short_and_missing_vectors(spark):
    p = projection.Projection((1.0, 2.0), (1.0, 0.0), (0.0, 1.0), 1)
    g = spark.createDataFrame([(0, [3.0, 5.0]), (1, [3.0]), (2, []), (3, None)], "id long, v array<float>")
    got = {r.id: (r.x, r.y) for r in projection.project(g, p).collect()}
    assert got == {0: (2.0, 3.0), 1: (2.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}


def test_canvas(spark):
    points = spark.createDataFrame([(0, 0.0, 5.0), (1, 1.0, 5.0), (2, 4.0, 5.0)], "id long, x double, y double")
    got = projection.to_canvas(points)
    assert [(r.x, r.y) for r in got.orderBy("id").collect()] == [(26.0, 26.0), (143.0, 26.0), (494.0, 26.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_query_point_stretches_the_canvas_only(spark):
    x = vectors(60)
    far = spark.createDataFrame([(7, (x[0] * 50).tolist())], "qid long, v array<float>")
    rows = projection.galaxy(gallery(spark, x), DIM, far).collect()
    assert len(rows) == 61 and [r.id for r in rows if r.isQuery] == [7]
    xs = [r.x for r in rows]
    assert min(xs) == pytest.approx(26) and max(xs) == pytest.approx(494)


def test_legend_order(spark):
    rows = projection.legend(gallery(spark, vectors(10))).collect()
    assert [(r.category, r.first_pos) for r in rows] == [("c0", 0), ("c1", 1), ("c2", 2)]


def test_relative_relevance(spark):
    rows = [(0, i, s) for i, s in enumerate([1.0, 0.5, 0.44, 0.0])] + [(1, 9, 0.7), (1, 8, 0.7)]
    results = spark.createDataFrame(rows, "qid long, id long, score double")
    got = {(r.qid, r.id): (round(r.rel, 6), r.dim) for r in relevance.relative_relevance(results).collect()}
    assert got == {(0, 0): (1.0, False), (0, 1): (0.5, False), (0, 2): (0.44, True), (0, 3): (0.0, True),
                   (1, 9): (0.0, True), (1, 8): (0.0, True)}
    off = relevance.relative_relevance(results, active=False)
    assert not off.filter(F.col("dim")).count()


def test_attribution(spark):
    items = spark.createDataFrame(
        [("T", "C", "BY 2.0", "http://l", "http://s", False), ("T", "C", "BY", "", "", False),
         ("f.png", None, None, None, None, True)],
        "title string, creator string, license string, licenseUrl string, source string, isUpload boolean")
    got = [tuple(r) for r in relevance.attribution(items).select("credit", "creditLicenseUrl", "creditSource").collect()]
    assert got == [("“T” by C · BY 2.0 · source (via Openverse)", "http://l", "http://s"),
                   ("“T” by C · BY ·  (via Openverse)", None, None), ("Uploaded image", None, None)]


@pytest.mark.parametrize("mode", ["seeded", "exact"])
def test_matrix_free_fit_equals_the_matrix(spark, mode, monkeypatch):
    """A few dimensions through both ways; more than the matrix allows through the one without it."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 24)) * np.linspace(3, 0.2, 24)
    rows = [(i, i, "c", v.tolist()) for i, v in enumerate(x)] + [(900, 900, "c", None), (901, 901, "c", [1.0]), (902, 902, "c", [])]
    g = spark.createDataFrame(rows, "id long, pos long, category string, v array<double>").repartition(3)
    whole = projection.fit(projection.moments(g, 24), 24, mode)
    monkeypatch.setattr(projection, "_PART", 7)
    free = projection.fit_matrix_free(g, 24, mode)
    for a, b in ((whole.mean, free.mean), (whole.pc1, free.pc1), (whole.pc2, free.pc2)):
        assert np.allclose(a, b, atol=1e-5)
    assert free.used == whole.used == 300
    monkeypatch.setattr(projection, "MAX_DIM", 8)
    with pytest.raises(ValueError, match="matrix_free"):
        projection.moments(g, 24)
    if mode == "exact":
        got = {r.id: (r.x, r.y) for r in projection.galaxy(g, 24, mode=mode).collect()}
        monkeypatch.setattr(projection, "MAX_DIM", 24)
        expected = {r.id: (r.x, r.y) for r in projection.galaxy(g, 24, mode=mode).collect()}
        assert len(got) == 303 and all(np.allclose(got[i], expected[i], atol=1e-3) for i in got)
    with pytest.raises(ValueError, match="no vector"):
        projection.fit_matrix_free(g.limit(0), 24, mode)


def test_products_without_the_matrix(spark):
    rng = np.random.default_rng(9)
    x, block = rng.normal(size=(50, 5000)), rng.normal(size=(5000, 2))         # more dimensions than the matrix takes
    g = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(4)
    n, got = projection.covariance_products(g, x.mean(0), block)
    centred = x - x.mean(0)
    assert n == 50 and np.allclose(got, centred.T @ (centred @ block))
