"""Two-dimensional map of a gallery by principal components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.fixed_values import (CANVAS_HEIGHT, CANVAS_PADDING, CANVAS_WIDTH, POWER_ITERATIONS,
                                 SEED_AMPLITUDE, SEED_FREQUENCY)
from lumora.functions.kernels import QueryVectors
from lumora.functions.vectors import dot, vector_literal
from lumora.operators.joins import category_colour
from lumora.plans.freeze import freeze
from lumora.plans.packed import scores_column
from lumora.plans.sums import vector_sums

MAX_DIM = 4096          # the d x d matrix on the driver: 134 MB at this bound


def moments(gallery: DataFrame, dim: int) -> DataFrame:
    """(i, n, total): row i of the Gram matrix XᵀX for i in 0..dim-1, and the
    component sums as row ``dim``.

    One pass.  Each task multiplies its batches and emits dim+1 rows once; rows are
    then summed per ``i``.  Vectors of another length (or NULL) are left out; their
    number is the item count minus ``n``.
    """
    if dim > MAX_DIM:
        raise ValueError(f"{dim} dimensions: the matrix is built for at most {MAX_DIM}; see fit_matrix_free")

    def partial(batches):
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks, list_array

        n, gram = 0, np.zeros((dim + 1, dim))
        for batch in batches:
            for _, x in equal_length_blocks(batch.column(0), 16_384):
                if x.shape[1] == dim:
                    n += len(x)
                    gram[:dim] += x.T @ x
                    gram[dim] += x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim + 1)), pa.array(np.full(dim + 1, n)), list_array(gram)],
                names=["i", "n", "total"])

    parts = gallery.select("v").mapInArrow(partial, "i long, n long, total array<double>")
    return combine_moments(parts)


def combine_moments(*parts: DataFrame) -> DataFrame:
    """Moments add up: new arrivals are merged without rescanning the gallery."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("i").agg(
        F.sum("n").alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector(F.col("total")))).alias("total"))


def mean_vector(gallery: DataFrame, dim: int | None = None) -> DataFrame:
    """(dim, mean): one row per component.

    With ``dim``, over the vectors of that length; else over all that are not missing or
    empty, which must be of one length."""
    sums = vector_sums(gallery.select(F.lit(0).alias("k"), "v"), "k", "v", "int", dim)
    return sums.select("n", F.posexplode("total").alias("dim", "t")).select(
        F.col("dim").cast("long"), (F.col("t") / F.col("n")).alias("mean"))


def covariance(gram: DataFrame, dim: int) -> DataFrame:
    """(i, j, value) of the centred product XcᵀXc = XᵀX - s sᵀ / n."""
    row = gram.filter(F.col("i") < dim)
    sums = gram.filter(F.col("i") == dim).select(F.col("total").alias("s")).scalar()
    return (row.withColumn("s", sums)
            .select("i", "n", "s", F.posexplode("total").alias("j", "g"))
            .select("i", F.col("j").cast("long").alias("j"),
                    (F.col("g") - F.get("s", F.col("i").cast("int")) * F.get("s", F.col("j"))
                     / F.col("n")).alias("value")))


@dataclass(frozen=True)
class Projection:
    """A fitted map: mean and two unit axes.  ``used`` vectors went into the fit."""

    mean: tuple[float, ...]
    pc1: tuple[float, ...]
    pc2: tuple[float, ...]
    used: int

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(list(self.mean), list(self.pc1), list(self.pc2), self.used)],
            "mean array<double>, pc1 array<double>, pc2 array<double>, used long")


def seed_vector(dim: int) -> np.ndarray:
    """Start of the power iteration; the remainder keeps the sign of its dividend."""
    return np.fmod(np.sin(np.arange(1, dim + 1) * SEED_FREQUENCY) * SEED_AMPLITUDE, 1.0)


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.sqrt(v @ v)
    return v / (n if n > 0 else 1.0)


def _power(c: np.ndarray, against: np.ndarray | None, iterations: int) -> np.ndarray:
    v = _unit(seed_vector(len(c)))
    for _ in range(iterations):
        w = c @ v
        if against is not None:
            w = w - (w @ against) * against
        v = _unit(w)
    return v


def fit(gram: DataFrame, dim: int, mode: str = "seeded",
        iterations: int = POWER_ITERATIONS) -> Projection:
    """Fit from :func:`moments`: dim+1 rows reach the driver, whatever the data size.

    ``seeded`` runs the fixed number of power steps from the fixed seed, converged or
    not; ``exact`` takes the two leading eigenvectors, signed towards the seed.
    """
    rows = {r["i"]: r for r in gram.filter(F.col("i") <= dim).collect()}
    if not rows:
        raise ValueError(f"no vector of dimension {dim} to fit on")
    n = rows[dim]["n"]
    s = np.array(rows[dim]["total"])
    g = np.array([rows[i]["total"] for i in range(dim)])
    c = g - np.outer(s, s) / n
    if mode == "seeded":
        pc1 = _power(c, None, iterations)
        pc2 = _power(c, pc1, iterations)
    elif mode == "exact":
        _, axes = np.linalg.eigh((c + c.T) / 2)
        seed = seed_vector(dim)
        pc1, pc2 = (a if a @ seed >= 0 else -a for a in (axes[:, -1], axes[:, -2]))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return Projection(tuple((s / n).tolist()), tuple(pc1.tolist()), tuple(pc2.tolist()), int(n))


def covariance_products(vectors: DataFrame, mean: np.ndarray, block: np.ndarray) -> tuple[int, np.ndarray]:
    """(n, XcᵀXc·block) without the matrix: one pass over ``vectors`` (v, all of one dimension).

    ``block`` has a column per product.  A task adds up its own rows and sends one sum per
    ``_PART`` components and column, which are added up again before one copy of the product reaches the driver.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    dim, width = block.shape
    shipped = vectors.sparkSession.sparkContext.broadcast((mean, block, mean @ block))

    def partial(batches):
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks, list_array

        mu, b, offset = shipped.value
        n, product, sums = 0, np.zeros((dim, width)), np.zeros(width)
        for batch in batches:
            for _, x in equal_length_blocks(batch.column(0), max(1, 16_777_216 // (8 * max(1, dim)))):
                if x.shape[1] == dim:
                    s = x @ b - offset
                    product += x.T @ s
                    sums += s.sum(0)
                    n += len(x)
        if n:
            flat = (product - np.outer(mu, sums)).T.ravel()
            parts = -(-len(flat) // _PART)
            rows = np.zeros(parts * _PART)
            rows[:len(flat)] = flat
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(parts)), pa.array(np.full(parts, n)), list_array(rows.reshape(parts, _PART))],
                names=["part", "n", "total"])

    total = vector_to_array(Summarizer.sum(array_to_vector(F.col("total"))))
    rows = (vectors.select("v").mapInArrow(partial, "part long, n long, total array<double>")
            .groupBy("part").agg(F.sum("n").alias("n"), total.alias("total")).collect())
    shipped.unpersist()
    if not rows:
        return 0, np.zeros((dim, width))
    flat = np.concatenate([r["total"] for r in sorted(rows, key=lambda r: r["part"])])
    return rows[0]["n"], flat[:dim * width].reshape(width, dim).T


_PART = 4096


def fit_matrix_free(gallery: DataFrame, dim: int, mode: str = "seeded", iterations: int = POWER_ITERATIONS,
                    tolerance: float = 1e-12) -> Projection:
    """Fit without forming the dim x dim matrix, for any dimension.

    Vectors are written once and read once per step.  ``seeded``: the same power steps as
    :func:`fit`, first for one axis, then for the other against it.  ``exact``: orthogonal
    iteration on a block of ten vectors, one pass a step, until the two leading
    directions stand still (their change is below ``tolerance``) or after 1000 steps.
    """
    vectors = freeze(gallery.filter(F.col("v").isNotNull() & (F.size("v") == dim)).select("v"))
    sums = vector_sums(vectors.select(F.lit(0).alias("k"), "v"), "k", "v", "int", dim).first()
    if sums is None:
        raise ValueError(f"no vector of dimension {dim} to fit on")
    mean = np.array(sums["total"]) / sums["n"]
    seed = seed_vector(dim)
    if mode == "seeded":
        axes: list[np.ndarray] = []
        for _ in range(2):
            v = _unit(seed)
            for _ in range(iterations):
                w = covariance_products(vectors, mean, v[:, None])[1][:, 0]
                for a in axes:
                    w = w - (w @ a) * a
                v = _unit(w)
            axes.append(v)
    elif mode == "exact":
        width = min(dim, 10)
        q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(dim, width)))
        last = np.zeros((dim, 2))
        for _ in range(1000):
            product = covariance_products(vectors, mean, q)[1]
            values, turn = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
            lead = np.zeros((dim, 2))
            lead[:, :min(2, width)] = (q @ turn[:, ::-1])[:, :2]
            lead *= np.where(seed @ lead >= 0, 1, -1)
            if np.abs(lead - last).max() < tolerance ** 0.5:
                break
            last = lead
            q, _ = np.linalg.qr(product)
        axes = [lead[:, 0], lead[:, 1]]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return Projection(tuple(mean.tolist()), tuple(axes[0].tolist()), tuple(axes[1].tolist()), int(sums["n"]))


def fit_gallery(gallery: DataFrame, dim: int, mode: str = "seeded") -> Projection:
    """Fit in one pass through the matrix where it is small enough, else without it."""
    if dim > MAX_DIM:
        return fit_matrix_free(gallery, dim, mode)
    return fit(moments(gallery, dim), dim, mode)


def project(gallery: DataFrame, p: Projection) -> DataFrame:
    """Replace ``v`` by ``x, y``: the centred vector on both axes; no shuffle."""
    axes = QueryVectors([0, 1], [p.pc1, p.pc2])
    mean = np.array(p.mean)
    length = F.coalesce(F.size("v"), F.lit(0))

    def centre(axis):
        # a short or missing vector is centred over the components it has
        partial = dot(F.slice(vector_literal(p.mean), F.lit(1), length), vector_literal(axis))
        return F.when(length >= len(mean), F.lit(float(mean @ np.array(axis)))).otherwise(partial)

    s = gallery.withColumn("__s", scores_column(gallery, "v", axes))
    return (s.withColumn("x", F.get("__s", F.lit(0)) - centre(p.pc1))
            .withColumn("y", F.get("__s", F.lit(1)) - centre(p.pc2)).drop("v", "__s"))


def to_canvas(points: DataFrame, *, width: float = CANVAS_WIDTH, height: float = CANVAS_HEIGHT,
              padding: float = CANVAS_PADDING) -> DataFrame:
    """Min-max scale ``x, y`` into the padded canvas; an extent of zero counts as one.

    The four extents are a scalar subquery, not a join or a one-task window.
    ``points`` is read twice; freeze it first if it is costly to compute.
    """
    extents = points.agg(F.struct(
        F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1")).alias("e")).scalar()

    def scaled(c, low, high, size):
        span = F.col(f"__e.{high}") - F.col(f"__e.{low}")
        span = F.when(span == 0.0, 1.0).otherwise(span)
        return padding + (F.col(c) - F.col(f"__e.{low}")) / span * (size - 2 * padding)

    return (points.withColumn("__e", extents)
            .withColumn("x", scaled("x", "x0", "x1", width))
            .withColumn("y", scaled("y", "y0", "y1", height)).drop("__e"))


def galaxy(gallery: DataFrame, dim: int, queries: DataFrame | None = None,
           mode: str = "seeded") -> DataFrame:
    """The scaled map of a gallery (id, pos, category, x, y, isQuery).

    Query points are projected and count for the extents, but not for the fit.
    """
    return canvas(gallery, fit_gallery(gallery, dim, mode), queries)


def canvas(gallery: DataFrame, p: Projection, queries: DataFrame | None = None) -> DataFrame:
    """The scaled map of a gallery on axes that are fitted already (id, pos, category, x, y, isQuery)."""
    points = gallery.select("id", "pos", "category", "v", F.lit(False).alias("isQuery"))
    if queries is not None:
        points = points.unionByName(queries.select(
            F.col("qid").alias("id"), "v", F.lit(True).alias("isQuery")), allowMissingColumns=True)
    return to_canvas(freeze(project(points, p)))


def legend(gallery: DataFrame) -> DataFrame:
    """Distinct categories in first-seen order with their colour."""
    return (gallery.groupBy("category").agg(F.min("pos").alias("first_pos"))
            .withColumn("colour", category_colour("category")).orderBy("first_pos"))
