import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumora.functions import bulk, text, vectors
from lumora.functions.kernels import QueryVectors, equal_length_blocks, sequential_dots


def one(spark, value, build, kind="array<double>"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build("v")).first()[0]


def test_normalize_guards(spark):
    assert one(spark, [3.0, 4.0], vectors.l2_normalize) == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], vectors.l2_normalize) == [0.0, 0.0]
    got = one(spark, [math.nan, 2.0], vectors.l2_normalize)
    assert math.isnan(got[0]) and got[1] == 2.0
    assert one(spark, [], vectors.l2_normalize) == []
    assert one(spark, None, vectors.l2_normalize) is None


def test_normalize_is_scale_invariant(spark):
    v = np.random.default_rng(0).normal(size=32)
    a = one(spark, v.tolist(), vectors.l2_normalize)
    b = one(spark, (v * 1024).tolist(), vectors.l2_normalize)
    assert a == b and abs(np.linalg.norm(a) - 1) < 1e-12


def test_quantize_rounds_halves_up(spark):
    got = one(spark, [0.5e-5, -0.5e-5, 1.5e-5, -1.5e-5, 0.123456], vectors.quantize)
    assert got == [1e-5, 0.0, 2e-5, -1e-5, 0.12346]
    below = np.nextafter(0.5, 0).item()
    assert one(spark, [below], lambda c: vectors.quantize(c, 0)) == [0.0]


def test_float32_keeps_five_decimals(spark):
    v = [round(x, 5) for x in np.random.default_rng(1).uniform(-1, 1, 200).tolist()]
    assert one(spark, v, lambda c: vectors.quantize(vectors.to_float32(c))) == v


@pytest.mark.parametrize("a,b,expected", [
    ([1.0, 2.0, 3.0], [4.0, 5.0], 14.0), ([1.0], [2.0, 9.0], 2.0),
    ([], [1.0], 0.0), (None, [1.0], 0.0), ([2.0, 3.0], [4.0, 5.0], 23.0)])
def test_dot_uses_the_shorter_length(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a array<float>, b array<double>")
    assert df.select(vectors.dot("a", "b")).first()[0] == expected


def test_column_and_kernel_agree_bit_for_bit(spark):
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(50, 24)).astype(np.float32), rng.normal(size=24)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<float>")
    got = [r[0] for r in df.orderBy("i").select(vectors.dot("v", vectors.vector_literal(q))).collect()]
    assert got == sequential_dots(x.astype(np.float64), q[None, :])[:, 0].tolist()


def test_bulk_equals_expressions(spark):
    rng = np.random.default_rng(3)
    rows = [None, [], [0.0, 0.0], [0.5e-5, -1.5e-5, 7.0], *rng.normal(size=(40, 9)).tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v array<double>").coalesce(2)
    for name in ("l2_normalize", "quantize"):
        both = df.select("i", getattr(bulk, name)("v").alias("a"), getattr(vectors, name)("v").alias("b"))
        for r in both.collect():
            assert r.a == r.b
    floats = df.select(vectors.to_float32("v").alias("v"))
    assert floats.filter(~bulk.l2_normalize("v").eqNullSafe(vectors.l2_normalize("v"))).count() == 0


def test_norm_is_evaluated_once(spark):
    plan = spark.createDataFrame([([1.0],)], "v array<double>").select(vectors.l2_normalize("v").alias("u"))
    lines = plan._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count("aggregate(") == 1


def test_ragged_blocks():
    import pyarrow as pa
    column = pa.array([[1.0, 2.0], None, [3.0], [4.0, 5.0], []], pa.list_(pa.float32()))
    got = {}
    for rows, x in equal_length_blocks(column.slice(0), 2):
        got.update({int(r): v.tolist() for r, v in zip(rows, x)})
    assert got == {0: [1, 2], 1: [], 2: [3], 3: [4, 5], 4: []}
    sliced = pa.array([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0]]).slice(1)
    assert [x.tolist() for _, x in equal_length_blocks(sliced, 10)] == [[[1, 2], [3, 4]]]
    q = QueryVectors([7, 8], [[1.0, 1.0], [2.0]])
    assert q.scores(np.array([[3.0, 4.0]])).tolist() == [[7.0, 6.0]]


def test_trim_covers_all_blanks(spark):
    padded = "﻿ \t  x y 　 \n"
    assert one(spark, padded, text.trim_blank, "string") == "x y"
    assert one(spark, "a \u0085", text.trim_blank, "string") == "a \u0085"
    assert one(spark, "   ", text.trim_blank, "string") == ""


def test_first_filled(spark):
    df = spark.createDataFrame([("", "u"), (None, "u"), ("t", "u"), ("", ""), (None, None)], "t string, u string")
    assert [r[0] for r in df.select(text.first_filled("t", "u")).collect()] == ["u", "u", "t", None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(
    st.floats(0, 1), st.integers(0, 2000).map(lambda n: n / 2000),
    st.integers(0, 2000).map(lambda n: np.nextafter(n / 2000, 0.0).item() if n else 0.0)),
    min_size=200, max_size=400), st.sampled_from([2, 3]))
def test_to_fixed_is_exact(spark, xs, digits):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = [(r.f, r.t) for r in df.select("i", text.to_fixed("x", digits).alias("f"),
                                         text.fixed_text("x", digits).alias("t")).orderBy("i").collect()]
    for x, (f, t) in zip(xs, got):
        expected = Decimal(float(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
        assert (f, t) == (float(expected), str(expected))


def test_prompt_and_colours(spark):
    from lumora.operators.joins import category_colour
    df = spark.createDataFrame([("dog",), ("upload",), ("zebra",), (None,)], "c string")
    assert df.select(text.prompt("c")).first()[0] == "a photo of dog"
    assert [r[0] for r in df.select(category_colour(F.col("c"))).collect()] == [
        "#f97316", "#ffffff", "#94a3b8", "#94a3b8"]
