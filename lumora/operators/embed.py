"""Batch embedding with an encoder the caller supplies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumora.functions.bulk import unit_rows
from lumora.functions.spaces import Space, marked
from lumora.functions.text import trim_blank
from lumora.functions.vectors import l2_norm
from lumora.plans.spread import spread


@dataclass(frozen=True)
class Encoder:
    """How to turn a batch of inputs into vectors.

    ``load`` runs once per Python worker and returns a function from an array of
    strings or bytes to a matrix with ``dim`` columns.  An input that cannot be
    decoded yields a row of NaN.
    """

    model: str
    dtype: str
    dim: int
    load: Callable[[], Callable[[np.ndarray], np.ndarray]]

    @property
    def space(self) -> Space:
        return Space(self.model, self.dtype, self.dim)


class UndecodableInput(ValueError):
    """Some inputs could not be embedded and the caller asked for all or nothing."""


def encode(column: Column | str, encoder: Encoder, batch_size: int = 64) -> Column:
    """Unit vector of each input, in double precision; NaN where it cannot be decoded."""
    load = encoder.load

    def make():
        model = load()
        return lambda inputs: unit_rows(np.asarray(model(inputs), dtype=np.float64))

    run = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    return run(column)


def embed(df: DataFrame, column: str, encoder: Encoder, *, batch_size: int = 64,
          on_bad: str = "fail", partitions: int | None = None) -> DataFrame:
    """Add ``v``, the unit vector of ``column``, marked with the encoder's space.

    ``partitions``: deal the rows over so many tasks first, for a table that would be read
    in fewer tasks than the cluster has cores.
    ``on_bad``: ``fail`` stops the job at the first undecodable input, ``keep`` leaves
    its ``v`` NULL for :func:`split_bad`.
    """
    raw = spread(df, partitions).withColumn("__raw", encode(column, encoder, batch_size))
    bad = F.exists("__raw", lambda x: x.isNull() | F.isnan(x))      # Arrow may turn NaN into NULL
    unit = F.col("__raw")
    if on_bad == "fail":
        value = F.when(bad, F.raise_error(F.lit(f"undecodable input in {column}"))
                       .cast("array<double>")).otherwise(unit)
    elif on_bad == "keep":
        value = F.when(~bad, unit)
    else:
        raise ValueError(f"unknown on_bad {on_bad!r}")
    carried = [c for c in raw.columns if c not in ("__raw", "v")]
    return raw.select(*carried, marked(value, encoder.space))


def split_bad(embedded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, undecodable) rows of ``embed(..., on_bad="keep")``."""
    return embedded.filter(F.col("v").isNotNull()), embedded.filter(F.col("v").isNull()).drop("v")


def clean_query_text(queries: DataFrame, column: str = "query") -> DataFrame:
    """Trim; blank queries are dropped."""
    return (queries.withColumn(column, trim_blank(column)).filter(F.length(column) > 0))


def profile(vectors: DataFrame) -> DataFrame:
    """One row: count, dimension range and norm range."""
    size, norm = F.size("v"), l2_norm("v")
    return vectors.select(size.alias("d"), norm.alias("n")).agg(
        F.count(F.lit(1)).alias("count"), F.min("d").alias("dim_min"), F.max("d").alias("dim_max"),
        F.min("n").alias("norm_min"), F.max("n").alias("norm_max"))


def header(vectors: DataFrame, encoder: Encoder, tolerance: float = 1e-2) -> DataFrame:
    """The one-row header of an embedding set, measured rather than asserted."""
    p = profile(vectors)
    unit = (F.abs(F.col("norm_min") - 1) <= tolerance) & (F.abs(F.col("norm_max") - 1) <= tolerance)
    return p.select(F.lit(encoder.model).alias("model"), F.lit(encoder.dtype).alias("dtype"),
                    F.coalesce("dim_max", F.lit(0)).cast("long").alias("dim"),
                    F.coalesce(unit, F.lit(True)).alias("normalized"), "count")


def check_comparable(a: DataFrame, b: DataFrame) -> None:
    """Refuse to compare vectors of different models, dtypes or dimensions."""
    left, right = a.first(), b.first()
    for field in ("model", "dtype", "dim"):
        if left[field] != right[field]:
            raise ValueError(f"embedding sets differ in {field}: {left[field]} and {right[field]}")


def check_uniform(vectors: DataFrame, dim: int) -> None:
    """Refuse a set with missing vectors or vectors of another length than ``dim``."""
    p = profile(vectors.filter(F.col("v").isNotNull())).first()
    missing = vectors.filter(F.col("v").isNull()).count()
    if missing:
        raise ValueError(f"{missing} vectors are missing")
    if p["count"] and not p["dim_min"] == p["dim_max"] == dim:
        raise ValueError(f"expected dimension {dim}, found {p['dim_min']} to {p['dim_max']}")
