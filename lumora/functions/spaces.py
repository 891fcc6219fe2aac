"""Which model a vector column comes from, kept in the column's metadata.

Vectors of different models, dtypes or dimensions cannot be compared, and nothing in
the numbers shows it.  Embedding marks the column; selecting, joining, grouping and parquet
files keep the mark.  A column without a mark is taken as it is.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Space(NamedTuple):
    model: str
    dtype: str
    dim: int


class DifferentSpaces(ValueError):
    """Vectors that cannot be compared."""


_KEY = "lumora.space"


def marked(v: Column | str, space: Space | None, name: str = "v") -> Column:
    """The column with its mark; as it is where there is none."""
    v = F.col(v) if isinstance(v, str) else v
    return v.alias(name, metadata={_KEY: list(map(str, space))}) if space else v.alias(name)


def space_of(df: DataFrame, vector: str = "v") -> Space | None:
    if vector not in df.columns:
        return None
    mark = (df.schema[vector].metadata or {}).get(_KEY)
    return Space(mark[0], mark[1], int(mark[2])) if mark else None


def require_same_space(a: DataFrame, b: DataFrame, vector: str = "v") -> None:
    """Refuse to compare marked vectors of different models, dtypes or dimensions."""
    left, right = space_of(a, vector), space_of(b, vector)
    if left and right:
        for field, x, y in zip(Space._fields, left, right):
            if x != y:
                raise DifferentSpaces(f"embedding sets differ in {field}: {x} and {y}")
