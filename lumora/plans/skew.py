"""A left join that does not care how often a key repeats on the left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

HOT_ROWS = 1_000_000


def skew_left_join(left: DataFrame, right: DataFrame, key: str,
                   one_per_key: Callable[[DataFrame], DataFrame],
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` ⟕ ``one_per_key(right)`` on ``key``.

    Adaptive execution cannot split a hot key where the other side is aggregated on the
    way to the join.  So keys (NULL included) with more than ``hot_rows`` left rows are
    counted first, and if there are any they are joined apart: there can be only few,
    their right rows are frozen, and Catalyst broadcasts those by their known size.
    """
    counts = left.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__rows"))
    hot = freeze(counts.filter(F.col("__rows") > hot_rows).select("__hot"))
    if hot.isEmpty():
        return left.join(one_per_key(right), key, "left")

    def side(df, how):
        return df.join(hot, F.col(key).eqNullSafe(F.col("__hot")), how)

    few = freeze(one_per_key(side(right, "left_semi")))
    apart = side(left, "left_semi").join(few, key, "left")
    return side(left, "left_anti").join(one_per_key(right), key, "left").unionByName(apart)
