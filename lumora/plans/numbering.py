"""Row numbers over data of any size, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

_INDEX_BITS = 33        # monotonically_increasing_id: partition above, row below


def range_sorted(df: DataFrame, *order: Column, rows: int | None = None) -> DataFrame:
    """Range-partition by the full sort key and sort each partition.

    The key should end in something unique, so that equal leading values (one hot
    group, a third of all scores equal) are still split over many partitions.
    One partition for every ``RANGE_ROWS`` of ``rows``, where the caller knows their
    number; else ``spark.sql.shuffle.partitions``.
    """
    n = (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if rows is None
         else max(1, -(-rows // RANGE_ROWS)))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


RANGE_ROWS = 250_000


def _unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def number_rows(df: DataFrame, order: Sequence[Column], out: str,
                groups: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Add 1-based ``out``: the row's place within its group, by ``order``.

    Same values as ``row_number().over(partitionBy(groups).orderBy(order))``, but a
    group may span partitions.  Rows are sorted across the cluster once and frozen
    with their index inside the partition; per-partition counts give the offsets.
    The way is the same for every size; ``rows``, where the caller has counted them,
    gives the number of partitions only.  ``order`` must be a total order within the
    group.  ``df`` is read twice; freeze it first if it is costly to compute.
    """
    groups = list(groups)
    row, part, shift = _unused(df, "__row", "__part", "__shift")
    placed = range_sorted(df, *[F.col(g) for g in groups], *order, rows=rows).withColumn(
        row, F.monotonically_increasing_id())
    left = freeze(placed).withColumn(part, F.shiftright(row, _INDEX_BITS))
    n, first = _unused(left, "__n", "__first")
    counts = left.groupBy(part, *groups).agg(F.count(F.lit(1)).alias(n), F.min(row).alias(first))
    earlier = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0)))
    earlier = earlier.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = freeze(counts.select(
        part, *groups, (F.coalesce(F.sum(n).over(earlier), F.lit(0)) - F.col(first) + 1).alias(shift)))
    same = left[part] == offsets[part]
    for g in groups:
        same &= left[g].eqNullSafe(offsets[g])
    return (left.join(offsets, same, "left")
            .select(*[left[c] for c in df.columns],
                    (left[row] + offsets[shift]).cast("long").alias(out)))
