"""Use the whole cluster for work that is heavy per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Repartition for heavy work per row; None leaves the table where it is.

    A small table tends to arrive as one file or row group, that is, one task, and moving
    it costs little beside encoding it.  Larger tables come in splits enough.  Only the
    caller knows which it is.
    """
    return df if partitions is None else df.repartition(partitions)
