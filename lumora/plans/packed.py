"""Ship a small table of query vectors to every task, once its size is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumora.functions.kernels import QueryVectors, list_array

MAX_ROWS = 4096
MAX_BYTES = 64 << 20


def pack(queries: DataFrame, *, qid: str = "qid", vector: str = "v",
         exclude: str | None = None, max_rows: int = MAX_ROWS) -> QueryVectors | None:
    """Fetch at most ``max_rows`` query vectors of ``MAX_BYTES``; None if there are more.

    They are counted and measured first, so neither the driver nor a task ever holds a
    large table.  Callers must have a path for None (see :mod:`lumora.plans.tiles`).
    """
    wanted = [F.col(qid).cast("long").alias("qid"), F.col(vector).alias("v")]
    if exclude:
        wanted.append(F.col(exclude).cast("long").alias("exclude"))
    few = queries.select(*wanted)
    n, size = few.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("v")), F.lit(0))).first()
    if n > max_rows or size > MAX_BYTES:
        return None
    rows = few.toArrow().to_pylist()
    rows.sort(key=lambda r: r["qid"])
    return QueryVectors([r["qid"] for r in rows], [r["v"] for r in rows],
                        [r["exclude"] for r in rows] if exclude else None)


def scores_column(gallery: DataFrame, vector: str, packed: QueryVectors) -> Column:
    """``array<double>``: the score of each packed query, in ``packed.qids`` order.

    An Arrow UDF: only the vector column leaves the JVM, one batch at a time.
    """
    shipped = gallery.sparkSession.sparkContext.broadcast(packed)

    @F.arrow_udf("array<double>")
    def score(v):
        import numpy as np

        from lumora.functions.kernels import equal_length_blocks

        queries = shipped.value
        out = np.empty((len(v), len(queries)))
        for rows, x in equal_length_blocks(v, queries.block_rows):
            out[rows] = queries.scores(x)
        return list_array(out)

    return score(F.col(vector))
