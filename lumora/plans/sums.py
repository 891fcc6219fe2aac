"""Exact column sums of vectors, reduced inside each task before the shuffle."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MAX_KEYS = 4096        # partial sums a task holds before it passes them on


def vector_sums(df: DataFrame, key: str, vector: str, key_type: str, dim: int | None = None) -> DataFrame:
    """(key, n, total): count and component-wise sum of the vectors of each key.

    Missing and empty vectors, and with ``dim`` those of another length, are left out.

    Each task sends one partial sum per key, so a key with a third of all rows costs
    the shuffle no more than any other.
    """
    def partial(batches):
        import numpy as np
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks, list_array

        sums: dict = {}

        def flush():
            for d in {len(t) for _, t in sums.values()}:
                part = [(k, n, t) for (k, _), (n, t) in sums.items() if len(t) == d]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in part], type=arrow_type),
                     pa.array([p[1] for p in part], type=pa.int64()),
                     list_array(np.array([p[2] for p in part]))],
                    names=[key, "n", "total"])
            sums.clear()

        arrow_type = None
        for batch in batches:
            arrow_type = batch.schema.field(0).type
            codes = batch.column(0).dictionary_encode("encode")
            names = codes.dictionary.to_pylist()
            index = codes.indices.to_numpy(zero_copy_only=False)
            for rows, x in equal_length_blocks(batch.column(1), 65_536):
                order = np.argsort(index[rows], kind="stable")
                code = index[rows][order]
                starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                counts = np.diff(np.append(starts, len(code)))
                totals = np.add.reduceat(x[order], starts, axis=0) if x.shape[1] else np.zeros((len(starts), 0))
                for c, n, total in zip(code[starts], counts, totals):
                    slot = (names[c], x.shape[1])
                    seen, so_far = sums.get(slot, (0, 0.0))
                    sums[slot] = (seen + int(n), so_far + total)
                if len(sums) > _MAX_KEYS:
                    yield from flush()
        yield from flush()

    fits = F.size(vector) == dim if dim else F.size(vector) > 0
    parts = (df.filter(F.col(vector).isNotNull() & fits).select(F.col(key), F.col(vector))
             .mapInArrow(partial, f"`{key}` {key_type}, n long, total array<double>"))
    return (parts.groupBy(key)
            .agg(F.sum("n").alias("n"),
                 vector_to_array(Summarizer.sum(array_to_vector(F.col("total")))).alias("total")))
