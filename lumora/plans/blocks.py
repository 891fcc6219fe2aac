"""Stream a query table of any size past each partition of the gallery.

Queries that are too many to ship are written to the shared folder in blocks of a bounded size.
The gallery is scanned where it lies: a task takes a stretch of its rows and reads
the blocks one after the other.  Vectors of the gallery are neither shuffled nor
copied; a task holds one stretch, one block, and the best ``k`` of each query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.functions.kernels import QueryVectors, TopK
from lumora.plans.freeze import new_dir

BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
STRETCH_BYTES = 32 << 20
#: Best rows a task keeps for all queries of a pass (24 bytes each); more queries take another pass.
KEPT_ROWS = 4_000_000


@dataclass(frozen=True)
class QueryBlocks:
    """Query vectors in the folders ``block=0``, ``block=1``, ... of ``path``."""

    path: str
    count: int
    rows: int
    dim: int
    exclude: bool

    def load(self, block: int) -> QueryVectors:
        """Read by a task; a number that no query's hash gave is an empty block."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = open_store(self.path)
        files = store.get_file_info(fs.FileSelector(f"{root}/block={block}", allow_not_found=True))
        tables = [pq.read_table(f.path, filesystem=store, partitioning=None) for f in sorted(files, key=lambda f: f.path)
                  if f.path.endswith(".parquet")]
        rows = sorted((r for t in tables for r in t.to_pylist()), key=lambda r: r["qid"])
        return QueryVectors([r["qid"] for r in rows], [r["v"] for r in rows],
                            [r["exclude"] for r in rows] if self.exclude else None)

    def passes(self, k: int) -> list[range]:
        """Blocks by pass, so that ``k`` rows for each query of a pass stay within KEPT_ROWS."""
        per_pass = max(1, KEPT_ROWS // max(1, k * self.rows))
        return [range(a, min(a + per_pass, self.count)) for a in range(0, self.count, per_pass)]


def open_store(path: str):
    """(file system, path in it) for Python code; a folder as Hadoop or as Python writes it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def reachable(path: str) -> bool:
    """Whether Python tasks can open the folder, not only Spark."""
    try:
        open_store(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def write_blocks(queries: DataFrame, exclude: str | None = None, block_rows: int = BLOCK_ROWS) -> QueryBlocks | None:
    """Blocks of ``queries`` (qid, v and, if given, ``exclude``); None where tasks cannot read the shared folder.

    Rows are dealt to blocks by a hash, so blocks hold about the same number."""
    spark = queries.sparkSession
    path = new_dir(spark, "blocks")
    if not reachable(path):
        return None
    wanted = [F.col("qid").cast("long").alias("qid"), F.col("v")]
    if exclude:
        wanted.append(F.col(exclude).cast("long").alias("exclude"))
    few = queries.select(*wanted)
    n, dim = few.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, dim))))
    count = max(1, -(-n // rows))
    (few.withColumn("block", F.pmod(F.xxhash64("qid", "v"), F.lit(count)))
     .repartition(min(count, 200), "block").write.partitionBy("block").parquet(path))
    return QueryBlocks(path, count, rows, dim, bool(exclude))


def stretches(batches, dim: int) -> Iterator:
    """Arrow batches joined to tables of about STRETCH_BYTES of vectors."""
    import pyarrow as pa

    held, rows, most = [], 0, max(1, STRETCH_BYTES // (8 * max(1, dim)))
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def top_k_scan(items: DataFrame, blocks: QueryBlocks, k: int, schema: str) -> DataFrame:
    """The best ``k`` rows per task and query: (qid, id, pos, score) from ``items`` (id, pos, v)."""
    found = None
    for part in blocks.passes(k):
        def scan(batches, part=part):
            best: dict[int, TopK] = {}
            for table in stretches(batches, blocks.dim):
                ids, pos = table["id"].to_numpy(), table["pos"].to_numpy()
                v = table["v"].combine_chunks()
                for block in part:
                    queries = blocks.load(block)
                    if not len(queries):
                        continue
                    mine = best.setdefault(block, TopK(queries, k))
                    mine.queries = queries
                    mine.update(ids, pos, v)
                    mine.queries = QueryIds(queries.qids)       # vectors are read again for the next stretch
            for mine in best.values():
                yield mine.batch()

        one = items.mapInArrow(scan, schema)
        found = one if found is None else found.unionByName(one)
    return found


@dataclass
class QueryIds:
    """What is kept of a block between two stretches."""

    qids: Sequence[int]


def score_scan(items: DataFrame, blocks: QueryBlocks, columns: list[str], schema: str) -> DataFrame:
    """(qid, *columns, score) of every query and row of ``items`` (columns and v)."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks

        for table in stretches(batches, blocks.dim):
            kept, v = table.select(columns), table["v"].combine_chunks()
            for block in range(blocks.count):
                queries = blocks.load(block)
                if not len(queries):
                    continue
                for rows, x in equal_length_blocks(v, queries.block_rows):
                    part = kept.take(pa.array(np.repeat(rows, len(queries))))
                    out = pa.Table.from_arrays(
                        [pa.array(np.tile(queries.qids, len(rows))), *part.columns, pa.array(queries.scores(x).ravel())],
                        names=["qid", *columns, "score"])
                    yield from out.combine_chunks().to_batches()

    return items.select(*columns, "v").mapInArrow(scan, schema)
