"""Pair two large vector tables in bounded tiles.

Used when the query side is too large to ship to every task.  Both sides are cut
by hash into tiles of a bounded size; each row is copied once per opposite tile
and every (left tile, right tile) pair meets in one task.  Nothing grows with the
data except the number of tiles.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

TILE_BYTES = 32 << 20


def _tiles(rows: int, dim: int, tile_bytes: int) -> int:
    return max(1, -(-rows * (8 * dim + 32) // tile_bytes))


def _numbers(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def tile_pairs(gallery: DataFrame, queries: DataFrame,
               kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str, *,
               tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Run ``kernel(gallery_tile, query_tile)`` for every pair of tiles.

    ``gallery`` needs ``id, pos, v`` and ``queries`` needs ``qid, v``.  Rows are
    spread by hash over id and position together, so copies of one id do not pile
    up in a tile.
    """
    queries = freeze(queries)
    n, dim = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    # components beyond the longest query never count, so tiles stay within their bound
    gallery = gallery.withColumn(
        "v", F.when(F.size("v") > dim, F.slice("v", 1, max(dim, 1))).otherwise(F.col("v")))
    g_tiles = _tiles(gallery.count(), dim, tile_bytes)
    q_tiles = _tiles(n, dim, tile_bytes)
    left = gallery.select(
        "*", F.pmod(F.xxhash64("pos", "id"), F.lit(g_tiles)).alias("__g"),
        F.explode(_numbers(q_tiles)).alias("__q"))
    right = queries.select(
        "*", F.pmod(F.xxhash64("qid"), F.lit(q_tiles)).alias("__q"),
        F.explode(_numbers(g_tiles)).alias("__g"))
    return (left.groupBy("__g", "__q").cogroup(right.groupBy("__g", "__q"))
            .applyInArrow(kernel, schema))
