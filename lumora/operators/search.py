"""Exact vector search: scoring, ranking, top-k, find-similar, browse."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.functions.kernels import QueryVectors, TopK
from lumora.functions.spaces import require_same_space
from lumora.functions.vectors import orderable
from lumora.operators.joins import one_per_key
from lumora.plans.blocks import BLOCK_ROWS, score_scan, top_k_scan, write_blocks
from lumora.plans.freeze import freeze
from lumora.plans.numbering import number_rows
from lumora.plans.packed import MAX_ROWS, pack, scores_column
from lumora.plans.tiles import TILE_BYTES, tile_pairs

HIT = "qid long, id long, pos long, score double"
# Merging 4 million partial hits of one query in one sort is fine, 100 million is not:
# above this k the hits of a query are first merged in salted parts.
_SALT_FROM_K = 16
_SALTS = 64


def best_first() -> list[Column]:
    """Ranking order: score descending, missing scores last, then gallery position."""
    return [F.col("score").desc_nulls_last(), F.col("pos").asc(), F.col("id").asc()]


def score_one(gallery: DataFrame, query: list[float]) -> DataFrame:
    """Add ``score`` of one query vector to every item; one pass, no shuffle."""
    packed = QueryVectors([0], [query])
    scored = gallery.withColumn("score", F.get(scores_column(gallery, "v", packed), F.lit(0)))
    return scored.withColumn("score", orderable("score"))


def _ranking(gallery: DataFrame, query: list[float]) -> DataFrame:
    """Scores without vectors, frozen: a range sort reads its input twice, and this way
    the vectors are read once and never sorted."""
    return freeze(score_one(gallery, query).drop("v"))


def rank(gallery: DataFrame, query: list[float]) -> DataFrame:
    """The whole gallery, best first: a distributed range sort."""
    return _ranking(gallery, query).orderBy(*best_first())


def rank_numbered(gallery: DataFrame, query: list[float]) -> DataFrame:
    """The whole gallery with its 1-based ``rank``."""
    return number_rows(_ranking(gallery, query), best_first(), "rank")


class ScoreTable(NamedTuple):
    """Frozen scores of every query and item: one row per item with an array of scores
    (``wide``), or one row per pair."""

    table: DataFrame
    qids: list[int] | None

    @property
    def wide(self) -> bool:
        return self.qids is not None

    @property
    def width(self) -> int:
        """Pairs in a row of the table."""
        return len(self.qids) if self.wide else 1

    def rows(self, table: DataFrame | None = None) -> DataFrame:
        """(qid, ..., score) per pair; ``table`` may be the wide table with more columns."""
        table = self.table if table is None else table
        if not self.wide:
            return table
        carried = [c for c in table.columns if c != "scores"]
        qids = F.lit(self.qids).cast("array<long>")
        return (table.select(*carried, F.posexplode("scores").alias("__q", "__score"))
                .select(F.get(qids, F.col("__q")).alias("qid"), *carried,
                        orderable("__score").alias("score")))


def score_table(gallery: DataFrame, queries: DataFrame, carry: tuple[str, ...] = (),
                *, max_packed: int = MAX_ROWS, tile_bytes: int | None = None, block_rows: int = BLOCK_ROWS) -> ScoreTable:
    """Scores of every query and item, with ``carry`` columns of the item.

    For operators that need the complete ranking of each query, most of which read it
    more than once.  Up to ``max_packed`` queries travel to the data; blocks of more are streamed past
    it, or, with ``tile_bytes`` or where tasks cannot read the shared folder, met in tiles.
    """
    require_same_space(gallery, queries)
    columns = ["id", "pos", *carry]
    packed = pack(queries, max_rows=max_packed)
    if packed is not None:
        scores = scores_column(gallery, "v", packed).alias("scores")
        return ScoreTable(freeze(gallery.select(*columns, scores)), packed.qids.tolist())

    def kernel(items, targets):
        import numpy as np
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks

        got = QueryVectors(targets["qid"].to_pylist(), targets["v"].to_pylist())
        kept = items.select(columns)
        out = [pa.Table.from_arrays([pa.array([], pa.int64()), *kept.slice(0, 0).columns,
                                     pa.array([], pa.float64())], names=["qid", *columns, "score"])]
        for rows, x in equal_length_blocks(items["v"].combine_chunks(), got.block_rows):
            part = kept.take(pa.array(np.repeat(rows, len(got))))
            out.append(pa.Table.from_arrays(
                [pa.array(np.tile(got.qids, len(rows))), *part.columns,
                 pa.array(got.scores(x).ravel())], names=["qid", *columns, "score"]))
        return pa.concat_tables(out)

    types = dict(gallery.dtypes)
    schema = ", ".join(["qid long", *[f"`{c}` {types[c]}" for c in columns], "score double"])
    blocks = write_blocks(queries, block_rows=block_rows) if tile_bytes is None else None
    if blocks is not None:
        pairs = score_scan(gallery, blocks, columns, schema)
    else:
        pairs = tile_pairs(gallery.select(*columns, "v"), queries.select(F.col("qid").cast("long"), "v"),
                           kernel, schema, tile_bytes=tile_bytes or TILE_BYTES)
    return ScoreTable(freeze(pairs.withColumn("score", orderable("score"))), None)


def score_pairs(gallery: DataFrame, queries: DataFrame, carry: tuple[str, ...] = (),
                **options) -> DataFrame:
    """(qid, id, pos, *carry, score) for every query and item."""
    return score_table(gallery, queries, carry, **options).rows()


def merge_top_k(hits: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of partial hits per query, with a 1-based ``rank``."""
    if k >= _SALT_FROM_K:
        salted = hits.withColumn("__salt", F.pmod(F.xxhash64("id", "pos"), F.lit(_SALTS)))
        part = Window.partitionBy("qid", "__salt").orderBy(*best_first())
        hits = (salted.withColumn("__n", F.row_number().over(part))
                .filter(F.col("__n") <= k).drop("__n", "__salt"))
    best = Window.partitionBy("qid").orderBy(*best_first())
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(gallery: DataFrame, queries: DataFrame, k: int, *, exclude: str | None = None,
          max_packed: int = MAX_ROWS, tile_bytes: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(qid, id, pos, score, rank): the ``k`` best items of every query, exactly.

    ``gallery`` has ``id, pos, v``; ``queries`` has ``qid, v`` and, if ``exclude``
    names a column, the item id each query must not return.  Every task keeps ``k``
    hits per query, so the shuffle carries ids and scores only, never vectors.  More queries than
    ``max_packed`` are streamed past the gallery in blocks, which is not shuffled either; with
    ``tile_bytes``, or where tasks cannot read the shared folder, both meet in tiles.  Vectors marked
    with different models are refused (:mod:`lumora.functions.spaces`).
    """
    require_same_space(gallery, queries)
    columns = ["id", "pos", "v"]
    items = gallery.select(F.col("id").cast("long"), F.col("pos").cast("long"), "v")
    packed = pack(queries, exclude=exclude, max_rows=max_packed)
    if packed is not None:
        shipped = gallery.sparkSession.sparkContext.broadcast(packed)

        def scan(batches):
            best = TopK(shipped.value, k)
            for batch in batches:
                ids, pos, v = (batch.column(c) for c in columns)
                best.update(ids.to_numpy(), pos.to_numpy(), v)
            yield best.batch()

        return merge_top_k(items.mapInArrow(scan, HIT), k)

    blocks = write_blocks(queries, exclude, block_rows) if tile_bytes is None else None
    if blocks is not None:
        return merge_top_k(top_k_scan(items, blocks, k, HIT), k)

    def kernel(tile, targets):
        import pyarrow as pa

        excludes = targets["exclude"].to_pylist() if exclude else None
        best = TopK(QueryVectors(targets["qid"].to_pylist(), targets["v"].to_pylist(), excludes), k)
        best.update(tile["id"].to_numpy(), tile["pos"].to_numpy(), tile["v"].combine_chunks())
        return pa.Table.from_batches([best.batch()])

    wanted = [F.col("qid").cast("long"), F.col("v")]
    if exclude:
        wanted.append(F.col(exclude).cast("long").alias("exclude"))
    return merge_top_k(
        tile_pairs(items, queries.select(*wanted), kernel, HIT, tile_bytes=tile_bytes or TILE_BYTES), k)


def find_similar(gallery: DataFrame, target_ids: DataFrame, k: int, **options) -> DataFrame:
    """The ``k`` items nearest to each target item, the target itself left out.

    ``target_ids`` has one column ``id``; its vector is the first with that id in the
    gallery, so a repeated id is one target.  The ids
    are frozen so that their size, not a guess at it, decides whether they are broadcast.
    """
    wanted = freeze(target_ids.select(F.col("id").alias("__t")).distinct())
    found = gallery.select("id", "pos", "v").join(wanted, F.col("id") == F.col("__t"), "left_semi")
    targets = one_per_key(freeze(found), "id", "pos", last=False).select(
        F.col("id").alias("qid"), "v", F.col("id").alias("self"))
    return top_k(gallery, targets, k, exclude="self", **options)


def with_items(hits: DataFrame, gallery: DataFrame) -> DataFrame:
    """Put the item columns back next to top-k hits.

    Hits are few and frozen, so it is they that are broadcast, not the gallery, whose
    vectors are not read.
    """
    found = freeze(hits)
    items = gallery.drop("v").withColumnsRenamed({"id": "__id", "pos": "__pos"})
    same = (F.col("id") == F.col("__id")) & (F.col("pos") == F.col("__pos"))
    return found.join(items, same).drop("__id", "__pos")


def browse(gallery: DataFrame) -> DataFrame:
    """No query: every item with score 0 in gallery order."""
    return gallery.drop("v").withColumn("score", F.lit(0.0)).orderBy("pos")


def lookup(gallery: DataFrame, item_id: int) -> DataFrame:
    """The first item with this id; the filter reaches the scan."""
    return gallery.filter(F.col("id") == item_id).orderBy("pos").limit(1)


def lookup_many(gallery: DataFrame, ids: DataFrame) -> DataFrame:
    """The first item of each wanted id, all in one pass.

    The ids are frozen: their size decides whether they are broadcast or both sides shuffled.  Only ids that
    then occur more than once are reduced to their first row (:func:`lumora.operators.joins.one_per_key`).
    """
    wanted = freeze(ids.select(F.col("id").alias("__id")).distinct())
    found = freeze(gallery.join(wanted, F.col("id") == F.col("__id"), "left_semi"))
    return one_per_key(found, "id", "pos", last=False)
