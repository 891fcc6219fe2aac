"""Retrieval quality: precision at k, reciprocal rank, average precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.fixed_values import PRECISION_CUTOFFS, TOP_IDS
from lumora.functions.text import fixed_text, to_fixed
from lumora.operators.joins import join_vectors_items, last_wins
from lumora.operators.search import best_first, score_table
from lumora.plans.blocks import BLOCK_ROWS
from lumora.plans.freeze import freeze
from lumora.plans.numbering import range_sorted
from lumora.plans.packed import MAX_ROWS
from lumora.plans.skew import skew_left_join
from lumora.plans.spread import spread

#: Pairs that one task makes of wide rows, or adds up, about; what it writes to a shuffle lies in memory first.
PAIRS_PER_TASK = 1 << 20
_RUN = ("is_total boolean, run long, qid long, place long, hits long, rel boolean, id long")
_SCORE_BITS = 40
_RUN_BITS = 32


def _sort_prefix():
    """A long that rises with (a hash of the query, falling score).

    Spark's sort compares a 64-bit prefix of the first key before anything else; with
    the query id there, every comparison within a query would fall through to the full
    row.  Queries whose hashes collide may interleave, which the run numbers allow for.
    """
    top = float((1 << _SCORE_BITS) - 1)
    bounded = F.greatest(F.least(F.col("score"), F.lit(1.0)), F.lit(-1.0))
    falling = F.floor((1.0 - bounded) / 2.0 * top).cast("long")
    query = F.pmod(F.xxhash64("qid"), F.lit(1 << (63 - _SCORE_BITS)))
    return F.shiftleft(query, _SCORE_BITS) + F.when(
        F.col("score").isNull(), F.lit((1 << _SCORE_BITS) - 1)).otherwise(falling)


def _sorted_runs(top: int):
    """Number rows and relevant rows of each run of one query in a sorted partition.

    Only what the metrics need leaves the task: relevant rows, the first ``top`` rows
    of each run, and one total per run.
    """
    def scan(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        run_id = TaskContext.get().partitionId() << _RUN_BITS
        current, n, h = None, 0, 0

        def rows(is_total, run, qid, place, hits, rel, ids):
            m = len(qid)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, is_total)), pa.array(run, pa.int64()),
                 pa.array(qid, pa.int64()), pa.array(place, pa.int64()),
                 pa.array(hits, pa.int64()), pa.array(rel, pa.bool_()),
                 pa.array(ids, pa.int64())],
                names=["is_total", "run", "qid", "place", "hits", "rel", "id"])

        def totals(run, qid, place, hits):
            m = len(qid)
            return rows(True, run, qid, place, hits, np.zeros(m, bool), np.zeros(m, np.int64))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            qid = batch.column(0).to_numpy()
            ids = batch.column(1).to_numpy()
            rel = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], qid[1:] != qid[:-1])))
            ends = np.append(starts[1:], len(qid))
            seen = np.cumsum(rel)
            at = np.repeat(np.arange(len(starts)), ends - starts)
            place = np.arange(len(qid)) - starts[at] + 1
            hits = seen - (seen[starts] - rel[starts])[at]
            if current is not None and qid[0] == current:
                place[:ends[0]] += n
                hits[:ends[0]] += h
            elif current is not None:
                yield totals([run_id], [current], [n], [h])
                run_id += 1
            run = run_id + at
            last = ends[:-1] - 1                # runs that end inside this batch
            if len(last):
                yield totals(run[last], qid[last], place[last], hits[last])
            run_id = int(run[-1])
            current, n, h = int(qid[-1]), int(place[-1]), int(hits[-1])
            keep = (rel == 1) | (place <= top)
            yield rows(False, run[keep], qid[keep], place[keep], hits[keep],
                       rel[keep] == 1, ids[keep])
        if current is not None:
            yield totals([run_id], [current], [n], [h])

    return scan


def ranked_relevance(scored: DataFrame, top: int = TOP_IDS, rows: int | None = None) -> DataFrame:
    """(qid, rank, hits, rel, id): global rank and running hit count.

    ``scored`` has ``qid, id, pos, score, rel``.  Contains every relevant row and at
    least the first ``top`` rows of each query.  A query's ranking is spread over as
    many partitions as its size calls for; no window sees a whole gallery.  ``rows``: how
    many rows there are, where that is known.
    """
    ordered = range_sorted(scored.withColumn("__prefix", _sort_prefix()),
                           F.col("__prefix"), F.col("qid"), *best_first(), rows=rows)
    runs = freeze(ordered.select("qid", "id", "rel").mapInArrow(_sorted_runs(top), _RUN))
    earlier = (Window.partitionBy("qid").orderBy("run")
               .rowsBetween(Window.unboundedPreceding, -1))
    # about one row per (partition, query): frozen, so that its size decides the join
    offsets = freeze(runs.filter("is_total").select(
        "run",
        F.coalesce(F.sum("place").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("hits").over(earlier), F.lit(0)).alias("hits_before")))
    return (runs.filter(~F.col("is_total")).join(offsets, "run")
            .select("qid", (F.col("place") + F.col("rows_before")).alias("rank"),
                    (F.col("hits") + F.col("hits_before")).alias("hits"), "rel", "id"))


def precision_at(k: int) -> Column:
    """Hits among the first k over k, even where fewer than k items exist."""
    return F.sum(F.when(F.col("rel") & (F.col("rank") <= k), 1).otherwise(0)) / F.lit(float(k))


_BLOCK_BITS = 20        # ranks of a query that one task adds up


def _fold_runs(batches):
    """(qid, block, total): terms of neighbouring rows with equal (qid, block), added from left to right."""
    import numpy as np
    import pyarrow as pa

    key, total = None, 0.0

    def out(keys, totals):
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                                           pa.array(totals, pa.float64())], names=["qid", "block", "total"])

    for batch in batches:
        if not batch.num_rows:
            continue
        qid, block, term = (batch.column(k).to_numpy() for k in range(3))
        first = np.flatnonzero(np.concatenate([[True], (qid[1:] != qid[:-1]) | (block[1:] != block[:-1])]))
        keys, totals = [], []
        for a, b in zip(first, np.append(first[1:], len(qid))):
            mine = (int(qid[a]), int(block[a]))
            if key is not None and mine != key:
                keys.append(key)
                totals.append(total)
                total = 0.0
            key, total = mine, float(np.cumsum(np.concatenate([[total], term[a:b]]))[-1])
        yield out(keys, totals)
    if key is not None:
        yield out([key], [total])


def _tasks(pairs: int) -> int:
    return max(1, -(-pairs // PAIRS_PER_TASK))


def _precision_sums(ranked: DataFrame, rows: int | None = None) -> DataFrame:
    """(qid, __precision): precision at each relevant rank, summed in rank order.

    Like the means below, a sum of doubles must not depend on how rows were spread.  Stretches of 2**20
    ranks are added from left to right as streams of their own, then the stretches of a query."""
    terms = ranked.filter("rel").select("qid", F.shiftright(F.col("rank") - 1, _BLOCK_BITS).cast("long").alias("block"), "rank",
                                        (F.col("hits") / F.col("rank")).alias("term"))
    schema = "qid long, block long, total double"
    blocks = (terms.repartition(*([] if rows is None else [_tasks(rows)]), "qid", "block").sortWithinPartitions("qid", "block", "rank").select("qid", "block", "term")
              .mapInArrow(_fold_runs, schema))
    whole = (blocks.repartition("qid").sortWithinPartitions("qid", "block").select("qid", F.lit(0).cast("long").alias("block"), "total")
             .mapInArrow(_fold_runs, schema))
    return whole.select("qid", F.col("total").alias("__precision"))


def query_metrics(ranked: DataFrame, ks: Sequence[int] = PRECISION_CUTOFFS,
                  top: int = TOP_IDS, rows: int | None = None) -> DataFrame:
    """Metrics per query from :func:`ranked_relevance` rows.

    Counts with map-side partials; the only list holds ``top`` ids.  ``rows``: how many rows were ranked, where
    that is known.
    """
    found = F.sum(F.col("rel").cast("long"))
    best = F.sort_array(F.collect_list(F.when(F.col("rank") <= top, F.struct("rank", "id"))))
    pairs = [x for k in ks for x in (F.lit(str(k)), precision_at(k))]
    return (ranked.groupBy("qid").agg(
        found.alias("nRelevant"),
        F.create_map(*pairs).alias("pAt"),
        F.coalesce(1.0 / F.min(F.when(F.col("rel"), F.col("rank"))), F.lit(0.0)).alias("rr_exact"),
        best.alias("__best"))
        .join(_precision_sums(ranked, rows), "qid", "left")
        .withColumn("ap_exact", F.coalesce(F.col("__precision") / F.col("nRelevant"), F.lit(0.0))).drop("__precision")
        .withColumn("topIds", F.transform("__best", lambda r: r["id"])).drop("__best")
        .withColumn("rr", to_fixed("rr_exact", 3)).withColumn("ap", to_fixed("ap_exact", 3)))


def _latest_scores(scores: DataFrame, gallery: DataFrame) -> DataFrame:
    """Rows of repeated ids, each with the score of the id's last vector; as they are where
    no id repeats."""
    if gallery.groupBy("id").count().filter("count > 1").isEmpty():
        return scores
    last = freeze(scores.groupBy("qid", "id").agg(F.max_by(F.struct("score"), "pos").alias("__last")))
    return (scores.drop("score").join(last, ["qid", "id"])
            .withColumn("score", F.col("__last.score")).drop("__last"))


def _dealt(table: DataFrame, pairs: int) -> DataFrame:
    """The wide table in as many tasks as its ``pairs`` call for, wherever its rows were: by bytes, they would be
    too few, as a row becomes as many as there are queries."""
    return table if pairs <= PAIRS_PER_TASK else spread(table, max(_tasks(pairs), table.sparkSession.sparkContext.defaultParallelism))


def evaluate(gallery: DataFrame, queries: DataFrame, ks: Sequence[int] = PRECISION_CUTOFFS,
             top: int = TOP_IDS, *, items: DataFrame | None = None, max_packed: int = MAX_ROWS,
             tile_bytes: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Metrics of every query against the whole gallery.

    ``gallery`` has ``id, pos, v`` and either its own ``category`` or ``items`` (``id,
    pos, category``) to take it from; a vector without item is never relevant.
    ``queries`` has ``qid, query, category, v``.  Vectors are read once and never
    shuffled: they are scored first, and it is scores that meet the items and are sorted
    across the cluster.
    """
    scored = score_table(gallery, queries, () if items is not None else ("category",),
                         max_packed=max_packed, tile_bytes=tile_bytes, block_rows=block_rows)
    pairs = scored.table.count() * scored.width
    table = join_vectors_items(scored.table, items, ["category"]) if items is not None and scored.wide else scored.table
    scores = scored.rows(_dealt(table, pairs) if scored.wide else None)
    if items is not None and not scored.wide:
        scores = skew_left_join(_latest_scores(scores, gallery), items, "id",
                                lambda df: last_wins(df, "id", "pos", ["category"]))
    targets = freeze(queries.select(F.col("qid").cast("long").alias("qid"), "query",
                                    F.col("category").alias("target")))
    flagged = (scores.join(targets.select("qid", "target"), "qid")
               .select("qid", "id", "pos", "score",
                       F.col("category").eqNullSafe(F.col("target")).alias("rel")))
    metrics = query_metrics(ranked_relevance(flagged, top, rows=pairs), ks, top, pairs)
    zeros = F.create_map(*[x for k in ks for x in (F.lit(str(k)), F.lit(0.0))])
    found = targets.join(metrics, "qid", "left")         # an empty gallery leaves every query unanswered
    return found.select(
        "qid", "query", F.col("target").alias("category"), F.coalesce("nRelevant", F.lit(0)).alias("nRelevant"),
        F.coalesce("pAt", zeros).alias("pAt"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("rr", "ap", "rr_exact", "ap_exact")],
        F.coalesce("topIds", F.array().cast("array<long>")).alias("topIds"))


_FOLD = "queries long, ap double, rr double, ap_exact double, rr_exact double, at array<double>"


def _fold(batches):
    """Sums of sorted rows from left to right, one row in all.

    A sum of doubles depends on its order, and a mean next to a tie of the published
    decimals shows it; ``avg`` adds partial sums in whatever order tasks end."""
    import pyarrow as pa

    n, sums = 0, None
    for batch in batches:
        if sums is None:
            width = len(batch.column(4)[0]) if batch.num_rows else 0
            sums = [0.0] * (4 + width) if batch.num_rows else None
        columns = [c.to_pylist() for c in batch.columns]
        for ap, rr, ap_exact, rr_exact, at in zip(*columns):
            n += 1
            for k, x in enumerate((ap, rr, ap_exact, rr_exact, *at)):
                sums[k] += x
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), *[pa.array([x]) for x in sums[:4]], pa.array([sums[4:]], pa.list_(pa.float64()))],
            names=["queries", "ap", "rr", "ap_exact", "rr_exact", "at"])


def aggregate(per_query: DataFrame, gallery_size: int,
              ks: Sequence[int] = PRECISION_CUTOFFS) -> DataFrame:
    """One row: sizes and macro means, summed in the order of ``qid``.

    Reciprocal rank and average precision enter already rounded to three decimals and
    are rounded again; the unrounded means are alongside.  The rows of one number per
    query and metric are sorted into one partition and added up there as a stream, so
    the result does not depend on how the queries were spread.
    """
    at = F.array(*[F.col("pAt")[str(k)] for k in ks])
    rows = (per_query.select("qid", "ap", "rr", "ap_exact", "rr_exact", at.alias("at"))
            .repartition(1).sortWithinPartitions("qid", "ap_exact", "rr_exact")
            .select("ap", "rr", "ap_exact", "rr_exact", "at"))
    # no query at all leaves one row of NULL means
    total = rows.mapInArrow(_fold, _FOLD).agg(*[F.first(c).alias(c) for c in
                                                ("queries", "ap", "rr", "ap_exact", "rr_exact", "at")])
    mean = {c: F.col(c) / F.col("queries") for c in ("ap", "rr", "ap_exact", "rr_exact")}
    pairs = [x for i, k in enumerate(ks)
             for x in (F.lit(str(k)), to_fixed(F.get("at", F.lit(i)) / F.col("queries"), 3))]
    return total.select(
        F.coalesce("queries", F.lit(0)).cast("long").alias("queries"),
        F.lit(gallery_size).cast("long").alias("gallerySize"),
        to_fixed(mean["ap"], 3).alias("mAP"), to_fixed(mean["rr"], 3).alias("mrr"),
        F.create_map(*pairs).alias("pAt"),
        mean["ap_exact"].alias("mAP_exact"), mean["rr_exact"].alias("mrr_exact"))


def report(aggregated: DataFrame) -> DataFrame:
    """(metric, value) as shown to people: mean AP with 3 decimals, the rest with 2."""
    def line(name, column, digits):
        return F.struct(F.lit(name).alias("metric"), fixed_text(column, digits).alias("value"))

    lines = F.array(line("mean AP", "mAP", 3), line("MRR", "mrr", 2),
                    line("Precision@1", F.col("pAt")["1"], 2),
                    line("Precision@3", F.col("pAt")["3"], 2))
    return aggregated.select(F.explode(lines).alias("r")).select("r.metric", "r.value")
