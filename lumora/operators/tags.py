"""Zero-shot tagging: softmax of an item's similarity to every label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.fixed_values import SOFTMAX_TEMPERATURE, TAGS_PER_ITEM
from lumora.functions.kernels import QueryVectors
from lumora.plans.freeze import freeze
from lumora.plans.packed import MAX_ROWS, pack
from lumora.plans.tiles import TILE_BYTES, tile_pairs

TAG = "id long, pos long, label_pos long, score double"
_PARTIAL = ("row long, id long, pos long, peak double, mass double, "
            "best array<struct<label_pos:long,s:double>>")


def _select(s, k):
    """Per row: columns of the k largest values; equal values keep vocabulary order."""
    import numpy as np

    return np.argsort(-s, axis=1, kind="stable")[:, :k]


def zero_shot_tags(gallery: DataFrame, labels: DataFrame, k: int = TAGS_PER_ITEM,
                   temperature: float = SOFTMAX_TEMPERATURE, *, max_packed: int = MAX_ROWS,
                   tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(id, pos, label_pos, label, score, rank): the best ``k`` labels of every item.

    ``labels`` has ``label_pos, label, v``.  Scores are shares of the whole
    vocabulary, so the best ``k`` need not add up to one.  A vocabulary that fits is
    shipped to the items: no shuffle, ``k`` rows out per item.  A larger one meets the
    items in tiles whose partial softmax sums are then merged per item.
    """
    names = labels.select("label_pos", "label")
    packed = pack(labels, qid="label_pos", max_rows=max_packed)
    if packed is not None:
        tags = _tags_packed(gallery, packed, k, temperature)
        names = F.broadcast(names)              # no more rows than were just packed
    else:
        names = freeze(names)
        tags = _tags_tiled(gallery, labels, k, temperature, tile_bytes)
    return tags.join(names, "label_pos").select("id", "pos", "label_pos", "label", "score", "rank")


def _tags_packed(gallery, packed: QueryVectors, k, temperature) -> DataFrame:
    shipped = gallery.sparkSession.sparkContext.broadcast(packed)

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks

        vocab = shipped.value
        for batch in batches:
            for rows, x in equal_length_blocks(batch.column(2), vocab.block_rows):
                s = vocab.scores(x)
                share = np.exp((s - s.max(axis=1, keepdims=True)) * temperature)
                share /= share.sum(axis=1, keepdims=True)
                best = _select(s, k)
                n, width = best.shape
                at = pa.array(np.repeat(rows, width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(vocab.qids[best].ravel()),
                     pa.array(np.take_along_axis(share, best, axis=1).ravel()),
                     pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n))],
                    names=["id", "pos", "label_pos", "score", "rank"])

    return (gallery.select(F.col("id").cast("long"), F.col("pos").cast("long"), "v")
            .mapInArrow(scan, TAG + ", rank int"))


def _tags_tiled(gallery, labels, k, temperature, tile_bytes) -> DataFrame:
    def kernel(items, vocab):
        import numpy as np
        import pyarrow as pa

        from lumora.functions.kernels import equal_length_blocks

        vocab = vocab.sort_by("qid")
        got = QueryVectors(vocab["qid"].to_pylist(), vocab["v"].to_pylist())
        out = {name: [] for name in ("row", "id", "pos", "peak", "mass", "best")}
        if len(got):
            for rows, x in equal_length_blocks(items["v"].combine_chunks(), got.block_rows):
                s = got.scores(x)
                peak = s.max(axis=1)
                best = _select(s, k)
                value = np.take_along_axis(s, best, axis=1)
                for name, column in (("row", "id"), ("id", "item"), ("pos", "place")):
                    out[name] += items[column].take(pa.array(rows)).to_pylist()
                out["peak"] += peak.tolist()
                out["mass"] += np.exp((s - peak[:, None]) * temperature).sum(axis=1).tolist()
                out["best"] += [[{"label_pos": int(p), "s": float(v)} for p, v in zip(ps, vs)]
                                for ps, vs in zip(got.qids[best], value)]
        return pa.table(out, schema=pa.schema([
            ("row", pa.int64()), ("id", pa.int64()), ("pos", pa.int64()), ("peak", pa.float64()),
            ("mass", pa.float64()),
            ("best", pa.list_(pa.struct([("label_pos", pa.int64()), ("s", pa.float64())])))]))

    # rows get numbers of their own, as neither id nor position need be unique
    items = freeze(gallery.select(F.monotonically_increasing_id().alias("id"), F.lit(0).cast("long").alias("pos"),
                                  F.col("id").cast("long").alias("item"), F.col("pos").cast("long").alias("place"), "v"))
    parts = tile_pairs(items, labels.select(F.col("label_pos").cast("long").alias("qid"), "v"),
                       kernel, _PARTIAL, tile_bytes=tile_bytes)
    # per item: as many partial rows as the vocabulary has tiles, k labels in each
    merged = parts.groupBy("row").agg(
        F.first("id").alias("id"), F.first("pos").alias("pos"), F.max("peak").alias("peak"),
        F.collect_list(F.struct("peak", "mass")).alias("masses"),
        F.flatten(F.collect_list("best")).alias("best"))
    total = F.aggregate("masses", F.lit(0.0), lambda acc, m: acc + m["mass"] * F.exp(
        (m["peak"] - F.col("peak")) * temperature))
    # a score that is not a number comes last, as a negated one does in ascending order
    keyed = F.transform("best", lambda t: F.struct((-t["s"]).alias("fall"), t["label_pos"].alias("label_pos"), t["s"].alias("s")))
    ordered = F.slice(F.array_sort(keyed), 1, k)
    return (merged.select("id", "pos", "peak", total.alias("total"), F.posexplode(ordered).alias("p", "t"))
            .select("id", "pos", F.col("t.label_pos").alias("label_pos"),
                    (F.exp((F.col("t.s") - F.col("peak")) * temperature) / F.col("total")).alias("score"),
                    (F.col("p") + 1).alias("rank")))
