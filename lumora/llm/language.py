"""Language identification by the nearest of several centroids per language.

A text's vector has a component for each of ``BUCKETS`` hashed n-grams of 2 and 3 bytes of its
lower-cased letters (runs of anything else count as one space; a text begins and ends with spaces).
Components are ``(1 + ln tf) * idf`` and vectors have length 1, so products are cosines
(Salton and Buckley, "Term-weighting approaches in automatic text retrieval", 1988).

1. Document frequencies of all n-grams, over all training documents: one sum per task, then in Spark.
2. ``CLUSTERS`` centroids per language by spherical k-means (Dhillon and Modha, "Concept decompositions for
   large sparse text data using clustering", 2001).  Only where it starts from is taken from a bounded
   sample: the texts of a language with the smallest hashes, at most ``SAMPLE`` in all languages together
   and ``SAMPLE_EACH`` in one (with more than SAMPLE / 16 languages 16 in each).  Then ``ROUNDS`` passes
   over all training documents move the centroids; sums are kept per task and added up in Spark.
3. A text gets the language of the centroid with the largest cosine; ties go to the language with more
   training documents, then to the first in alphabetical order.
4. Distances reject: of the training documents nearest to a centroid of their own language, ``ACCEPTED``
   parts in 1000 lie within the centroid's radius (counted over all of them, in steps of 1/1000).  A text
   farther than that from its centroid is rejected: ``lang`` becomes ``UNKNOWN`` while ``nearest``
   keeps the language.

NULL texts and texts without a letter are ``UNKNOWN`` with score 0 and train nothing, as does a NULL
language; without any training document every text is ``UNKNOWN``.  Repeated rows count and are answered
each; equal texts get equal answers; an empty table gives an empty result; extra columns are ignored.
Long texts are counted in slabs of ``SLAB`` bytes, so memory does not grow with a text beyond the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.llm.common import flat
from lumora.plans.freeze import freeze

BITS = 13
BUCKETS = 1 << BITS
CLUSTERS, ROUNDS = 4, 2
SAMPLE, SAMPLE_EACH = 4096, 256
ACCEPTED = 995
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
#: Texts, and bytes of texts, that are counted at once.
TEXTS, SLAB = 256, 1 << 20
#: Bytes of texts whose n-grams are looked up at once: the working arrays, some 50 bytes a byte, stay in the cache.
PIECE = 1 << 16
_BLOCK = 1024           # components in a row of partial sums

_letters = np.full(256, 32, np.uint8)
_letters[0x80:] = np.arange(0x80, 0x100)
_letters[97:123] = np.arange(97, 123)
_TWO_SPACES = np.full(2, 32, np.uint8)


def _grams(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether it counts, bucket of two bytes, bucket of three bytes) of all positions but the last two."""
    two = x[:-2].astype(np.uint32)
    two *= np.uint32(257)
    two += x[1:-1]
    kept = two != 32 * 257 + 32
    three = two * np.uint32(257)
    three += x[2:]
    three += np.uint32(1)
    for code, factor in ((two, 0x9E3779B1), (three, 0x85EBCA77)):
        code *= np.uint32(factor)
        code >>= np.uint32(32 - BITS)
    return kept, two, three


def _counted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram counts of each text, one row of BUCKETS each."""
    n, size = len(offsets) - 1, np.diff(offsets) + 2
    x = np.insert(data[offsets[0]:offsets[-1]], np.repeat(offsets[:-1] - offsets[0], 2), 32)
    kept, two, three = _grams(_letters.take(np.concatenate([x, _TWO_SPACES])))
    row = np.repeat(np.arange(n, dtype=np.int64) << BITS, size)
    row[~kept] = n << BITS                                               # a last row for what doesn't count
    at = np.empty((2, len(row)), np.int64)
    np.add(row, two, out=at[0])
    np.add(row, three, out=at[1])
    return np.bincount(at.reshape(-1), minlength=(n + 1) << BITS)[:n << BITS].reshape(n, BUCKETS)


def gram_counts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, counts): the n-gram counts of runs of texts, one row of BUCKETS each."""
    data, offsets = flat(pc.utf8_lower(texts))
    n, i = len(offsets) - 1, 0
    upto = lambda k, size: max(k + 1, int(np.searchsorted(offsets, offsets[k] + size, "right")) - 1)
    while i < n:
        j = min(i + TEXTS, upto(i, SLAB))
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin > 2 * SLAB:                                       # one long text
            total = np.zeros((1, BUCKETS), np.int64)
            for at in range(begin, end, SLAB):
                part = [data[at:min(at + SLAB + 2, end)]]
                if at == begin:
                    part.insert(0, _TWO_SPACES)
                if at + SLAB + 2 > end:
                    part.append(_TWO_SPACES[:2 - max(0, end - at - SLAB)])
                kept, two, three = _grams(_letters.take(np.concatenate(part)))
                total[0] += np.bincount(two[kept], minlength=BUCKETS)
                total[0] += np.bincount(three[kept], minlength=BUCKETS)
        else:
            total, k = np.empty((j - i, BUCKETS), np.int32), i
            while k < j:                                                 # a few texts at a time
                m = min(j, upto(k, PIECE))
                total[k - i:m - i] = _counted(data, offsets[k:m + 1])
                k = m
        yield i, j, total
        i = j


_weights = np.concatenate([[0.0], 1 + np.log(np.arange(1, 4096))]).astype(np.float32)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length 1 (0 where there is no n-gram)."""
    at = np.flatnonzero(counts != 0)
    tf = counts.reshape(-1).take(at)
    value = _weights.take(np.minimum(tf, 4095))
    big = tf > 4095
    if big.any():
        value[big] = 1 + np.log(tf[big])
    value *= idf.take(at & (BUCKETS - 1))
    row = at >> BITS
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(counts)))
    x = np.zeros(counts.shape, np.float32)
    x.reshape(-1)[at] = value / norm.take(row)
    return x


@dataclass
class Centroids:
    """``rows[k]`` is a centroid of ``langs[of[k]]``; languages with more training documents come first."""

    langs: list[str]
    of: np.ndarray
    idf: np.ndarray
    rows: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, cosine) of each row of x."""
        cosine = (x @ self.rows.T).round(6)
        best = cosine.argmax(1)
        return best, cosine[np.arange(len(x)), best].clip(0, 1)

    def nearest_of(self, x: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """The nearest centroid among those of each row's own language."""
        cosine = (x @ self.rows.T).round(6)
        cosine[self.of[None, :] != lang[:, None]] = -2
        return cosine.argmax(1)


def _parts(key: int, sums: np.ndarray, n: int) -> pa.RecordBatch:
    """A vector of sums as rows of ``_BLOCK`` components."""
    rows = sums.reshape(-1, _BLOCK)
    k = len(rows)
    values = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, _BLOCK, dtype=np.int32)), pa.array(rows.ravel()))
    return pa.RecordBatch.from_arrays([pa.array([key] * k, pa.int32()), pa.array(np.arange(k, dtype=np.int32)),
                                       pa.array([n] * k, pa.int64()), values], ["key", "block", "n", "total"])


_PARTS = "key int, block int, n long, total array<double>"


def _added_up(parts: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """{key: (n, sums)}: as many keys as the model has centroids."""
    total = vector_to_array(Summarizer.sum(array_to_vector(F.col("total"))))
    spread = parts.groupBy("key", "block", F.pmod(F.spark_partition_id(), F.lit(64)).alias("salt")).agg(
        F.sum("n").alias("n"), total.alias("total"))
    rows = spread.groupBy("key", "block").agg(F.sum("n").alias("n"), total.alias("total")).orderBy("key", "block").toArrow()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for key, n, values in zip(rows["key"].to_pylist(), rows["n"].to_pylist(), rows["total"]):
        got = out.get(key, (n, np.zeros(0)))[1]
        out[key] = (n, np.concatenate([got, values.values.to_numpy()]))
    return out


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, how many have each n-gram) over all texts."""

    def run(batches):
        n, seen = 0, np.zeros(BUCKETS)
        for batch in batches:
            for _, _, counts in gram_counts(batch.column(0)):
                n += int(counts.any(1).sum())
                seen += np.bincount(np.flatnonzero(counts != 0) & (BUCKETS - 1), minlength=BUCKETS)
        if n:
            yield _parts(0, seen, n)

    return _added_up(docs.select("text").mapInArrow(run, _PARTS)).get(0, (0, np.zeros(BUCKETS)))


def _sample(docs: DataFrame, idf: np.ndarray, sizes: dict[str, int], clusters: int) -> list[np.ndarray]:
    """For each language centroids of a bounded sample of its texts.

    Hashes below a bound that some 8 times as many texts pass are looked at only, and copies of a text once, so the
    window by language stays small at any number of rows."""
    langs = list(sizes)
    each = max(16, min(SAMPLE_EACH, SAMPLE // max(1, len(langs))))

    def run(batches):
        for batch in batches:
            for i, j, counts in gram_counts(batch.column(1)):
                row, bucket = np.nonzero(counts)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts[row, bucket].astype(np.int64)))], ["lang", "bucket", "count"])

    first = Window.partitionBy("lang").orderBy("h", "text")
    space = 1 << 40
    bound = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(space, space * 8 * each // n))])
    few = (docs.withColumn("h", F.xxhash64("text")).filter(F.pmod("h", F.lit(space)) < F.element_at(bound, F.col("lang")))
           .withColumn("h", F.pmod("h", F.lit(space))).dropDuplicates(["lang", "h"])
           .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= each).select("lang", "text"))
    rows = few.mapInArrow(run, "lang string, bucket array<int>, count array<long>").toArrow()
    mine: dict[str, list[np.ndarray]] = {x: [] for x in langs}
    for lang, bucket, count in zip(rows["lang"].to_pylist(), rows["bucket"], rows["count"]):
        counts = np.zeros(BUCKETS, np.int64)
        counts[bucket.values.to_numpy()] = count.values.to_numpy()
        mine[lang].append(unit_vectors(counts[None], idf)[0])
    return [_clustered(np.array(mine[x]), clusters) for x in langs]


def _clustered(x: np.ndarray, clusters: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means from rows at the far quartile of those before; at most ``clusters`` rows."""
    order = np.lexsort(x.T[:8])
    x = x[order]
    chosen = [int((x @ x.mean(0)).argmax())]
    while len(chosen) < clusters:
        near = (x @ x[chosen].T).max(1)
        at = int(np.argsort(near, kind="stable")[len(x) // 4])           # far from those chosen, but no outlier
        if near[at] > 1 - 1e-6:
            break
        chosen.append(at)
    rows = x[chosen]
    for _ in range(steps):
        at = (x @ rows.T).argmax(1)
        sums = np.array([x[at == k].sum(0) for k in range(len(rows)) if (at == k).any()])
        rows = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return rows.astype(np.float32)


def fit(docs: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Centroids | None:
    """Centroids from the rows of ``docs`` (lang, text); None without a text that has a letter and a language."""
    docs = docs.filter(F.col("lang").isNotNull() & has_letter("text")).select("lang", "text")
    sizes = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not sizes:
        return None
    langs = [r["lang"] for r in sizes]
    n, seen = document_frequencies(docs)
    idf = (np.log((n + 1) / (seen + 1)) + 1).astype(np.float32)
    starts = _sample(docs, idf, {r["lang"]: r["count"] for r in sizes}, clusters)
    model = Centroids(langs, np.repeat(np.arange(len(langs)), [len(s) for s in starts]), idf, np.vstack(starts))
    for _ in range(rounds):
        def run(batches, model=model):
            number = {x: k for k, x in enumerate(model.langs)}
            sums, size = np.zeros(model.rows.shape), np.zeros(len(model.rows), np.int64)
            for batch in batches:
                lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                for i, j, counts in gram_counts(batch.column(1)):
                    x = unit_vectors(counts, model.idf)
                    at = model.nearest_of(x, lang[i:j])
                    one = np.zeros((len(model.rows), j - i), np.float32)
                    one[at, np.arange(j - i)] = 1
                    sums += one @ x
                    size += np.bincount(at, minlength=len(size))
            for k in np.flatnonzero(size):
                yield _parts(int(k), sums[k], int(size[k]))

        moved = _added_up(docs.mapInArrow(run, _PARTS))
        kept = sorted(moved)                                             # a centroid that lost all its texts goes
        rows = np.array([moved[k][1] for k in kept])
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        model = Centroids(langs, model.of[kept], idf, rows.astype(np.float32))
    return model


def has_letter(text: str) -> Column:
    """Most texts have one among their first characters; only others are looked through as a whole."""
    return F.coalesce(F.substring(text, 1, 64).rlike(r"\p{L}") | F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, accepted: int = ACCEPTED) -> DataFrame:
    """(doc_id, held_out, lang, nearest, centroid, score, radius, rejected), one row per row of ``docs`` (doc_id, text, lang).

    Rows whose id has the remainder ``HELD_OUT`` are not learned from.  ``score`` is the cosine with the
    nearest centroid, ``radius`` the largest accepted distance (1 - cosine) from it."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT
    docs = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text", F.col("lang").alias("given"))
    model = fit(docs.filter(~F.col("held_out")).select(F.col("given").alias("lang"), "text"), clusters, rounds)
    known = docs.select("doc_id", "held_out", "given", has_letter("text").alias("letters"), "text")
    if model is None:
        none = F.lit(None)
        return known.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang"), none.cast("string").alias("nearest"),
                            none.cast("int").alias("centroid"), F.lit(0.0).alias("score"), none.cast("double").alias("radius"),
                            F.lit(True).alias("rejected"))

    def run(batches):
        for batch in batches:
            centroid, score = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for i, j, counts in gram_counts(batch.column(4)):
                centroid[i:j], score[i:j] = model.nearest(unit_vectors(counts, model.idf))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(centroid), pa.array(score.round(6))],
                                             ["doc_id", "held_out", "given", "letters", "centroid", "score"])

    found = freeze(known.mapInArrow(run, "doc_id long, held_out boolean, given string, letters boolean, centroid int, score double"))
    names = F.array(*[F.lit(model.langs[k]) for k in model.of])
    found = found.withColumn("nearest", F.when(F.col("letters"), F.get(names, F.col("centroid"))))
    # of each centroid's own training documents, the distance that holds the given share: counts in 1001 steps
    step = F.floor((1 - F.col("score")) * 1000).cast("int")
    counts = (found.filter(~F.col("held_out") & F.col("letters") & (F.col("given") == F.col("nearest")))
              .groupBy("centroid", step.alias("step")).count())
    by = Window.partitionBy("centroid")
    running = F.sum("count").over(by.orderBy("step"))
    radii = (counts.select("centroid", "step", running.alias("within"), F.sum("count").over(by).alias("all"))
             .filter(F.col("within") * 1000 >= F.col("all") * accepted).groupBy("centroid")
             .agg(((F.min("step") + 1) / 1000).alias("radius")))
    distance = F.col("nearest").isNull() | (1 - F.col("score") > F.coalesce("radius", F.lit(0.0)))
    return found.join(F.broadcast(radii), "centroid", "left").select(
        "doc_id", "held_out", F.when(distance, UNKNOWN).otherwise(F.col("nearest")).alias("lang"), "nearest",
        F.when(F.col("letters"), F.col("centroid")).alias("centroid"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        "radius", distance.alias("rejected"))
