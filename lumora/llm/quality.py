"""Document quality by attention-based multiple-instance learning.

After Ilse, Tomczak and Welling, "Attention-based deep multiple instance learning" (2018): a document
is a bag of passages of ``PASSAGE`` words.  Every passage is encoded from its byte-class pairs and word
repetition, a gated attention learned from document labels weighs the passages, and the weighted sum
of their encodings gives the score.  Labels are of documents only; no passage has one.

The model is trained in numpy on at most ``MAX_DOCS`` labelled documents, those with the smallest
hashes of their ids, each of at most ``MAX_PASSAGES`` passages, as far as ``ALL_PASSAGES`` go (280 bytes
each on the driver); scoring covers all passages.  Of texts with one id the one of the smallest hash teaches.  A NULL
or empty text is one empty passage; without labels of both kinds the score is the labels' share (0.5
without any).  Of contradicting labels of a document the lower counts.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import U64, in_train, pieces, words
from lumora.plans.freeze import freeze

PASSAGE = 64
MAX_DOCS, MAX_PASSAGES, ALL_PASSAGES = 6000, 4096, 400_000
FOLDS = 5
THRESHOLD = 0.3
ENCODED, ATTENTION = 24, 12
_CLASSES = 8
FEATURES = _CLASSES * _CLASSES + 6


def _byte_classes() -> np.ndarray:
    """lower, upper, digit, space, line break, sentence mark, other mark, beyond ASCII."""
    out = np.full(256, 6, np.int64)
    out[128:] = 7
    out[97:123], out[65:91], out[48:58], out[32] = 0, 1, 2, 3
    out[9:14] = 4
    out[[ord(c) for c in ".,;:'?"]] = 5
    return out


_CLASS = _byte_classes()


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of each document's passages, features) of concatenated texts."""
    n = len(offsets) - 1
    start, end, doc, h = words(data, offsets)
    count = np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)
    bags = np.maximum(1, -(-count // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(bags)])
    total = int(bounds[-1])
    out = np.zeros((total, FEATURES), np.float32)
    if not len(h):
        return bounds, out
    place = np.arange(len(h)) - (np.cumsum(count) - count)[doc]
    passage = bounds[doc] + place // PASSAGE
    many = np.maximum(1, np.bincount(passage, minlength=total)).astype(np.float32)
    # byte-class pairs: a byte belongs to the passage of the last word that began before it in its document,
    # or to the document's first passage; without words nothing is counted
    where = np.repeat(np.arange(n), np.diff(offsets))
    word = np.zeros(len(data), np.int64)
    word[start] = 1
    word = np.maximum(np.cumsum(word) - 1, 0)
    owner = np.where((doc[word] == where) & (start[word] <= np.arange(len(data))), passage[word], bounds[where])
    kind = _CLASS[data]
    inside = (where[1:] == where[:-1]) & (count[where[:-1]] > 0)
    pair = (owner[:-1] * _CLASSES * _CLASSES + kind[:-1] * _CLASSES + kind[1:])[inside]
    pair = np.bincount(pair, minlength=total * _CLASSES * _CLASSES).reshape(total, -1).astype(np.float32)
    out[:, :_CLASSES * _CLASSES] = np.sqrt(pair / np.maximum(1, pair.sum(1, keepdims=True)))
    # repetition: of the word before, of the words two before, of any word in the passage
    def share(flag):
        return np.bincount(passage[flag], minlength=total) / many
    near = np.zeros(len(h), bool)
    near[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    far = np.zeros(len(h), bool)
    far[2:] = (h[2:] == h[:-2]) & (passage[2:] == passage[:-2])
    order = np.argsort(h ^ (passage.astype(U64) * U64(0x9E3779B97F4A7C15)), kind="stable")
    again = np.zeros(len(h), bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (passage[order[1:]] == passage[order[:-1]])
    k = _CLASSES * _CLASSES
    out[:, k], out[:, k + 1], out[:, k + 2] = share(near), share(far), share(again)
    out[:, k + 3] = np.bincount(passage, weights=end - start, minlength=total) / many / 10
    out[:, k + 4] = share(end - start == 1)
    out[:, k + 5] = np.log1p(np.bincount(passage, minlength=total)) / 4
    return bounds, out


def _softmax(a: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    size = np.diff(bounds)
    e = np.exp(a - np.repeat(np.maximum.reduceat(a, bounds[:-1]), size))
    return e / np.repeat(np.add.reduceat(e, bounds[:-1]), size)


class Bags:
    """The model; arrays only, so that it is small to send."""

    def __init__(self, features: int = FEATURES, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)
        self.p = {"W": g(features, ENCODED), "b": np.zeros(ENCODED, np.float32), "V": g(ENCODED, ATTENTION),
                  "U": g(ENCODED, ATTENTION), "a": g(ATTENTION, 1), "w": g(ENCODED, 1), "c": np.zeros(1, np.float32)}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, bounds: np.ndarray):
        p = self.p
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        weight = _softmax(((t * s) @ p["a"])[:, 0], bounds)
        z = np.add.reduceat(h * weight[:, None], bounds[:-1], axis=0)
        y = 1 / (1 + np.exp(-np.clip((z @ p["w"])[:, 0] + p["c"][0], -30, 30)))
        return h, t, s, weight, z, y

    def score(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bounds) - 1, self.constant)
        return self.forward((x - self.mean) / self.scale, bounds)[-1].astype(np.float64)

    def gradient(self, x, bounds, label):
        p, size = self.p, np.diff(bounds)
        h, t, s, weight, z, y = self.forward(x, bounds)
        e = ((y - label) / len(label)).astype(np.float32)[:, None]
        g = {"w": z.T @ e, "c": e.sum(0)}
        dz = np.repeat(e @ p["w"].T, size, axis=0)
        dweight = (dz * h).sum(1)
        mean = np.add.reduceat(dweight * weight, bounds[:-1])
        da = (weight * (dweight - np.repeat(mean, size)))[:, None]
        g["a"] = (t * s).T @ da
        dg = da @ p["a"].T
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        g["V"], g["U"] = h.T @ dt, h.T @ ds
        dh = (dz * weight[:, None] + dt @ p["V"].T + ds @ p["U"].T) * (h > 0)
        g["W"], g["b"] = x.T @ dh, dh.sum(0)
        return g

    def fit(self, bags: list[np.ndarray], label: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 0.004) -> Bags:
        if len(set(label.tolist())) < 2:
            self.constant = float(label.mean()) if len(label) else 0.5
            return self
        rows = np.concatenate(bags)
        self.mean, self.scale = rows.mean(0), rows.std(0) + np.float32(0.02)
        bags = [(b - self.mean) / self.scale for b in bags]
        r = np.random.default_rng(7)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        epochs = max(10, min(epochs, 240_000 // len(bags)))
        for _ in range(epochs):
            order = r.permutation(len(bags))
            for at in range(0, len(order), batch):
                mine = order[at:at + batch]
                bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in mine])])
                g = self.gradient(np.concatenate([bags[i] for i in mine]), bounds, label[mine])
                step += 1
                for k in self.p:
                    d = g[k] + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Bags:
    """A model from a bounded sample of the labelled training documents."""
    chosen = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(in_train("doc_id", FOLDS))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in pieces(batch.column(1)):
                bounds, x = passages(data, offsets)
                few = [k for k in range(j - i) if bounds[k + 1] - bounds[k] <= MAX_PASSAGES]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i).take(pa.array(few, pa.int64())) for k in (0, 2)]
                    + [pa.array([x[bounds[k]:bounds[k + 1]].tobytes() for k in few], pa.binary())], ["doc_id", "quality", "bag"])

    sample = freeze(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
                    .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
                        F.min_by("text", F.xxhash64("text")).alias("text"), F.first("quality").alias("quality"))
                    .mapInArrow(run, "doc_id long, quality int, bag binary"))
    sizes = sample.select("doc_id", F.octet_length("bag").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    used = sum(x <= ALL_PASSAGES * 4 * FEATURES for x in itertools.accumulate(r["size"] for r in sizes))
    found = sample if used == len(sizes) else sample.filter(F.col("doc_id").isin([r["doc_id"] for r in sizes[:used]]))
    found = found.select("quality", "bag").collect()
    bags = sorted((r["quality"], bytes(r["bag"])) for r in found)
    return Bags().fit([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, b in bags],
                      np.array([q for q, _ in bags], np.float32))


def _scores(model: Bags, texts: pa.Array) -> np.ndarray:
    found = [model.score(x, bounds) for bounds, x in (passages(data, offsets) for _, _, data, offsets in pieces(texts))]
    return np.concatenate(found) if found else np.zeros(0)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    model = fit(docs, labels, max_docs)

    def run(batches):
        for batch in batches:
            y = _scores(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(y, pa.float64()), pa.array((y >= threshold).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), (~in_train("doc_id", FOLDS)).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold`` or more."""
    model, text = fit(docs, labels, max_docs), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(text)) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
