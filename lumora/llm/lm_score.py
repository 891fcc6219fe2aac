"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

The model (Mnih and Hinton, "Three new graphical models for statistical language modelling", 2007;
Mnih and Teh, "A fast and simple algorithm for training neural probabilistic language models", 2012)
predicts the class of each token from the ``ORDER`` tokens before it: their vectors, each scaled by
its position's weights, add up to a predicted vector, whose products with the classes' vectors plus
biases are the scores.  The most frequent tokens are classes of their own; the others share ``BUCKETS``
classes by their last bytes.  Of those, ``MEMBERS`` times the square root of the number of distinct
tokens, the next most frequent ones, have vectors of their own: as contexts, and as members of their
class, of which the predicted vector says which one comes, or that it is one of the rest.  Within the
rest a token's probability is its smoothed share.  Scoring divides by the sum over all classes, and by
the sum over the members of the class (a matrix product per block of tokens, and one per class), so a
text's probability is a product of normalised conditional ones.  Classes and members both learn by
noise-contrastive estimation; noise for a member comes from its class.

1. Counts of all training tokens are summed per task, then shuffled by token.
2. Every training document is used for training once: tasks start from the same parameters, make
   steps over their own documents, and the parameters are averaged, weighted by tokens, in Spark, by
   parts of the model;
   the second half of the documents starts from the average of the first.
3. Texts are encoded once, as numbers of classes, and written; training and scoring read those.  Encoding looks up
   frequent tokens in a table of ``HEAD`` counts sent to the tasks; the others, once
   per document, are joined with the counts of the whole vocabulary.

Tokens are known by 64-bit hashes.  NULL and empty texts are one end token; repeated rows are counted
and scored each; without training documents every class is as likely as any; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import U64, in_train, lower_ascii, mix, pieces, words
from lumora.plans.freeze import freeze

FOLDS = 10
ORDER, VECTOR = 4, 24
WORDS, BUCKETS, MEMBERS = 128, 128, 8
HEAD = 131_072
NOISE, BATCH, RATE = 32, 1024, 0.2
#: Tokens in a row that a step takes from a text.
SEGMENT = 64
#: Noise samples for each member, and the weight of a member's gradient in a step (a class has 1 / batch).
INNER_NOISE, INNER_WEIGHT = 1, 0.3
#: Bits of a natural logarithm's unit, and the size of scores in bits whose powers of two are summed as they are.
BITS, SAFE = np.float32(1 / np.log(2)), 115
#: Parts of a class's noise that are looked up at once.
CELLS = 512
#: Parameters averaged as one row.
PART = 4096
ROUNDS = 2
#: Tokens whose scores are in memory at once, tokens whose vectors are added up at once, and tokens whose predicted vectors
#: are in memory; bytes of text tokenised at once.
BLOCK, STRETCH = 128, 512
RUN, TEXT = 200_000, 1 << 18
#: Hash of the end token, which no word has but by chance.
END = U64(0x0123456789ABCDEF)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, bucket) of all tokens, each document's end last."""
    n, data = len(offsets) - 1, lower_ascii(data)
    start, stop, doc, h = words(data, offsets)
    tail = np.zeros(len(h), U64)
    for k in range(1, 4):
        tail = tail * U64(257) + np.where(stop - k >= start, data.take(stop - k, mode="clip"), 0)
    bucket = (mix(tail) % U64(BUCKETS)).astype(np.int64)
    at = np.arange(len(doc)) + doc                      # an end after every document before
    hashes, buckets = np.full(len(doc) + n, END), np.zeros(len(doc) + n, np.int64)
    hashes[at], buckets[at] = h, bucket
    return np.repeat(np.arange(n), np.bincount(doc, minlength=n) + 1), hashes, buckets


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def count_words(docs: DataFrame) -> DataFrame:
    """(h, bucket, c): the count of every token in the training documents, written."""

    def run(batches):
        def row(parts):
            h, bucket, c = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h)
            h = h.take(order)
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            return h.take(first), bucket.take(order.take(first)), np.add.reduceat(c.take(order), first)

        def out(h, bucket, c):
            return pa.RecordBatch.from_arrays([_longs(h), pa.array(bucket.astype(np.int32)), pa.array(c)], ["h", "bucket", "c"])

        held = []
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0), TEXT):
                _, h, bucket = tokens(data, offsets)
                held.append(row([(h, bucket, np.ones(len(h), np.int64))]))
                if sum(len(x[0]) for x in held) > 1_500_000:
                    held = [row(held)]
                    if len(held[0][0]) > 750_000:
                        yield out(*held[0])
                        held = []
        if held:
            yield out(*row(held))

    counted = docs.filter("train").select("text").mapInArrow(run, "h long, bucket int, c long")
    return freeze(counted.groupBy("h").agg(F.min("bucket").alias("bucket"), F.sum("c").alias("c")))


@dataclass
class Vocabulary:
    """The frequent tokens with their counts, the classes, and the totals."""

    total: int
    distinct: int
    head: np.ndarray          # sorted hashes
    count: np.ndarray         # their counts
    own: np.ndarray           # their own code, or -1
    mass: np.ndarray          # per class: the logarithm (base 10) of what the count of a token without its own code is divided by
    noise: np.ndarray         # per class: its share of the training tokens, smoothed
    words: int                # classes of one token
    member: np.ndarray        # per member, by class: its class
    share: np.ndarray         # per member: its count

    @property
    def classes(self) -> int:
        return self.words + BUCKETS

    @functools.cached_property
    def _guide(self) -> tuple[U64, np.ndarray, np.ndarray]:
        """A shift, the first place of the frequent hashes from each number of upper bits on, and the hashes with one above them."""
        bits = len(self.head).bit_length() + 1
        lowest = np.arange(1 << bits, dtype=U64) << U64(64 - bits)
        return U64(64 - bits), np.searchsorted(self.head, lowest), np.append(self.head, U64(2 ** 64 - 1))

    def look_up(self, h: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, place among the frequent ones or -1) of each token: codes of members follow those
        of the classes, whose codes mean the class's only token or one of its rest."""
        if not len(self.head):
            return self.words + bucket, np.full(len(h), -1)
        shift, guide, head = self._guide
        at = _search(head, guide, (h >> shift).astype(np.intp), h)
        hit = head.take(at) == h
        hit &= at < len(self.head)
        at[~hit] = -1
        own = np.append(self.own, -1).take(at, mode="wrap")
        return np.where(own >= 0, own, self.words + bucket), at

    @property
    def kind(self) -> type:
        """Of codes as they are written; the start of a text follows those of the members."""
        return np.uint16 if self.classes + len(self.member) < 1 << 16 else np.int32

    def model(self) -> LogBilinear:
        rest = np.where(np.arange(self.classes) < self.words, 0, 10 ** self.mass)
        return LogBilinear(self.noise, self.member, self.share, rest)


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = counts.select("h", "bucket", "c").orderBy(F.desc("c"), "h").limit(head).toArrow()
    h, bucket, c = (np.asarray(top.column(k)) for k in range(3))
    by = {r["bucket"]: (r["m"], r["v"]) for r in counts.groupBy("bucket").agg(
        F.sum("c").alias("m"), F.count(F.lit(1)).alias("v")).collect()}
    m, v = (np.array([by.get(k, (0, 0))[i] for k in range(BUCKETS)], np.float64) for i in (0, 1))
    n = min(WORDS, len(h))
    np.subtract.at(m, bucket[:n], c[:n])
    np.subtract.at(v, bucket[:n], 1)
    share = np.concatenate([c[:n], m]) + 1.0
    inner = np.arange(n, min(len(h), n + int(MEMBERS * distinct ** 0.5)))
    inner = inner[np.argsort(bucket[inner], kind="stable")]
    np.subtract.at(m, bucket[inner], c[inner])
    np.subtract.at(v, bucket[inner], 1)
    own = np.full(len(h), -1)
    own[:n] = np.arange(n)
    own[inner] = n + BUCKETS + np.arange(len(inner))
    order = np.argsort(h.view(U64))
    return Vocabulary(total or 0, distinct, h.view(U64)[order], c[order], own[order],
                      np.concatenate([np.zeros(n), np.log10(m + 0.1 * (v + 1))]), share / share.sum(), n,
                      n + bucket[inner].astype(np.int64), c[inner].astype(np.float64))


class LogBilinear:
    """R: vectors of codes before a token (the last one stands for the text's start); D: weights of
    positions; Q, b: vectors and biases of predicted classes; S: vectors of the members of classes, and of
    the rest after them, their biases last."""

    NAMES = ("R", "D", "Q", "b", "S")

    def __init__(self, noise: np.ndarray, member: np.ndarray = np.zeros(0, np.int64), count: np.ndarray = np.zeros(0),
                 rest: np.ndarray | None = None, seed: int = 2) -> None:
        """``member``: the class of each member, in order; ``count``: theirs; ``rest``: the count of each class's rest."""
        r, n = np.random.default_rng(seed), len(noise)
        self.noise = noise
        self.up_to = np.cumsum(noise)
        self.log_k = np.log(NOISE * noise).astype(np.float32)
        # places of the second level: the members of a class, then its rest
        inside = np.bincount(member, minlength=n)
        self.width = np.where(inside > 0, inside + 1, 0)
        self.first = np.cumsum(self.width) - self.width
        self.start = n + len(member)                     # the code of a text's start, which is never predicted
        self.top = np.concatenate([np.arange(n), member, [0]])
        own = self.first[member] + np.arange(len(member)) - (np.cumsum(inside) - inside)[member]
        self.place = np.concatenate([np.where(inside > 0, self.first + inside, -1), own, [-1]])
        share = np.zeros(int(self.width.sum()))
        share[own] = count
        if len(member):
            share[self.place[:n][inside > 0]] = rest[inside > 0]
            sums = np.add.reduceat(share, self.first[inside > 0])
            share /= np.repeat(sums, self.width[inside > 0])
        self.order = np.cumsum(inside > 0) - 1          # of a class among those with members
        up_to = np.cumsum(share)
        self.inner_guide = np.searchsorted(up_to, np.arange(CELLS * int((inside > 0).sum()) + 1) / CELLS)
        self.inner_up_to = np.append(up_to, np.inf)
        self.inner_log_k = np.log(INNER_NOISE * share).astype(np.float32)
        before = r.normal(0, 0.3, (n + 1, VECTOR)).astype(np.float32)
        self.p = {"R": np.concatenate([before[self.top[:-1]], before[n:]]),
                  "D": np.full((ORDER, VECTOR), 0.5, np.float32),
                  "Q": r.normal(0, 0.3, (n, VECTOR)).astype(np.float32), "b": np.log(noise).astype(np.float32),
                  "S": np.zeros((len(share), VECTOR + 1), np.float32)}
        self.p["S"][:, VECTOR] = np.log(share)
        self.square = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].reshape(-1) for k in self.NAMES])

    def load(self, x: np.ndarray) -> LogBilinear:
        at = 0
        for k in self.NAMES:
            size = self.p[k].size
            self.p[k] = np.array(x[at:at + size], np.float32).reshape(self.p[k].shape)
            at += size
        return self

    def _wide(self, n: int) -> np.ndarray:
        """The positions' weights, repeated for n tokens in a row."""
        return np.broadcast_to(self.p["D"][:, None], (ORDER, n, VECTOR)).reshape(ORDER, -1)

    @staticmethod
    def _along(before: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """The predicted vectors of rows of tokens, each row in one piece; of ``before``, the vectors of their codes, the first ORDER are context only."""
        n = before.shape[1] - ORDER * VECTOR
        r = before[:, (ORDER - 1) * VECTOR:][:, :n] * wide[0, :n]
        part = np.empty_like(r)
        for k in range(2, ORDER + 1):
            np.multiply(before[:, (ORDER - k) * VECTOR:][:, :n], wide[k - 1, :n], out=part)
            r += part
        return r

    def _move(self, name: str, at: np.ndarray | None, d: np.ndarray) -> None:
        """A step against gradient ``d``, which is used up, of the rows ``at``, or of all."""
        square, p = self.square[name], self.p[name]
        s, x = (square, p) if at is None else (square.take(at, axis=0), p.take(at, axis=0))
        s += d * d
        d *= RATE
        d /= np.sqrt(s)
        x -= d
        if at is not None:
            _put(square, at, s)
            _put(p, at, x)

    def step(self, codes: np.ndarray, random: np.random.Generator) -> None:
        """One step of noise-contrastive estimation on rows of codes, of which the first ORDER are context
        only: the noise samples of classes serve the whole batch."""
        p, codes = self.p, codes.astype(np.intp)
        code = codes[:, ORDER:].reshape(-1)
        target, starts = self.top.take(code), np.flatnonzero(code >= self.start)
        n = max(1, len(code) - len(starts))
        other = np.minimum(np.searchsorted(self.up_to, random.random(NOISE)), len(self.noise) - 1)
        bias = p["b"] - self.log_k
        wide = self._wide(codes.shape[1] - ORDER)
        before = p["R"].take(codes, axis=0).reshape(len(codes), -1)
        r = self._along(before, wide).reshape(-1, VECTOR)
        q, q_other = p["Q"].take(target, axis=0), p["Q"].take(other, axis=0)
        g_mine = (r * q) @ np.ones(VECTOR, np.float32)
        g_mine += bias.take(target)
        g_mine = _sigmoid(g_mine)
        g_mine -= 1
        g_theirs = q_other @ r.T                            # a row per sample
        g_theirs += bias.take(other)[:, None]
        g_theirs = _sigmoid(g_theirs)
        g_mine[starts], g_theirs[:, starts] = 0, 0
        dr = g_theirs.T @ q_other
        q *= g_mine[:, None]
        dr += q
        hot = (np.arange(len(self.noise))[:, None] == other).astype(np.float32)
        g_q, g_b = hot @ (g_theirs @ r), hot @ g_theirs.sum(1)
        at, sums, sum_b = _sums(target, len(g_q), r * g_mine[:, None], g_mine)
        g_q[at] += sums
        g_b[at] += sum_b
        inner = self._inner(r, code, dr, random)
        dr = dr.reshape(len(codes), -1)
        g_before, g_wide, part = np.empty_like(before), np.empty_like(wide), np.empty_like(dr)
        g_before[:, dr.shape[1]:] = 0
        for k in range(ORDER, 0, -1):
            here = slice((ORDER - k) * VECTOR, (ORDER - k) * VECTOR + dr.shape[1])
            np.einsum("ij,ij->j", before[:, here], dr, out=g_wide[k - 1])
            if k == ORDER:
                np.multiply(dr, wide[k - 1], out=g_before[:, here])
            else:
                g_before[:, here] += np.multiply(dr, wide[k - 1], out=part)
        at, sums = _sums(codes.reshape(-1), len(p["R"]), g_before.reshape(-1, VECTOR))
        sums *= np.where((at < len(self.noise)) | (at == self.start), 1 / n, INNER_WEIGHT).astype(np.float32)[:, None]
        self._move("R", at, sums)
        self._move("Q", None, g_q / n)
        self._move("b", None, g_b / n)
        self._move("D", None, g_wide.reshape(ORDER, -1, VECTOR).sum(1) / n)
        if inner:
            self._move("S", *inner)

    def _inner(self, r: np.ndarray, code: np.ndarray, dr: np.ndarray, random: np.random.Generator):
        """(places, gradients) of the second level, whose part of the gradient of ``r`` is added to ``dr``."""
        place = self.place.take(code)
        some = np.flatnonzero(place >= 0)
        if not len(some):
            return None
        cls = self.top.take(code.take(some))
        drawn = self.order.take(cls) + random.random((len(some), INNER_NOISE)).T
        drawn = _search(self.inner_up_to, self.inner_guide, (drawn * CELLS).astype(np.intp).ravel(), drawn.ravel()).reshape(drawn.shape)
        first = self.first.take(cls)
        at = np.concatenate([place.take(some)[None], np.minimum(np.maximum(drawn, first), first + self.width.take(cls) - 1)])
        vectors = self.p["S"].take(at, axis=0)
        mine = np.ones((len(some), VECTOR + 1), np.float32)
        mine[:, :VECTOR] = r.take(some, axis=0)
        z = np.einsum("knd,nd->kn", vectors, mine)
        z -= self.inner_log_k.take(at)
        g = _sigmoid(z)
        g[0] -= 1
        vectors *= g[:, :, None]
        _put(dr, some, dr.take(some, axis=0) + vectors.sum(0)[:, :VECTOR])
        toward = g[:, :, None] * mine[:, :VECTOR]
        at, sums, sum_b = _sums(at.reshape(-1), len(self.p["S"]), toward.reshape(-1, VECTOR), g.reshape(-1))
        sums = np.concatenate([sums, sum_b[:, None]], axis=1)
        sums *= np.float32(INNER_WEIGHT)
        return at, sums

    def log10(self, context: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The normalised log10 probability of each code after its context: the ORDER codes before it, the nearest first."""
        rows_ = np.concatenate([context[:, ::-1], np.asarray(code)[:, None]], axis=1)
        wide = self._wide(1)
        return self._log10(lambda lo, hi: self._along(self.p["R"].take(rows_[lo:hi], axis=0).reshape(hi - lo, -1), wide), np.asarray(code))

    def log10_along(self, codes: np.ndarray) -> np.ndarray:
        """The same for each code of a sequence but the first ORDER ones, which are context."""
        wide = self._wide(STRETCH)
        return self._log10(lambda lo, hi: self._along(self.p["R"].take(codes[lo:hi + ORDER], axis=0).reshape(1, -1), wide).reshape(-1, VECTOR),
                           codes[ORDER:])

    def _log10(self, predicted, code: np.ndarray) -> np.ndarray:
        """Of each code's class, and of itself within the class; ``predicted`` gives the vectors of a stretch."""
        # the bias is one more component; scores are in bits, as powers of two take less time than those of e
        target, weights = self.top.take(code), np.vstack([self.p["Q"].T, self.p["b"]]) * BITS
        r = np.ones((len(code), VECTOR + 1), np.float32)
        for at in range(0, len(code), STRETCH):
            r[at:at + STRETCH, :VECTOR] = predicted(at, min(at + STRETCH, len(code)))
        # no score is larger than the product of the lengths; up to SAFE, sums of powers are safe as they are
        length = np.einsum("ij,ij->i", r, r)
        longest = np.einsum("ij,ij->j", weights, weights).max()
        room = np.empty(BLOCK * len(self.noise), np.float32)
        mine, total = np.empty((2, len(code)), np.float32)
        for at in range(0, len(code), BLOCK):
            here = slice(at, at + BLOCK)
            mine[here], total[here] = _share(r[here], weights, target[here], length[here].max() * longest <= SAFE ** 2, room)
        out = mine.astype(np.float64) - np.log2(total)
        # the second level, class by class
        place = self.place.take(code)
        some = np.flatnonzero(place >= 0)
        some = some[np.argsort(target[some].astype(np.uint16), kind="stable")]
        ends = np.flatnonzero(np.append(target[some][1:] != target[some][:-1], True)) + 1 if len(some) else []
        r, place, length = r.take(some, axis=0), place.take(some), length.take(some)
        mine, total = np.empty((2, len(some)), np.float32)
        for lo, hi in zip([0, *ends[:-1]], ends):
            first, width = (int(x[target[some[lo]]]) for x in (self.first, self.width))
            inner = np.multiply(self.p["S"][first:first + width].T, BITS, order="C")
            longest = np.einsum("ij,ij->j", inner, inner).max()
            size = max(1, BLOCK * len(self.noise) // width)
            for at in range(lo, hi, size):
                here = slice(at, min(hi, at + size))
                mine[here], total[here] = _share(r[here], inner, place[here] - first, length[here].max() * longest <= SAFE ** 2, room)
        out[some] += mine.astype(np.float64) - np.log2(total)
        return out * np.log10(2)


def _share(r: np.ndarray, weights: np.ndarray, target: np.ndarray, safe: bool, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores r @ weights at ``target``, sums of 2 to the power of all), both lowered alike where sums aren't ``safe``; ``room`` holds the scores."""
    shape = len(r), weights.shape[1]
    score = np.matmul(r, weights, out=room[:shape[0] * shape[1]].reshape(shape)) if shape[0] * shape[1] <= len(room) else r @ weights
    if not safe and not max(score.max(), -score.min()) <= SAFE:
        score -= score.max(1, keepdims=True)
    mine = score[np.arange(len(score)), target]
    np.exp2(score, out=score)
    return mine, score @ np.ones(shape[1], np.float32)


def _search(up: np.ndarray, guide: np.ndarray, cell: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What np.searchsorted(up, x) gives, for ``up`` that ends above all of x and ``guide``, the first places of cells of
    values, of which few have many places: upwards from there."""
    at = guide.take(cell)
    later = np.flatnonzero(up.take(at) < x)
    while len(later):
        at[later] += 1
        later = later[up.take(at.take(later)) < x.take(later)]
    return at


def _put(x: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """x[at] = rows, a row at once."""
    row = f"V{x.strides[0]}"
    x.view(row)[:, 0][at] = rows.view(row)[:, 0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) in the place of x, which counts as 30 at most either way."""
    if x.size and not max(x.max(), -x.min()) <= 30:
        np.clip(x, -30, 30, out=x)
    x *= -BITS
    np.exp2(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums(at: np.ndarray, n: int, *xs: np.ndarray) -> list[np.ndarray]:
    """Distinct values of ``at``, which are below n, and the sums of their rows of each of ``xs``: rows sorted (by radix, if they are few) and added up by run."""
    order = np.argsort(at.astype(np.uint16) if n < 1 << 16 else at, kind="stable")
    at = at.take(order)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    found = [at.take(first)]
    for x in xs:
        x = x.take(order, axis=0)
        twos = x.view(np.complex64) if x.ndim == 2 and x.shape[1] % 2 == 0 else x        # adds two columns at once
        found.append(np.add.reduceat(twos, first, axis=0).view(x.dtype))
    return found


_ENCODED = ("rid long, doc_id long, held_out boolean, part int, n_tokens long, known long, base double, within double, "
            "code binary, tail array<struct<h:long,n:int>>")


def encode(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> DataFrame:
    """Every text as codes, with all of its score that counts alone give, written.

    ``part`` says which round a training text serves in; ``code`` has the codes' bytes, as numbers of ``known.kind``;
    ``tail`` has the tokens that aren't frequent."""
    every = np.log10(known.total + 0.1 * (known.distinct + 1))

    def run(batches):
        logs = np.append(np.log10(known.count + 0.1), 0.0)
        for batch in batches:
            found, tails, codes = [], [], []
            for i, j, data, offsets in pieces(batch.column(4), TEXT):
                n = j - i
                doc, h, bucket = tokens(data, offsets)
                code, at = known.look_up(h, bucket)
                seen = at >= 0
                log_count = logs.take(at, mode="wrap")
                rest = (code >= known.words) & (code < known.classes)
                within = np.where(rest, log_count - known.mass.take(code, mode="clip"), 0.0)
                found.append([np.bincount(doc, minlength=n), np.bincount(doc[seen], minlength=n),
                              np.bincount(doc, weights=log_count - every, minlength=n), np.bincount(doc, weights=within, minlength=n)])
                codes.append(code.astype(known.kind))
                d, x = doc[~seen], h[~seen]
                order = np.lexsort((x, d))
                d, x = d[order], x[order]
                first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])) if len(d) else np.zeros(0, int)
                many = np.diff(np.append(first, len(d))).astype(np.int32)
                tails.append((np.bincount(d[first], minlength=n), x[first], many))
            if not found:
                continue
            total, at_head, base, within = (np.concatenate(x) for x in zip(*found))
            size, x, many = (np.concatenate(t) for t in zip(*tails))
            lists = lambda n, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(total, pa.int64()), pa.array(at_head, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(within, pa.float64()), _packed(total, np.concatenate(codes)),
                 lists(size, pa.StructArray.from_arrays([_longs(x), pa.array(many, pa.int32())], ["h", "n"]))],
                [f.split()[0] for f in _ENCODED.split(", ")])

    part = F.pmod(F.xxhash64("text"), F.lit(rounds)).cast("int").alias("part")
    return freeze(docs.select("rid", "doc_id", (~F.col("train")).alias("held_out"), part, "text").mapInArrow(run, _ENCODED))


def _packed(size: np.ndarray, codes: np.ndarray) -> pa.Array:
    """The bytes of each text's codes."""
    ends = np.concatenate([[0], np.cumsum(size)]) * codes.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(codes)]).cast(pa.binary())


def _sequence(column: pa.Array, kind: type, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sizes) of a column of codes' bytes as one sequence, with ORDER starts before each text, so that no
    context reaches into another text."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(column) else np.zeros(0, np.uint8)
    size = np.diff(ends) // np.dtype(kind).itemsize
    codes = np.frombuffer(data.tobytes(), kind).astype(np.int32)
    return np.insert(codes, np.repeat(np.cumsum(size) - size, ORDER), start), size


def train(encoded: DataFrame, words_: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """The parameters after each training document of ``encoded`` has been used once."""
    model = words_.model()
    for turn in range(rounds):
        start = model.flat()

        def run(batches):
            mine, random = words_.model().load(start), np.random.default_rng(turn)
            seen, held = 0, []

            def steps(parts, before):
                codes = np.concatenate([*parts, np.full(SEGMENT, mine.start, np.int32)])
                at = np.arange(ORDER, len(codes) - SEGMENT, SEGMENT)
                at = random.permutation(at)
                tokens_ = sum(map(len, parts))
                batch = max(1, min(BATCH, (before + tokens_) // 512) // SEGMENT)      # the first tokens make smaller steps
                for k in range(0, len(at), batch):
                    mine.step(codes[at[k:k + batch, None] + np.arange(-ORDER, SEGMENT)], random)
                return tokens_

            for batch in batches:
                codes, _ = _sequence(batch.column(0), words_.kind, mine.start)
                for at in range(0, len(codes), RUN):                 # a piece of a long batch begins with its context
                    held.append(codes[max(0, at - ORDER):at + RUN])
                    if sum(map(len, held)) >= RUN:
                        seen += steps(held, seen)
                        held = []
            if held:
                seen += steps(held, seen)
            x = mine.flat() if seen else start[:0]
            for at in range(0, len(x), PART):
                yield pa.RecordBatch.from_arrays([pa.array([at // PART], pa.int32()), pa.array([float(seen)]),
                                                  pa.array([x[at:at + PART].tobytes()], pa.binary())], ["part", "seen", "p"])

        part = encoded.filter(~F.col("held_out") & (F.col("part") == turn)).select("code")
        mean = part.mapInArrow(run, _PART).repartition("part").mapInArrow(_mean, _PART).collect()
        if mean:
            model.load(np.concatenate([np.frombuffer(r["p"], np.float32) for r in sorted(mean, key=lambda r: r["part"])]))
    return model


_PART = "part int, seen double, p binary"


def _mean(batches):
    """The mean of each part of the parameters, weighted by the tokens seen."""
    sums, seen = {}, {}
    for batch in batches:
        for k, n, x in zip(*(c.to_pylist() for c in batch.columns)):
            sums[k] = sums.get(k, 0.0) + n * np.frombuffer(x, np.float32).astype(np.float64)
            seen[k] = seen.get(k, 0.0) + n
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([seen[k] for k in sums]),
             pa.array([(sums[k] / seen[k]).astype(np.float32).tobytes() for k in sums], pa.binary())], ["part", "seen", "p"])


_SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"


def score_texts(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """(rid, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``."""
    docs = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"),
                       in_train("doc_id", FOLDS).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    counts = count_words(docs)
    known = vocabulary(counts, head)
    encoded = encode(docs, known)
    model = train(encoded, known)

    def run(batches):
        for batch in batches:
            score = np.array(batch.column(6).to_numpy())
            codes, size = _sequence(batch.column(7), known.kind, model.start)
            row = np.repeat(np.arange(len(size)), size + ORDER)
            for at in range(ORDER, len(codes), RUN):
                part = codes[at - ORDER:at + RUN]
                log10 = np.where(part[ORDER:] < model.start, model.log10_along(part), 0.0)
                score += np.bincount(row[at:at + RUN], weights=log10, minlength=len(score))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(score)], [f.split()[0] for f in _SCORED.split(", ")])

    partial = encoded.select("rid", "doc_id", "held_out", "n_tokens", "known", "base", "within", "code").mapInArrow(run, _SCORED)
    tail = encoded.select("rid", F.explode("tail").alias("t")).select("rid", F.col("t.h").alias("h"), F.col("t.n").alias("n"))
    sums = tail.join(counts.select("h", "c"), "h", "left").groupBy("rid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"))
    more = F.coalesce("more", F.lit(0.0))
    return partial.join(sums, "rid", "left").select(
        "rid", "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(known.total)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))
