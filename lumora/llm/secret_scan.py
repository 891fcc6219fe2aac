"""Secrets by rules and a character convolutional network.

The rules find assignments to telling names, access keys and long hexadecimal runs.  Candidates are
the rules' spans, every run of ``SHORTEST`` or more characters that secrets are made of, and what
stands after ``:`` or ``=`` from ``LEAST`` characters on, punctuation included, whatever the name.  A
convolutional network in numpy (one layer of width ``WIDTH`` over learned character vectors, after
Kim, "Convolutional neural networks for sentence classification", 2014) looks at each candidate's
characters and at ``CONTEXT`` characters on either side, and takes the largest response of each filter
in each of the three parts; a candidate longer than ``TILE`` is seen in tiles, of which the highest
score counts.  It is trained on a drawn tile of every distinct candidate, findings of the rules and others, dealt
by hash to tasks of some ``PER_TASK``; these start each of ``EPOCHS`` rounds from the same parameters, which Spark averages
after it by number of samples, Adam's moments too.  What a part teaches is written as codes once for all rounds.  Half of the findings are shown with the text of another
place around them, so that what a secret looks like counts too, and a quarter of all samples once more
with some punctuation in them.  Scores are calibrated (Platt) on a
fifth held back, seen whole, and the threshold keeps ``RECALL`` of the findings held back: it lies halfway (in
log odds) between the score that just does and the next lower one of another candidate, as all between
them are equally precise; its precision there is reported (``precision``, and in the log).  Other candidates that a network
trained on other ones takes for a secret are left out of training.  Candidates from the threshold on
are added as kind ``model`` where no rule's span overlaps, of overlapping ones the best; a rule's
span stays.

NULL and empty texts have no spans, an empty table gives an empty result, repeated rows each get
theirs, extra columns are ignored.  Without findings to learn from, nothing is added.
"""

from __future__ import annotations

import bisect
import copy
import hashlib
import logging
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import pieces, rows, spans_text
from lumora.plans.freeze import freeze
from lumora.plans.sums import vector_sums

_log = logging.getLogger(__name__)

KINDS = ("assign", "access", "hex", "model")
SHORTEST, LEAST, CONTEXT, TILE = 16, 6, 24, 64
#: Tiles scored at once.
TILES = 4096
PER_TASK, EPOCHS = 4000, 6
#: Logits are counted in bins of 1 / BINS to fit Platt's a and b.
BINS = 64
RECALL = 0.95
MARKS = "!#$%&*?@^~.|"
WIDTH, VECTOR, FILTERS = 5, 10, 24
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
_RUN = re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: What stands after a colon or an equals sign: all of it, and the parts between further such signs.
_VALUES = (re.compile(r"""[:=]\x20*+["']?+([^\s"'`,;()<>{}\[\]:=][^\s"'`,;()<>{}\[\]]++)"""),
           re.compile(r"""[:=]\x20*+["']?+([^\s"'`,;()<>{}\[\]:=]++(?:={1,2}+(?![^\s"'`,;()<>{}\[\]]))?+)"""))


#: By byte: 1 for what runs are made of, 2 for a colon or an equals sign.
_BYTES = bytes((c < 128 and (chr(c).isalnum() or chr(c) in "+/_=-")) + 2 * (c in b":=") for c in range(256))


def suspects(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    """(number, text, what ``_RUN`` finds in it) of the texts that hold such a run, a colon or an equals sign.  No rule
    finds anything and there is no candidate in any other; no Python object is made for them."""
    kind = np.frombuffer(data.tobytes().translate(_BYTES), np.uint8)
    whole, size = kind & 1, 1
    while size < SHORTEST:
        step = min(size, SHORTEST - size)
        whole, size = whole[:-step] & whole[step:], size + step
    at = np.flatnonzero(whole.view(bool))       # a run may begin here
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = at + SHORTEST <= offsets[doc + 1]  # and doesn't go on in the next text
    at, doc = at[inside], doc[inside]
    new = np.diff(at, prepend=-2) != 1
    start, stop, doc = at[new], at[np.append(new[1:], True)[:len(at)]] + SHORTEST, doc[new]
    signs = np.searchsorted(offsets, np.flatnonzero(kind > 1), "right") - 1
    for d in np.union1d(doc, signs).tolist():
        mine, (low, high) = slice(*np.searchsorted(doc, (d, d + 1))), offsets[d:d + 2]
        runs, own = np.stack([start[mine], stop[mine]]) - low, data[low:high]
        later = np.flatnonzero((own & 0xC0) == 0x80) if runs.size else runs     # of characters of several bytes
        yield d, own.tobytes().decode(), list(zip(*(runs - np.searchsorted(later, runs)).tolist())) if runs.size else []


def _runs(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _RUN.finditer(text)]


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) of the rules' spans, sorted; ``runs``: what ``_RUN`` finds, where it is known.
    Access keys and hexadecimal runs are parts of those."""
    out = []
    if ":" in text or "=" in text:
        lower = text.encode().lower()
        if any(name in lower for name in _NAMES):
            out += [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    access = "AKIA" in text
    for a, b in _runs(text) if runs is None else runs:
        if access:
            out += [(m.start(), 1, "access", m.end()) for m in _ACCESS.finditer(text, a, b) if len(m[0]) >= 20]
        out += [(m.start(), 2, "hex", m.end()) for m in _HEX.finditer(text, a, b)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, str, int]], runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, bool]]:
    """(start, end, found by a rule): the rules' findings, of an assignment the value only, and the
    other runs and values that overlap no rule's span; these may overlap each other."""
    out, k = [(_ASSIGN.match(text, a).start(2) if kind == "assign" else a, b, True) for a, _, kind, b in base], 0
    others = set(_runs(text) if runs is None else runs)
    for values in _VALUES if ":" in text or "=" in text else ():
        for m in values.finditer(text):
            a, b = m.start(1), m.start(1) + len(m[1].rstrip("."))
            if b - a >= LEAST:
                others.add((a, b))
    for a, b in sorted(others):
        while k < len(base) and base[k][3] <= a:
            k += 1
        if not any(x[0] < b and a < x[3] for x in base[max(0, k - 3):k + 8]):
            out.append((a, b, False))
    return out


#: Stands where there is no character; a text's own U+0000 is read as U+0001.
_PAD = "\0"


def _rows(left: str, parts: Iterable[str], right: str) -> list[str]:
    """For each part of a span context, part, context, padded to one length."""
    before, after = left[-CONTEXT:].replace(_PAD, "\1").rjust(CONTEXT, _PAD), right[:CONTEXT].replace(_PAD, "\1").ljust(CONTEXT, _PAD)
    return [before + part.replace(_PAD, "\1").ljust(TILE, _PAD) + after for part in parts]


def _codes(texts: list[str]) -> np.ndarray:
    """A row of codes for each of the padded texts, all at once: 1-127 for ASCII, 128 beyond; 0 is padding."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return np.minimum(points, 128).astype(np.uint8).reshape(-1, 2 * CONTEXT + TILE)


def _parts(span: str) -> list[str]:
    return [span[i:i + TILE] for i in range(0, len(span), TILE)] or [""]


def tiles(left: str, span: str, right: str) -> np.ndarray:
    """Rows of codes: context, a tile of the span, context."""
    return _codes(_rows(left, _parts(span), right))


#: Windows of the convolution whose middle is in the left context, the span, the right context.
_PARTS = ((0, CONTEXT), (CONTEXT, CONTEXT + TILE), (CONTEXT + TILE, 2 * CONTEXT + TILE))


class Network:
    def __init__(self, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        self.p = {"E": r.normal(0, 0.5, (129, VECTOR)).astype(np.float32),
                  "C": r.normal(0, 0.2, (WIDTH * VECTOR, FILTERS)).astype(np.float32), "b": np.zeros(FILTERS, np.float32),
                  "w": r.normal(0, 0.2, (len(_PARTS) * FILTERS + 1, 1)).astype(np.float32), "c": np.zeros(1, np.float32)}
        self.platt, self.threshold, self.precision = (1.0, 0.0), np.inf, np.nan
        self.moments = [{k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2)]
        self.steps = 0.0

    def flat(self) -> np.ndarray:
        """Parameters, moments and steps in a row, to be averaged."""
        return np.concatenate([*(d[k].ravel() for d in (self.p, *self.moments) for k in self.p), [self.steps]]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        self.p, *self.moments = (self._named(x) for x in flat[:-1].astype(np.float32).reshape(3, -1))
        self.steps = float(flat[-1])

    def _named(self, row: np.ndarray) -> dict[str, np.ndarray]:
        """Views of a row of numbers by the names and shapes of the parameters."""
        ends = np.cumsum([v.size for v in self.p.values()])
        return {k: x.reshape(v.shape) for (k, v), x in zip(self.p.items(), np.split(row, ends[:-1]))}

    def _forward(self, x: np.ndarray):
        """(codes with padding, E without padding's vector, response of each filter at each place).

        A window's response is the sum of those to its ``WIDTH`` codes, which are looked up; it is 0 at padding.  What is
        below 0 counts as 0, which :meth:`_out` sees to for the largest ones only."""
        n, length = x.shape
        e = self.p["E"].copy()
        e[0] = 0
        table = np.matmul(e, self.p["C"].reshape(WIDTH, VECTOR, FILTERS))
        table[0] += self.p["b"]
        padded = np.zeros((n, length + WIDTH - 1), np.uint8)
        padded[:, WIDTH // 2:WIDTH // 2 + length] = x
        place = np.flatnonzero(x != 0)
        codes, at = padded.reshape(-1), place + place // length * (WIDTH - 1)
        some = table[0].take(codes.take(at), 0)
        for k in range(1, WIDTH):
            some += table[k].take(codes.take(at + k), 0)
        r = np.zeros((n * length, FILTERS), np.float32)
        r[place] = some
        return codes, e, r.reshape(n, length, FILTERS)

    def _out(self, x: np.ndarray, pooled: list[np.ndarray]):
        """(what the last layer sees, logits)."""
        size = (x[:, CONTEXT:CONTEXT + TILE] > 0).sum(1, keepdims=True).astype(np.float32) / TILE
        h = np.maximum(np.concatenate([*pooled, size], axis=1), 0).astype(np.float32)
        return h, (h @ self.p["w"])[:, 0] + self.p["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), 256):
            r = self._forward(x[i:i + 256])[-1]
            out.append(self._out(x[i:i + 256], [r[:, a:b].max(1) for a, b in _PARTS])[-1])
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def highest(self, some: Iterable[tuple[str, str, str]]) -> np.ndarray:
        """The highest logit among the tiles of each (left, span, right), with some ``TILES`` in memory."""
        out, held, sizes = [], [], []

        def flush():
            z = self.logits(_codes(held))
            out.append(np.maximum.reduceat(z, np.cumsum([0, *sizes[:-1]])))
            held.clear()
            sizes.clear()

        for left, span, right in some:
            rows = _rows(left, _parts(span), right)
            held += rows
            sizes.append(len(rows))
            if len(held) >= TILES:
                flush()
        if held:
            flush()
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)

    def probability(self, z: np.ndarray) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.probability(self.logits(x))

    def _gradient(self, x, y):
        p, filters = self.p, len(_PARTS) * FILTERS
        codes, e, r = self._forward(x)
        best = np.concatenate([r[:, a:b].argmax(1) + a for a, b in _PARTS], axis=1) + np.arange(len(x))[:, None] * x.shape[1]
        h, logit = self._out(x, [r.reshape(-1).take(best * FILTERS + np.arange(filters) % FILTERS)])
        miss = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)).astype(np.float32)[:, None]
        d = (miss @ p["w"][:filters].T) * (h[:, :filters] > 0)
        some = np.flatnonzero(d)
        d, f = d.take(some), some % FILTERS
        at = best.take(some) + some // filters * (WIDTH - 1)
        # of the responses to each code at each place of a window
        window = np.arange(WIDTH)[:, None]
        cells = (codes.take(at + window) + 129 * window) * FILTERS + f
        table = np.bincount(cells.reshape(-1), np.tile(d, WIDTH), WIDTH * 129 * FILTERS).astype(np.float32).reshape(WIDTH, 129, FILTERS)
        g = {"w": h.T @ miss, "c": miss.sum(0), "E": np.matmul(table, p["C"].reshape(WIDTH, VECTOR, FILTERS).swapaxes(1, 2)).sum(0),
             "C": np.matmul(e.T, table).reshape(WIDTH * VECTOR, FILTERS), "b": np.bincount(f, d, FILTERS).astype(np.float32)}
        g["E"][0] = 0
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> Network:
        r = np.random.default_rng(13 + int(self.steps))
        p, m, v = (np.concatenate([d[k].ravel() for k in self.p]) for d in (self.p, *self.moments))
        self.p, step = self._named(p), self.steps       # views: a step moves all parameters at once
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), batch):
                mine = order[at:at + batch]
                g = self._gradient(x[mine], y[mine])
                g = np.concatenate([g[k].ravel() for k in self.p])
                step += 1
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g ** 2
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self.moments, self.steps = [self._named(m), self._named(v)], step
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> Network:
        return self.calibrate_on(self.logits(x).astype(np.float64), y, recall)

    def _fit_platt(self, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        good, bad = n[y > 0].sum(), n[y == 0].sum()
        target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
        a, b = 1.0, 0.0
        for _ in range(300):
            e = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - target
            a, b = a - 0.05 * np.average(e * z, weights=n) - 1e-4 * a, b - 0.05 * np.average(e, weights=n)
        self.platt = (a, b)

    def calibrate_over(self, held: DataFrame, recall: float = RECALL) -> Network:
        """As :meth:`calibrate_on` for a frozen table (found, z) of any size: Platt's a and b from counts by bin, threshold
        and precision from all rows."""
        held = held.withColumn("bin", F.floor(F.greatest(F.least("z", F.lit(100.0)), F.lit(-100.0)) * BINS))
        bins = sorted(tuple(r) for r in held.groupBy("bin", "found").agg(F.avg("z"), F.count(F.lit(1))).collect())
        z, y, n = (np.array([float(r[k]) for r in bins]) for k in (2, 1, 3))
        if not n[y > 0].sum():
            return self
        self._fit_platt(z, y, n)
        at, below = int((1 - recall) * n[y > 0].sum()), None
        for k, found, _, count in bins:
            if found and at < count:
                for r in held.filter("found").filter(F.col("bin") == k).groupBy("z").count().orderBy("z").collect():
                    least, at = r["z"], at - r["count"]
                    if at < 0:
                        break
                break
            at -= count * found
        below = held.filter("NOT found").filter(F.col("z") < least).agg(F.max("z")).first()[0]
        self.threshold = float(self.probability(np.float64(least)))
        if below is not None:
            least = min(least, (least + below) / 2)
            self.threshold = min(self.threshold, float(self.probability(np.float64(least))))
        kept = held.filter(F.col("z") >= least).agg(F.avg(F.col("found").cast("double")), F.count(F.lit(1))).first()
        self.precision = float(kept[0])
        _log.info("threshold %.4f: precision %.4f on %d held back", self.threshold, self.precision, int(n.sum()))
        return self

    def calibrate_on(self, z: np.ndarray, y: np.ndarray, recall: float = RECALL) -> Network:
        """Platt's a and b on the logits of held-back samples, the threshold that keeps ``recall`` of the
        findings, and the share of findings among the samples from there on."""
        self._fit_platt(z, y, np.ones(len(z)))
        score = self.probability(z)
        good = np.sort(score[y > 0])
        self.threshold = float(good[int((1 - recall) * len(good))]) if len(good) else np.inf
        below = score[(y == 0) & (score < self.threshold)]
        if len(good) and len(below):
            odds = np.log([s / (1 - s) for s in (self.threshold, float(below.max()))])
            self.threshold = min(self.threshold, float(1 / (1 + np.exp(-odds.mean()))))
        if len(good):
            self.precision = float((y[score >= self.threshold] > 0).mean())
            _log.info("threshold %.4f: precision %.4f on %d held back", self.threshold, self.precision, len(y))
        return self


_FOUND = ("rid long, doc_id long, base array<struct<start:long,kind:int,end:long>>, "
          "candidates array<struct<start:long,end:long,found:boolean,left:string,span:string,right:string>>")
_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_CANDIDATES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("found", pa.bool_()), ("left", pa.string()),
                                  ("span", pa.string()), ("right", pa.string())]))


def find(docs: DataFrame) -> DataFrame:
    """The rules' spans and the candidates of each row, written: the only pass over the texts."""

    def run(batches):
        for batch in batches:
            base, found = ([[] for _ in range(len(batch))] for _ in range(2))
            for first, _, data, offsets in pieces(batch.column(2)):
                for d, text, runs in suspects(data, offsets):
                    spans = base_spans(text, runs)
                    base[first + d] = [{"start": a, "kind": k, "end": b} for a, k, _, b in spans]
                    found[first + d] = [{"start": a, "end": b, "found": yes, "left": text[max(0, a - CONTEXT):a], "span": text[a:b],
                                         "right": text[b:b + CONTEXT]} for a, b, yes in candidates(text, spans, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base, _BASE), pa.array(found, _CANDIDATES)],
                ["rid", "doc_id", "base", "candidates"])

    return freeze(rows(docs).mapInArrow(run, _FOUND))


def marked(sample: tuple) -> tuple:
    """The sample with one to three characters of its span replaced by punctuation, which the rules'
    findings lack: of both kinds, so that punctuation by itself says nothing."""
    r = random.Random(sample[0])
    span = list(sample[3])
    for at in r.sample(range(min(len(span), TILE)), min(len(span), r.randint(1, 3))):
        span[at] = r.choice(MARKS)
    return (*sample[:3], "".join(span), sample[4])


_SAMPLE = ("h", "found", "left", "span", "right", "sure")


def _lesson(part: list[tuple], k: int) -> list[tuple]:
    """What a network learns from a part of the samples: 0 and 1 leave out the other candidates of that half, 2 none."""
    good, bad = ([r for r in part if r[1] == found] for found in (True, False))
    others = bad or [(0, False, "", "", "")]
    swap = [(h, f, b[2], s, b[4]) for (h, f, _, s, *_), b in zip(good[::2], others * len(good))]
    some = [r[:5] for r in good + swap + [r for r in bad if r[5] and r[0] // 5 % 2 != k] if r[0] % 5]
    return some + [marked(r) for r in some[::4]]


def _first_tiles(some: list[tuple]) -> np.ndarray:
    return _codes([row for r in some for row in _rows(r[2], [r[3][:TILE]], r[4])])


def _lessons(samples: DataFrame, tasks: int, kinds: tuple[int, ...]) -> DataFrame:
    """(k, y, x): for each part and kind of network what it learns from, as bytes of labels and of codes of tiles; written.
    Each part is dealt to a task of its own."""

    def write(batches):
        part = sorted(r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in _SAMPLE)))
        for k in kinds if part else ():
            some = _lesson(part, k)
            if some:
                lesson = (k, np.array([r[1] for r in some], np.uint8).tobytes(), _first_tiles(some).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(lesson, (pa.int32(), pa.binary(), pa.binary()))], ["k", "y", "x"])

    return freeze(samples.repartitionById(tasks, "part").mapInArrow(write, "k int, y binary, x binary"))


def _taught(samples: DataFrame, tasks: int, kinds: tuple[int, ...]) -> dict[int, Network]:
    """Networks of these kinds, trained on all samples."""
    networks, lessons = {k: Network() for k in kinds}, _lessons(samples, tasks, kinds)
    rounds, epochs = (1, EPOCHS) if tasks == 1 else (EPOCHS, 1)
    for _ in range(rounds):
        def learn(batches):
            for batch in batches:
                for k, y, x in zip(*(c.to_pylist() for c in batch.columns)):
                    mine, y = copy.deepcopy(networks[k]), np.frombuffer(y, np.uint8).astype(np.float32)
                    mine.fit(np.frombuffer(x, np.uint8).reshape(len(y), -1), y, epochs)
                    v = [*(mine.flat() * len(y)), float(len(y))]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v], pa.list_(pa.float64()))], ["k", "v"])

        sums = vector_sums(lessons.mapInArrow(learn, "k int, v array<double>"), "k", "v", "int").collect()
        for r in sums:
            total = np.array(r["total"])
            networks[r["k"]].load(total[:-1] / total[-1])
    return networks


def train(found: DataFrame, per_task: int = PER_TASK) -> Network:
    pool = found.select(F.explode("candidates").alias("c")).select(F.xxhash64("c.left", "c.span", "c.right").alias("h"), "c.*")
    # one tile of each teaches, drawn by a hash
    drawn = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.ceil(F.length("span") / TILE)))
    samples = freeze(pool.withColumn("span", F.col("span").substr((1 + TILE * drawn).cast("int"), F.lit(TILE)))
                     .groupBy("h", "left", "span", "right").agg(F.max("found").alias("found")))
    counts = {r["found"]: r["count"] for r in samples.groupBy("found").count().collect()}
    if True not in counts:
        return Network()
    tasks = -(-sum(counts.values()) // per_task)
    samples = samples.select("h", "found", "left", "span", "right", F.lit(True).alias("sure"),
                             F.pmod(F.xxhash64("h", F.lit(1)), F.lit(tasks)).cast("int").alias("part"))

    # candidates that no rule found may be secrets: those that a network trained without them takes
    # for one don't teach the final network; twice, as the first time they teach each other's
    for _ in range(2):
        halves = _taught(samples, tasks, (0, 1))

        def judge(batches, halves=halves):
            for batch in batches:
                some = list(zip(*(batch.column(k).to_pylist() for k in range(6))))
                sure = np.array([r[1] for r in some], bool)
                for k, network in halves.items():
                    mine = [i for i, r in enumerate(some) if not r[1] and r[0] // 5 % 2 == k]
                    if mine:
                        sure[mine] = network.logits(_first_tiles([some[i] for i in mine])) < 0
                yield batch.set_column(5, "sure", pa.array(sure))

        samples = freeze(samples.mapInArrow(judge, samples.schema))
    network = _taught(samples, tasks, (2,))[2]

    def strongest(batches):
        for batch in batches:
            z = network.highest(zip(*(c.to_pylist() for c in batch.columns[1:])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.float64())], ["found", "z"])

    # held-back candidates are judged as all are: by the best of all their tiles
    held_back = F.pmod("h", F.lit(5)) == 0
    last = samples.filter(held_back & (F.col("found") | F.col("sure"))).select("h", "found")
    held = pool.filter(held_back).select("h", "left", "span", "right").distinct().join(last, "h")
    return network.calibrate_over(freeze(held.select("found", "left", "span", "right").mapInArrow(strongest, "found boolean, z double")))


def best_apart(scored: list[tuple[float, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the candidates (score, start, end) that overlap none of a higher score; of equal
    scores the longer one, then the first, counts."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(scored, key=lambda x: (-x[0], x[1] - x[2], x[1])):
        at = bisect.bisect_right(starts, a)
        if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
            starts.insert(at, a)
            ends.insert(at, b)
    return list(zip(starts, ends))


def find_secrets(docs: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """(rid, doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added), one row per row of ``docs``."""
    found = find(docs)
    network = train(found, per_task)

    def run(batches):
        for batch in batches:
            size = len(batch)
            counts, digests, spans, added = [[0] * size for _ in range(3)], [hashlib.sha256(b"").hexdigest()] * size, [""] * size, [0] * size
            # what the rules find is among the candidates
            at = np.flatnonzero(pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False) > 0)
            bases, somes = (batch.column(k).take(pa.array(at)).to_pylist() for k in (2, 3))
            others = [(d, k, c) for d, some in enumerate(somes) for k, c in enumerate(some) if not c["found"]]
            z = network.highest((c["left"], c["span"], c["right"]) for _, _, c in others)
            score = dict(zip(((d, k) for d, k, _ in others), network.probability(z).tolist()))
            for d, (row, base, some) in enumerate(zip(at.tolist(), bases, somes)):
                mine = [(b["start"], b["kind"], KINDS[b["kind"]], b["end"]) for b in base]
                for k in range(3):
                    counts[k][row] = sum(b[1] == k for b in mine)
                digests[row] = hashlib.sha256(spans_text(mine).encode()).hexdigest()
                new = best_apart([(score[d, k], c["start"], c["end"]) for k, c in enumerate(some)
                                  if score.get((d, k), -1.0) >= network.threshold])
                new = [(a, 3, KINDS[3], b) for a, b in new]
                added[row] = len(new)
                spans[row] = spans_text(sorted(mine + new))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["rid", "doc_id", *(f"n_{k}" for k in KINDS[:3]), "base_sha256", "spans", "n_added"])

    return found.mapInArrow(run, "rid long, doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                            "spans string, n_added long")
