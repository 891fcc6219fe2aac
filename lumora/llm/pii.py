"""Personal data by rules and a semi-Markov conditional random field.

The rules find e-mail addresses, IP addresses, card and phone numbers.  The model reads the stretches
of text around digits and at-signs ("islands"; nothing else can hold these entities) as tokens, scores
whole candidate segments of up to ``LONGEST`` tokens by features of the span as a whole, and chooses
boundaries and types together by dynamic programming (Sarawagi and Cohen, "Semi-Markov conditional
random fields for information extraction", 2004).  It is trained in numpy on the rules' findings in at
most ``MAX_ISLANDS`` islands of at most ``TAUGHT`` characters, those with the smallest hashes of each kind
and of those without findings; islands of any length are searched, in blocks of tokens.
A rule takes the longest run and drops it whole where its digits are wrong, so what it left out is no
negative where a shorter valid span of whole numbers lies inside: such islands don't teach the model.
It learns what entities look like side by side from ``PAIRS`` findings of each two kinds set next to
each other.  Its segments are added where no rule's span overlaps them and they beat leaving them out
by ``MARGIN`` (natural log odds); a rule's span stays.

Matching is linear in the text: each rule starts at what it must contain.  NULL and empty texts have no
spans, an empty table gives an empty result, repeated rows each get theirs, extra columns are ignored.
"""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import rows, spans_text
from lumora.plans.freeze import freeze

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
MAX_ISLANDS, TAUGHT = 1500, 400
PAIRS = 20
MARGIN = 4.0
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile("[0-9]")
_NUMBERS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    for m in _CHAIN.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str):
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) of the rules' spans, sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, "email", b) for a, b in _emails(text)]
    if _NUMBER.search(text):
        out += [(a, 1, "ip", b) for a, b in _ips(text)]
        out += [(a, 2, "card", b) for a, b in _cards(text)]
        if "+" in text:
            out += [(a, 3, "phone", b) for a, b in _phones(text)]
    return sorted(out)


def dropped(text: str) -> list[tuple[int, int]]:
    """Runs that the card or the phone rule dropped though a shorter span of whole numbers in them is valid."""
    out = []
    if _NUMBER.search(text):
        for m in _DIGITS.finditer(text):
            sizes = [len(n[0]) for n in _NUMBERS.finditer(m[0])]
            digits = m[0].replace(" ", "").replace("-", "")
            if len(sizes) < 2 or len(digits) < 14 or len(digits) <= 19 and luhn(digits):
                continue
            at = [0]
            for n in sizes:
                at.append(at[-1] + n)
            if any(14 <= b - a <= 19 and luhn(digits[a:b]) for i, a in enumerate(at) for b in at[i + 1:i + 20]):
                out.append(m.span())
        for m in _PHONE.finditer(text) if "+" in text else ():
            size, some = 0, False
            for n in _NUMBERS.finditer(m[0]):
                size += len(n[0])
                some = some or 10 <= size <= 15
            if some and size > 15:
                out.append(m.span())
    return sorted(out)


_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_MARK = re.compile(r"[0-9@]")
_NEXT = re.compile(r"[ ][^\s0-9@]{0,3}[0-9@]")
#: Characters of text on either side that an island carries for its features.
AROUND = 3


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of words with digits or at-signs, with what stands directly before."""
    out, end = [], 0
    for m in _MARK.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        if start > end and text[start - 1] == " " and start - 2 >= end and text[start - 2] in "+(":
            start -= 2
        stop = m.end()
        while True:
            while stop < len(text) and not text[stop].isspace():
                stop += 1
            more = _NEXT.match(text, stop)
            if not more:
                break
            stop = more.end()
        out.append((start, stop))
        end = stop
    return out


FEATURES = 32
#: Tokens of an island whose segments are in memory at once.
BLOCK_TOKENS = 1024


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


class Segments:
    """The candidate segments of an island: whole tokens, at most LONGEST, with a digit or an at-sign.

    They are made in blocks of tokens; what their features count are differences of running sums over
    the block's characters, so an island may be of any length."""

    def __init__(self, text: str, lead: int, tail: int) -> None:
        self.text, self.lead = text, lead
        spans = np.fromiter((x for m in _TOKEN.finditer(text, lead, len(text) - tail) for x in m.span()), np.int64)
        self.tokens = spans.reshape(-1, 2) - lead
        self.n = len(self.tokens)

    def block(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, token after the last, features) of the segments that begin in tokens lo to hi - 1."""
        tokens = self.tokens[lo:hi + LONGEST]
        if not len(tokens):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, FEATURES))
        # one character on the left and two on the right are looked at; there are zeros where the text ends
        begin, end = self.lead + int(tokens[0, 0]) - 1, self.lead + int(tokens[-1, 1]) + 2
        text = "\0" * max(0, -begin) + self.text[max(0, begin):end] + "\0" * max(0, end - len(self.text))
        start, stop = (tokens + (self.lead - begin)).T
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

        def flags(test):
            return np.fromiter(map(test, text), bool, len(text))

        def among(characters):
            return np.isin(code, np.array([ord(c) for c in characters], np.uint32))

        alnum, digit, number = flags(str.isalnum), flags(str.isdigit), (code >= 48) & (code <= 57)
        marks = _sums((number | (code == 64))[start])
        i = np.repeat(np.arange(min(len(tokens), hi - lo)), LONGEST)
        j = i + np.tile(np.arange(1, LONGEST + 1), len(i) // LONGEST)
        i, j = i[j <= len(tokens)], j[j <= len(tokens)]
        keep = ~flags(str.isspace)[start[i]] & (marks[j] > marks[i]) & alnum[stop[j - 1] - 1]
        i, j = i[keep], j[keep]
        a, b = start[i], stop[j - 1]

        def count(flag):
            sums = _sums(flag)
            return sums[b] - sums[a]

        size, digits, letters, at = b - a, count(number), count(flags(str.isalpha)), count(code == 64)
        dots, spaces, plain = _sums(code == 46), count(code == 32), count(digit)
        n_dots = dots[b] - dots[a]
        last_at = np.maximum.accumulate(np.where(code == 64, np.arange(len(code)), 0))[b - 1]
        # Luhn's sum: digits at an even distance from the last one count as they are, the others doubled
        d = code[digit].astype(np.int64) - 48
        doubled, even = np.where(d < 5, 2 * d, 2 * d - 9), np.arange(len(d)) % 2 == 0
        place, as_even, as_odd = _sums(digit), _sums(np.where(even, d, doubled)), _sums(np.where(even, doubled, d))
        u, v = place[a], place[b]
        luhn_sum = np.where(v % 2 == 1, as_even[v] - as_even[u], as_odd[v] - as_odd[u])
        all_digits = (plain > 0) & (plain + spaces + count(code == 45) == size)
        tokens_in = j - i
        features = np.stack([
            np.ones(len(a), bool),
            at == 1,
            (at == 1) & (dots[b] > dots[last_at]),
            (at == 1) & among(_LOCAL)[a] & (spaces == 0),
            at > 1,
            digits == 0,
            (digits >= 1) & (digits < 4),
            (digits >= 4) & (digits < 10),
            (digits >= 10) & (digits < 14),
            (digits >= 14) & (digits < 20),
            digits >= 20,
            letters > 0,
            (letters > 0) & (digits > letters),
            code[a] == 43,
            code[a] == 40,
            alnum[a],
            alnum[b - 1],
            spaces > 0,
            (n_dots == 3) & (digits + 3 == size),
            n_dots > 3,
            all_digits,
            all_digits & (luhn_sum % 10 == 0),
            alnum[a - 1],
            alnum[b],
            among("@._-+")[a - 1],
            among("@-_")[b],
            (code[b] == 46) & alnum[b + 1],
            ((code[b] == 32) | (code[b] == 45)) & digit[b + 1],
            count(among("=\"'<>/\\|")) > 0,
            tokens_in == 1,
            (tokens_in >= 2) & (tokens_in < 6),
            tokens_in >= 12,
        ], axis=1).astype(np.float64)
        return i + lo, j + lo, features

    @functools.cached_property
    def whole(self) -> tuple[list[tuple[int, int]], np.ndarray]:
        """All segments and their features, for islands that are short."""
        i, j, x = self.block(0, self.n)
        return list(zip(i.tolist(), j.tolist())), x

    @property
    def at(self) -> list[tuple[int, int]]:
        return self.whole[0]

    @functools.cached_property
    def ends(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in range(self.n + 1)]
        for k, (_, j) in enumerate(self.at):
            out[j].append(k)
        return out

    def scores(self, w: np.ndarray) -> np.ndarray:
        """Scores of all (segment, kind)."""
        return self.whole[1] @ w

    def labels(self, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        """(segment, kind) of the spans (start, end, kind) that are segments and don't overlap."""
        place = {(int(self.tokens[i][0]), int(self.tokens[j - 1][1])): k for k, (i, j) in enumerate(self.at)}
        out, end = [], -1
        for a, b, kind in sorted(spans):
            k = place.get((a, b))
            if k is not None and a >= end:
                out.append((k, kind))
                end = b
        return out


def _logsum(x: np.ndarray) -> float:
    m = x.max()
    return float(m + np.log(np.exp(x - m).sum()))


class SemiMarkov:
    """Weights of (feature, kind); tokens outside segments score 0."""

    def __init__(self) -> None:
        self.w = np.zeros((FEATURES, len(KINDS)))
        self.w[0] = -2.0

    def forward(self, s: Segments, score: np.ndarray) -> np.ndarray:
        alpha = np.zeros(s.n + 1)
        for j in range(1, s.n + 1):
            ways = [np.array([alpha[j - 1]])] + [score[k] + alpha[s.at[k][0]] for k in s.ends[j]]
            alpha[j] = _logsum(np.concatenate(ways))
        return alpha

    def marginals(self, s: Segments) -> np.ndarray:
        """The chance of each (segment, kind)."""
        score = s.scores(self.w)
        alpha, beta = self.forward(s, score), np.full(s.n + 1, -np.inf)
        beta[s.n] = 0.0
        for j in range(s.n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], beta[j])
            for k in s.ends[j]:
                i = s.at[k][0]
                beta[i] = np.logaddexp(beta[i], _logsum(score[k]) + beta[j])
        at = np.array(s.at)
        return np.exp(score + (alpha[at[:, 0]] + beta[at[:, 1]])[:, None] - alpha[s.n])

    def fit(self, data: list[tuple[Segments, list[tuple[int, int]]]], steps: int = 9000, rate: float = 0.3) -> SemiMarkov:
        """Adagrad on the conditional likelihood of the labelled segmentations, in ``steps`` steps or so."""
        order, square = np.random.default_rng(3), np.full_like(self.w, 1e-2)
        data = [d for d in data if len(d[0].at)]
        for _ in range(min(60, -(-steps // max(1, len(data))))):
            for at in order.permutation(len(data)):
                s, gold = data[at]
                x = s.whole[1]
                g = -(x.T @ self.marginals(s))
                for k, kind in gold:
                    g[:, kind] += x[k]
                g -= 1e-4 * self.w
                square += g * g
                self.w += rate * g / np.sqrt(square)
        return self

    def best(self, s: Segments, margin: float = MARGIN) -> list[tuple[int, int, int]]:
        """(start, end, kind) in the island of the best segmentation's segments that beat ``margin``.

        A segment that scores 0 or less is never better than no segment, so only others are kept, and
        of those only what ends in the block at hand or beyond."""
        value, back = [0.0] * (s.n + 1), {}
        ahead = defaultdict(list)
        for lo in range(0, s.n, BLOCK_TOKENS):
            hi = min(s.n, lo + BLOCK_TOKENS)
            first, after, x = s.block(lo, hi)
            score = x @ self.w
            top = score.max(1)
            for k in np.flatnonzero(top > 0).tolist():
                ahead[int(after[k])].append((int(first[k]), int(score[k].argmax()), float(top[k])))
            for j in range(lo + 1, hi + 1):
                value[j] = value[j - 1]
                for i, kind, z in ahead.pop(j, ()):
                    if z + value[i] > value[j]:
                        value[j], back[j] = z + value[i], (i, kind, z)
        out, j = [], s.n
        while j > 0:
            if j not in back:
                j -= 1
                continue
            i, kind, z = back[j]
            if z >= margin:
                out.append((int(s.tokens[i][0]), int(s.tokens[j - 1][1]), kind))
            j = i
        return out[::-1]


_FOUND = ("rid long, doc_id long, base array<struct<start:long,kind:int,end:long>>, "
          "islands array<struct<start:long,lead:int,tail:int,text:string,doubt:boolean>>")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_ISLAND = pa.list_(pa.struct([("start", pa.int64()), ("lead", pa.int32()), ("tail", pa.int32()), ("text", pa.string()),
                            ("doubt", pa.bool_())]))


def find(docs: DataFrame) -> DataFrame:
    """The rules' spans and the islands of each row, written: the only pass over the texts."""

    def run(batches):
        for batch in batches:
            base, found = [], []
            for value in batch.column(2):
                text = value.as_py()
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, _, b in spans])
                some = []
                if "@" in text or _NUMBER.search(text):
                    doubts = collections.deque(dropped(text))
                    for a, b in islands(text):
                        lead, tail = min(a, AROUND), min(len(text) - b, AROUND)
                        while doubts and doubts[0][1] <= a:
                            doubts.popleft()
                        some.append({"start": a, "lead": lead, "tail": tail, "text": text[a - lead:b + tail],
                                     "doubt": any(a < y for _, y in itertools.takewhile(lambda d: d[0] < b, doubts))})
                found.append(some)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base, _SPAN), pa.array(found, _ISLAND)],
                ["rid", "doc_id", "base", "islands"])

    return freeze(rows(docs).mapInArrow(run, _FOUND))


def side_by_side(findings: list[list[str]], pairs: int = PAIRS) -> list[tuple[Segments, list[tuple[int, int]]]]:
    """Findings of every two kinds next to each other, as islands with both labelled."""
    out = []
    for k, ours in enumerate(findings):
        for j, theirs in enumerate(findings):
            for n in range(min(pairs, len(ours), len(theirs))):
                x, y = ours[n], theirs[-1 - n]
                s = Segments(f" {x} {y} ", 1, 1)
                out.append((s, s.labels([(0, len(x), k), (len(x) + 1, len(x) + 1 + len(y), j)])))
    return out


def train(found: DataFrame, most: int = MAX_ISLANDS) -> SemiMarkov:
    pool = (found.select("base", F.explode("islands").alias("i")).filter((F.length("i.text") <= TAUGHT) & ~F.col("i.doubt"))
            .select(F.xxhash64("i.text").alias("h"), "i", F.filter("base", lambda b: (b["start"] >= F.col("i.start")) & (
                b["end"] <= F.col("i.start") + F.length("i.text"))).alias("b"))
            .dropDuplicates(["h"]))
    sample: dict[int, object] = {}
    for kind in range(len(KINDS)):
        some = pool.filter(F.exists("b", lambda b: b["kind"] == kind)).orderBy("h").limit(most // (len(KINDS) + 1))
        sample |= {r["h"]: r for r in some.collect()}
    rest = pool.filter(F.size("b") == 0).orderBy("h").limit(most - len(sample))
    sample |= {r["h"]: r for r in rest.collect()}
    data, findings = [], [[] for _ in KINDS]
    for _, r in sorted(sample.items()):
        s = Segments(r["i"]["text"], r["i"]["lead"], r["i"]["tail"])
        gold = s.labels([(b["start"] - r["i"]["start"], b["end"] - r["i"]["start"], b["kind"]) for b in r["b"]])
        data.append((s, gold))
        for k, kind in gold:
            i, j = s.at[k]
            findings[kind].append(r["i"]["text"][s.lead + s.tokens[i][0]:s.lead + s.tokens[j - 1][1]])
    return SemiMarkov().fit(data + side_by_side(findings))


def find_personal_data(docs: DataFrame, margin: float = MARGIN, max_islands: int = MAX_ISLANDS) -> DataFrame:
    """(rid, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row per row of ``docs``."""
    found = find(docs)
    model = train(found, max_islands)

    def run(batches):
        for batch in batches:
            counts, digests, spans, added = [[] for _ in KINDS], [], [], []
            for base, some in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                mine = [(b["start"], b["kind"], KINDS[b["kind"]], b["end"]) for b in base]
                for k in range(len(KINDS)):
                    counts[k].append(sum(b[1] == k for b in mine))
                digests.append(hashlib.sha256(spans_text(mine).encode()).hexdigest())
                new = []
                for i in some:
                    segments = Segments(i["text"], i["lead"], i["tail"])
                    for a, b, kind in model.best(segments, margin):
                        a, b = a + i["start"], b + i["start"]
                        if not any(a < x[3] and x[0] < b for x in mine):
                            new.append((a, kind, KINDS[kind], b))
                added.append(len(new))
                spans.append(spans_text(sorted(mine + new)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["rid", "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return found.mapInArrow(run, "rid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                            "base_sha256 string, spans string, n_added long")
