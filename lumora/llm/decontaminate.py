"""Benchmark decontamination: benchmark items found in documents up to an edit distance.

Texts are compared as bytes: ASCII and Latin-1 letters in lower case, and each run of ASCII
characters other than letters and digits as one space.  A document holds an item of L bytes if some
part of it is within ``L // SEED - 1`` edits of the item.

1. An item is cut into one piece more than it may have edits, so at least one piece is untouched,
   and pieces have ``SEED`` bytes or more.  Rolling hashes of all positions of a text are looked up
   among the pieces' first bytes; a hit places an item-sized window.  No item within the bound is
   missed here.
2. Windows and items are embedded by the random walk of Chakraborty, Goldenberg and Koucky
   ("Streaming algorithms for embedding and computing edit distance", 2016), which turns edits into
   Hamming distance, and meet in tables keyed by a few sampled coordinates.  The number of tables
   follows from ``recall``, by the agreement measured on items edited at the bound, for each octave of
   lengths; where ``MOST_TABLES`` don't reach it, all windows go on to the exact check.
3. Windows that meet their item are confirmed by the exact edit distance of the item to any part of
   the text around the window (Myers' bit vectors).

Items of SHORTEST to 2 * SEED - 1 normalised bytes allow no edit: they are found word for word between
word boundaries (in scripts without spaces, anywhere).  Shorter ones ("yes", "42") identify nothing and
are ignored.

Items are read in blocks of at most some ``BLOCK_ITEMS`` and ``BLOCK_BYTES``, each of which is sent to
the tasks; more items mean more passes.  NULL texts count as empty, repeated items are reported each, an empty table gives an empty result (an empty benchmark:
nothing found), extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import lower_ascii, mix, pieces, rows

SEED = 12
#: Normalised bytes from which an item identifies something at all; below 2 * SEED it is looked for verbatim.
SHORTEST = 8
#: Chance that a window at the bound meets its item in some table.
RECALL = 0.995
#: Coordinates in a table's key, and independent walks that tables take turns with.
COORDINATES, WALKS = 2, 4
#: Tables at most for a length class; a class that would need more is checked exactly, every window of it.
MOST_TABLES = 1024
#: Items, and bytes of them, sent to the tasks at once.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
#: Bytes of windows held in a task, and of embeddings made at once.
WINDOW_BYTES, WALK_BYTES = 32 << 20, 8 << 20
_A = np.uint32(0x9E3779B1)
_BITS = 22


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal form of concatenated texts, and the new offsets; a text begins and ends with a space."""
    data = lower_ascii(data)
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = np.where(latin, data + np.uint8(32), data)
    word = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    data = np.where(word, data, np.uint8(32))
    keep = word.copy()
    keep[1:] |= word[:-1]                    # the first of a run of spaces stays
    edges = offsets[:-1][offsets[:-1] < len(data)]
    keep[edges] = True
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def normal_text(text: str) -> bytes:
    data = np.frombuffer(text.encode(), np.uint8)
    return normal(data, np.array([0, len(data)]))[0].tobytes().strip(b" ")


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 32-bit hash of the ``width`` (8 or 12) bytes at each position."""
    if len(data) < width:
        return np.zeros(0, np.uint32)
    with np.errstate(over="ignore"):
        a2 = _A * _A
        a4 = a2 * a2
        h = data.astype(np.uint32) + np.uint32(1)
        h = h[:-1] * _A + h[1:]
        h4 = h[:-2] * a2 + h[2:]
        h8 = h4[:-4] * a4 + h4[4:]
        h = h8 if width == 8 else h8[:-4] * a4 + h4[8:]
        return h * np.uint32(0x85EBCA6B)


def edits(length: int) -> int:
    return length // SEED - 1


def distance(item: bytes, text: bytes, most: int) -> int:
    """The least edit distance of ``item`` to any part of ``text``, or most + 1."""
    if item in text:
        return 0
    m = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        x = eq | down
        d = ((((x & up) + up) ^ up) | x) & full
        h_up = (down | ~(d | up)) & full
        h_down = up & d
        if h_up & top:
            score += 1
        elif h_down & top:
            score -= 1
        h_up = (h_up << 1) & full
        h_down = (h_down << 1) & full
        up = (h_down | ~(d | h_up)) & full
        down = h_up & d
        if score < best:
            best = score
    return min(best, most + 1)


def grams(text: bytes) -> np.ndarray:
    """How often each pair of neighbouring bytes comes, in 1024 classes."""
    x = np.frombuffer(text, np.uint8).astype(np.int64)
    return np.bincount((x[:-1] * 31 + x[1:]) & 1023, minlength=1024)


#: UTF-8 lead bytes of scripts that put no space between words (kana to hangul): no boundary is asked for there.
_UNSPACED = range(0xE3, 0xEE)


def _unspaced(text: bytes) -> tuple[bool, bool]:
    """Whether the first and the last character are of a script without spaces."""
    last = next((c for c in reversed(text) if c & 0xC0 != 0x80), 0)
    return text[0] in _UNSPACED, last in _UNSPACED


class _Starts:
    """The first ``width`` bytes of some patterns, looked up at all positions of a text."""

    def __init__(self, width: int, patterns: list[tuple[bytes, int, int]]) -> None:
        """``patterns``: (bytes, item, offset in the item)."""
        self.width = width
        found = sorted((int(rolling(np.frombuffer(t[:width], np.uint8), width)[0]), n, o) for t, n, o in patterns)
        self.hash = np.array([f[0] for f in found], np.uint32)
        self.item = np.array([f[1] for f in found], np.int64)
        self.offset = np.array([f[2] for f in found], np.int64)
        self.bitmap = np.zeros(1 << _BITS if patterns else 0, bool)
        self.bitmap[self.hash >> np.uint32(32 - _BITS)] = True

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, offset in the item) wherever hashes agree."""
        if not len(self.hash):
            return (np.zeros(0, np.int64),) * 3
        h = rolling(data, self.width)
        at = np.flatnonzero(self.bitmap[h >> np.uint32(32 - _BITS)])
        lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.item[which], self.offset[which]


class Block:
    """A block of items ready for searching; what it holds grows with the items' bytes only."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL, most_tables: int = MOST_TABLES) -> None:
        kept = [(i, t) for i, x in items if len(t := normal_text(x)) >= SHORTEST]
        self.ids = [i for i, _ in kept]
        self.texts = [t for _, t in kept]
        self.most = [max(0, edits(len(t))) for t in self.texts]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        pieces_, verbatim = [], []
        for n, (t, k) in enumerate(zip(self.texts, self.most)):
            if len(t) < 2 * SEED:
                verbatim.append((t, n, 0))
                continue
            size = len(t) // (k + 1)
            pieces_ += [(t[o:o + SEED], n, o) for o in range(0, size * (k + 1), size)]
        self.seeds, self.verbatim = _Starts(SEED, pieces_), _Starts(SHORTEST, verbatim)
        random = np.random.default_rng(20)
        self.draw = random.integers(1, 1 << 63, (WALKS, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        #: Items by octave of their length: each has its own number of tables, 0 where windows go to the exact check.
        self.octave = np.array([len(t).bit_length() for t in self.texts], np.int64)
        self.places = random.random((most_tables, COORDINATES))
        self.tables = {int(o): self._tables(np.flatnonzero((self.octave == o) & (self.length >= 2 * SEED)), recall, most_tables, random)
                       for o in set(self.octave.tolist()) if (self.length[self.octave == o] >= 2 * SEED).any()}

    def walk(self, texts: list[bytes], walk: int, steps: int) -> np.ndarray:
        """The embedding of each text: at each step its current byte, which says whether to go on.

        Whether byte c goes on at step s is the top bit of draw[c] times an odd number mixed from s."""
        widest = max(map(len, texts))
        x = np.zeros((len(texts), widest + 1), np.uint8)
        for i, t in enumerate(texts):
            x[i, :len(t)] = np.frombuffer(t, np.uint8)
        odd = mix(np.arange(1, steps + 1, dtype=np.uint64)) | np.uint64(1)
        out = np.zeros((steps, len(texts)), np.uint8)
        at, row = np.zeros(len(texts), np.int64), np.arange(len(texts))
        for step in range(steps):
            goes = ((self.draw[walk] * odd[step]) >> np.uint64(63)).astype(np.int64)
            out[step] = c = x[row, at]
            at = np.minimum(at + goes[c], widest)
        return out.T

    def keys(self, texts: list[bytes], item: np.ndarray, tables: int) -> np.ndarray:
        """The sampled coordinates of each text in each table, as one number; coordinates scale with the item."""
        out = np.zeros((len(texts), tables), np.uint32)
        steps = 2 * int(self.length[item].max(initial=1))
        part = max(1, WALK_BYTES // steps)
        for lo in range(0, len(texts), part) if tables else ():
            some, length = texts[lo:lo + part], self.length[item[lo:lo + part]]
            for walk in range(WALKS):
                embedded = self.walk(some, walk, steps)
                for table in range(walk, tables, WALKS):
                    for place in self.places[table]:
                        step = (place * 2 * length).astype(np.int64)
                        out[lo:lo + part, table] = out[lo:lo + part, table] * 256 + embedded[np.arange(len(some)), step]
        return out

    def _tables(self, members: np.ndarray, recall: float, most: int, random: np.random.Generator) -> int:
        """Tables that the items need for ``recall``, from their agreement with copies edited at the bound;
        0 where ``most`` are too few: then nothing is left to chance."""
        sample = random.choice(members, min(64, len(members)), replace=False)
        same = []
        for n in sample:
            t = bytearray(self.texts[n])
            for _ in range(self.most[n]):
                at, kind = int(random.integers(len(t))), int(random.integers(3))
                c = self.texts[n][int(random.integers(len(self.texts[n])))]
                t[at:at + (kind != 1)] = [c] if kind != 2 else []
            for walk in range(WALKS):
                x, y = self.walk([self.texts[n], bytes(t)], walk, 2 * len(self.texts[n]))
                same.append((x == y).mean())
        meet = np.array(same) ** COORDINATES
        tables = WALKS
        while (1 - (1 - meet) ** tables).mean() < recall:
            tables += WALKS
            if tables > most:
                return 0
        return tables

    def search(self, texts: pa.Array) -> dict[int, dict[int, int]]:
        """Row -> {item: distance} of a column of texts."""
        found: dict[int, dict[int, int]] = defaultdict(dict)
        windows: dict[tuple[int, int, int], tuple[bytes, int]] = {}
        held = 0
        for first, _, data, offsets in pieces(texts):
            data, offsets = normal(data, offsets)
            self._verbatim(first, data, offsets, found)
            at, item, offset = self.seeds.find(data)
            doc = np.searchsorted(offsets, at, "right") - 1
            start = at - offset - offsets[doc]
            for d, i, s in set(zip(doc.tolist(), item.tolist(), start.tolist())):
                a, b, slack = int(offsets[d]), int(offsets[d + 1]), 2 * self.most[i]
                lo = max(a, a + s - slack)
                around = data[lo:max(a, min(b, a + s + len(self.texts[i]) + slack))].tobytes()
                windows[first + d, i, s] = around, max(a, a + s) - lo
                held += len(around)
                if held > WINDOW_BYTES:
                    self._confirm(windows, found)
                    windows, held = {}, 0
        self._confirm(windows, found)
        return found

    def _verbatim(self, first: int, data: np.ndarray, offsets: np.ndarray, found: dict[int, dict[int, int]]) -> None:
        """Items too short for edits, word for word between word boundaries."""
        at, item, _ = self.verbatim.find(data)
        doc = np.searchsorted(offsets, at, "right") - 1
        for d, i, a in zip(doc.tolist(), item.tolist(), at.tolist()):
            b, (open_left, open_right) = a + len(self.texts[i]), _unspaced(self.texts[i])
            if (b <= offsets[d + 1] and data[a:b].tobytes() == self.texts[i] and (open_left or a == offsets[d] or data[a - 1] == 32)
                    and (open_right or b == offsets[d + 1] or data[b] == 32)):
                found[first + d][i] = 0

    def _confirm(self, windows: dict[tuple[int, int, int], tuple[bytes, int]], found: dict[int, dict[int, int]]) -> None:
        """Windows that meet their item in a table are confirmed by the exact distance."""
        for octave, tables in self.tables.items():
            todo = sorted(w for w in windows if self.octave[w[1]] == octave)
            for k in range(0, len(todo), 4096):
                part = todo[k:k + 4096]
                for (row, i, s), yes in zip(part, self._meets(part, windows, tables)):
                    around = windows[row, i, s][0]
                    if yes and found.get(row, {}).get(i, 1):
                        # an edit changes two pairs at most, so more missing pairs than that rule the text out
                        if np.maximum(grams(self.texts[i]) - grams(around), 0).sum() > 2 * self.most[i]:
                            continue
                        d = distance(self.texts[i], around, self.most[i])
                        if d <= self.most[i]:
                            found[row][i] = min(d, found[row].get(i, d))

    def _meets(self, part: list[tuple[int, int, int]], windows: dict, tables: int) -> np.ndarray:
        """Whether each window (row, item, start) has a key of its item in some table."""
        if not tables:
            return np.ones(len(part), bool)
        items, place = np.unique([i for _, i, _ in part], return_inverse=True)
        cut = [windows[w][0][windows[w][1]:][:max(0, len(self.texts[w[1]]) + min(0, w[2]))] for w in part]
        own = self.keys([self.texts[i] for i in items], items, tables)
        return (self.keys(cut, items[place], tables) == own[place]).any(axis=1)


_HITS = "rid long, doc_id long, text string, hits array<struct<item_id:long,distance:int>>"


def _searched(df: DataFrame, items: list[tuple[int, str]], recall: float) -> DataFrame:
    """``df`` with the hits of one block of items appended to ``hits``."""
    block = Block(items, recall)

    def run(batches):
        for batch in batches:
            found = block.search(batch.column(2)) if block.texts else {}
            hits = batch.column(3).to_pylist()
            for row, some in found.items():
                hits[row] += [{"item_id": block.ids[i], "distance": d} for i, d in sorted(some.items())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(hits, pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())])))],
                ["rid", "doc_id", "text", "hits"])

    return df.mapInArrow(run, _HITS)


def find_items(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(rid, doc_id, hits): the items (item_id, distance) in each row of ``docs``, in order of the items."""
    n, size = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-size // BLOCK_BYTES))
    out = rows(docs).withColumn("hits", F.expr("cast(array() as array<struct<item_id:long,distance:int>>)"))
    for k in range(blocks):
        mine = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        items = mine.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit(""))).collect()
        out = _searched(out, sorted((r[0] if r[0] is not None else -1, r[1]) for r in items), recall)
    return out.select("rid", "doc_id", F.array_sort("hits").alias("hits"))
