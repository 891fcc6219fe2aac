"""Hard negatives by exact search of an inverted multi-index.

The index (Babenko and Lempitsky, "The inverted multi-index", 2012) cuts a vector in two halves with a codebook
each; a row lies in the cell of its two nearest codewords.  A half's score with an anchor is at most the
codeword's score plus the anchor half's length times the codeword's radius, the largest distance of a row's half
from it.  The multi-sequence algorithm visits cells in the order of the sum of both bounds, from a heap over the
two sorted lists.  A search for the best rows of a score window stops when the next cell's bound lies below the
window or below the last row wanted in it: then no unvisited row can belong to the answer, which is exact.

1. Vectors become integers and rows are written once.  The codebooks come from a bounded sample (the ``SAMPLE``
   rows with the smallest hashes); every row is indexed, and radii cover all rows.
2. Rows are range-partitioned by (cell, hash) into shards of some ``rows_per_shard`` rows, so that a cell with a
   third of all rows spans shards.  A shard is known by the codewords it holds.
3. Anchors are sent to shards.  First to the one of their own cell; what they find there is a floor for the answer, and
   then they go only to those other shards whose bound reaches it.  A task reads a shard's rows, which come
   first, builds the lists of its cells, and answers the anchors one batch after the other; a shard gives at
   most the wanted number of rows per window.  Nothing is held beyond a shard, a batch and the codebooks.
4. This is done twice: for an anchor's positives (its best rows of the same label, no window), then for
   negatives (other labels, one window per positive).  Partial answers are merged by a window function.

Scores are integer inner products over the shorter length, exact in double precision as long as sums stay below
2**53 and modulo 2**64 beyond.  Rows with a NULL label, a NULL vector or a NULL, NaN or infinite component take no
part; empty vectors score 0.  Equal scores are ordered by id (NULL last), then by row; repeated ids
are rows of their own, as anchors too.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

SAMPLE = 16_384
ROWS_PER_CELL = 256
MAX_CODEWORDS = 4096
POSITIVES, NEGATIVES = 5, 3
LEAST = -(1 << 63)
#: Negatives score between these hundredths of the positive's score.
LOW, HIGH = 50, 95


def rows_per_shard(n: int) -> int:
    """Some 8 * sqrt(n), so that neither shards nor anchors sent per shard become many; 16 MB at most at 64 components."""
    return int(min(131_072, max(2_048, 8 * n ** 0.5)))


def halves(dim: int) -> int:
    return (dim + 1) // 2


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of ``dim`` doubles, shorter ones filled up with zeros."""
    lengths = np.asarray(pc.list_value_length(column), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return values.reshape(len(column), dim).astype(np.float64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def products(rows: np.ndarray, of: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products with x; ``rows`` are doubles, ``of`` the same as integers where doubles may be inexact."""
    if of is None:
        return (rows @ x.astype(np.float64)).astype(np.int64)
    return of @ x.astype(np.int64)


@dataclass
class Codebooks:
    """Per half: codewords, and the radius of each over all rows."""

    dim: int
    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = halves(self.dim)
        return x[:, :h], x[:, h:]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codeword of each half, distance of each half from it)."""
        out = []
        for half, words in zip(self.split(x), self.words):
            at = (half @ words.T - 0.5 * (words * words).sum(1)).argmax(1)
            out += [at, np.sqrt(((half - words[at]) ** 2).sum(1))]
        return out[0], out[2], out[1], out[3]

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of x and codeword the most a row's half under that codeword can score."""
        out = []
        for half, words, radius in zip(self.split(x), self.words, self.radii):
            length = np.sqrt((half * half).sum(1))[:, None]
            most = half @ words.T + length * radius
            out.append(most + 1e-9 * (1 + np.abs(most) + length * (1 + radius)))      # the products' rounding
        return out[0], out[1]


def _words(x: np.ndarray, k: int, steps: int = 6) -> np.ndarray:
    """k-means codewords of the rows of x, at most k."""
    if not x.size:
        return np.zeros((1, x.shape[1]))
    x = np.unique(x, axis=0)
    words = x[np.random.default_rng(0).permutation(len(x))[:k]].astype(np.float64)
    for _ in range(steps):
        at = (x @ words.T - 0.5 * (words * words).sum(1)).argmax(1)
        size = np.bincount(at, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, at, x)
        words = sums[size > 0] / size[size > 0, None]
    return words


def train(rows: DataFrame, n: int, dim: int, sample: int = SAMPLE, per_cell: int = ROWS_PER_CELL) -> Codebooks:
    """Codebooks from a bounded sample: some ``per_cell`` rows a cell."""
    few = rows.select("v").orderBy(F.xxhash64("rid")).limit(sample).toArrow()
    x = matrix(few["v"].combine_chunks(), dim)
    k = max(1, min(MAX_CODEWORDS, int((n / per_cell) ** 0.5)))
    h = halves(dim)
    return Codebooks(dim, (_words(x[:, :h], k), _words(x[:, h:], k)))


class Shard:
    """The rows of a shard by cell."""

    def __init__(self, table: pa.Table, books: Codebooks) -> None:
        first, second = table["first"].to_numpy(), table["second"].to_numpy()
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        self.rid, self.label = table["rid"].to_numpy()[order], table["label"].to_numpy()[order]
        ids = table["vec_id"].combine_chunks()
        self.id = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()[order]
        self.missing = np.asarray(ids.is_null())[order]
        self.rows = matrix(table["v"].combine_chunks(), books.dim)[order]
        most = float(np.abs(self.rows).max(initial=0))
        self.exact = table["v"].combine_chunks()
        self.limit = 2.0 ** 53 / max(1.0, most * books.dim)            # components up to here multiply exactly
        starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        self.cells = {(int(first[a]), int(second[a])): (int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(first)))}
        self.first, self.second = np.unique(first), np.unique(second)
        self.order = order
        self._whole = None

    def whole(self) -> np.ndarray:
        """The vectors as integers, for products that doubles can't hold."""
        if self._whole is None:
            lengths = np.asarray(pc.list_value_length(self.exact), dtype=np.int64)
            out = np.zeros(self.rows.shape, np.int64)
            out[np.arange(out.shape[1]) < lengths[:, None]] = self.exact.flatten().to_numpy(zero_copy_only=False)
            self._whole = out[self.order]
        return self._whole

    def search(self, query: Query, first: np.ndarray, second: np.ndarray) -> int:
        """Fill the query's windows from this shard; how many cells were visited.

        ``first`` and ``second`` bound the half scores per codeword.  The heap holds pairs of places in the two
        sorted lists; from place (i, j) follow (i, j + 1) and, where j is 0, (i + 1, 0)."""
        a, b = self.first[np.argsort(-first[self.first], kind="stable")], self.second[np.argsort(-second[self.second], kind="stable")]
        heap, visited = [(-(first[a[0]] + second[b[0]]), 0, 0)], 0
        inexact = np.abs(query.v).max(initial=0) > self.limit
        while heap:
            bound, i, j = heapq.heappop(heap)
            if not inexact and not query.wants(-bound):
                break
            if j + 1 < len(b):
                heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))
            cell = self.cells.get((int(a[i]), int(b[j])))
            if cell is None:
                continue
            visited += 1
            lo, hi = cell
            score = products(self.rows[lo:hi], self.whole()[lo:hi] if inexact else None, query.v)
            query.see(score, lo, self)
        return visited


class Query:
    """An anchor with its windows: of the rows whose label is (``same``) or isn't the anchor's, the best ``want``
    with a score from ``low`` to ``high``.  ``floor``: what is known already to be too little."""

    def __init__(self, rid: int, label: int, v: np.ndarray, same: bool, want: int,
                 windows: list[tuple[int, int, int]]) -> None:
        self.rid, self.label, self.v, self.same, self.want = rid, label, v, same, want
        self.windows = windows
        self.best: list[list[tuple]] = [[] for _ in windows]             # sorted (-score, missing, id, rid)

    def wants(self, bound: float) -> bool:
        """Whether a row that scores at most ``bound`` may still enter a window."""
        for (low, high, floor), best in zip(self.windows, self.best):
            if low > high:
                continue
            least = max(low, floor)
            if len(best) >= self.want:
                least = max(least, -best[-1][0])
            if bound >= least:
                return True
        return False

    def see(self, score: np.ndarray, at: int, shard: Shard) -> None:
        part = slice(at, at + len(score))
        fits = (shard.label[part] == self.label) == self.same
        fits &= shard.rid[part] != self.rid
        for k, (low, high, floor) in enumerate(self.windows):
            least = max(low, floor)
            best = self.best[k]
            if len(best) >= self.want:
                least = max(least, -best[-1][0])
            rows = np.flatnonzero(fits & (score >= least) & (score <= high))
            if not len(rows):
                continue
            if len(rows) > self.want:
                rows = rows[np.lexsort((shard.rid[at + rows], shard.id[at + rows], shard.missing[at + rows], -score[rows]))[:self.want]]
            found = [(-int(score[r]), bool(shard.missing[at + r]), int(shard.id[at + r]), int(shard.rid[at + r])) for r in rows]
            self.best[k] = sorted(best + found)[:self.want]


_FOUND = "anchor long, place int, score long, vec_id long, rid long"


def _answers(queries: list[Query]) -> pa.RecordBatch:
    flat = [(q.rid, place, -s, None if missing else i, r)
            for q in queries for place, best in enumerate(q.best) for s, missing, i, r in best]
    columns = list(zip(*flat)) if flat else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "place", "score", "vec_id", "rid"])


def _best(found: DataFrame, want: int) -> DataFrame:
    """The best ``want`` of each window, numbered from 1 in ``rank``."""
    order = [F.desc("score"), F.col("vec_id").asc_nulls_last(), F.col("rid")]
    by = Window.partitionBy("anchor", "place").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= want)


@dataclass
class Index:
    """Rows by shard (shard, rid, vec_id, label, first, second, v), written; what each shard holds."""

    rows: DataFrame
    books: Codebooks
    shards: np.ndarray          # per shard: number, least and largest first codeword, least and largest second

    def search(self, anchors: DataFrame, same: bool, want: int) -> DataFrame:
        """(anchor, place, score, vec_id, rid, rank): the answers to all windows of ``anchors`` (rid, label, v, home,
        windows: arrays of low and high)."""
        anchors = anchors.withColumn("windows", F.transform("windows", lambda w: F.array(w[0], w[1], F.lit(LEAST))))
        home = _best(self._visit(anchors.withColumn("shards", F.array(F.col("home").cast("int"))), same, want), want)
        home = freeze(home)
        # the worst row of a window that is full at home is a floor for all others
        floors = (home.groupBy("anchor", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
                  .filter(F.col("n") >= want).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("least")))
        known = anchors.join(floors, anchors["rid"] == floors["anchor"], "left").drop("anchor")
        known = known.withColumn("windows", F.transform("windows", lambda w, k: F.array(
            w[0], w[1], F.coalesce(F.try_element_at(F.col("least"), k.cast("int")), w[2])))).drop("least")
        rest = self._visit(self._routed(known), same, want)
        return _best(home.drop("rank").unionByName(rest), want)

    def _routed(self, anchors: DataFrame) -> DataFrame:
        """Adds ``shards``: those other than the home one whose bound reaches a window."""
        books, shards = self.books, self.shards

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                first, second = books.bounds(matrix(batch.column("v"), books.dim))
                least = [min((max(low, floor) for low, high, floor in w if low <= high), default=np.inf) for w in batch.column("windows").to_pylist()]
                home = batch.column("home").to_numpy()
                out = []
                for k in range(batch.num_rows):
                    best = _range_max(first[k], shards[:, 1], shards[:, 2]) + _range_max(second[k], shards[:, 3], shards[:, 4])
                    out.append(shards[(best >= least[k]) & (shards[:, 0] != home[k]), 0])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                flat = np.concatenate(out).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                                 [*batch.schema.names, "shards"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema.fields)
        return anchors.mapInArrow(run, f"{fields}, shards array<int>")

    def _visit(self, anchors: DataFrame, same: bool, want: int) -> DataFrame:
        """Answers of each shard to the anchors sent to it.

        Rows and anchors of a shard meet in a task of its own, sorted so that the rows come first; the task holds
        the shard and streams the anchors."""
        books = self.books
        left = self.rows.select("shard", F.lit(0).alias("kind"), "rid", "vec_id", "label", "first", "second", "v",
                                F.lit(None).cast("array<array<long>>").alias("windows"))
        right = anchors.select(F.explode("shards").alias("shard"), F.lit(1).alias("kind"), "rid", F.lit(None).cast("long").alias("vec_id"),
                               "label", F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("second"), "v", "windows")

        def run(batches):
            number, parts, shard = None, [], None
            for batch in batches:
                numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
                for lo, hi in zip(np.concatenate([[0], cuts]), np.append(cuts, len(numbers))):
                    if lo == hi:
                        continue
                    if numbers[lo] != number:
                        number, parts, shard = numbers[lo], [], None
                    part = batch.slice(lo, hi - lo)
                    if kinds[lo] == 0:
                        parts.append(part)
                        continue
                    if shard is None:
                        if not parts:
                            continue
                        shard, parts = Shard(pa.Table.from_batches(parts), books), []
                    yield _answers(_asked(part, shard, books, same, want))

        tasks = int(self.shards[-1, 0]) + 1      # shards are numbered from 0; by a hash of the number several would share a task
        met = left.unionByName(right).repartitionById(tasks, "shard").sortWithinPartitions("shard", "kind")
        return met.mapInArrow(run, _FOUND)


def _asked(anchors: pa.RecordBatch, shard: Shard, books: Codebooks, same: bool, want: int) -> list[Query]:
    vectors = matrix(anchors.column("v"), books.dim)
    first, second = books.bounds(vectors)
    out = []
    for k, (rid, label, windows) in enumerate(zip(anchors.column("rid").to_pylist(), anchors.column("label").to_pylist(),
                                                  anchors.column("windows").to_pylist())):
        v = vectors[k]
        if np.abs(v).max(initial=0) > shard.limit:
            v = np.zeros(books.dim, np.int64)
            given = anchors.column("v")[k].as_py()
            v[:len(given)] = given
        query = Query(rid, label, v, same, want, [tuple(w) for w in windows])
        shard.search(query, first[k], second[k])
        out.append(query)
    return out


def _range_max(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest of x[low..high] for each pair, from a table of maxima over powers of two."""
    table = [x]
    while 2 << (len(table) - 1) <= len(x):
        half = 1 << (len(table) - 1)
        table.append(np.maximum(table[-1][:-half], table[-1][half:]))
    level = np.floor(np.log2(high - low + 1)).astype(int)
    out = np.empty(len(low))
    for k in np.unique(level):
        at = level == k
        out[at] = np.maximum(table[k][low[at]], table[k][high[at] - (1 << k) + 1])
    return out


def whole_rows(table: DataFrame, scale: int = 256) -> DataFrame:
    """(rid, vec_id, label, v): rows that take part, with whole-number components; numbered, written."""
    x = F.col("embedding")
    fine = (F.col("label").isNotNull() & x.isNotNull()
            & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return freeze(table.filter(fine).select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long"), label.alias("label"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")))


def build(rows: DataFrame, sample: int = SAMPLE, per_cell: int = ROWS_PER_CELL, per_shard: int | None = None) -> Index | None:
    """The index of ``rows`` (rid, vec_id, label, v); None without rows."""
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return None
    books = train(rows, n, dim, sample, per_cell)

    def run(batches):
        for batch in batches:
            first, second, far_first, far_second = books.assign(matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(far_first), pa.array(far_second)],
                [*batch.schema.names, "first", "second", "far_first", "far_second"])

    placed = freeze(rows.mapInArrow(run, "rid long, vec_id long, label long, v array<long>, first int, second int, "
                                         "far_first double, far_second double"))
    shards = max(1, -(-n // (per_shard or rows_per_shard(n))))
    order = [F.col("first"), F.col("second"), F.xxhash64("rid"), F.col("rid")]
    sharded = freeze(placed.repartitionByRange(shards, *order).withColumn("shard", F.spark_partition_id()).drop("far_first", "far_second"))
    radii = []
    for half, words in zip(("first", "second"), books.words):
        far = placed.groupBy(half).agg(F.max(f"far_{half}")).toArrow()
        radius = np.zeros(len(words))
        radius[far[0].to_numpy()] = far[1].to_numpy()
        radii.append(radius)
    books.radii = (radii[0], radii[1])
    held = sharded.groupBy("shard").agg(F.min("first"), F.max("first"), F.min("second"), F.max("second")).orderBy("shard").toArrow()
    return Index(sharded, books, np.stack([held[c].to_numpy().astype(np.int64) for c in range(5)], 1))


def mine(table: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, **options) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), and the rows' numbers
    (anchor_rid, positive_rid, negative_rid), for each anchor of ``table`` (vec_id, embedding, label)."""
    rows = whole_rows(table)
    index = build(rows, **options)
    if index is None:
        nothing = table.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long, anchor_rid long, positive_rid long, negative_rid long")
        return nothing
    is_anchor = F.col("vec_id") % 50 == 0 if is_anchor is None else is_anchor
    chosen = freeze(index.rows.filter(is_anchor).select("rid", "vec_id", "label", "v", F.col("shard").alias("home")))
    everything = F.array(F.array(F.lit(LEAST), F.lit(-LEAST - 1)))
    near = freeze(index.search(chosen.withColumn("windows", everything), True, positives))
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id", "rid"))).alias("near"))
    asked = freeze(chosen.join(windows, chosen["rid"] == windows["anchor"]).drop("anchor").withColumn(
        "windows", F.transform("near", lambda p: F.array(F.ceil(p["score"].cast("decimal(19,0)") * low / 100).cast("long"),
                                                         F.floor(p["score"].cast("decimal(19,0)") * high / 100).cast("long")))))
    found = index.search(asked.drop("near", "vec_id"), False, negatives)
    positive = F.get("near", F.col("place"))
    return found.join(asked.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"), "near"), "anchor").select(
        "anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
        F.col("anchor").alias("anchor_rid"), positive["rid"].alias("positive_rid"), F.col("rid").alias("negative_rid"))
