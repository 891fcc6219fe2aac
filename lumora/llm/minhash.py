"""Near-duplicate documents by MinHash with tensored banding.

A table key joins one key from each of two small collections, after Andoni and Indyk, "Efficient
algorithms for substring near neighbor problem" (2006), and Dahlgaard, Knudsen and Thorup, "Fast
similarity sketching" (2017): with m keys of ``half`` minhashes on each side there are m*m tables,
but only 2*m*half minhashes are computed.  Two documents of similarity s meet in some table unless
all keys of a side differ, so m is the smallest number whose misses at the threshold are rarer than
``miss``.

1. Shingle sets are hashed in 64 bits; rows with the same set become one node.
2. Table keys are dealt by range of (key, node), so that a large bucket spans several tasks, and
   read in order.  In buckets of up to ``SMALL`` nodes all pairs are candidates; in larger ones each
   node meets the bucket's first one and the one before it.
3. Candidates are confirmed on the full sets of their texts.
4. Nodes of large buckets that hold several components are searched again.  Whatever met in a table
   shares a key of the left side, so only those m keys are joined: nodes outside a key's largest
   component meet all its nodes of other components whose sizes allow the similarity and whose
   sketches, of two bits of ``SKETCH`` further minhashes, do too (a pair at the threshold fails this
   with a chance of at most 1.4e-5, the sum of both tests' binomial tails).

A document without words is linked with nothing; with fewer words than a shingle has, its words are
one shingle.  NULL texts count as empty, NULL ids come last when the smallest is sought, repeated
rows share a node, an empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import U64, lower_ascii, mix, pieces, rows, words
from lumora.llm.components import components
from lumora.plans.freeze import freeze

#: Minhashes in a key of either collection.
HALF = 2
#: Chance that a pair at the threshold meets in no table.
MISS = 1e-4
#: Minhashes in a sketch, those of them that are compared first, and the standard deviations allowed.
SKETCH, SKETCH_FIRST, DEVIATIONS = 1024, 128, 4.75
#: Nodes in a bucket whose pairs are all candidates.
SMALL = 4
#: Rows of one bucket held at once; the rest of it goes on as another part.
HELD = 4096
#: Nodes whose ids may be broadcast (8 bytes each).
BROADCAST_ROWS = 1_000_000


def keys_a_side(similarity: float, half: int = HALF, miss: float = MISS) -> int:
    m = 1
    while 1 - (1 - (1 - similarity ** half) ** m) ** 2 > miss:
        m += 1
    return m


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle, in document order; repeats stay."""
    _, _, doc, h = words(lower_ascii(data), offsets)
    n = np.bincount(doc, minlength=len(offsets) - 1)
    out_doc, out = [], []
    if len(h) >= width:
        run = h[width - 1:] + U64(width)
        for k in range(width - 2, -1, -1):
            run = mix(run) ^ h[k:len(h) - width + 1 + k]
        whole = doc[width - 1:] == doc[:len(doc) - width + 1]
        out_doc.append(doc[:len(doc) - width + 1][whole])
        out.append(mix(run[whole]))
    first = np.cumsum(n) - n
    for short in range(1, width):
        at = np.flatnonzero(n == short)
        if len(at):
            run = h[first[at] + short - 1] + U64(short)
            for k in range(short - 2, -1, -1):
                run = mix(run) ^ h[first[at] + k]
            out_doc.append(at)
            out.append(mix(run))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    doc, h = np.concatenate(out_doc), np.concatenate(out)
    order = np.argsort(doc, kind="stable")
    return doc[order], h[order]


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, hashes): sorted distinct hashes of each text of a piece of the column."""
    for i, j, data, offsets in pieces(texts):
        doc, h = shingles(data, offsets, width)
        ends = np.searchsorted(doc, np.arange(j - i + 1))
        sets = [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield i, np.concatenate([[0], np.cumsum([len(s) for s in sets])]), np.concatenate(sets or [h[:0]])


def signatures(bounds: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` minhashes of each set; 0 for an empty one."""
    n = len(bounds) - 1
    out = np.zeros((n, count), U64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        seeds = mix(np.arange(1, 2 * count + 1, dtype=U64))
        for k in range(count):
            out[full, k] = np.minimum.reduceat(hashes * (seeds[2 * k] | U64(1)) + seeds[2 * k + 1], bounds[full])
    return out


def sketches(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two bits of each of SKETCH minhashes of each set, 32 of them to a number."""
    bits = mix(signatures(bounds, hashes, SKETCH)) >> U64(62)
    bits = bits.reshape(len(bits), SKETCH // 32, 32) << (U64(2) * np.arange(32, dtype=U64))
    return np.bitwise_or.reduce(bits, axis=2)


def _allowed(count: int, percent: int) -> int:
    """Minhashes of ``count`` that may differ in their two bits at the threshold."""
    p = 0.75 * (1 - percent / 100)
    return int(count * p + DEVIATIONS * (count * p * (1 - p)) ** 0.5)


def _differing(count: int):
    """How many of the first minhashes of two sketches differ, as an expression of columns sketchx and sketchy."""
    total = F.lit(0)
    for k in range(count // 32):
        d = F.col("sketchx")[k].bitwiseXOR(F.col("sketchy")[k])
        total = total + F.bit_count(d.bitwiseOR(F.shiftright(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _band(signature: np.ndarray, half: int) -> np.ndarray:
    n, count = signature.shape
    parts = signature.reshape(n, count // half, half)
    key = np.zeros((n, count // half), U64)
    for k in range(half):
        key = mix(key ^ parts[:, :, k]) + U64(k + 1)
    return key


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(x: np.ndarray) -> pa.Array:
    n, m = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), _longs(x.reshape(-1)))


def set_table(docs: DataFrame, width: int, m: int, half: int = HALF) -> DataFrame:
    """(rid, doc_id, n, f1, f2, left, right, text): sizes, fingerprints and keys, written."""

    def run(batches):
        for batch in batches:
            found = []
            for _, bounds, hashes in shingle_sets(batch.column(2), width):
                n = np.diff(bounds)
                signature = signatures(bounds, hashes, 2 * m * half)
                sums = [np.zeros(len(n), U64), np.zeros(len(n), U64)]
                full = np.flatnonzero(n)
                for s, seed in zip(sums, (1, 2)):
                    if len(full):
                        s[full] = np.add.reduceat(mix(hashes + U64(seed)), bounds[full])
                found.append((n, *sums, _band(signature[:, :m * half], half),
                              _band(signature[:, m * half:], half)))
            if not found:
                continue
            n, f1, f2, left, right = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), _longs(f1), _longs(f2),
                 _lists(left), _lists(right), batch.column(2)],
                ["rid", "doc_id", "n", "f1", "f2", "left", "right", "text"])

    return freeze(rows(docs).mapInArrow(run, "rid long, doc_id long, n long, f1 long, f2 long, "
                                        "left array<long>, right array<long>, text string"))


def _keyed(nodes: DataFrame, m: int) -> DataFrame:
    """(key, id, n): the m*m table keys of every node."""

    def run(batches):
        number = mix(np.arange(m * m, dtype=U64)).reshape(1, m, m)
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                left, right = (np.asarray(batch.column(c).flatten()).view(U64).reshape(-1, m) for c in (2, 3))
                key = mix(left[:, :, None] ^ mix(right[:, None, :] + number))
                yield pa.RecordBatch.from_arrays(
                    [_longs(key.reshape(-1)), pa.array(np.repeat(np.asarray(batch.column(0)), m * m)),
                     pa.array(np.repeat(np.asarray(batch.column(1)), m * m))], ["key", "id", "n"])

    return nodes.select("id", "n", "left", "right").mapInArrow(run, "key long, id long, n long")


_CANDIDATE = "kind int, key long, a long, b long, na long, nb long"
PAIR, MEMBER, HEAD = 0, 1, 2


def _bucket_candidates(percent: int):
    """Reads (key, id, n) in order; makes candidate pairs, members of large buckets, and heads of their parts."""

    def emit(kind, key, a, b, na, nb):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), *(pa.array(x) for x in (key, a, b, na, nb))],
            ["kind", "key", "a", "b", "na", "nb"])

    def pairs(key, a, b, na, nb):
        fits = (a != b) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        key, a, b, na, nb = (x[fits] for x in (key, a, b, na, nb))
        return emit(PAIR, key, np.minimum(a, b), np.maximum(a, b), na, nb)

    def run(batches):
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        first = True

        def part(key, ids, n, edge):
            """Whole buckets or parts of one; ``edge``: whether the last may go on elsewhere."""
            nonlocal first
            if not len(key):
                return
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(key)))
            cut = np.zeros(len(start), bool)
            cut[0], first = first, False
            cut[-1] |= edge
            large = (size > SMALL) | cut
            if large.any():
                row = np.repeat(large, size)
                head = np.repeat(start, size)[row]
                yield pairs(key[row], ids[row], ids[head], n[row], n[head])
                yield emit(MEMBER, key[row], ids[row], ids[row], n[row], n[row])
                yield emit(HEAD, key[start[large]], ids[start[large]], ids[start[large]], n[start[large]], n[start[large]])
            small = np.repeat(~large, size)
            for d in range(1, SMALL):
                same = key[d:] == key[:-d]
                same = np.flatnonzero(same if d == 1 else same & small[d:])
                if not len(same):
                    break
                yield pairs(key[same], ids[same + d], ids[same], n[same + d], n[same])

        for batch in batches:
            key, ids, n = (np.concatenate([h, np.asarray(c)]) for h, c in zip(held, batch.columns))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if len(key) - last > HELD:
                last = len(key)
            yield from part(key[:last], ids[:last], n[:last], last == len(key))
            first = first or last == len(key)           # what follows may be the rest of the same bucket
            held = key[last:], ids[last:], n[last:]
        yield from part(*held, True)

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v): those of the pairs (a, b) whose full sets are similar enough."""

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                good = []
                sets = []
                for column in (2, 3):
                    mine = []
                    for _, bounds, hashes in shingle_sets(batch.column(column), width):
                        mine += [hashes[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
                    sets.append(mine)
                for i, (x, y) in enumerate(zip(*sets)):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                        good.append(i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(good, pa.int64())), batch.column(1).take(pa.array(good, pa.int64()))],
                    ["u", "v"])

    def side(name):
        return texts.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}"))

    return freeze(pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
                  .select("a", "b", "text_a", "text_b").mapInArrow(run, "u long, v long"))


def _mixed(df: DataFrame) -> DataFrame:
    """(key, top): keys that hold several labels, and the label with the most rows."""
    shares = df.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    return freeze(shares.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("k"))
                  .filter("k > 1").select("key", F.col("top.label").alias("top")))


def _more_candidates(members: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int,
                     m: int) -> DataFrame:
    """(a, b): pairs of nodes of mixed buckets that have different labels and may be similar enough."""

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                found = [sketches(bounds, hashes) for _, bounds, hashes in shingle_sets(batch.column(1), width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(np.concatenate(found))], ["id", "sketch"])

    buckets = freeze(members.join(labels, "id"))
    again = freeze(buckets.join(_mixed(buckets), "key", "left_semi").select("id").distinct())
    few = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    sketched = texts.join(few, "id", "left_semi").select("id", "text").mapInArrow(run, "id long, sketch array<long>")
    keyed = freeze(nodes.join(sketched, "id").join(labels, "id")
                   .select("id", "n", "label", "sketch", "left", F.posexplode("left").alias("table", "band"))
                   .select(F.xxhash64("table", "band").alias("key"), "id", "n", "label", "sketch", "left", "table"))
    keyed = freeze(keyed.join(_mixed(keyed.select("key", "label")), "key"))
    x, y = (keyed.select("key", *[F.col(c).alias(f"{c}{s}") for c in ("id", "label", "n", "sketch", "left", "table", "top")])
            for s in "xy")
    first = F.col("tablex") == F.col("tabley")       # a pair is made where its first shared key is
    for k in range(m):
        first &= (F.col("tablex") <= k) | (F.col("leftx")[k] != F.col("lefty")[k])
    return x.filter("labelx <> topx").join(y, "key").filter(
        first & (F.col("labelx") != F.col("labely")) & ((F.col("labely") == F.col("topy")) | (F.col("idx") < F.col("idy")))
        & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
        & (_differing(SKETCH_FIRST) <= _allowed(SKETCH_FIRST, percent)) & (_differing(SKETCH) <= _allowed(SKETCH, percent))
    ).select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")).distinct()


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of all nodes after more links between labels."""
    links = freeze(links)
    if links.isEmpty():
        return labels
    more = freeze(components(links)).select(F.col("u").alias("label"), F.col("label").alias("__to"))
    return freeze(labels.join(more, "label", "left").select("id", F.coalesce("__to", "label").alias("label")))


def _by_label(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs with the labels la and lb of their ends."""
    return (pairs.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a")
            .join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``width``: words in a shingle; documents are linked from ``percent`` % Jaccard similarity of
    their sets; a component's row with the smallest id is kept."""
    m = keys_a_side(percent / 100, miss=miss)
    sets = set_table(docs, width, m)
    # rows with one set are one node, named after its first row
    node = freeze(sets.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("rid").alias("id")))
    nodes = sets.join(node.select(F.col("id").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "id")
    nodes = freeze(nodes.select("id", "n", "left", "right"))

    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() * m * m // 2_000_000))
    found = freeze(_keyed(nodes, m).repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
                   .mapInArrow(_bucket_candidates(percent), _CANDIDATE))
    heads = found.filter(F.col("kind") == HEAD).groupBy("key").agg(F.min("a").alias("first"))
    across = (found.filter(F.col("kind") == HEAD).join(heads, "key").filter("a <> first")
              .select(F.least("a", "first").alias("a"), F.greatest("a", "first").alias("b")))
    pairs = freeze(found.filter(F.col("kind") == PAIR).select("a", "b").unionByName(across).distinct())
    members = found.filter(F.col("kind") == MEMBER).select("key", F.col("a").alias("id")).distinct()

    wanted = freeze(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
                    .unionByName(members.select("id")).distinct())
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = freeze(sets.select(F.col("rid").alias("id"), "text").join(few, "id", "left_semi"))

    labels = _merge(wanted.select("id", F.col("id").alias("label")), _confirmed(pairs, texts, width, percent))
    more = freeze(_more_candidates(members, labels, nodes, texts, width, percent, m).join(pairs, ["a", "b"], "left_anti"))
    links = _confirmed(more, texts, width, percent)
    links = _by_label(links.select(F.col("u").alias("a"), F.col("v").alias("b")), labels).select(
        F.col("la").alias("u"), F.col("lb").alias("v"))
    labels = _merge(labels, links)

    # back to rows: a row's component is its node's label, or the node itself
    named = node.join(labels, "id", "left").select(
        "f1", "f2", "n", F.coalesce("label", "id").alias("component"))
    named = freeze(named)
    owned = freeze(sets.select("rid", "doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
                   .select("rid", "doc_id", "n", F.coalesce("component", "rid").alias("component"),
                           F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid").alias("rank")))
    best = freeze(owned.groupBy("component").agg(F.min("rank").alias("best")))
    return owned.join(best, "component").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"),
        (F.col("rid") == F.col("best.rid")).alias("kept"))
