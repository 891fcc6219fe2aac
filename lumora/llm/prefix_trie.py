"""A trie of conversation prefixes from sorted sequences, LCPs and range minima.

Conversations are sorted by their sequences of turn digests; every node of the trie is then an interval of them.
With L(p) the number of turns that conversations p - 1 and p share at the start (their LCP), the first d turns of p
belong to the interval from the smallest l to the largest r such that no L in (l, p] or (p, r] is below d.  A sparse
table of minima over powers of two (Bender and Farach-Colton, "The LCA problem revisited", 2000) answers a
minimum in two look-ups, so each candidate (p, d) finds both ends by binary search, on its own and without a
stack.  Sums over an interval come from running sums:

* leaves end at each p with more turns than L(p + 1); children of depth d + 1 start at each p > l in the interval
  with L(p) = d and more than d turns, and at l if it has more than d;
* what sharing saves below a node is, over p in (l, r], the bytes of p's turns d to L(p).

1. Turns become digests (SHA-256 cut to 128 bits, of role and text) and sizes before anything is shuffled; texts go
   no further.  Turns of a conversation are gathered to one row of 24 bytes a turn, then rebuilt (see ``rebuilt``).
2. Rows are range-partitioned by (sequence, conv_id), so copies of one conversation may span partitions, and written.
   Each partition's first and last row are told to its neighbours; then each partition is a block that one
   task works on: LCPs, sparse table, searches.
3. A node inside a block is complete.  One that crosses a block's edge is a prefix of the row there: it leaves
   each block as a part, and parts, at most two paths a block, are added up by their prefix's digest.  Parents
   of complete nodes that cross an edge are joined by it.  The ids that end in such a node leave each block
   as one text, already sorted; these are hashed in block order as a stream.

Ties: turns of equal number are ordered by digest.  NULL roles and texts are empty texts; a NULL turn comes first;
rows with a NULL conv_id take no part; repeated rows are turns of their own.  Without conversations there is no
node.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

#: Hexadecimal digits of a turn's digest.
DIGITS = 32
#: Turns in a block, about.
BLOCK_TURNS = 500_000
EVERY, LONGEST = 5, 9


def gathered(table: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (turn, digest, bytes) in order), one row per conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS)
    turns = table.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
                                                F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame, every: int = EVERY, longest: int = LONGEST) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % every; its own follow after its first h."""
    c = F.col("conv_id")
    turns = freeze(turns)
    h = (F.crc32(c.cast("string")) % longest).cast("int")
    base = turns.select(c.alias("base"), F.slice("turns", 1, longest).alias("start"))
    own = turns.withColumn("base", c - c % every).withColumn("h", h)
    start = F.slice(F.coalesce("start", F.array().cast("array<struct<turn:long,digest:string,bytes:long>>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", F.concat(start, rest).alias("turns"))


def _leading(key: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each row the number of equal digests at the start of it and the row before; 0 for the first."""
    out = np.zeros(len(length), np.int64)
    common = np.minimum(length[1:], length[:-1])
    row = np.repeat(np.arange(1, len(length)), common)
    place = np.arange(len(row)) - np.repeat(np.cumsum(common) - common, common)
    differs = (key[start[row] + place] != key[start[row - 1] + place]).any(1)
    out[1:] = common
    np.minimum.at(out, row[differs], place[differs])
    return out


class Minima:
    """A sparse table: minima of x over any range, in two look-ups."""

    def __init__(self, x: np.ndarray) -> None:
        self.rows = [x]
        while 2 << (len(self.rows) - 1) <= len(x):
            half = 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(self.rows[-1][:-half], self.rows[-1][half:]))

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The minimum of x[low..high], for low <= high."""
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][low[at]], self.rows[k][high[at] - (1 << k) + 1])
        return out

    def first_from(self, p: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The smallest l such that no x in (l, p] is below d, by binary search."""
        low, high = np.zeros(len(p), np.int64), p.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.flatnonzero(open_)
            fits = self.over(middle[at] + 1, p[at]) >= d[at]
            high[at[fits]] = middle[at[fits]]
            low[at[~fits]] = middle[at[~fits]] + 1
        return high

    def last_to(self, p: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The largest r such that no x in (p, r] is below d."""
        low, high = p.copy(), np.full(len(p), len(self.rows[0]) - 1, np.int64)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            at = np.flatnonzero(open_)
            fits = self.over(p[at] + 1, middle[at]) >= d[at]
            low[at[fits]] = middle[at[fits]]
            high[at[~fits]] = middle[at[~fits]] - 1
        return low


def _digests(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(one row of two numbers per turn, turns per key) of keys made of hexadecimal digests."""
    length = np.array([len(k) // DIGITS for k in keys], np.int64)
    data = np.frombuffer(bytes.fromhex("".join(keys)), dtype=">u8").reshape(-1, DIGITS // 16)
    return data, length


def _shared(a: str, b: str) -> int:
    """How many digests two keys share at the start."""
    n = min(len(a), len(b)) // DIGITS
    return next((k for k in range(n) if a[k * DIGITS:(k + 1) * DIGITS] != b[k * DIGITS:(k + 1) * DIGITS]), n)


def _prefixes(key: str, depth: int) -> list[str]:
    """A digest of each prefix of 0 to ``depth`` turns."""
    h, out = hashlib.sha256(), []
    for k in range(depth + 1):
        out.append(h.hexdigest())
        h.update(key[k * DIGITS:(k + 1) * DIGITS].encode())
    return out


_NODE = ("node string, conv_id long, depth int, parent string, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved long, ends string, above long, block int")
_EMPTY = hashlib.sha256(b"").hexdigest()


def block_nodes(keys: list[str], ids: np.ndarray, sizes: list[np.ndarray], before: str | None, after: str | None, block: int) -> pa.RecordBatch:
    """The nodes of a block of sorted conversations, ``before`` and ``after`` being the keys next to it.

    A complete node has no ``node`` and ``ends`` is a hash; a part of a node that crosses an edge carries the prefix's digest
    in ``node``, the ids that end in it in ``ends``, and in ``saved`` the bytes of all shared starts, from which
    ``above``, the bytes of the turns above the node, goes off once for each conversation but the first."""
    digest, length = _digests(keys)
    n, start = len(keys), np.cumsum(length) - length
    shared = _leading(digest, start, length)
    left = -1 if before is None else _shared(before, keys[0])
    right = -1 if after is None else _shared(keys[-1], after)
    shared[0] = left
    following = np.append(shared[1:], right)
    up_to = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if len(digest) else np.zeros(1, np.int64)     # bytes before each turn
    bytes_to = lambda p, d: up_to[start[p] + d] - up_to[start[p]]  # noqa: E731  bytes of the first d turns of p
    leaf = np.concatenate([[0], np.cumsum(length > following)])
    gain = np.concatenate([[0], np.cumsum(bytes_to(np.arange(n), np.maximum(shared, 0)))])
    minima, least_id = Minima(shared), Minima(ids)

    # candidates: every prefix of every conversation, the empty one included
    p = np.repeat(np.arange(n), length + 1)
    d = np.arange(len(p)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    l, r = minima.first_from(p, d), minima.last_to(p, d)
    own = np.flatnonzero(l == p)                                     # the interval's first conversation stands for it
    number = np.full(len(p), -1)
    number[own] = np.arange(len(own))
    at = np.cumsum(length + 1) - length - 1                          # of (p, 0) among the candidates
    p, d, r = p[own], d[own], r[own]
    up = np.flatnonzero(d > 0)
    parent = np.full(len(own), -1)
    parent[up] = number[at[l[at[p[up]] + d[up] - 1]] + d[up] - 1]
    begins = shared[p] < d                                           # not so where it goes on from the block before
    children = np.bincount(parent[up], weights=begins[up], minlength=len(own)).astype(np.int64)
    members = r - p + 1
    leaves = leaf[r + 1] - leaf[p]
    first_gain = np.where(begins, gain[p + 1], gain[p])             # the first of all has nothing to share with
    above = bytes_to(p, np.maximum(d - 1, 0))
    crosses_left, crosses_right = (p == 0) & (d <= left), (r == n - 1) & (d <= right)
    crosses = crosses_left | crosses_right
    saved = gain[r + 1] - first_gain - np.where(crosses, 0, (members - 1) * above)
    least = least_id.over(p, r)

    names = [_prefixes(keys[0], max(left, 0)) if left >= 0 else [], _prefixes(keys[-1], max(right, 0)) if right >= 0 else []]
    name = [None] * len(own)
    for k in np.flatnonzero(crosses):
        name[k] = names[0][d[k]] if crosses_left[k] else names[1][d[k]]
    ends = ["" if c else _EMPTY for c in crosses]
    # the conversations with just d turns come first in an interval, and copies lie side by side
    new = np.flatnonzero(np.concatenate([[True], (shared[1:] < length[1:]) | (length[1:] != length[:-1])]))
    text = ids.astype(str)
    for a, b in zip(new, np.append(new[1:], n)):
        k = number[at[l[at[a] + length[a]]] + length[a]]
        joined = ",".join(text[a:b])
        ends[k] = joined if crosses[k] else hashlib.sha256(joined.encode()).hexdigest()
    has = parent >= 0
    over = np.where(has, parent, 0)
    parent_crosses = has & crosses[over]
    return pa.RecordBatch.from_arrays([
        pa.array(name, pa.string()), pa.array(least, pa.int64()), pa.array(d, pa.int32()),
        pa.array([name[q] if c else None for q, c in zip(over, parent_crosses)], pa.string()),
        pa.array(least[over], pa.int64(), mask=~has | parent_crosses), pa.array(members, pa.int64()), pa.array(children, pa.int64()),
        pa.array(leaves, pa.int64()), pa.array(saved, pa.int64()), pa.array(ends, pa.string()),
        pa.array(above, pa.int64()), pa.array(np.full(len(own), block), pa.int32())],
        [f.split()[0] for f in _NODE.split(", ")])


def sorted_blocks(convs: DataFrame, turns: int) -> DataFrame:
    """(block, kind, key, conv_id, sizes): the conversations in order, kind 1, and in each block the rows next to it,
    kind 0 before and 2 after."""
    rows = convs.select(F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("key"), "conv_id",
                        F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    n = max(1, -(-turns // BLOCK_TURNS))
    placed = freeze(rows.repartitionByRange(n, "key", "conv_id").select(F.spark_partition_id().alias("block"), "key", "conv_id", "sizes"))
    edges = freeze(placed.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last")))
    order = Window.partitionBy(F.lit(0)).orderBy("block")            # one row per block
    near = edges.select("block", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    none = F.lit(None)
    sides = near.select("block", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("before").alias("key")),
                                                   F.struct(F.lit(2).alias("kind"), F.col("after").alias("key")))).alias("s"))
    sides = sides.select("block", "s.kind", "s.key", none.cast("long").alias("conv_id"), none.cast("array<long>").alias("sizes"))
    return placed.select("block", F.lit(1).alias("kind"), "key", "conv_id", "sizes").unionByName(sides)


def _scan(batches):
    number, held = None, None

    def done():
        keys, ids, sizes, before, after = held
        if keys:
            yield block_nodes(keys, np.array(ids, np.int64), sizes, before, after, number)

    for batch in batches:
        for block, kind, key, conv_id, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                                   batch.column(3).to_pylist(), batch.column(4)):
            if block != number:
                if number is not None:
                    yield from done()
                number, held = block, [[], [], [], None, None]
            if kind == 1:
                held[0].append(key)
                held[1].append(conv_id)
                held[2].append(size.values.to_numpy())
            else:
                held[3 if kind == 0 else 4] = key
    if number is not None:
        yield from done()


def _hash_stream(batches):
    """The hash of each node's texts, joined in order; texts arrive sorted by node and block."""
    node, h, any_ = None, None, False
    for batch in batches:
        out = []
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    out.append((node, h.hexdigest()))
                node, h, any_ = name, hashlib.sha256(), False
            if any_:
                h.update(b",")
            h.update(ends.encode())
            any_ = True
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], ["node", "hash"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], ["node", "hash"])


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv_id, turns as in ``gathered``)."""
    convs = freeze(convs)
    turns = convs.agg(F.coalesce(F.sum(F.size("turns") + 1), F.lit(0))).first()[0]
    blocks = sorted_blocks(convs, turns)
    n = max(1, -(-turns // BLOCK_TURNS))
    found = freeze(blocks.repartition(n, "block").sortWithinPartitions("block", "kind", "key", "conv_id").mapInArrow(_scan, _NODE))
    parts = found.filter(F.col("node").isNotNull())
    # above is the same in all parts of a node
    whole = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("saved") - (F.sum("n_convs") - 1) * F.first("above")).alias("saved"))
    ends = (parts.filter(F.col("ends") != "").select("node", "block", "ends")
            .repartition("node").sortWithinPartitions("node", "block").mapInArrow(_hash_stream, "node string, hash string"))
    whole = freeze(whole.join(ends, "node", "left").withColumn("ends", F.coalesce("hash", F.lit(_EMPTY))).drop("hash"))
    names = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    nodes = found.filter(F.col("node").isNull()).select(*_RESULT, "parent", "parent_conv_id").unionByName(
        whole.select(*_RESULT, "parent", F.lit(None).cast("long").alias("parent_conv_id")))
    # only nodes next to an edge look for their parent
    joined = nodes.filter(F.col("parent").isNotNull()).join(names, "parent", "left").drop("parent")
    alone = nodes.filter(F.col("parent").isNull()).drop("parent").withColumn("found", F.lit(None).cast("long"))
    return joined.unionByName(alone).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "found").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


_RESULT = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends"]


def prefix_trie(table: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node, over
    the rebuilt conversations of ``table`` (conv_id, turn, role, text)."""
    return trie(rebuilt(gathered(table)))
