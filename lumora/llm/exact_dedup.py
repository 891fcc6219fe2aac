"""Exact deduplication against history through a minimal perfect hash.

The distinct digests of the historical rows are dealt over shards of bounded size by their own
first bytes.  Each shard becomes a minimal perfect hash (cascaded collision-free bit levels with
rank, after Limasset et al., "Fast and scalable minimal perfect hashing for massive key sets",
2017) whose slots hold the full SHA-256 digest, the locator of the row that wins, and a count.
Arriving digests, already reduced to one row each, meet the shard: the slot is compared byte by
byte, so a text outside history that lands on a slot is told apart.  Repeats join the winner's
group; the others group among themselves.

NULL texts count as empty.  Of equal texts the smallest doc_id stays, NULL ids last; of repeated
rows with that id, exactly one.  An empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import U64, mix, rows
from lumora.plans.freeze import freeze

#: Distinct digests in a shard, on average.
SHARD_DIGESTS = 32_768
GAMMA = 2.0
LEVELS = 48


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers of each digest (n x 32 bytes)."""
    part = np.ascontiguousarray(digests[:, 8:24]).view(U64)
    return part[:, 0], part[:, 1]


def _place(h1, h2, level: int, size: int) -> np.ndarray:
    return (mix(h1 + U64(level) * h2) % U64(size)).astype(np.int64)


class PerfectHash:
    """A bijection from n distinct digests to 0..n-1."""

    def __init__(self, digests: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = len(digests)
        left, base = np.arange(self.n), 0
        h1, h2 = _halves(digests) if self.n else (np.zeros(0, U64),) * 2
        while len(left):
            if len(self.levels) == LEVELS:
                raise ValueError("digests in a shard are not distinct")
            size = max(1, int(GAMMA * len(left)))
            at = _place(h1[left], h2[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            base = int(rank[-1]) + 1
            left = left[~alone[at]]

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; any slot or -1 for one that is no member."""
        slot = np.full(len(digests), -1, np.int64)
        if not len(digests):
            return slot
        h1, h2 = _halves(digests)
        left = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            at = _place(h1[left], h2[left], level, len(alone))
            hit = alone[at]
            slot[left[hit]] = rank[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return slot


def _bytes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, 32)


def build_shard(part: pd.DataFrame) -> pd.DataFrame:
    """The slots of one shard, in the order of its perfect hash."""
    hashed = PerfectHash(_bytes(part["digest"]))
    order = np.empty(len(part), np.int64)
    order[hashed(_bytes(part["digest"]))] = np.arange(len(part))
    part = part.iloc[order]
    return pd.DataFrame({"shard": part["shard"].iloc[:1], "n": len(part),
                         "digests": [b"".join(part["digest"])],
                         "no_id": [part["no_id"].tolist()], "keep_id": [part["keep_id"].tolist()],
                         "keep_rid": [part["keep_rid"].tolist()], "size": [part["size"].tolist()]})


def lookup_shard(index: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
    """All groups of one shard: history with its repeats, and the texts history hasn't."""
    names = ["digest", "no_id", "keep_id", "keep_rid", "size"]
    if not len(index):
        return arrivals[names].assign(known=False)
    slots = index.iloc[0]
    stored = np.frombuffer(slots["digests"], dtype=np.uint8).reshape(-1, 32)
    old = pd.DataFrame({"digest": [x.tobytes() for x in stored]} | {
        c: np.asarray(slots[c]) for c in names[1:]}).assign(known=True)
    if not len(arrivals):
        return old
    wanted = _bytes(arrivals["digest"])
    slot = PerfectHash(stored)(wanted)
    member = (slot >= 0) & (stored[slot] == wanted).all(axis=1)
    new = arrivals[names].assign(known=False)
    hits, at = new[member], slot[member]
    mine = list(zip(old["no_id"].to_numpy()[at], old["keep_id"].to_numpy()[at], old["keep_rid"].to_numpy()[at]))
    best = [min(a, b) for a, b in zip(mine, zip(hits["no_id"], hits["keep_id"], hits["keep_rid"]))]
    if best:
        for c, values in zip(names[1:4], zip(*best)):
            column = old[c].to_numpy().copy()
            column[at] = values
            old[c] = column
        size = old["size"].to_numpy().copy()
        size[at] += hits["size"].to_numpy()
        old["size"] = size
    return pd.concat([old, new[~member]], ignore_index=True)


_GROUP = "digest binary, no_id int, keep_id long, keep_rid long, size long"
_INDEX = "shard int, n long, digests binary, no_id array<int>, keep_id array<long>, keep_rid array<long>, size array<long>"


def _distinct(keys: DataFrame, shards: int) -> DataFrame:
    """One row per digest: the row that wins, and how many rows there are."""
    won = keys.groupBy("digest").agg(
        F.min(F.struct("no_id", "keep_id", "rid")).alias("won"), F.count(F.lit(1)).alias("size"))
    number = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return won.select((number % shards).cast("int").alias("shard"), "digest", "won.no_id", "won.keep_id",
                      F.col("won.rid").alias("keep_rid"), "size")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """(shard, slots): a written table, one bounded row per shard. history: keys as of ``keys_of``."""
    return freeze(_distinct(history, shards).groupBy("shard").applyInPandas(build_shard, _INDEX))


def keys_of(docs: DataFrame, history: Column) -> DataFrame:
    """(rid, doc_id, digest, old, ...), written: texts are read once and only digests move on."""
    return freeze(rows(docs).select(
        "rid", "doc_id", F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("digest"),
        F.coalesce(history, F.lit(False)).alias("old"), F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("keep_id")))


def exact_dedup(docs: DataFrame, history: Column | None = None, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """(rid, doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    ``history``: which rows the index is built from (an expression of doc_id); by default every
    other id by hash, so that a single table shows both sides.
    """
    if history is None:
        history = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    keys = keys_of(docs, history)
    shards = max(1, -(-keys.count() // shard_digests))
    index = build_index(keys.filter("old"), shards)
    arrivals = _distinct(keys.filter("NOT old"), shards)
    groups = freeze(index.groupBy("shard").cogroup(arrivals.groupBy("shard"))
                    .applyInPandas(lookup_shard, f"{_GROUP}, known boolean"))
    groups = groups.select("digest", F.when(F.col("no_id") == 0, F.col("keep_id")).alias("keep_id"),
                           "keep_rid", F.col("size").alias("group_size"))
    return keys.select("rid", "doc_id", "digest").join(groups, "digest").select(
        "rid", "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
