"""Sharding by a weighted hash tree: region, rack, shard.

At each level every child draws ``ln(u) / weight`` with u a hash of the document id and the
child's name, and the largest draw wins: a child is chosen with probability proportional to its
weight, and a draw depends on nothing but the id, the name and the child's own weight.  When the
weight of a subtree changes, only its draw changes, so documents move only into it (heavier) or
out of it (lighter); the draws inside all other subtrees stay.

A tree grows by a region of its own: ``grown`` appends one region with one rack and one shard.
No other weight changes, so the new shard takes documents into itself and no other document moves
(the law ``key``).  Everything is a column expression; no Python runs on the data.

NULL texts have no bytes and the checksum 0, NULL ids draw as the empty text, repeated rows go to
the same shard and get a slot each, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

#: Hex digits of the hash that make the draw: 52 bits are exact in a double.
DIGITS = 13
#: Rows that are numbered together.
BLOCK_ROWS = 100_000


@dataclass(frozen=True)
class Tree:
    """regions[i][j][k] = (shard number, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def even(cls, regions: int = 3, racks: int = 2, shards: int = 4, weight: float = 1.0) -> Tree:
        """regions x racks x shards of equal weight, numbered from 0."""
        return cls(tuple(tuple(tuple(((i * racks + j) * shards + k, weight) for k in range(shards))
                               for j in range(racks)) for i in range(regions)))

    @property
    def shards(self) -> list[int]:
        return [s for region in self.regions for rack in region for s, _ in rack]

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, the next number, in a region of its own."""
        return Tree((*self.regions, ((((max(self.shards) + 1), weight),),)))


def draw(key: Column, name: Column, weight: Column) -> Column:
    """ln(u) / weight with u in (0, 1] from the hash of key and name."""
    hashed = F.conv(F.substring(F.md5(F.concat_ws("/", key, name)), 1, DIGITS), 16, 10).cast("double")
    return F.log((hashed + 1) / F.lit(float(16 ** DIGITS))) / weight


def _children(groups: list[list[tuple[str, float]]]) -> Column:
    """Per parent, its children's (at, name, weight); literals of the size of the tree."""
    return F.array(*[F.array(*[F.struct(F.lit(i).alias("at"), F.lit(n).alias("name"), F.lit(float(w)).alias("weight"))
                               for i, (n, w) in enumerate(group)]) for group in groups])


def _descend(key: Column, children: Column) -> Column:
    """The place of the child with the largest draw (on equal draws the later one)."""
    draws = F.transform(children, lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("d"), c["at"].alias("at")))
    return F.array_max(draws)["at"]


def place(df: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """``df`` with the shard of each row in ``out``."""
    racks = [(i, j) for i, region in enumerate(tree.regions) for j in range(len(region))]
    first = F.array(*[F.lit(next(n for n, r in enumerate(racks) if r[0] == i)) for i in range(len(tree.regions))])
    weigh = lambda rack: sum(w for _, w in rack)
    top = _children([[(f"region{i}", sum(map(weigh, region))) for i, region in enumerate(tree.regions)]])
    mid = _children([[(f"region{i}/rack{j}", weigh(rack)) for j, rack in enumerate(region)]
                     for i, region in enumerate(tree.regions)])
    low = _children([[(f"shard{s}", w) for s, w in tree.regions[i][j]] for i, j in racks])
    numbers = F.array(*[F.array(*[F.lit(s) for s, _ in tree.regions[i][j]]) for i, j in racks])
    return (df.withColumn("__region", _descend(key, top[0]))
            .withColumn("__rack", first[F.col("__region")] + _descend(key, mid[F.col("__region")]))
            .withColumn(out, numbers[F.col("__rack")][_descend(key, low[F.col("__rack")])].cast("int"))
            .drop("__region", "__rack"))


def number_slots(df: DataFrame, order: list[str]) -> DataFrame:
    """``slot``: gapless from 0 within each shard, by ``order``, without a window over a shard.

    Rows are dealt by range of the order into blocks, written with their block's number; a
    block's rows are numbered within (shard, block) and shifted by the counts of earlier blocks.
    ``order`` must end in a column that differs in all rows, so that equal keys can be split.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // BLOCK_ROWS))
    blocks = freeze(df.repartitionByRange(n, *order).withColumn("block", F.spark_partition_id()))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("__n")).select(
        "shard", "block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    within = Window.partitionBy("shard", "block").orderBy(*order)
    return (blocks.withColumn("__row", F.row_number().over(within)).join(shift, ["shard", "block"])
            .withColumn("slot", (F.col("__row") + F.col("__shift") - 1).cast("long")))


def shard_documents(docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``."""
    tree = tree or Tree.even()
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sized = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"),
                        (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = freeze(place(place(sized, key, tree, "shard"), key, tree.grown(), "grown_shard"))
    return number_slots(placed, ["doc_id", "text_crc32", "size", "rid"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
