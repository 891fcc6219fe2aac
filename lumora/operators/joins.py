"""Joins between items and vectors, and dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumora.fixed_values import CATEGORY_COLOURS, DEFAULT_COLOUR
from lumora.functions.vectors import to_float32
from lumora.plans.freeze import freeze
from lumora.plans.skew import HOT_ROWS, skew_left_join


def one_per_key(df: DataFrame, key: str, order: str, last: bool = True) -> DataFrame:
    """The whole row with the highest (or, not ``last``, the lowest) ``order`` of each ``key``; no row without key.

    Keys that occur more than once are found first, by a hash aggregate of two numbers a key.  Only
    they are looked at further: rows of all other keys pass as they are, and superseded rows go
    before anything wide is shuffled.  The table of such keys is frozen, so Catalyst broadcasts it
    where its size allows.  Of several rows with the same key and order the one whose values hash
    highest stays.  Runs jobs when called; ``df`` is read again, so freeze it first if it is
    costly to compute.
    """
    pick = F.max if last else F.min
    rows = df.filter(F.col(key).isNotNull())
    repeated = freeze(rows.groupBy(F.col(key).alias("__k")).agg(pick(order).alias("__at"), F.count(F.lit(1)).alias("__n"))
                      .filter("__n > 1").select("__k", "__at"))
    if repeated.isEmpty():
        return rows
    same = F.col(key) == F.col("__k")
    single = rows.join(repeated, same, "left_anti")
    best = rows.join(repeated, same & F.coalesce(F.col(order) == F.col("__at"), F.col("__at").isNull()), "left_semi")
    hashed = F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])
    best = freeze(best.withColumns({"__hash": hashed, "__row": F.monotonically_increasing_id()}))
    # equal order: the highest hash, and of rows that are equal in everything the first as written
    narrow = best.select(F.col(key).alias("__k"), "__hash", "__row")
    top = narrow.groupBy("__k").agg(F.max("__hash").alias("__most"))
    chosen = (narrow.join(top, "__k").filter(F.col("__hash") == F.col("__most"))
              .groupBy("__k").agg(F.min("__row").alias("__first")))
    kept = best.join(freeze(chosen.select("__first")), F.col("__row") == F.col("__first"), "left_semi")
    return single.unionByName(kept.drop("__hash", "__row"))


def last_wins(df: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """One row per ``key``: the values of its row with the highest ``order``; see :func:`one_per_key`.

    Rows without a key count as one key, too."""
    wanted = list(dict.fromkeys([key, order, *values]))
    keyless = (df.filter(F.col(key).isNull()).groupBy(key).agg(F.max_by(F.struct(*values), order).alias("__r"))
               .select(key, *[F.col(f"__r.{c}").alias(c) for c in values]))
    return one_per_key(df.select(*wanted), key, order).select(key, *values).unionByName(keyless)


def join_items_vectors(items: DataFrame, vectors: DataFrame,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every item with its vector as float32; an empty vector where there is none.

    ``vectors`` has ``id, pos, v``; of several vectors for one id the last counts.
    Vectors are shuffled once, by the join, and never aggregated.
    """
    def latest(df):
        return one_per_key(df.select("id", "pos", "v"), "id", "pos").select("id", "v")

    empty = F.array().cast("array<float>")
    return (skew_left_join(items, vectors, "id", latest, hot_rows)
            .withColumn("v", F.coalesce(to_float32("v"), empty)))


def join_vectors_items(vectors: DataFrame, items: DataFrame, columns: list[str],
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every vector with columns of its item; NULL where the item is unknown.

    Repeated vector ids stay as rows, each with the last vector of that id; of
    repeated items the last counts.  ``items`` has ``id, pos`` and ``columns``.
    ``vectors`` has ``id, pos`` and what is to be carried, be it vectors or scores;
    carrying scores is far cheaper, see :func:`lumora.operators.evaluate.evaluate`.
    """
    carried = [c for c in vectors.columns if c not in ("id", "pos")]
    rows = vectors.select("id", "pos")
    if carried:
        rows = skew_left_join(rows, vectors, "id",
                              lambda df: one_per_key(df, "id", "pos").select("id", *carried), hot_rows)
    return skew_left_join(rows, items, "id",
                          lambda df: one_per_key(df.select("id", "pos", *columns), "id", "pos").select("id", *columns), hot_rows)


def relevance(vectors: DataFrame, items: DataFrame, target: Column | str) -> DataFrame:
    """1 where the category of the vector's item equals ``target``, else 0."""
    target = F.lit(target) if isinstance(target, str) else target
    joined = join_vectors_items(vectors, items, ["category"])
    return joined.withColumn("rel", F.col("category").eqNullSafe(target).cast("int"))


def category_colour(category: Column | str) -> Column:
    """Colour of a category, a default for any other.

    The table is a fixed handful of entries, so it is a map literal, not a join.
    """
    category = F.col(category) if isinstance(category, str) else category
    table = F.create_map(*[F.lit(x) for pair in CATEGORY_COLOURS.items() for x in pair])
    return F.coalesce(table[category], F.lit(DEFAULT_COLOUR))


def with_attribute(df: DataFrame, dimension: DataFrame, key: str, value: str,
                   default) -> DataFrame:
    """Look ``value`` up by ``key`` in a dimension table, ``default`` where absent.

    The dimension is frozen: Catalyst broadcasts it if its size allows, and else leaves
    hot keys to adaptive execution.
    """
    dim = freeze(dimension.select(F.col(key).alias("__k"), F.col(value).alias("__v")))
    return (df.join(dim, F.col(key) == F.col("__k"), "left")
            .withColumn(value, F.coalesce("__v", F.lit(default))).drop("__k", "__v"))
