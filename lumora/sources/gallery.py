"""Readers: envelopes, columnar galleries, landed hits, image bytes, small tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumora import fixed_values, schemas
from lumora.operators.joins import join_items_vectors
from lumora.plans.blocks import open_store, reachable
from lumora.sources.envelopes import read_array


def _one(head: DataFrame) -> DataFrame:
    """One header of the parts of an envelope: their counts add up, all else is the first part's."""
    fields = [f for f in head.columns if f != "part"]
    return head.agg(*[(F.sum(c) if c == "count" else F.min_by(c, "part")).alias(c) for c in fields])


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(items with ``pos`` in file order, one-row metadata) of a JSON envelope."""
    items, head = read_array(spark, path, "items", schemas.ITEM, T.StructType(schemas.MANIFEST.fields[:2]))
    return items, _one(head)


def read_embeddings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors ``id, pos, v``, one-row header) of a JSON envelope."""
    vectors, head = read_array(spark, path, "embeddings", schemas.VECTOR, schemas.EMBEDDING_HEADER)
    return vectors.select("id", "pos", "v"), _one(head)


def read_evaluation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(per-query metrics with ``qid`` in file order, one-row aggregate)."""
    per_query, head = read_array(spark, path, "perQuery", schemas.PER_QUERY, T.StructType(schemas.EVALUATION.fields[:3]))
    return per_query.withColumnRenamed("pos", "qid"), _one(head).select("model", "evaluatedAt", "aggregate.*")


def read_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, one-row header) as written by :mod:`lumora.sources.sinks`."""
    return spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/header")


class Gallery(NamedTuple):
    items: DataFrame        # items joined with their vectors
    header: DataFrame
    evaluation: DataFrame
    aggregate: DataFrame


def as_gallery(items: DataFrame, vectors: DataFrame, base: str = "") -> DataFrame:
    """Items and vectors as one gallery: ``src`` resolved, ``isUpload`` false."""
    return (join_items_vectors(items, vectors)
            .withColumn("src", F.concat(F.lit(base), F.col("file")))
            .withColumn("isUpload", F.lit(False)).drop("file"))


def load_gallery(spark: SparkSession, folder: str, base: str = "") -> Gallery:
    """The three artifacts of a folder together; a missing or broken one fails the load.

    Envelopes are read in as many tasks as they have splits (:mod:`lumora.sources.envelopes`).

    ``<name>.json`` envelopes and ``<name>/rows`` + ``<name>/header`` parquet tables
    are both understood; the latter is the layout for galleries of any size.
    """
    def either(name, read):
        path = f"{folder}/{name}.json"
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return read(spark, path) if fs.exists(jpath) else read_table(spark, f"{folder}/{name}")

    items, built = either("manifest", read_manifest)
    vectors, head = either("embeddings", read_embeddings)
    per_query, total = either("eval", read_evaluation)
    for one_row in (built, head, total):
        one_row.first()
    return Gallery(as_gallery(items, vectors, base), head, per_query, total)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """(file, content, length) of every file under ``root``; ``file`` is relative to it,
    as in the manifest."""
    jroot = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = jroot.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = fs.makeQualified(jroot).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.expr(f"substring(path, {len(prefix) + 2})").alias("file"),
                        "content", "length")


CONTENT_BYTES = 32 << 20        # image bytes in an Arrow batch, about


def with_images(items: DataFrame, root: str) -> DataFrame:
    """``items`` with the ``content`` of the image that ``file`` names under ``root``.

    Tasks open the named files only, whatever else lies there; ``content`` is NULL where there is no such file.
    Where Python tasks cannot reach the folder, Spark reads all of it and joins."""
    if not reachable(root):
        images = read_images(items.sparkSession, root).select("file", "content")
        return items.join(images, "file", "left").select(*items.columns, "content")

    def run(batches):
        import pyarrow as pa

        store, base = open_store(root)
        for batch in batches:
            names = batch.column("file").to_pylist()
            start, held, size = 0, [], 0
            for k, name in enumerate(names):
                try:
                    with store.open_input_file(f"{base}/{name}") as f:
                        held.append(f.read())
                except FileNotFoundError:
                    held.append(None)
                size += len(held[-1] or b"")
                if size >= CONTENT_BYTES or k == len(names) - 1:
                    part = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], [*batch.schema.names, "content"])
                    start, held, size = k + 1, [], 0

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInArrow(run, f"{fields}, content binary")


def read_candidates(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed search results, one document per category, as hits with their position.

    A document without results contributes nothing.
    """
    pages = spark.read.schema(schemas.CANDIDATE_PAGE).format(fmt).load(path)
    return pages.select("category", F.posexplode("results").alias("pos", "hit")).select(
        "category", F.col("pos").cast("long").alias("pos"), "hit.*")


def category_plan(spark: SparkSession, plan: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    rows = [(i, c, p) for i, (c, p) in enumerate(plan or fixed_values.CATEGORY_PLAN)]
    return spark.createDataFrame(rows, "cat_pos int, category string, phrase string")


def evaluation_prompts(spark: SparkSession) -> DataFrame:
    rows = [(i, c, p) for i, (c, p) in enumerate(fixed_values.EVALUATION_PROMPTS)]
    return spark.createDataFrame(rows, "qid long, category string, query string")


def label_vocabulary(spark: SparkSession, labels: Sequence[str] | None = None) -> DataFrame:
    rows = list(enumerate(labels or fixed_values.LABEL_VOCABULARY))
    return spark.createDataFrame(rows, "label_pos long, label string")
