"""The three batch jobs: curate, embed, evaluate.  Tables are the interface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumora.fixed_values import ITEMS_PER_CATEGORY
from lumora.operators import curate as cur
from lumora.operators import embed as emb
from lumora.operators import evaluate as ev
from lumora.operators import search
from lumora.plans.freeze import freeze
from lumora.plans.spread import spread
from lumora.sources import gallery as src
from lumora.sources import sinks


def curation_job(candidates: DataFrame, plan: DataFrame, out: str, *,
                 per_category: int = ITEMS_PER_CATEGORY, hits: int | None = None) -> DataFrame:
    """Hits to ``<out>/manifest``; returns the fill report.

    ``hits``: look at so many eligible hits of a category only (one result page, say).

    A category without hits, or a bad hit, never stops the run.
    """
    kept = cur.assign_ids(cur.keep(candidates, plan, per_category, hits))
    sinks.write_manifest(cur.clean_metadata(kept), f"{out}/manifest")
    return cur.fill_report(kept, plan, per_category)


def embedding_job(spark: SparkSession, folder: str, images: str, encoder: emb.Encoder,
                  *, batch_size: int = 64, partitions: int | None = None) -> DataFrame:
    """``<folder>/manifest`` and the image files under ``images`` to
    ``<folder>/embeddings``; returns the header.

    Only files that the manifest names are opened, by tasks that embed them at once, so image
    bytes are neither shuffled nor joined.  An item without image, or an image that cannot be
    decoded, fails the job.  ``partitions``: see :func:`lumora.operators.embed.embed`.
    """
    items, head = src.read_table(spark, f"{folder}/manifest")
    named = src.with_images(spread(items.select("id", "pos", "file"), partitions), images).filter(F.col("content").isNotNull())
    vectors = freeze(emb.embed(named, "content", encoder, batch_size=batch_size).select("id", "pos", "v"))
    missing = head.first()["count"] - vectors.count()
    if missing:
        raise FileNotFoundError(f"{missing} items of {folder} have no image under {images}")
    sinks.write_embeddings(vectors, emb.header(vectors, encoder), f"{folder}/embeddings")
    return src.read_table(spark, f"{folder}/embeddings")[1]


def evaluation_job(spark: SparkSession, folder: str, prompts: DataFrame, text_encoder: emb.Encoder,
                   *, batch_size: int = 64) -> DataFrame:
    """Score the prompts against the embedded gallery; returns the aggregate row."""
    items, _ = src.read_table(spark, f"{folder}/manifest")
    vectors, head = src.read_table(spark, f"{folder}/embeddings")
    h = head.first()
    if (h["model"], h["dtype"]) != (text_encoder.model, text_encoder.dtype):
        raise ValueError(f"gallery was embedded by {h['model']} ({h['dtype']})")
    emb.check_uniform(vectors, text_encoder.dim)
    queries = freeze(emb.embed(prompts, "query", text_encoder, batch_size=batch_size))
    per_query = freeze(ev.evaluate(sinks.restore(vectors), queries, items=items))
    total = ev.aggregate(per_query, vectors.count())
    sinks.write_evaluation(per_query, total, f"{folder}/eval", text_encoder.model)
    return total


def text_search(gallery: DataFrame, queries: DataFrame, encoder: emb.Encoder, k: int,
                *, batch_size: int = 64) -> DataFrame:
    """Free-text queries (qid, query) to their best ``k`` items.

    Queries are trimmed, blank ones dropped, and embedded once.  Item columns are put
    back with :func:`lumora.operators.search.with_items`.
    """
    clean = emb.clean_query_text(queries)
    vectors = freeze(emb.embed(clean, "query", encoder, batch_size=batch_size)
                     .select(F.col("qid").cast("long").alias("qid"), "query", "v"))
    hits = search.top_k(gallery, vectors, k)
    return hits.join(vectors.select("qid", "query"), "qid")
