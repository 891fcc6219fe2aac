"""One query per operator over the given tables; each reads its tables whole.

``embeddings`` is the gallery (label n stands for the n-th planned category),
``documents`` stand in for hits, items and arriving payloads, ``benchmark`` for free
text queries and ``pages`` for image bytes.  Query vectors and label vectors are the
category prototypes: the unit sum of a category's vectors.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumora import fixed_values as fv
from lumora import schemas
from lumora.functions import bulk, text, vectors
from lumora.operators import curate, embed, evaluate, joins, projection, relevance, search, tags
from lumora.plans.freeze import freeze, new_dir
from lumora.plans import jobs
from lumora.plans.jobs import text_search
from lumora.plans.sums import vector_sums
from lumora.sources import gallery as sources
from lumora.sources import sinks
from lumora.standins import byte_histogram, word_hash
from lumora.streaming.arrivals import Arrivals, count_originals

DIM = 64
LANGS = [("de", "German"), ("en", "English"), ("es", "Spanish"), ("fr", "French"), ("it", "Italian")]
PAD_LEFT, PAD_RIGHT = "\u00a0\t", " \ufeff"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gallery(spark, sf_dir) -> DataFrame:
    names = F.create_map(*[F.lit(x) for i, (c, _) in enumerate(fv.CATEGORY_PLAN) for x in (i, c)])
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("vec_id").alias("pos"), "label",
        names[F.col("label")].alias("category"), F.col("embedding").alias("v"))


def prototypes(items: DataFrame) -> DataFrame:
    """(qid, category, query, v): one query per category, frozen (at most one per label)."""
    prompts = F.create_map(*[F.lit(x) for pair in fv.EVALUATION_PROMPTS for x in pair])
    names = F.create_map(*[F.lit(x) for i, (c, _) in enumerate(fv.CATEGORY_PLAN) for x in (i, c)])
    sums = vector_sums(items, "label", "v", "int")
    return freeze(sums.select(
        F.col("label").cast("long").alias("qid"), names[F.col("label")].alias("category"),
        prompts[names[F.col("label")]].alias("query"), vectors.l2_normalize("total").alias("v")))


def centre_query(items: DataFrame) -> list[float]:
    """The unit mean direction of the whole gallery, as a single query vector."""
    row = vector_sums(items.select(F.lit(0).alias("k"), "v"), "k", "v", "int").select(
        vectors.l2_normalize("total").alias("v")).first()
    return row["v"]


def digest(v="v"):
    """A number that depends on every component and its place."""
    v = F.col(v) if isinstance(v, str) else v
    weighted = F.transform(v, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 6)


def document_vectors(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return embed.embed(docs, "text", word_hash(DIM), partitions=spark.sparkContext.defaultParallelism)


# ------------------------------------------------------------------ vectors

def vector_profile(spark, sf_dir):
    return embed.profile(gallery(spark, sf_dir)).select(
        "count", F.col("dim_min").cast("long").alias("dim_min"),
        F.col("dim_max").cast("long").alias("dim_max"),
        F.round("norm_min", 6).alias("norm_min"), F.round("norm_max", 6).alias("norm_max"))


def l2_normalize(spark, sf_dir):
    g = gallery(spark, sf_dir).withColumn("v", F.transform("v", lambda x: x.cast("double") * 3.0))
    return g.select("id", bulk.l2_normalize("v").alias("v")).select(
        "id", digest().alias("digest"), F.round(vectors.l2_norm("v"), 6).alias("norm"))


def quantize_5dp(spark, sf_dir):
    g = gallery(spark, sf_dir).select("id", bulk.quantize("v").alias("v"))
    return g.select("id", digest().alias("digest"), F.array_min("v").alias("low"),
                    F.array_max("v").alias("high"))


def narrow_float32(spark, sf_dir):
    g = gallery(spark, sf_dir).withColumn("v", F.transform("v", lambda x: x.cast("double") / 3.0))
    return g.select("id", vectors.to_float32("v").alias("v")).select(
        "id", digest().alias("digest"), F.array_max("v").cast("double").alias("high"))


def pair_cosine(spark, sf_dir):
    """Cosine of each vector with the first half of itself and with a missing vector."""
    g = gallery(spark, sf_dir)
    half, none = F.slice("v", 1, DIM // 2), F.lit(None).cast("array<float>")
    return g.select("id", F.round(vectors.cosine("v", "v"), 6).alias("own"),
                    F.round(vectors.cosine("v", half), 6).alias("half"),
                    vectors.cosine("v", none).alias("missing"))


# ------------------------------------------------------------------ text

def clean_query_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    bench = table(spark, sf_dir, "benchmark").select(F.lit("b").alias("kind"), F.col("item_id").alias("id"), "text")
    padded = docs.unionByName(bench).withColumn(
        "query", F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT)))
    return embed.clean_query_text(padded).select(
        "kind", "id", F.md5(F.col("query")).alias("md5"), F.length("query").cast("long").alias("n"))


def label_prompts(spark, sf_dir):
    labels = table(spark, sf_dir, "documents").select(F.col("source").alias("label")).distinct()
    return labels.select("label", text.prompt("label").alias("prompt"))


# ------------------------------------------------------------------ joins

def join_items_vectors(spark, sf_dir):
    g = gallery(spark, sf_dir).select("id", "pos", "v")
    later = g.select("id", (F.col("pos") + 1_000_000).alias("pos"),
                     F.transform("v", lambda x: -x).alias("v"))
    items = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return joins.join_items_vectors(items, g.unionByName(later)).select(
        "id", "lang", F.size("v").cast("long").alias("dim"), digest().alias("digest"))


def relevance_join(spark, sf_dir):
    items = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("pos"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("category"))
    return joins.relevance(gallery(spark, sf_dir).select("id", "pos", "v"), items, "good").select(
        "id", "category", F.col("rel").cast("long").alias("rel"))


def last_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return joins.last_wins(events, "user_id", "event_id", ["event_type", "value"])


def item_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("pos"), "lang", "n_chars")
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return search.lookup_many(docs, wanted).select("id", "lang", "n_chars")


def category_colours(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"))
    both = gallery(spark, sf_dir).select("id", "category").unionByName(docs)
    return both.select("id", "category", joins.category_colour("category").alias("colour"))


def dimension_lookup(spark, sf_dir):
    dim = spark.createDataFrame(LANGS[:3], "lang string, language string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.with_attribute(docs, dim, "lang", "language", "other").select("doc_id", "language")


# ------------------------------------------------------------------ search

def score_gallery(spark, sf_dir):
    g = gallery(spark, sf_dir)
    return search.score_one(g, centre_query(g)).select("id", F.round("score", 6).alias("score"))


def search_ranked(spark, sf_dir):
    g = gallery(spark, sf_dir)
    return search.rank_numbered(g, centre_query(g)).select(
        "id", "category", F.round("score", 6).alias("score"), "rank")


def search_topk(spark, sf_dir, k=10):
    g = gallery(spark, sf_dir)
    q = spark.createDataFrame([(0, centre_query(g))], "qid long, v array<double>")
    return search.top_k(g, q, k).select("id", F.round("score", 6).alias("score"), "rank")


def batch_topk(spark, sf_dir, k=10):
    g = gallery(spark, sf_dir)
    return search.top_k(g, prototypes(g), k).select(
        "qid", "id", F.round("score", 6).alias("score"), "rank")


def batch_topk_blocks(spark, sf_dir, k=10):
    """Every fifth item as a query, in blocks streamed past the gallery."""
    g = gallery(spark, sf_dir)
    asked = g.filter(F.col("id") % 5 == 0).select(F.col("id").alias("qid"), "v", F.col("id").alias("self"))
    return search.top_k(g, asked, k, exclude="self", max_packed=2, block_rows=64).select(
        "qid", "id", F.round("score", 6).alias("score"), "rank")


def relevance_blocks(spark, sf_dir):
    """Complete shaded result sets where no more than two queries may be packed."""
    g = gallery(spark, sf_dir)
    return relevance.relative_relevance(search.score_pairs(g, prototypes(g), max_packed=2, block_rows=2)).select(
        "qid", "id", F.round("score", 6).alias("score"), F.round("rel", 6).alias("rel"), "dim")


def find_similar(spark, sf_dir, k=5):
    """Neighbours of the first item of every category."""
    g = gallery(spark, sf_dir)
    covers = g.groupBy("category").agg(F.min("id").alias("id")).select("id")
    return search.find_similar(g, covers, k).select(
        "qid", "id", F.round("score", 6).alias("score"), "rank")


def search_text(spark, sf_dir, k=5):
    g = document_vectors(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("pos"), bulk.quantize("v").alias("v"))
    queries = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT)).alias("query"))
    # nine decimals: with five-decimal vectors many scores end exactly in a seventh digit 5
    return text_search(g, queries, word_hash(DIM), k).select(
        "qid", "id", F.round("score", 9).alias("score"), "rank")


def browse(spark, sf_dir):
    return search.browse(gallery(spark, sf_dir)).select("id", "category", "score")


def relative_relevance(spark, sf_dir):
    g = gallery(spark, sf_dir)
    results = search.score_pairs(g, prototypes(g))
    return relevance.relative_relevance(results).select(
        "qid", "id", F.round("score", 6).alias("score"), F.round("rel", 6).alias("rel"), "dim")


# ------------------------------------------------------------------ tags and map

def _vocabulary(g):
    return prototypes(g).select(F.col("qid").alias("label_pos"), F.col("category").alias("label"), "v")


def zero_shot_tags(spark, sf_dir):
    g = gallery(spark, sf_dir)
    return tags.zero_shot_tags(g, _vocabulary(g)).select(
        "id", "label", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def mean_vector(spark, sf_dir):
    return projection.mean_vector(gallery(spark, sf_dir)).select("dim", F.round("mean", 9).alias("mean"))


def covariance_matrix(spark, sf_dir):
    m = freeze(projection.moments(gallery(spark, sf_dir), DIM))
    return projection.covariance(m, DIM).select("i", "j", F.round("value", 6).alias("value"))


def _axes(spark, sf_dir, mode):
    return _axes_rows(spark, projection.fit(projection.moments(gallery(spark, sf_dir), DIM), DIM, mode))


def _axes_rows(spark, p):
    return p.to_df(spark).select(F.posexplode(F.arrays_zip("mean", "pc1", "pc2"))).select(
        F.col("pos").cast("long").alias("dim"), F.round("col.mean", 6).alias("mean"),
        F.round("col.pc1", 6).alias("pc1"), F.round("col.pc2", 6).alias("pc2"))


def pca_axes(spark, sf_dir):
    return _axes(spark, sf_dir, "seeded")


def pca_axes_exact(spark, sf_dir):
    return _axes(spark, sf_dir, "exact")


def pca_axes_matrix_free(spark, sf_dir):
    return _axes_rows(spark, projection.fit_matrix_free(gallery(spark, sf_dir), DIM))


def project_axes(spark, sf_dir):
    """The gallery on two prototype axes about its mean."""
    g = gallery(spark, sf_dir)
    axes = {r["qid"]: r["v"] for r in prototypes(g).filter(F.col("qid") < 2).select("qid", "v").collect()}
    mean = [r["mean"] for r in projection.mean_vector(g).orderBy("dim").collect()]
    p = projection.Projection(tuple(mean), tuple(axes[0]), tuple(axes[1]), 0)
    return projection.project(g, p).select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def galaxy_map(spark, sf_dir):
    g = gallery(spark, sf_dir)
    return projection.galaxy(g, DIM, prototypes(g).select("qid", "v")).select(
        "id", "isQuery", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def category_legend(spark, sf_dir):
    return projection.legend(gallery(spark, sf_dir))


# ------------------------------------------------------------------ evaluation

def _evaluation(spark, sf_dir):
    g = gallery(spark, sf_dir)
    return evaluate.evaluate(g, prototypes(g))


def _flat(per_query):
    return per_query.select(
        "qid", "query", "category", "nRelevant", *[F.round(F.col("pAt")[str(k)], 6).alias(f"p{k}")
                                                   for k in fv.PRECISION_CUTOFFS],
        "rr", "ap", F.round("rr_exact", 6).alias("rr_exact"), F.round("ap_exact", 6).alias("ap_exact"),
        F.array_join(F.col("topIds").cast("array<string>"), ",").alias("top_ids"))


def eval_per_query(spark, sf_dir):
    return _flat(_evaluation(spark, sf_dir))


def _aggregate(spark, sf_dir):
    return evaluate.aggregate(_evaluation(spark, sf_dir), gallery(spark, sf_dir).count())


def eval_aggregate(spark, sf_dir):
    return _aggregate(spark, sf_dir).select(
        "queries", "gallerySize", "mAP", "mrr",
        *[F.col("pAt")[str(k)].alias(f"p{k}") for k in fv.PRECISION_CUTOFFS],
        F.round("mAP_exact", 6).alias("mAP_exact"), F.round("mrr_exact", 6).alias("mrr_exact"))


def eval_report(spark, sf_dir):
    return evaluate.report(_aggregate(spark, sf_dir))


# ------------------------------------------------------------------ curation

def candidates(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    src, key = F.col("source"), F.col("doc_id").cast("string")
    licence = F.when(src == "src5", F.lit(None)).when(F.col("n_chars") < 500, "by-nc").when(
        F.col("n_chars") < 2000, "by-sa").otherwise("by")
    hits = docs.join(toxic, "doc_id", "left").select(
        "doc_id", F.col("doc_id").alias("pos"), F.col("lang").alias("category"),
        F.when(F.col("lang") == "en", "").when(src == "src1", F.lit(None)).otherwise(
            F.concat(F.lit("thumb/"), key)).alias("thumbnail"),
        F.when(src != "src2", F.concat(F.lit("https://"), src, F.lit("/"), key)).alias("url"),
        F.when(src == "src3", "  ").otherwise(F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT))).alias("title"),
        F.when(src != "src4", F.concat(F.lit(" "), src, F.lit("\ufeff"))).alias("creator"),
        licence.alias("license"), F.when(src != "src5", "2.0").alias("license_version"),
        F.when(src != "src6", F.concat(F.lit("https://licence/"), key)).alias("license_url"),
        F.when(src != "src7", F.concat(F.lit("https://landing/"), key)).alias("foreign_landing_url"),
        F.when(src != "src8", src).alias("provider"),
        (F.col("toxic") == 1).alias("mature"), (src != "src9").alias("status_ok"),
        F.when(src == "src10", "text/html").when(src == "src11", "Image/JPG; q=1").otherwise("image/jpeg").alias("mime"),
        F.col("n_chars").alias("length"))
    return hits


def language_plan(spark) -> DataFrame:
    return sources.category_plan(spark, LANGS)


def clean_metadata(spark, sf_dir):
    return curate.clean_metadata(candidates(spark, sf_dir)).select(
        "doc_id", "title", "creator", "license", "licenseUrl", "source", "provider")


def eligible_hits(spark, sf_dir):
    return curate.eligible(candidates(spark, sf_dir), fv.HITS_PER_CATEGORY).select("doc_id", "category", "pos")


def valid_hits(spark, sf_dir):
    usable = curate.with_source_url(candidates(spark, sf_dir))
    return usable.filter(curate.valid_payload()).select("doc_id", "src")


def curate_items(spark, sf_dir):
    return curate.curate(candidates(spark, sf_dir), language_plan(spark), hits=fv.HITS_PER_CATEGORY)


def curate_all_hits(spark, sf_dir):
    """Items from all landed hits, not from one result page of each category."""
    return curate.curate(candidates(spark, sf_dir), language_plan(spark))


def curation_fill_report(spark, sf_dir):
    plan = language_plan(spark)
    return curate.fill_report(curate.keep(candidates(spark, sf_dir), plan, hits=fv.HITS_PER_CATEGORY), plan)


def attribution_lines(spark, sf_dir):
    items = curate.clean_metadata(candidates(spark, sf_dir)).withColumn(
        "isUpload", F.col("category") == "fr")
    return relevance.attribution(items).select(
        "doc_id", F.md5(F.col("credit")).alias("credit_md5"), "creditLicenseUrl", "creditSource")


# ------------------------------------------------------------------ embedding

def embed_texts(spark, sf_dir):
    return document_vectors(spark, sf_dir).select(
        "doc_id", F.size("v").cast("long").alias("dim"), digest().alias("digest"))


def embed_images(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return embed.embed(pages, "content", byte_histogram(DIM), partitions=spark.sparkContext.defaultParallelism).select(
        "page_id", F.size("v").cast("long").alias("dim"), digest().alias("digest"))


def embedding_header(spark, sf_dir):
    return embed.header(document_vectors(spark, sf_dir), word_hash(DIM))


# ------------------------------------------------------------------ arrivals

def _stamp(docs):
    return docs.select(F.lit(None).cast("timestamp").alias("modificationTime"),
                       F.format_string("docs/%012d", "doc_id").alias("path"), "v")


def _arrive(spark, sf_dir, files=None, **options):
    """Stream ``documents`` into the gallery: as they are, or landed as several files."""
    g = gallery(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    if files:
        folder = new_dir(spark, "landing")
        docs.repartition(files, "doc_id").write.parquet(folder)
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    else:
        # a stream takes one file by a pattern only; this one matches a folder of part files as well
        stream = spark.readStream.schema(docs.schema).parquet(f"{sf_dir}/[d]ocuments.parquet")
    run = Arrivals(new_dir(spark, "arrivals"), g.drop("label"), **options)
    run.prepare()
    query = run.start(_stamp(embed.embed(stream, "text", word_hash(DIM), partitions=spark.sparkContext.defaultParallelism)))
    query.awaitTermination()
    return run


def arrivals_topk(spark, sf_dir, k=10):
    """Best items after all arrivals, each known by its title or, in the base, by its id."""
    queries = prototypes(gallery(spark, sf_dir))
    run = _arrive(spark, sf_dir, files=1, queries=queries, k=k)
    hits = run.top().select("qid", "id", "pos", "rank", "score")
    return search.with_items(hits, run.gallery()).select(
        "qid", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"),
        F.coalesce("title", F.col("id").cast("string")).alias("item"))


def arrivals_batches(spark, sf_dir, k=10):
    """The same in several micro-batches: the ranking of scores doesn't depend on them."""
    queries = prototypes(gallery(spark, sf_dir))
    run = _arrive(spark, sf_dir, files=4, queries=queries, k=k)
    return run.top().select("qid", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def _arrive_images(spark, sf_dir):
    """Pages arrive as files: every third is no image by its name, every seventh is empty."""
    page, folder = F.col("page_id"), new_dir(spark, "landing")
    table(spark, sf_dir, "pages").select(
        F.format_string("in/%012d", page).alias("stem"), page).select(
        F.concat("stem", F.when(page % 3 == 0, ".txt").otherwise(".JPG")).alias("path"),
        F.timestamp_seconds(F.lit(1_700_000_000) - page).alias("modificationTime"),
        F.when(page % 7 == 0, "").otherwise(F.concat(F.lit("p"), page.cast("string"))).cast("binary").alias("head"), page,
    ).join(table(spark, sf_dir, "pages"), "page_id").select(
        "path", "modificationTime", F.when(F.length("head") > 0, F.encode("html", "UTF-8")).otherwise(F.col("head")).alias("content"),
    ).write.parquet(folder)
    stream = spark.readStream.schema("path string, modificationTime timestamp, content binary").parquet(folder)
    run = Arrivals(new_dir(spark, "arrivals"), gallery(spark, sf_dir).drop("label"), encoder=byte_histogram(DIM),
                   on_bad="quarantine")
    run.prepare()
    run.start(stream).awaitTermination()
    return run


def arrivals_images(spark, sf_dir):
    """Only images join, oldest first, and what can't be decoded is left out."""
    return _arrive_images(spark, sf_dir).uploads().select("id", "title", digest().alias("digest"))


def arrivals_quarantine(spark, sf_dir):
    return _arrive_images(spark, sf_dir).quarantine().select("path")


def arrivals_gallery(spark, sf_dir):
    run = _arrive(spark, sf_dir)
    return run.gallery().select("id", "pos", "category", "isUpload",
                                F.coalesce("title", F.lit("")).alias("title"), digest().alias("digest"))


def arrivals_tags(spark, sf_dir):
    run = _arrive(spark, sf_dir, labels=_vocabulary(gallery(spark, sf_dir)))
    return run.tags().select("id", "label", F.round("score", 6).alias("score"),
                             F.col("rank").cast("long").alias("rank"))


def arrivals_mean(spark, sf_dir):
    """Mean of gallery and arrivals from merged moments, without a rescan."""
    m = _arrive(spark, sf_dir, files=3, projection_dim=DIM).moments().filter(F.col("i") == DIM)
    return m.select("n", F.posexplode("total").alias("dim", "t")).select(
        F.col("dim").cast("long").alias("dim"), F.round(F.col("t") / F.col("n"), 6).alias("mean"))


def _arrive_twice(spark, sf_dir, between=None, **options):
    """Documents with even ids arrive in one batch and odd ones in the next; ``between`` is done between the two."""
    docs, folder = table(spark, sf_dir, "documents"), new_dir(spark, "landing")
    run = Arrivals(new_dir(spark, "arrivals"), gallery(spark, sf_dir).drop("label"), **options)
    run.prepare()
    for half in (0, 1):
        docs.filter(F.col("doc_id") % 2 == half).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(docs.schema).parquet(folder)
        embedded = embed.embed(stream, "text", word_hash(DIM), partitions=spark.sparkContext.defaultParallelism)
        run.start(_stamp(embedded)).awaitTermination()
        if half == 0 and between:
            between(run)
    return run


def arrivals_query_change(spark, sf_dir, k=10):
    """Between two batches, searches 0 and 1 end, 5 and up begin, and 3 becomes a search for the first item of category 3."""
    g = gallery(spark, sf_dir)
    p = prototypes(g).select("qid", "v")
    first = search.lookup_many(g.withColumn("id", F.col("label").cast("long")), spark.createDataFrame([(3,)], "id long"))

    def change(run):
        run.change_queries(add=p.filter("qid >= 5").unionByName(
            first.select(F.lit(3).cast("long").alias("qid"), F.col("v").cast("array<double>").alias("v"))), drop=p.filter("qid < 2"))

    run = _arrive_twice(spark, sf_dir, change, queries=p.filter("qid < 5"), k=k)
    hits = run.top().select("qid", "id", "pos", "rank", "score")
    return search.with_items(hits, run.gallery()).join(run.active_queries().select("qid", "since"), "qid").select(
        "qid", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"),
        F.coalesce("title", F.col("id").cast("string")).alias("item"), (F.col("since") > 0).alias("late"))


def arrivals_galaxy(spark, sf_dir):
    """The map of gallery and arrivals on axes refitted from merged moments."""
    run = _arrive_twice(spark, sf_dir, projection_dim=DIM)
    return run.galaxy(prototypes(gallery(spark, sf_dir)).select("qid", "v")).select(
        "id", "isQuery", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def arrivals_failing(spark, sf_dir):
    """Pages with even ids arrive; the batch of the odd ones holds some that can't be decoded, and fails as a whole."""
    pages, folder = table(spark, sf_dir, "pages"), new_dir(spark, "landing")
    page = F.col("page_id")
    run = Arrivals(new_dir(spark, "arrivals"), gallery(spark, sf_dir).drop("label"), encoder=byte_histogram(DIM))
    run.prepare()
    failed = []
    for half in (0, 1):
        content = F.when((page % 7 == 0) & (page % 2 == 1), F.lit("")).otherwise(F.col("html"))
        pages.filter(page % 2 == half).select(
            F.format_string("in/%012d.png", page).alias("path"), F.timestamp_seconds(F.lit(1_700_000_000) + page).alias("modificationTime"),
            F.encode(content, "UTF-8").alias("content")).write.mode("append").parquet(folder)
        query = run.start(spark.readStream.schema("path string, modificationTime timestamp, content binary").parquet(folder))
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failed.append("undecodable input" in str(error))
    return run.uploads().select("id", "title", digest().alias("digest"), F.lit(failed == [True]).alias("failed"))


def originals_count(spark, sf_dir):
    run = _arrive(spark, sf_dir)
    return count_originals(run.gallery())


# ------------------------------------------------------------------ sinks and sources

def manifest_roundtrip(spark, sf_dir):
    path = new_dir(spark, "manifest")
    items = curate.clean_metadata(candidates(spark, sf_dir)).withColumns(
        {"id": F.col("doc_id"), "file": F.format_string(fv.FILE_NAME_FORMAT, "doc_id")})
    sinks.write_manifest(items, path)
    rows, head = sources.read_table(spark, path)
    return rows.withColumn("count", head.select("count").scalar()).select(
        "pos", "id", "file", "category", "title", "creator", "license", "licenseUrl", "source",
        "provider", "count")


def embeddings_roundtrip(spark, sf_dir):
    path = new_dir(spark, "embeddings")
    g = gallery(spark, sf_dir)
    sinks.write_embeddings(g, embed.header(g, word_hash(DIM)), path)
    rows, head = sources.read_table(spark, path)
    return sinks.restore(rows).withColumn("h", head.select(F.struct("*")).scalar()).select(
        "id", "pos", digest().alias("digest"), "h.dim", "h.normalized", "h.count")


def evaluation_roundtrip(spark, sf_dir):
    path = new_dir(spark, "eval")
    per_query = freeze(_evaluation(spark, sf_dir))
    total = evaluate.aggregate(per_query, gallery(spark, sf_dir).count())
    sinks.write_evaluation(per_query, total, path, "prototypes")
    rows, head = sources.read_table(spark, path)
    return rows.withColumn("h", head.select(F.struct("*")).scalar()).select(
        "qid", "query", "category", "nRelevant", "rr", "ap",
        F.array_join(F.col("topIds").cast("array<string>"), ",").alias("top_ids"),
        "h.model", "h.queries", "h.gallerySize", F.col("h.mAP").alias("mean_ap"))


# ------------------------------------------------------------------ jobs and envelopes

def curation_job(spark, sf_dir):
    out = new_dir(spark, "job")
    jobs.curation_job(candidates(spark, sf_dir), language_plan(spark), out, hits=fv.HITS_PER_CATEGORY)
    rows, head = sources.read_table(spark, f"{out}/manifest")
    return rows.withColumn("count", head.select("count").scalar()).select(
        "pos", "id", "file", "category", "title", "source", "count")


def embedding_job(spark, sf_dir):
    """Pages as files, one each, and a manifest that names them."""
    folder, images = new_dir(spark, "job"), new_dir(spark, "images")
    files = sinks.write_files(table(spark, sf_dir, "pages").select(F.col("page_id").alias("name"), F.col("html").alias("text")), images)
    page = F.regexp_extract("file", "name=([0-9]+)", 1).cast("long")
    blank = {f: F.lit("") for f in ("category", "title", "creator", "license", "licenseUrl", "source", "provider")}
    sinks.write_manifest(files.withColumns({"id": page, "pos": page, **blank}), f"{folder}/manifest")
    head = jobs.embedding_job(spark, folder, images, byte_histogram(DIM))
    rows, _ = sources.read_table(spark, f"{folder}/embeddings")
    return sinks.restore(rows).withColumn("h", head.select(F.struct("*")).scalar()).select(
        "id", digest().alias("digest"), "h.model", "h.dim", "h.normalized", "h.count")


def evaluation_job(spark, sf_dir):
    """Documents as a gallery, their languages as categories, benchmark texts as prompts."""
    folder = new_dir(spark, "job")
    docs = freeze(document_vectors(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("pos"), F.col("lang").alias("category"), "v"))
    blank = {f: F.lit("") for f in ("file", "title", "creator", "license", "licenseUrl", "source", "provider")}
    sinks.write_manifest(docs.drop("v").withColumns(blank), f"{folder}/manifest")
    sinks.write_embeddings(docs, embed.header(docs, word_hash(DIM)), f"{folder}/embeddings")
    langs = F.array(*[F.lit(c) for c, _ in LANGS])
    prompts = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query"),
        F.get(langs, (F.col("item_id") % len(LANGS)).cast("int")).alias("category"))
    jobs.evaluation_job(spark, folder, prompts, word_hash(DIM))
    rows, head = sources.read_table(spark, f"{folder}/eval")
    return rows.withColumn("h", head.select(F.struct("*")).scalar()).select(
        "qid", "category", "nRelevant", *[F.round(F.col("pAt")[str(k)], 6).alias(f"p{k}") for k in fv.PRECISION_CUTOFFS],
        "rr", "ap", F.array_join(F.col("topIds").cast("array<string>"), ",").alias("top_ids"),
        "h.model", "h.queries", "h.gallerySize", F.col("h.mAP").alias("mean_ap"), "h.mrr",
        *[F.col("h.pAt")[str(k)].alias(f"mp{k}") for k in fv.PRECISION_CUTOFFS])


def gallery_load(spark, sf_dir, rows=200):
    """The three JSON envelopes of a gallery, in parts of bounded size, written from the tables and loaded together."""
    folder, g = new_dir(spark, "gallery"), gallery(spark, sf_dir)
    blank = {f: F.lit("") for f in ("creator", "license", "licenseUrl", "source", "provider")}
    item = F.struct(F.col("id").cast("long").alias("id"), F.format_string(fv.FILE_NAME_FORMAT, "id").alias("file"), "category",
                    F.concat(F.lit("no. "), F.col("id").cast("string")).alias("title"), *[c.alias(n) for n, c in blank.items()])

    def envelope(parts, name, array, **head):
        one = parts.groupBy("part").agg(F.count(F.lit(1)).alias("count"), F.transform(
            F.array_sort(F.collect_list(F.struct("at", "row"))), lambda r: r["row"]).alias(array))
        (one.withColumns({k: F.lit(v) for k, v in head.items()}).repartitionByRange(4, "part").sortWithinPartitions("part")
         .drop("part").write.json(f"{folder}/{name}.json"))

    part = F.floor(F.col("id") / rows).alias("part")
    envelope(g.select(part, F.col("id").alias("at"), item.alias("row")), "manifest", "items", builtAt="2024-01-01T00:00:00Z")
    envelope(g.select(part, F.col("id").alias("at"), F.struct("id", bulk.quantize("v").alias("v")).alias("row")), "embeddings",
             "embeddings", model="given", dtype="float32", dim=DIM, normalized=True)
    per_query = freeze(_evaluation(spark, sf_dir))
    fields = ["query", "category", "nRelevant", "pAt", "rr", "ap", "topIds"]
    total = evaluate.aggregate(per_query, g.count()).select("queries", "gallerySize", "mAP", "mrr", "pAt")
    lines = per_query.groupBy(F.floor(F.col("qid") / rows).alias("part")).agg(F.transform(F.array_sort(F.collect_list(
        F.struct("qid", F.to_json(F.struct(*fields)).alias("q")))), lambda r: r["q"]).alias("rows"))
    (lines.select("part", F.lit("given").alias("model"), F.lit("2024-01-01T00:00:00Z").alias("evaluatedAt"), F.from_json(
        F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")), schemas.EVALUATION["perQuery"].dataType).alias("perQuery"))
     .withColumn("aggregate", total.select(F.struct("*")).scalar()).orderBy("part").drop("part").write.json(f"{folder}/eval.json"))
    loaded = sources.load_gallery(spark, folder, base="img/")
    return (loaded.items.withColumn("h", loaded.header.select(F.struct("*")).scalar())
            .withColumn("a", loaded.aggregate.select(F.struct("*")).scalar())
            .withColumn("evaluated", loaded.evaluation.agg(F.count(F.lit(1))).scalar()).select(
                "id", "pos", "category", "title", "src", "isUpload", digest().alias("digest"), "h.dim", "h.count",
                F.col("a.mAP").alias("mean_ap"), "evaluated"))


def landed_hits(spark, sf_dir, page=50):
    """Search results as landed, one document per page of hits, read back in hit order."""
    folder = new_dir(spark, "hits")
    hits = candidates(spark, sf_dir)
    result = F.struct("pos", *[F.col(f.name) for f in schemas.CANDIDATE.fields[2:]])
    (hits.groupBy("category", F.floor(F.col("doc_id") / page).alias("page"))
     .agg(F.sort_array(F.collect_list(result)).alias("results")).write.json(folder))
    return sources.read_candidates(spark, folder).select(
        "category", "pos", F.coalesce("url", F.lit("")).alias("url"), F.md5("title").alias("title_md5"), "mature", "length")


def mean_vector_with_gaps(spark, sf_dir):
    """The mean leaves out items without vector, as a join of items and vectors makes them."""
    items = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    joined = joins.join_items_vectors(items, gallery(spark, sf_dir).select("id", "pos", "v"))
    return projection.mean_vector(joined, DIM).select("dim", F.round("mean", 6).alias("mean"))


QUERIES = {f.__name__: f for f in [
    vector_profile, l2_normalize, quantize_5dp, narrow_float32, pair_cosine,
    clean_query_text, label_prompts,
    join_items_vectors, relevance_join, last_wins, item_lookup, category_colours, dimension_lookup,
    score_gallery, search_ranked, search_topk, batch_topk, batch_topk_blocks, relevance_blocks, find_similar, search_text, browse,
    relative_relevance, attribution_lines,
    zero_shot_tags, mean_vector, covariance_matrix, pca_axes, pca_axes_exact, pca_axes_matrix_free, project_axes,
    galaxy_map, category_legend,
    eval_per_query, eval_aggregate, eval_report,
    clean_metadata, eligible_hits, valid_hits, curate_items, curate_all_hits, curation_fill_report,
    embed_texts, embed_images, embedding_header,
    arrivals_topk, arrivals_batches, arrivals_images, arrivals_quarantine, arrivals_gallery, arrivals_tags, arrivals_mean, originals_count,
    arrivals_query_change, arrivals_galaxy, arrivals_failing,
    manifest_roundtrip, embeddings_roundtrip, evaluation_roundtrip,
    curation_job, embedding_job, evaluation_job, gallery_load, landed_hits, mean_vector_with_gaps,
]}
