"""New images join a gallery while searches are running.

Each micro-batch is embedded, given ids, appended to the gallery and merged into the
running top-k of the active queries.  Queries may change between batches: one that joins late
is answered once from the base and everything published so far, and then merged like
the others.  State is kept by :mod:`lumora.streaming.state` in these tables:

    uploads     the items that arrived
    queries     the active queries, each with the version it joined at
    top         best k per active query
    moments     Gram sums of base and arrivals, if a projection is kept
    axes        the projection fitted after each batch
    tags        labels of the arrivals, if a vocabulary is given
    quarantine  inputs that could not be decoded, if they are set aside

A batch, or a change of queries, becomes visible with its manifest and else leaves nothing.
Replaying a batch that is done changes nothing; replaying one that failed gives the same ids
and the same result.  Arrivals are append-only, so the merged top-k is exact.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumora import schemas
from lumora.fixed_values import UPLOAD_CATEGORY
from lumora.functions.spaces import DifferentSpaces, require_same_space, space_of
from lumora.operators import embed as emb
from lumora.operators import projection
from lumora.operators.search import merge_top_k, top_k
from lumora.operators.tags import zero_shot_tags
from lumora.plans.freeze import freeze, new_dir, remove
from lumora.plans.numbering import number_rows
from lumora.streaming.state import Manifest, StateLog

_BATCH_SPAN = 1 << 32       # positions reserved per batch
_UPLOADS = T.StructType([T.StructField(n, t) for n, t in (
    ("id", T.LongType()), ("pos", T.LongType()), ("src", T.StringType()), ("category", T.StringType()), ("title", T.StringType()),
    ("isUpload", T.BooleanType()), ("v", T.ArrayType(T.FloatType())))])
IMAGE_NAME = r"(?i)\.(apng|avif|bmp|gif|heic|heif|ico|jfif|jpe?g|png|svg|tiff?|webp)$"


def image_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Files landing in a folder, as bytes."""
    reader = spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def is_image(mime: str | None = None) -> Column:
    """By MIME column where there is one, else by file name."""
    if mime:
        return F.coalesce(F.col(mime), F.lit("")).startswith("image/")
    return F.col("path").rlike(IMAGE_NAME)


def count_originals(gallery: DataFrame) -> DataFrame:
    """How many items are not uploads."""
    return gallery.filter(~F.col("isUpload")).agg(F.count(F.lit(1)).alias("originals"))


@dataclass
class Arrivals:
    """``base`` and ``queries`` as in :func:`lumora.operators.search.top_k`.

    Without an ``encoder`` the stream carries its own ``v``.  ``on_bad="fail"`` makes a
    batch all or nothing; ``"quarantine"`` sets undecodable inputs aside.  One process writes a state
    at a time; within it, batches and changes of queries take turns.
    """

    state: str
    base: DataFrame
    queries: DataFrame | None = None
    k: int = 10
    encoder: emb.Encoder | None = None
    batch_size: int = 64
    on_bad: str = "fail"
    labels: DataFrame | None = None
    projection_dim: int | None = None
    _turn: threading.RLock = field(default_factory=threading.RLock, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.base.sparkSession

    @property
    def log(self) -> StateLog:
        return StateLog(self.spark, self.state)

    def prepare(self) -> None:
        """Version 0: the base gallery's own top-k, moments and axes.  Where the state exists already it is taken up:
        ``queries`` are then those that it holds, and what a crashed attempt left is removed."""
        known = space_of(self.base)
        if self.encoder is not None and known and known != self.encoder.space:
            raise DifferentSpaces(f"the gallery is of {known}, arrivals would be of {self.encoder.space}")
        if self.labels is not None:
            self.labels = freeze(self.labels)
        if self.log.current() is not None:
            self.log.sweep()
            return
        first = Manifest(0, -1, 0)
        if self.queries is not None:
            first = self._with_queries(first, self.queries, None)
        if self.projection_dim:
            first = self._with_moments(first, projection.moments(self.base, self.projection_dim), -1)
        # readers find the tables even if nothing ever arrives
        none = self.spark.createDataFrame([], _UPLOADS)
        first = first.extended("uploads", None, _UPLOADS)
        if self.labels is not None:
            first = first.extended("tags", None, zero_shot_tags(none, self.labels).schema)
        self.log.commit(first)

    # ------------------------------------------------------------------ queries

    def _with_queries(self, m: Manifest, add: DataFrame | None, drop: DataFrame | None) -> Manifest:
        """``m`` with queries added (replacing those of the same ``qid``) and dropped, and their top-k."""
        log, kept, top = self.log, None, None
        if add is not None:
            require_same_space(self.base, add)
            add = freeze(add.select(F.col("qid").cast("long").alias("qid"), "v", F.lit(m.version).alias("since")))
        if "queries" in m.runs:
            gone = [x.select(F.col("qid").cast("long").alias("qid")) for x in (add, drop) if x is not None]
            ids = gone[0] if len(gone) == 1 else gone[0].unionByName(gone[1])
            ids = freeze(ids.distinct())
            kept = log.read(m, "queries").join(ids, "qid", "left_anti").select("qid", "v", "since")
            top = log.read(m, "top").join(ids, "qid", "left_anti")
        if add is not None:
            found = top_k(self._gallery(m), add, self.k)
            kept = add if kept is None else kept.unionByName(add)
            top = found if top is None else top.unionByName(found.select(*top.columns))
        for table, rows in (("queries", kept), ("top", top)):
            run, back = log.write(rows, table, max(m.batch, 0))
            m = m.replaced(table, run, back.schema)
        return m

    def change_queries(self, add: DataFrame | None = None, drop: DataFrame | None = None) -> int:
        """Add queries (qid, v) and drop others (qid), also while the stream is running; the version they hold from.

        Added ones are answered over the base and all published arrivals in one pass.  A batch
        that is being processed comes wholly before or wholly after the change."""
        if add is None and drop is None:
            raise ValueError("nothing to change")
        with self._turn:
            m = self.log.current()
            if add is None and "queries" not in m.runs:
                return m.version
            m = self.log.commit(self._with_queries(m.next(), add, drop))
            self.log.sweep()
            return m.version

    # ------------------------------------------------------------------ batches

    def _land(self, batch: DataFrame) -> tuple[DataFrame, str]:
        """The batch with its vectors, computed once, and its folder.  It is read back by the session of
        the base gallery, since a stream's own session plans without adaptive execution."""
        if self.encoder is not None:
            mode = "keep" if self.on_bad == "quarantine" else self.on_bad
            batch = emb.embed(batch.filter(is_image()), "content", self.encoder,
                              batch_size=self.batch_size, on_bad=mode).drop("content")
        batch = batch.withColumn("__row", F.monotonically_increasing_id())
        path = new_dir(self.spark, "landed")
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path), path

    def _numbered(self, landed: DataFrame, rows: int) -> DataFrame:
        """``landed`` with ``n`` from 1 in order of arrival.

        Only (row, time, path) are sorted; the numbers, 16 bytes a row and written, go back to the rows by row
        number, broadcast as long as their size allows."""
        arrival = [F.col("modificationTime").asc(), F.col("path").asc(), F.col("__row").asc()]
        stamps = landed.select("__row", "modificationTime", "path")
        numbers = freeze(number_rows(stamps, arrival, "n", rows=rows).select("__row", "n"))
        return landed.join(numbers, "__row")

    def _with_moments(self, m: Manifest, moments: DataFrame, batch: int) -> Manifest:
        """``m`` with merged moments and the axes fitted from them."""
        run, back = self.log.write(moments, "moments", max(batch, 0))
        m = m.replaced("moments", run, back.schema)
        if back.isEmpty():
            return m
        axes = projection.fit(back, self.projection_dim).to_df(self.spark).withColumn("batch", F.lit(batch).cast("long"))
        run, back = self.log.write(axes, "axes", max(batch, 0), rows=1)
        return m.extended("axes", run, back.schema)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch, published at once by its manifest; one that is done is left alone."""
        with self._turn:
            log, before = self.log, self.log.current()
            if batch_id <= before.batch:
                return
            m = before.next(batch=batch_id)
            good, landed = self._land(batch)
            if self.encoder is not None and self.on_bad == "quarantine":
                good, bad = emb.split_bad(good)
                run, back = log.write(bad.drop("__row"), "quarantine", batch_id)
                m = m.extended("quarantine", run, back.schema)
            count = good.count()
            run, new = log.write(self._numbered(good, count).select(
                (-(F.lit(before.uploads) + F.col("n"))).alias("id"),
                (F.lit(-(batch_id + 1) * _BATCH_SPAN) + F.col("n") - 1).alias("pos"),
                F.col("path").alias("src"), F.lit(UPLOAD_CATEGORY).alias("category"),
                F.element_at(F.split("path", "/"), -1).alias("title"),
                F.lit(True).alias("isUpload"), F.col("v").cast("array<float>").alias("v")), "uploads", batch_id, rows=count)
            m = Manifest(m.version, batch_id, before.uploads + count, m.runs, m.schemas).extended("uploads", run, new.schema)
            if count and "queries" in m.runs:
                top = log.read(m, "top")
                hits = top.drop("rank").unionByName(top_k(new, log.read(m, "queries"), self.k).drop("rank"))
                run, back = log.write(merge_top_k(hits, self.k).select(*top.columns), "top", batch_id)
                m = m.replaced("top", run, back.schema)
            if count and self.projection_dim:
                m = self._with_moments(m, projection.combine_moments(
                    log.read(m, "moments"), projection.moments(new, self.projection_dim)), batch_id)
            if self.labels is not None:
                run, back = log.write(zero_shot_tags(new, self.labels), "tags", batch_id)
                m = m.extended("tags", run, back.schema)
            log.compact(log.commit(m))
            log.sweep()
            remove(self.spark, landed)

    def start(self, stream: DataFrame, **trigger):
        """Run the stream; by default until everything that has landed is processed."""
        if self.encoder is None and "v" in stream.columns:
            require_same_space(self.base, stream)
        return (stream.writeStream.foreachBatch(self.process)
                .option("checkpointLocation", f"{self.state}/checkpoint")
                .trigger(**(trigger or {"availableNow": True})).start())

    # ------------------------------------------------------------------ what readers see

    def last_batch(self) -> int:
        return self.log.current().batch

    def _table(self, name: str) -> DataFrame:
        return self.log.read(self.log.current(), name)

    def uploads(self) -> DataFrame:
        return self._table("uploads")

    def tags(self) -> DataFrame:
        return self._table("tags")

    def quarantine(self) -> DataFrame:
        return self._table("quarantine")

    def active_queries(self) -> DataFrame:
        """(qid, v, since): the queries that are being answered, each with the version it joined at."""
        return self._table("queries")

    def _gallery(self, m: Manifest, batch: int | None = None) -> DataFrame:
        base = self.base
        if "isUpload" not in base.columns:
            base = base.withColumn("isUpload", F.lit(False))
        if "uploads" not in m.schemas:
            return base
        uploads = self.log.read(m, "uploads")
        if batch is not None:
            uploads = uploads.filter(F.col("pos") >= -(batch + 1) * _BATCH_SPAN)
        return uploads.unionByName(base, allowMissingColumns=True)

    def gallery(self, batch: int | None = None) -> DataFrame:
        """Arrivals of all finished batches (up to ``batch``) and the base; ``pos`` puts the newest batch first."""
        return self._gallery(self.log.current(), batch)

    def top(self) -> DataFrame:
        """Best k per active query over everything that has arrived."""
        return self._table("top")

    def moments(self) -> DataFrame:
        return self._table("moments")

    def axes(self, batch: int | None = None) -> projection.Projection:
        """The projection fitted after ``batch`` (the last one that brought vectors, by default); -1 is the base alone."""
        rows = self._table("axes")
        if batch is not None:
            rows = rows.filter(F.col("batch") <= batch)
        r = rows.orderBy(F.desc("batch")).first()
        return projection.Projection(tuple(r["mean"]), tuple(r["pc1"]), tuple(r["pc2"]), r["used"])

    def galaxy(self, queries: DataFrame | None = None, batch: int | None = None) -> DataFrame:
        """The scaled map of gallery and arrivals as of ``batch``, on the axes fitted then; nothing is refitted or rescanned
        for the fit, and points are projected when they are read."""
        return projection.canvas(self.gallery(batch), self.axes(batch), queries)
