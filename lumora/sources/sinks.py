"""Writers: a row table and a one-row header table under one folder.

A single JSON envelope would have to pass through one task; rows and header apart do
not.  Each write replaces what was there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora import schemas
from lumora.fixed_values import STORED_DECIMALS
from lumora.functions.bulk import quantize
from lumora.plans.blocks import open_store, reachable
from lumora.plans.freeze import freeze


def _write(rows: DataFrame, header: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    header.write.mode("overwrite").parquet(f"{path}/header")


FOLDERS = 256           # that files are dealt to by a hash of their name


def write_files(lines: DataFrame, root: str) -> DataFrame:
    """(file): text files below ``root``, one for each ``name`` (a plain one, as an id), with a line for every row (name, text).

    Tasks write the files themselves and say which, so that neither a committer nor a listing goes through
    them one by one; a task that runs again writes the same files again.  Where Python tasks can't
    reach the folder, Spark writes one folder a name, and they are listed."""
    rows = lines.select(F.col("name").cast("string").alias("name"), "text")
    if not reachable(root):
        from lumora.sources.gallery import read_images

        rows.repartition("name").write.partitionBy("name").text(root)
        return read_images(lines.sparkSession, root).select("file").filter("file LIKE '%.txt'")

    def run(batches):
        import pyarrow as pa

        store, base = open_store(root)
        made, last, out = set(), None, None
        for batch in batches:
            done = []
            for name, folder, text in zip(*(c.to_pylist() for c in batch.columns)):
                if name != last or out is None:
                    if out is not None:
                        out.close()
                    if folder not in made:
                        store.create_dir(f"{base}/{folder}", recursive=True)
                        made.add(folder)
                    last, file = name, f"{folder}/name={name}.txt"
                    out = store.open_output_stream(f"{base}/{file}")
                    done.append(file)
                out.write((text or "").encode() + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["file"])
        if out is not None:
            out.close()

    folder = F.format_string("%03d", F.pmod(F.xxhash64("name"), F.lit(FOLDERS)))
    return freeze(rows.select("name", folder.alias("folder"), "text").repartition("name").sortWithinPartitions("name")
                  .mapInArrow(run, "file string"))


def _iso_now():
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def write_manifest(items: DataFrame, path: str) -> None:
    """Items with their ``pos``; the header counts the rows as written."""
    columns = ["pos", *[f.name for f in schemas.ITEM]]
    if "pos" not in items.columns:
        items = items.withColumn("pos", F.col("id"))
    items.select(*columns).write.mode("overwrite").parquet(f"{path}/rows")
    written = items.sparkSession.read.parquet(f"{path}/rows")
    head = written.agg(F.count(F.lit(1)).alias("count")).select(_iso_now().alias("builtAt"), "count")
    head.write.mode("overwrite").parquet(f"{path}/header")


def write_embeddings(vectors: DataFrame, header: DataFrame, path: str,
                     decimals: int | None = STORED_DECIMALS) -> None:
    """Vectors rounded to ``decimals`` and stored as float32, and their header.

    float32 holds a five-decimal component of a unit vector without loss:
    :func:`restore` gives back the rounded doubles.
    """
    v = quantize("v", decimals) if decimals is not None else F.col("v")
    _write(vectors.select("id", "pos", v.cast("array<float>").alias("v")), header, path)


def restore(vectors: DataFrame, decimals: int = STORED_DECIMALS) -> DataFrame:
    """The decimal components behind stored float32 vectors, as doubles."""
    return vectors.withColumn("v", quantize("v", decimals))


def write_evaluation(per_query: DataFrame, aggregate: DataFrame, path: str, model: str) -> None:
    rows = per_query.select("qid", *[f.name for f in schemas.PER_QUERY])
    head = aggregate.select(F.lit(model).alias("model"), _iso_now().alias("evaluatedAt"),
                            *[f.name for f in schemas.AGGREGATE])
    _write(rows, head, path)
