"""Cut lineage by writing a DataFrame to the cluster's shared folder.

A frozen DataFrame is computed once, survives the loss of any executor, reads
back only the columns a consumer needs, and has a file size that Catalyst knows:
small tables are then broadcast under ``spark.sql.autoBroadcastJoinThreshold``
and large ones are shuffled, without hints.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Unset, a scratch folder, but only for a session whose tasks all run in this process."""
    configured = spark.conf.get(CONF, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CONF} to a folder that every executor can reach")
    spark.conf.set(CONF, tempfile.mkdtemp(prefix="lumora-"))
    return spark.conf.get(CONF)


_made: list[str] = []


def new_dir(spark: SparkSession, label: str) -> str:
    """A folder name of our own below the shared folder."""
    _made.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete one folder made by :func:`new_dir`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _made.remove(folder)


def release(spark: SparkSession) -> int:
    """Delete what this process froze; only when no DataFrame built on it is still needed."""
    n = len(_made)
    for folder in list(_made):
        remove(spark, folder)
    return n


def freeze(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    spark = df.sparkSession
    path = new_dir(spark, "frozen")
    df.write.partitionBy(*partition_by).parquet(path)
    if partition_by:
        return spark.read.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
