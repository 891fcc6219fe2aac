"""Shaping of a result set for display, and item credits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.fixed_values import CREDIT_SERVICE, DIM_BELOW, UPLOAD_CREDIT
from lumora.plans.freeze import freeze


def score_extents(results: DataFrame) -> DataFrame:
    """(qid, low, span) of each result set; a span of zero counts as one."""
    low, high = F.min("score"), F.max("score")
    return (results.groupBy("qid").agg(low.alias("low"), (high - low).alias("span"))
            .withColumn("span", F.when(F.col("span") == 0.0, 1.0).otherwise(F.col("span"))))


def relative_relevance(results: DataFrame, active: bool = True) -> DataFrame:
    """Add ``rel`` (0 to 1 within the result set) and ``dim`` (clearly worse results).

    The extents are one row per query.  They are frozen so that their size is known:
    Catalyst broadcasts them when small and otherwise joins by shuffle.  ``results`` is
    read twice; freeze it first if it is costly to compute.
    """
    extents = freeze(score_extents(results).withColumnRenamed("qid", "__q"))
    joined = results.join(extents, F.col("qid").eqNullSafe(F.col("__q")))
    dim = F.col("score") < F.col("low") + F.col("span") * DIM_BELOW
    return (joined.withColumn("rel", (F.col("score") - F.col("low")) / F.col("span"))
            .withColumn("dim", (dim if active else F.lit(False)))
            .drop("__q", "low", "span"))


def attribution(items: DataFrame, service: str = CREDIT_SERVICE) -> DataFrame:
    """Add ``credit``, ``creditLicenseUrl`` and ``creditSource`` (NULL: no link).

    Uploads carry no author or licence.
    """
    def link(name):
        return F.when(~F.col("isUpload") & (F.length(name) > 0), F.col(name))

    def text(name):
        return F.coalesce(F.col(name), F.lit(""))

    line = F.concat(F.lit("“"), text("title"), F.lit("” by "), text("creator"), F.lit(" · "),
                    text("license"), F.lit(" · "),
                    F.when(F.length(text("source")) > 0, F.lit("source")).otherwise(F.lit("")),
                    F.lit(f" (via {service})"))
    return (items.withColumn("credit", F.when(F.col("isUpload"), F.lit(UPLOAD_CREDIT)).otherwise(line))
            .withColumn("creditLicenseUrl", link("licenseUrl"))
            .withColumn("creditSource", link("source")))
