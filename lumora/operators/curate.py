"""Item curation from landed search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumora.fixed_values import (FILE_NAME_FORMAT, ITEMS_PER_CATEGORY, MIN_PAYLOAD_BYTES,
                                 PAYLOAD_MIME_PATTERN, TITLE_LENGTH,
                                 UNKNOWN_CREATOR, UNTITLED)
from lumora.functions.text import first_filled, trim_blank
from lumora.plans.freeze import freeze
from lumora.plans.numbering import number_rows


def hit_order(candidates: DataFrame) -> list[Column]:
    """Position, then what tells hits of several landed pages with one position apart."""
    known = ("pos", "url", "thumbnail", "foreign_landing_url", "title", "creator")
    return [F.col(c).asc() for c in known if c in candidates.columns]


def _first(candidates: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each category in hit order.

    Each task passes on at most ``n`` rows of a category, so a category holding most of
    the table costs no more than a small one.
    """
    order = Window.partitionBy("category").orderBy(*hit_order(candidates))
    return candidates.withColumn("__n", F.row_number().over(order)).filter(
        F.col("__n") <= n).drop("__n")


def eligible(candidates: DataFrame, hits: int | None = None) -> DataFrame:
    """Hits whose licence allows commercial use and that are not mature: all that landed,
    or the first ``hits`` of each category (``HITS_PER_CATEGORY`` is one result page)."""
    noncommercial = F.coalesce(F.col("license"), F.lit("")).rlike(r"(?i)\bnc\b")
    allowed = candidates.filter(~noncommercial & ~F.coalesce(F.col("mature"), F.lit(False)))
    return allowed if hits is None else _first(allowed, hits)


def with_source_url(candidates: DataFrame) -> DataFrame:
    """Thumbnail, else URL; hits with neither are dropped."""
    return (candidates.withColumn("src", first_filled("thumbnail", "url"))
            .filter(F.col("src").isNotNull()))


def valid_payload() -> Column:
    """The download succeeded, is a supported image type and is not tiny."""
    return (F.coalesce(F.col("status_ok"), F.lit(False))
            & F.coalesce(F.col("mime"), F.lit("")).rlike(PAYLOAD_MIME_PATTERN)
            & (F.coalesce(F.col("length"), F.lit(0)) >= MIN_PAYLOAD_BYTES))


def clean_metadata(candidates: DataFrame) -> DataFrame:
    """Display columns of a hit.

    The title is cut after ``TITLE_LENGTH`` code points (not UTF-16 units, which differ
    only beyond the basic plane).
    """
    title = F.substring(trim_blank(F.coalesce("title", F.lit(""))), 1, TITLE_LENGTH)
    licence = F.concat(F.coalesce("license", F.lit("")), F.lit(" "),
                       F.coalesce("license_version", F.lit("")))
    return candidates.withColumns({
        "title": F.coalesce(F.nullif(title, F.lit("")), F.lit(UNTITLED)),
        "creator": trim_blank(F.coalesce("creator", F.lit(UNKNOWN_CREATOR))),
        "license": F.upper(trim_blank(licence)),
        "licenseUrl": F.coalesce("license_url", F.lit("")),
        "source": F.coalesce("foreign_landing_url", "url", F.lit("")),
        "provider": F.coalesce("provider", F.lit("")),
    })


def first_valid(candidates: DataFrame, per_category: int = ITEMS_PER_CATEGORY) -> DataFrame:
    """The first valid hits of each category; invalid ones are skipped, not counted."""
    return _first(with_source_url(candidates).filter(valid_payload()), per_category)


def assign_ids(kept: DataFrame) -> DataFrame:
    """Dense ids from 0 in category-plan order, then hit order; file names from ids.

    ``pos`` becomes the place in the gallery, which is the id."""
    kept = freeze(kept)
    order = [F.col("cat_pos").asc(), *hit_order(kept)]
    numbered = number_rows(kept, order, "__n", rows=kept.count())
    return (numbered.withColumn("id", F.col("__n") - 1).withColumn("pos", F.col("id")).drop("__n")
            .withColumn("file", F.format_string(FILE_NAME_FORMAT, F.col("id"))))


def keep(candidates: DataFrame, plan: DataFrame, per_category: int = ITEMS_PER_CATEGORY,
         hits: int | None = None) -> DataFrame:
    """Eligible, valid hits of the planned categories, ``per_category`` each.

    The plan is frozen so that it is broadcast by its known size.
    """
    planned = candidates.join(freeze(plan.select("category", "cat_pos")), "category")
    return first_valid(eligible(planned, hits), per_category)


def fill_report(kept: DataFrame, plan: DataFrame,
                per_category: int = ITEMS_PER_CATEGORY) -> DataFrame:
    """(category, kept, under_filled) for every planned category, empty ones included."""
    counts = kept.groupBy("category").agg(F.count(F.lit(1)).alias("kept"))
    return (plan.join(counts, "category", "left")
            .withColumn("kept", F.coalesce("kept", F.lit(0)))
            .select("cat_pos", "category", "kept",
                    (F.col("kept") < per_category).alias("under_filled")))


def curate(candidates: DataFrame, plan: DataFrame, per_category: int = ITEMS_PER_CATEGORY,
           hits: int | None = None) -> DataFrame:
    """Manifest items from hits: (id, file, category, title, ..., provider)."""
    items = clean_metadata(assign_ids(keep(candidates, plan, per_category, hits)))
    return items.select("id", "file", "category", "title", "creator", "license",
                        "licenseUrl", "source", "provider")
