"""Drops the lines that a site repeats on too many of its pages, in DataFrame expressions only.

For each site the pages that hold a line are divided by all pages of the site. A line whose share
is above ``ratio``, on ``min_pages`` pages at least, is boilerplate of that site and goes from every
page of it; the same line stays on other sites.

Defined results: rows without a site form a site of their own; a null text has no lines and stays
null; a line without a word is never boilerplate; a line that a page holds twice counts once there,
and goes from both places; repeated rows are pages each; a text of which nothing is left becomes empty.
All further columns are kept as they are,
whatever their names; only ``lines_before`` and ``lines_dropped`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

#: A line on more than this share of a site's pages is boilerplate.
RATIO = 0.05
#: Fewer pages than this prove nothing.
MIN_PAGES = 8
#: Columns that the result adds; of these names in the input, only the result's remain.
ADDED = ("lines_before", "lines_dropped")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(
    docs: DataFrame, site_col: str, text_col: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per site with boilerplate: ``site_key`` and ``site_lines``, the digests of its lines.

    A site has at most (its lines per page / ratio) of them, whatever its number of pages.
    """
    pages = docs.select(F.col(site_col).alias("site_key"), F.col(text_col).cast("string").alias("page_text"))
    held = F.transform(
        F.array_distinct(F.filter(_lines(F.col("page_text")), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))),
        lambda x: F.md5(x),
    )
    common = (
        pages.select("site_key", F.explode(held).alias("line"))
        .groupBy("site_key", "line")
        .agg(F.count("*").alias("with_line"))
        .filter(F.col("with_line") >= min_pages)
    )
    totals = pages.groupBy("site_key").agg(F.count("*").alias("site_pages"))
    shares = common.join(
        totals.withColumnRenamed("site_key", "total_key"), F.col("site_key").eqNullSafe(F.col("total_key"))
    )
    return (
        shares.filter(F.col("with_line") > ratio * F.col("site_pages"))
        .groupBy("site_key")
        .agg(F.collect_list("line").alias("site_lines"))
    )


def drop_lines(
    docs: DataFrame,
    site_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """All columns of ``docs`` with the text's boilerplate gone, and ``lines_before``, ``lines_dropped``.

    The boilerplate is written first: as long as it is small, Spark broadcasts it by its measured size and
    the texts are not shuffled; beyond that they meet it by site, where a hot site is split at run time.
    """
    found = staged(boilerplate(docs, site_col, text_col, ratio, min_pages))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(site_col).alias("site"),
        F.col(text_col).cast("string").alias("page_text"),
    )
    rows = rows.join(found, F.col("site").eqNullSafe(F.col("site_key")), "left")
    before = _lines(F.col("page_text"))
    kept = F.filter(before, lambda x: ~F.array_contains(F.col("site_lines"), F.md5(x)))
    touched = F.col("site_lines").isNotNull() & F.col("page_text").isNotNull()
    rows = rows.withColumn("lines_kept", F.when(touched, kept))
    n_before = F.when(F.col("page_text").isNull(), 0).otherwise(F.size(before))
    left = F.coalesce(F.array_join("lines_kept", "\n"), F.col("page_text"))
    return rows.select(
        *[(left if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c not in ADDED],
        n_before.cast("long").alias("lines_before"),
        F.when(touched, n_before - F.size("lines_kept")).otherwise(0).cast("long").alias("lines_dropped"),
    )
