"""Titles: the leading sparse rows of a page or of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.functions.cells import empty_ratio, let, row_text, title_text


def head_entry(pos: Column, cells: Column, threshold: float) -> Column:
    return F.struct(
        pos.alias("pos"),
        F.coalesce(empty_ratio(cells) >= threshold, F.lit(False)).alias("sparse"),
        row_text(cells).alias("text"),
    )


def entry_of(rows: DataFrame, threshold: float) -> Column:
    """The head entry of a row, from its cells, or from the ``ratio`` and ``head_text`` of flagged rows."""
    if "head_text" not in rows.columns:
        return head_entry(F.col("row_idx"), F.col("cells"), threshold)
    sparse = F.coalesce(F.col("ratio") >= threshold, F.lit(False))
    return F.struct(F.col("row_idx").alias("pos"), sparse.alias("sparse"), F.col("head_text").alias("text"))


def leading_sparse(head: Column) -> Column:
    """How many entries stand before the first dense one."""
    dense_at = F.array_position(F.transform(head, lambda h: h["sparse"]), F.lit(False))
    return F.when(dense_at > 0, dense_at - 1).otherwise(F.size(head)).cast("int")


def title_at(head: Column, skip: Column, max_rows: int) -> Column:
    """``struct(title, taken)`` for the sparse run of a sorted head, after ``skip`` rows."""

    def read(taken: Column) -> Column:
        rows = F.slice(head, skip + 1, taken)
        return F.struct(
            title_text(F.transform(rows, lambda h: h["text"])).alias("title"),
            taken.alias("taken"),
        )

    left = F.greatest(leading_sparse(head) - skip, F.lit(0))
    return let(F.least(left, F.lit(max_rows)), read)


def first_rows(
    rows: DataFrame, keys: Sequence[str], size: int, threshold: float, extent: DataFrame | None = None
) -> DataFrame:
    """One record per group with its sorted first rows ``__head``.

    The filter reaches the scan, so only these rows are gathered; ``extent`` (all groups, by default found by
    a plain aggregate) keeps the groups without any.
    """
    heads = (
        rows.filter(F.col("row_idx") < size)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(entry_of(rows, threshold))).alias("__head"))
    )
    groups = rows.select(*keys).distinct() if extent is None else extent
    none = F.array().cast(heads.schema["__head"].dataType)
    return groups.join(heads, list(keys), "left").withColumn("__head", F.coalesce("__head", none))


def extract_titles(
    rows: DataFrame,
    keys: Sequence[str],
    max_title_rows: int = 3,
    threshold: float = 0.5,
) -> DataFrame:
    """One record per group: ``title`` and ``taken``, the number of rows the title uses."""
    heads = first_rows(rows, keys, max_title_rows, threshold)
    return heads.select(
        *keys, title_at(F.col("__head"), F.lit(0), max_title_rows).alias("__t")
    ).select(*keys, "__t.*")


def drop_leading_rows(
    rows: DataFrame,
    keys: Sequence[str],
    limit: int,
    sparse: Column,
    bucket: str = "bucket",
) -> DataFrame:
    """Without the leading sparse rows, at most ``limit``; they all lie in a group's first bucket."""
    so_far = (
        Window.partitionBy(*keys, bucket)
        .orderBy("row_idx")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("__dense", F.sum(F.when(sparse, 0).otherwise(1)).over(so_far))
        .filter((F.col("row_idx") >= limit) | (F.col("__dense") > 0))
        .drop("__dense")
    )


def page_heads(
    rows: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    max_title_rows: int,
    threshold: float,
    drop_rows: bool,
) -> DataFrame:
    """Per page: title, subtitle, extent (``n_rows``: last row plus one) and the first row after the titles.

    ``narrow``, ``repeated`` and ``bad_time`` say that some row of the page is flagged so, ``gaps`` that rows are missing.

    With ``drop_rows`` the subtitle is read after the title's rows are gone, else both are
    read from the same rows. Flagged rows (``splits.row_flags`` with ``heads=2 * max_title_rows``) serve in place of cells.
    """
    size = 2 * max_title_rows
    narrow = F.max(F.when(~F.col("narrow"), 1)).isNull() if "narrow" in rows.columns else F.lit(False)
    some = [c for c in ("repeated", "bad_time") if c in rows.columns]
    extent = rows.groupBy(*keys, *keep).agg(
        (F.max("row_idx") + 1).cast("long").alias("n_rows"),
        narrow.alias("narrow"),
        (F.count(F.lit(1)) < F.max("row_idx") + 1).alias("gaps"),
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in some],
    )
    extent = extent.withColumns({c: F.lit(False) for c in ("repeated", "bad_time") if c not in some})
    heads = first_rows(rows, keys, size, threshold, extent)
    first = heads.withColumn("__t1", title_at(F.col("__head"), F.lit(0), max_title_rows))
    skip = F.col("__t1.taken") if drop_rows else F.lit(0)
    both = first.withColumn("__t2", title_at(F.col("__head"), skip, max_title_rows))
    first_row = F.col("__t1.taken") + F.col("__t2.taken") if drop_rows else F.lit(0)
    return both.select(
        *keys,
        *keep,
        "n_rows",
        "narrow",
        "gaps",
        "repeated",
        "bad_time",
        F.col("__t1.title").alias("page_title"),
        F.col("__t2.title").alias("page_subtitle"),
        first_row.cast("int").alias("first_row"),
    )
