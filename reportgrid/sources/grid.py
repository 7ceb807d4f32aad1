"""Grid sources: cells or rows tables, restricted to the configured pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.functions.cells import let
from reportgrid.operators.scans import BUCKET_ROWS, bucket_of, page_buckets
from reportgrid.sources import staging

# A literal page list up to this size is broadcast; a longer one is joined as Spark sees fit.
MAX_BROADCAST_PAGES = 100_000


def page_config(spark: SparkSession, pages: Mapping[int | str, int]) -> DataFrame:
    """One record per configured page, in processing order: ``page_pos, page_num, n_col``."""
    records = [(pos, int(page), int(width)) for pos, (page, width) in enumerate(pages.items())]
    bad = [page for _, page, width in records if width <= 0]
    if bad:
        raise ValueError(f"pages without a positive column count: {bad}")
    frame = spark.createDataFrame(records, "page_pos int, page_num int, n_col int")
    return F.broadcast(frame) if len(records) <= MAX_BROADCAST_PAGES else frame


def check_page_config(config: DataFrame) -> DataFrame:
    """A page list held in a table; a width that is not positive fails the job that reads it."""
    width = F.when(F.col("n_col") > 0, F.col("n_col")).otherwise(
        F.raise_error(F.concat(F.lit("no positive column count for page "), F.col("page_num")))
    )
    return config.withColumn("n_col", width.cast("int"))


def _page_keys(config: DataFrame) -> list[str]:
    return ["doc_id", "page_num"] if "doc_id" in config.columns else ["page_num"]


def fit_cells(cells: Column, width: Column) -> Column:
    """Exactly ``width`` cells: extra ones are ignored, missing ones are null."""
    return F.when(F.size(cells) == width, cells).otherwise(
        F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.get(cells, i))
    )


def configured_rows(
    rows: DataFrame, config: DataFrame, bucket_rows: int = BUCKET_ROWS, partitions: int | None = None
) -> DataFrame:
    """Rows of the configured pages, with ``page_pos`` and ``n_col`` and cells cut to width.

    ``narrow`` marks rows with fewer cells than configured. A list that names documents is
    joined by page and row bucket, so that the rows of one long page meet it in many tasks. With ``partitions`` the rows
    come dealt to so many by page and ``bucket``; a list that names documents meets them there, without another exchange.
    """
    place = ["doc_id", "page_num", "bucket"]
    extra = [c for c in ("page_pos", "n_col") if c in rows.columns]
    rows = rows.drop(*extra)
    if "doc_id" in config.columns:
        extent = rows.groupBy("doc_id", "page_num").agg((F.max("row_idx") + 1).alias("n_rows"))
        buckets = page_buckets(extent.join(config, ["doc_id", "page_num"]), bucket_rows)
        rows = rows.withColumn("bucket", bucket_of("row_idx", bucket_rows))
        if partitions:
            rows = rows.repartition(partitions, *place)
        # one record per page and bucket in a hash table: the rows need no sort to meet it
        joined = rows.join(buckets.drop("n_rows").hint("shuffle_hash"), place)
    else:
        joined = rows.join(config, "page_num").withColumn("bucket", bucket_of("row_idx", bucket_rows))
        if partitions:
            joined = joined.repartition(partitions, *place)
    fitted = joined.withColumn("narrow", F.size("cells") < F.col("n_col")).withColumn(
        "cells", fit_cells(F.col("cells"), F.col("n_col"))
    )
    return fitted if partitions else fitted.drop("bucket")


def missing_pages(
    rows: DataFrame, pages: Mapping[int | str, int] | DataFrame, documents: DataFrame
) -> DataFrame:
    """Configured pages without any row, per document.

    ``documents`` lists all documents of the input (``doc_id``), also those without a configured page. A page
    list that names documents asks for their pages alone, any other for its pages in every document.
    """
    if isinstance(pages, DataFrame) and "doc_id" in pages.columns:
        wanted = pages.select("doc_id", "page_num", "n_col")
    elif isinstance(pages, DataFrame):
        wanted = _per_document(documents, pages)
    else:
        listed = F.array(
            *[
                F.struct(F.lit(int(p)).alias("page_num"), F.lit(int(n)).alias("n_col"))
                for p, n in pages.items()
            ]
        )
        wanted = documents.select("doc_id", F.inline(listed))
    present = rows.select("doc_id", "page_num").distinct()
    return wanted.join(present, ["doc_id", "page_num"], "left_anti")


def _per_document(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Every page of the list in every document; the list becomes one record."""
    listed = pages.agg(F.collect_list(F.struct("page_num", "n_col")).alias("__list")).withColumn("__one", F.lit(1))
    return documents.withColumn("__one", F.lit(1)).join(listed, "__one").select("doc_id", F.inline("__list"))


def page_extents(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per page of a rows table, ``width`` and ``height`` as read, to go with its cells."""
    return rows.groupBy("doc_id", "page_num").agg(
        F.max(F.size("cells")).alias("width"),
        (F.max("row_idx") + 1).cast("int").alias("height"),
        *[F.min(c).alias(c) for c in keep],
    )


def rows_from_cells(
    cells: DataFrame,
    config: DataFrame,
    keep: tuple[str, ...] = (),
    extents: DataFrame | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Grid rows from one record per cell; only cells inside the configured width count.

    A row without a cell stands between those that have some: up to a page's last row none is missing. ``repeated`` marks
    rows with two cells in one place, of which the smaller value is kept. A row gathers at most its cells.

    Cells alone do not tell a narrow page from one whose last columns are blank, nor how many blank rows end it.
    ``extents`` (``doc_id, page_num, width, height`` and the columns to keep) says so: rows are as wide as their page was read,
    up to the configured width, and as many; a page without any cell has blank rows. Cells beyond their page's extent,
    and pages without one, are left out.
    """
    page = ["doc_id", "page_pos", "page_num", "n_col", "width"]
    if extents is None:
        placed = cells.join(config, _page_keys(config)).withColumn("width", F.col("n_col"))
    else:
        pages = extents.join(config, _page_keys(config)).withColumn("width", F.least("width", "n_col"))
        pages = pages.withColumn("n_rows", F.col("height"))
        # by page and row bucket, so that the cells of one long page meet its extent in many tasks
        buckets = page_buckets(pages.filter("n_rows > 0"), bucket_rows).drop("n_rows")
        placed = (
            cells.drop(*keep)
            .withColumn("bucket", bucket_of("row_idx", bucket_rows))
            .join(buckets, ["doc_id", "page_num", "bucket"])
            .filter("row_idx >= 0 AND row_idx < height")
            .drop("bucket", "height")
        )
    inside = (F.col("col_idx") >= 0) & (F.col("col_idx") < F.col("width"))
    entry = F.struct("col_idx", "value")
    gathered = (
        placed.groupBy(*page, "row_idx", *keep)
        .agg(F.sort_array(F.collect_list(F.when(inside, entry))).alias("__list"))
        .withColumn("repeated", F.size("__list") > F.size(F.array_distinct(F.transform("__list", lambda x: x["col_idx"]))))
    )
    # as a rule a row is complete and its cells are the list; else each is looked up once
    first = F.filter(
        "__list", lambda x, i: (i == 0) | (F.get("__list", i - 1)["col_idx"] < x["col_idx"])
    )
    at = F.map_from_entries(first)
    looked_up = let(
        at,
        lambda m: F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.try_element_at(m, i)),
    )
    complete = (F.size("__list") == F.col("width")) & ~F.col("repeated")
    rows = gathered.withColumn(
        "cells",
        F.when(complete, F.transform("__list", lambda x: x["value"]))
        .when(F.col("width") > 0, looked_up)
        .otherwise(F.array().cast("array<string>")),
    ).drop("__list")
    if extents is None:
        held = placed.groupBy(*page).agg(
            (F.max("row_idx") + 1).alias("n_rows"),
            F.count_distinct("row_idx").alias("__n"),
            *[F.min(c).alias(c) for c in keep],
        )
    else:
        seen = placed.groupBy("doc_id", "page_num").agg(F.count_distinct("row_idx").alias("__n"))
        held = pages.join(seen, ["doc_id", "page_num"], "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    # only pages with a gap are filled, bucket by bucket
    end = F.least((F.col("bucket") + 1) * bucket_rows, F.col("n_rows")) - 1
    blank = (
        page_buckets(held.filter("n_rows > 0 AND __n < n_rows"), bucket_rows)
        .withColumn("row_idx", F.explode(F.sequence((F.col("bucket") * bucket_rows).cast("int"), end.cast("int"))))
        .join(rows.select("doc_id", "page_num", "row_idx"), ["doc_id", "page_num", "row_idx"], "left_anti")
    )
    blank = blank.select(
        *page,
        "row_idx",
        *keep,
        F.lit(False).alias("repeated"),
        F.array_repeat(F.lit(None).cast("string"), F.col("width")).alias("cells"),
    )
    return rows.unionByName(blank).drop("width")


def read_rows(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A rows table: ``doc_id, page_num, row_idx, cells, run_id, timestamp_utc``."""
    schema = (
        "doc_id bigint, page_num int, row_idx int, cells array<string>, "
        "run_id string, timestamp_utc string"
    )
    reader = spark.read.options(**options)
    return reader.parquet(path) if fmt == "parquet" else reader.schema(schema).format(fmt).load(path)


def read_cells(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A cells table: ``doc_id, page_num, row_idx, col_idx, value, run_id, timestamp_utc``."""
    schema = (
        "doc_id bigint, page_num int, row_idx int, col_idx int, value string, "
        "run_id string, timestamp_utc string"
    )
    reader = spark.read.options(**options)
    return reader.parquet(path) if fmt == "parquet" else reader.schema(schema).format(fmt).load(path)


def read_extents(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """The pages of a cells table as they were read: ``doc_id, page_num, width, height, run_id, timestamp_utc``."""
    schema = "doc_id bigint, page_num int, width int, height int, run_id string, timestamp_utc string"
    reader = spark.read.options(**options)
    return reader.parquet(path) if fmt == "parquet" else reader.schema(schema).format(fmt).load(path)


def stage_rows(
    rows: DataFrame, config: DataFrame, bucket_rows: int = BUCKET_ROWS, partitions: int | None = None
) -> DataFrame:
    """The configured rows, dealt once by page and ``bucket`` and written so: scans of them need no exchange by these keys."""
    n = partitions or staging.partitions(rows.sparkSession)
    fitted = configured_rows(rows, config, bucket_rows, n)
    return staging.staged_by(fitted, ["doc_id", "page_num", "bucket"], ["row_idx"], n)
