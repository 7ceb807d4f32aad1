"""From tables to parts with column names: side-by-side slices, headers, fallback, errors."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.functions.cells import let, norm_row, positional_similarity
from reportgrid.functions.headers import infer_header
from reportgrid.operators.dictionary import by_distinct
from reportgrid.operators.scans import BUCKET_ROWS, bucket_of, running
from reportgrid.operators.titles import head_entry, title_at

#: About the milliseconds that reading a pair of header rows takes.
HEADER_COST = 5.0

NO_HEADER, HEADER_WIDTH, NO_ITEM, NARROW, MISSING, GAPS, REPEATED, BAD_TIME = (
    "NO_HEADER", "HEADER_WIDTH", "NO_ITEM_AGG", "NARROW_GRID", "MISSING_PAGE", "MISSING_ROWS", "REPEATED_CELLS",
    "BAD_TIMESTAMP",
)


def table_heads(
    rows: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    max_title_rows: int,
    threshold: float,
    drop_title: bool,
    header_rows: int = 2,
) -> DataFrame:
    """One record per table: its extent, its own title and its first rows after the title.

    Of each table only the ``max_title_rows + header_rows`` first rows are gathered, in the pass that finds its extent.
    """
    size = max_title_rows + header_rows
    offset = F.col("row_idx") - F.col("table_start")
    entry = F.struct(offset.alias("pos"), F.col("cells").alias("cells"))
    tables = (
        # other rows go without their cells, whatever the aggregate does with them
        rows.select(
            *keys, "table_id", "table_start", *keep, "row_idx", F.when(offset < size, entry).alias("__entry")
        )
        .groupBy(*keys, "table_id", "table_start", *keep)
        .agg(
            (F.max("row_idx") + 1).alias("table_end"),
            F.sort_array(F.collect_list("__entry")).alias("__head"),
        )
        .filter(F.size("__head") > 0)
    )
    # only the rows that may be title rows are looked into
    heads = F.transform(F.slice("__head", 1, max_title_rows), lambda h: head_entry(h["pos"], h["cells"], threshold))
    titled = tables.withColumn("__t", let(heads, lambda h: title_at(h, F.lit(0), max_title_rows)))
    skip = F.col("__t.taken") if drop_title else F.lit(0)
    return titled.select(
        *keys,
        "table_id",
        *keep,
        F.col("__t.title").alias("page_subtitle_1"),
        (F.col("table_start") + skip).cast("int").alias("body_start"),
        F.col("table_end").cast("int").alias("table_end"),
        F.transform(
            F.slice(F.col("__head"), skip + 1, F.lit(header_rows)), lambda h: h["cells"]
        ).alias("head"),
    )


def side_by_side(
    head: Column,
    width: Column,
    header_rows: Sequence[int] = (0, 1),
    thresholds: Sequence[float] = (0.60, 0.95),
    base_part_id: int = 1,
    parent_id: int | None = None,
) -> Column:
    """Parts of a table as ``array<struct(part_id, parent_id, lo, width)>``.

    Two halves when the given header rows of both are alike enough, else the table itself.
    """
    half = F.floor(width / 2).cast("int")

    def part(part_id: int, parent: int | None, lo: Column, size: Column) -> Column:
        return F.struct(
            F.lit(part_id).alias("part_id"),
            F.lit(parent).cast("int").alias("parent_id"),
            lo.cast("int").alias("lo"),
            size.cast("int").alias("width"),
        )

    alike = (F.size(head) > max(header_rows)) & (width >= 2)
    for row, threshold in zip(header_rows, thresholds):
        cells = F.get(head, F.lit(row))
        near = positional_similarity(F.slice(cells, F.lit(1), half), F.slice(cells, half + 1, width - half))
        alike = alike & F.coalesce(near >= threshold, F.lit(False))
    return F.when(
        alike,
        F.array(
            part(base_part_id * 10 + 1, base_part_id, F.lit(0), half),
            part(base_part_id * 10 + 2, base_part_id, half, width - half),
        ),
    ).otherwise(F.array(part(base_part_id, parent_id, F.lit(0), width)))


def split_parts(
    tables: DataFrame,
    header_rows: Sequence[int] = (0, 1),
    thresholds: Sequence[float] = (0.60, 0.95),
) -> DataFrame:
    """One record per part; ``seq`` orders the parts of a page."""
    parts = side_by_side(F.col("head"), F.col("n_col"), header_rows, thresholds)
    return tables.select("*", F.inline(parts)).withColumn(
        "seq", (F.col("table_id") * 2 + F.when(F.col("lo") > 0, 1).otherwise(0)).cast("int")
    )


def infer_headers(
    df: DataFrame,
    row1: Column,
    row2: Column,
    tokens: Iterable[str],
    rules: Sequence[dict],
) -> DataFrame:
    """Adds ``header`` for two header rows, null when they are none.

    Reports repeat their headers, so each distinct pair of rows is read once, under a number that the records carry in
    place of the rows. Where very many records share a pair, the join's skewed partition is split at run time, by its measured size.
    """
    first, second = norm_row(row1), norm_row(row2)
    return by_distinct(
        df,
        {"row1": first, "row2": second},
        lambda pairs: {"header": infer_header(F.col("row1"), F.col("row2"), tokens, rules)},
        HEADER_COST,
        first.isNotNull() & second.isNotNull(),
    )


def with_headers(parts: DataFrame, tokens: Iterable[str], rules: Sequence[dict]) -> DataFrame:
    """Adds ``header`` (null when the first two rows are none) and the part's first data row."""
    row1, row2 = (
        F.slice(F.get("head", F.lit(i)), F.col("lo") + 1, F.col("width")) for i in (0, 1)
    )
    headed = infer_headers(parts, row1, row2, tokens, rules)
    below = F.when(F.col("header").isNotNull(), 2).otherwise(0)
    return headed.withColumn("first_data", (F.col("body_start") + below).cast("int"))


def with_fallback(
    parts: DataFrame,
    keys: Sequence[str],
    item_column: str = "item_agg",
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = True,
    bucket: str | None = None,
) -> DataFrame:
    """Adds ``names`` and an ``error`` code; a part without header takes the last one of its page.

    The last header serves only when it has as many names as the part has columns.
    """
    known = running(
        parts,
        keys,
        "seq",
        last={"last_names": F.col("header.names")},
        bucket_rows=bucket_rows,
        carry=carry,
        bucket=bucket,
    )
    names = F.coalesce(F.col("header.names"), F.col("last_names"))
    items = F.size(F.filter(F.col("names"), lambda n: n == item_column))
    return (
        known.withColumn("names", names)
        .withColumn(
            "error",
            F.when(F.col("names").isNull(), NO_HEADER)
            .when(F.size("names") != F.col("width"), HEADER_WIDTH)
            .when(items != 1, NO_ITEM),
        )
        .drop("last_names")
    )


def stop_at_error(
    parts: DataFrame,
    keys: Sequence[str],
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = True,
    bucket: str | None = None,
) -> DataFrame:
    """Adds ``reached``: false for the parts of a page that come after its first error."""
    return (
        running(
            parts,
            keys,
            "seq",
            last={"__failed": F.when(F.col("error").isNotNull(), F.lit(True))},
            bucket_rows=bucket_rows,
            carry=carry,
            bucket=bucket,
        )
        .withColumn("reached", F.col("__failed").isNull())
        .drop("__failed")
    )


# What each error code says.
ERROR_TEXT = {
    NO_HEADER: "no header rows and no earlier header on the page",
    HEADER_WIDTH: "the last header of the page has another number of columns",
    NO_ITEM: "the names do not hold the item column exactly once",
    NARROW: "the grid has fewer columns than configured",
    MISSING: "the page has no rows",
    GAPS: "row positions of the page are missing; its rows are kept where they stand",
    REPEATED: "the page has two cells in one place; the page is left out",
    BAD_TIME: "a time of the page cannot be read and is null",
}


def error_text(code: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for pair in ERROR_TEXT.items() for x in pair])
    return F.concat_ws(": ", code, F.try_element_at(texts, code))


def place_parts(parts: DataFrame, keys: Sequence[str], first: str, end: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One record per page and row bucket holding the ``parts`` with rows ``first`` to ``end``.

    A part that reaches over several buckets is listed in each; a bucket lists at most two
    parts per row, so the lists stay short whatever the size of a page.
    """
    reach = F.sequence(bucket_of(first, bucket_rows), bucket_of(F.col(end) - 1, bucket_rows))
    body = [c for c in parts.columns if c not in keys]
    return (
        parts.filter(F.col(first) < F.col(end))
        .withColumn("bucket", F.explode(reach))
        .groupBy(*keys, "bucket")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(first), *[c for c in body if c != first]))).alias("parts"))
    )
