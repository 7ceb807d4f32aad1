"""Ordered work inside groups of any size.

A group (a page, a document) may hold a large share of all rows, so no window here spans a
whole group of rows. Rows are cut into buckets of ``BUCKET_ROWS`` positions; windows run inside
a bucket, and what a bucket must know from the ones before it (the last mark, a running total)
is carried over a frame with one record per bucket. Only groups that reach into a second bucket
take part in the carry, so for ordinary pages it is empty and adaptive execution drops it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

BUCKET_ROWS = 1024


def bucket_of(pos: Column | str, bucket_rows: int = BUCKET_ROWS) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.call_function("div", pos, F.lit(bucket_rows))


def with_bucket(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows with their ``bucket``; staged rows have it, and are laid out by it."""
    return rows if "bucket" in rows.columns else rows.withColumn("bucket", bucket_of("row_idx", bucket_rows))


def page_buckets(heads: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One record per page and bucket of rows, from one record per page with ``n_rows``."""
    last = bucket_of(F.col("n_rows") - 1, bucket_rows)
    return heads.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def with_neighbours(
    df: DataFrame, pos: str, before: int, after: int, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Adds ``bucket`` and ``own``, copying the rows near a bucket's edge into its neighbour.

    With the copies (``own`` false) a look-back of ``before`` rows and a look-ahead of ``after``
    rows inside the bucket see the same rows as in the whole group. Positions must be dense.
    """
    if before + after >= bucket_rows:
        raise ValueError("the look-around must be shorter than a bucket")
    bucket = bucket_of(pos, bucket_rows)
    place = F.col(pos) % bucket_rows
    # no row is near both edges
    homes = (
        F.when(place >= bucket_rows - before, F.array(bucket, bucket + 1))
        .when((place < after) & (bucket > 0), F.array(bucket, bucket - 1))
        .otherwise(F.array(bucket))
    )
    return df.withColumn("bucket", F.explode(homes)).withColumn(
        "own", F.col("bucket") == bucket_of(pos, bucket_rows)
    )


def _carried(df, keys, pos, last, total, backward, b, own, walk_buckets) -> DataFrame:
    """What each bucket of a long group must know from the buckets before it."""
    rows = df.filter(own) if own else df
    long_groups = rows.filter(F.col(b) > 0).select(*keys).distinct()
    latest = F.min if backward else F.max
    per_bucket = (
        rows.join(long_groups, list(keys), "left_semi")
        .groupBy(*keys, b)
        .agg(
            *[
                latest(
                    F.when(F.col(f"__m_{k}").isNotNull(), F.struct(F.col(pos), F.col(f"__m_{k}")))
                )[f"__m_{k}"].alias(f"__s_{k}")
                for k in last
            ],
            *[F.sum(f"__m_{k}").alias(f"__s_{k}") for k in total],
        )
    )
    before = (
        Window.partitionBy(*keys).orderBy(walk_buckets).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_bucket.select(
        *keys,
        b,
        *[F.last(f"__s_{k}", ignorenulls=True).over(before).alias(f"__c_{k}") for k in last],
        *[F.sum(f"__s_{k}").over(before).alias(f"__c_{k}") for k in total],
    )
    return carried


def reaches(df: DataFrame, pos: str, bucket_rows: int = BUCKET_ROWS) -> bool:
    """Does any position lie beyond the first bucket? One small aggregate decides."""
    top = df.agg(F.max(pos)).first()[0]
    return top is not None and top >= bucket_rows


def running(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    last: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    inclusive: bool = False,
    backward: bool = False,
    bucket_rows: int = BUCKET_ROWS,
    bucket: str | None = None,
    own: str | None = None,
    carry: bool = True,
) -> DataFrame:
    """Adds running values along ``pos`` inside each group.

    ``last``: the latest non-null value before the row (``inclusive``: or at it).
    ``total``: the running sum. ``backward`` walks from the end of the group. ``bucket`` and
    ``own`` name columns made by :func:`with_neighbours` when the frame holds edge copies.
    ``carry=False`` leaves the carry out of the plan; only for frames known (:func:`reaches`)
    to hold no position beyond the first bucket.
    """
    last, total = last or {}, total or {}
    b = bucket or "__bucket"
    if bucket is None:
        df = df.withColumn(b, bucket_of(pos, bucket_rows))
    marks = {f"__m_{k}": v for k, v in {**last, **total}.items()}
    df = df.withColumns(marks)

    walk, walk_buckets = (F.col(pos).desc(), F.col(b).desc()) if backward else (pos, b)
    end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*keys, b).orderBy(walk).rowsBetween(Window.unboundedPreceding, end)
    out = df.withColumns(
        {f"__i_{k}": F.last(f"__m_{k}", ignorenulls=True).over(inside) for k in last}
        | {f"__i_{k}": F.sum(f"__m_{k}").over(inside) for k in total}
    )

    if carry:
        carried = _carried(df, keys, pos, list(last), list(total), backward, b, own, walk_buckets)
        out = out.join(carried, [*keys, b], "left").withColumns(
            {k: F.coalesce(f"__i_{k}", f"__c_{k}") for k in last}
            | {
                k: F.coalesce(f"__i_{k}", F.lit(0)) + F.coalesce(f"__c_{k}", F.lit(0))
                for k in total
            }
        )
    else:
        out = out.withColumns(
            {k: F.col(f"__i_{k}") for k in last}
            | {k: F.coalesce(f"__i_{k}", F.lit(0)) for k in total}
        )
    helpers = [f"__{p}_{k}" for p in ("mic" if carry else "mi") for k in [*last, *total]]
    return out.drop(*helpers, *([] if bucket else [b]))


def number_rows(
    df: DataFrame, keys: Sequence[str], pos: str, name: str = "ordinal", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """0-based row number along ``pos`` inside each group; for positions as dense as rows of a page (see :func:`sparse_ordinals`)."""
    return running(df, keys, pos, total={name: F.lit(1)}, bucket_rows=bucket_rows)


def sparse_ordinals(df: DataFrame, keys: Sequence[str], pos: str, name: str = "ordinal") -> DataFrame:
    """0-based row number along ``pos`` inside each group, whatever the gaps between the positions.

    Rows are range-partitioned by group and position, so a group of any size is spread; each partition numbers its
    own, and the counts of the partitions before it (one record per group and partition) are added.
    """
    parts = staged(df.repartitionByRange(*keys, pos).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "__part").orderBy(pos)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    base = sizes.withColumn("__base", F.sum("__n").over(before)).filter("__base > 0").drop("__n")
    numbered = parts.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    return (
        numbered.join(base, [*keys, "__part"], "left")
        .withColumn(name, F.col(name) + F.coalesce("__base", F.lit(0)))
        .drop("__part", "__base")
    )


def group_runs(
    df: DataFrame, keys: Sequence[str], pos: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Runs of consecutive positions as ``first, last`` per group (positions distinct)."""
    numbered = number_rows(df.select(*keys, pos), keys, pos, "__n", bucket_rows)
    return (
        numbered.groupBy(*keys, (F.col(pos) - F.col("__n")).alias("__run"))
        .agg(F.min(pos).alias("first"), F.max(pos).alias("last"))
        .drop("__run")
    )
