"""Reporting periods, chapters and carried group labels."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.functions.months import month_start
from reportgrid.operators.scans import BUCKET_ROWS, running
from reportgrid.sources.grid import MAX_BROADCAST_PAGES

# First appearances are far apart, so their buckets are wide.
LABEL_BUCKET = 1 << 20


def period_starts(
    labels: DataFrame,
    keys: Sequence[str],
    label: str,
    first: str,
    year: int,
    as_of: Column,
    carry: bool = True,
) -> DataFrame:
    """The start date of each distinct label of a group.

    ``labels`` has one record per group and label with its ``first`` appearance. A label that
    names no month takes the last date found before it, at first the month of ``as_of``.
    """
    dated = running(
        labels,
        keys,
        first,
        last={"period_start": month_start(F.col(label), year)},
        inclusive=True,
        bucket_rows=LABEL_BUCKET,
        carry=carry,
    )
    return dated.withColumn(
        "period_start", F.coalesce("period_start", F.trunc(as_of, "MM"))
    ).drop(first)


def join_periods(
    rows: DataFrame, dated: DataFrame, keys: Sequence[str], label: str
) -> DataFrame:
    """Adds ``period_start`` by group and label, null labels included.

    A label that very many rows share makes a skewed partition, which is split at run time by its measured size.
    """
    dated = dated.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col(label).alias("__label"),
        "period_start",
    )
    same = F.col(label).eqNullSafe(F.col("__label"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return rows.join(dated, same, "left").drop("__label", *[f"__{k}" for k in keys])


def map_period_start(
    rows: DataFrame,
    keys: Sequence[str],
    label: str,
    order: str,
    year: int,
    as_of: Column,
) -> DataFrame:
    """Adds ``period_start`` to the rows; ``order`` is the row number inside the group."""
    labels = rows.groupBy(*keys, label).agg(F.min(order).alias("__first"))
    dated = period_starts(labels, keys, label, "__first", year, as_of)
    return join_periods(rows, dated, keys, label)


Range = tuple[int, int, str, str]


def chapter_ranges(chapters: Mapping[str, Mapping[str, Sequence[int]]]) -> list[Range]:
    """``(first, last, chapter, sub-chapter)`` in the order given; empty ranges go."""
    listed = ((int(lo), int(hi), c, s) for c, subs in chapters.items() for s, (lo, hi) in subs.items())
    return [r for r in listed if r[0] <= r[1]]


def disjoint_ranges(ranges: Sequence[Range]) -> list[Range]:
    """The same lookup without overlaps: where ranges overlap the later one counts.

    A sweep over the ends of the ranges; a heap holds those that are open, the latest on top. Its work follows from the
    number of ranges, not from how many pages they span.
    """
    begins = sorted((lo, k) for k, (lo, *_) in enumerate(ranges))
    points = sorted({end for lo, hi, *_ in ranges for end in (lo, hi + 1)})
    open_: list[tuple[int, int]] = []
    out: list[Range] = []
    of, at = None, 0
    for low, high in zip(points, points[1:]):
        while at < len(begins) and begins[at][0] == low:
            k = begins[at][1]
            heapq.heappush(open_, (-k, ranges[k][1]))
            at += 1
        while open_ and open_[0][1] < low:
            heapq.heappop(open_)
        if not open_:
            of = None
            continue
        k = -open_[0][0]
        if k == of and out[-1][1] == low - 1:
            out[-1] = (out[-1][0], high - 1, *ranges[k][2:])
        else:
            out.append((low, high - 1, *ranges[k][2:]))
        of = k
    return out


@dataclass(frozen=True)
class ChapterIndex:
    """Disjoint ranges, each under the one or two blocks of pages that hold it, and the sizes of these blocks."""

    blocks: DataFrame
    levels: tuple[int, ...]


def chapter_index(spark: SparkSession, chapters: Mapping[str, Mapping[str, Sequence[int]]]) -> ChapterIndex:
    """An index over the ranges of a chapter map, of any width; a later range wins.

    Level ``k`` has blocks of ``2**k`` pages. A range stands on the lowest level on which it lies in two blocks at most, so there are at
    most two records a range, and a page looks into one block on each of the levels in use.
    """
    records = []
    for lo, hi, chapter, sub in disjoint_ranges(chapter_ranges(chapters)):
        level = max(0, (hi - lo).bit_length() - 1)
        while (hi >> level) - (lo >> level) > 1:
            level += 1
        records += [(level, block, lo, hi, chapter, sub) for block in range(lo >> level, (hi >> level) + 1)]
    shape = "level int, block long, lo long, hi long, capitolo string, sottocapitolo string"
    levels = tuple(sorted({r[0] for r in records}))
    frame = spark.createDataFrame(records, shape)
    return ChapterIndex(F.broadcast(frame) if len(records) <= MAX_BROADCAST_PAGES else frame, levels)


def overlapping_ranges(chapters: Mapping[str, Mapping[str, Sequence[int]]]) -> list[tuple[int, int]]:
    """Stretches of pages named by more than one range, for a warning."""
    ends = sorted(end for lo, hi, *_ in chapter_ranges(chapters) for end in ((lo, 1), (hi + 1, -1)))
    out: list[tuple[int, int]] = []
    depth, since = 0, 0
    for at, step in ends:
        if depth < 2 <= depth + step:
            since = at
        elif depth + step < 2 <= depth and since < at:
            if out and out[-1][1] == since - 1:
                since = out.pop()[0]
            out.append((since, at - 1))
        depth += step
    return out


def with_chapters(rows: DataFrame, index: ChapterIndex, page: str = "page_num") -> DataFrame:
    """Adds chapter and sub-chapter. Each different page of the rows is looked up once, in one block of each level."""
    number = F.col(page).cast("long")
    if not index.levels:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("capitolo", "sottocapitolo")})
    keys = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(number, k).alias("block")) for k in index.levels])
    found = (
        rows.select(page)
        .distinct()
        .select(number.alias("__page"), F.inline(keys))
        .join(index.blocks, ["level", "block"])
        .filter("lo <= __page AND __page <= hi")
        .select("__page", "capitolo", "sottocapitolo")
    )
    return rows.join(found, number == F.col("__page"), "left").drop("__page")


def group_label(
    rows: DataFrame,
    keys: Sequence[str],
    pos: str,
    item: Column,
    keywords: Sequence[str],
    name: str = "item_agg_1",
    bucket_rows: int = BUCKET_ROWS,
    bucket: str | None = None,
    carry: bool = True,
) -> DataFrame:
    """Adds the latest ``item`` at or above the row that is exactly one of the keywords."""
    return running(
        rows,
        keys,
        pos,
        last={name: F.when(item.isin(list(keywords)), item)},
        inclusive=True,
        bucket_rows=bucket_rows,
        bucket=bucket,
        carry=carry,
    )
