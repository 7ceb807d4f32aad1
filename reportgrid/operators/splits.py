"""Where a page is split into tables.

Split points are found row by row inside buckets (see :mod:`reportgrid.operators.scans`); what
decides for a whole page works on one record per page and bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.functions import cells as C
from reportgrid.functions.cells import contains_keyword, empty_ratio, let, looks_like_header
from reportgrid.operators.scans import (
    BUCKET_ROWS,
    bucket_of,
    page_buckets,
    running,
    with_bucket,
    with_neighbours,
)
from reportgrid.operators.titles import drop_leading_rows
from reportgrid.sources.staging import staged

# Kinds of split points: 0 for sparse runs, 1 and up for the keyword lists in turn.
SPARSE = 0
# Buckets composed in one step when points are thinned out over long groups.
CHUNK = 1024


def row_flags(
    rows: DataFrame,
    keys: Sequence[str],
    tokens: Iterable[str],
    keywords: Sequence[Iterable[str]] = (),
    heads: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row: ``ratio`` of empty cells, ``header`` likeness and one flag per keyword list.

    With ``heads`` also ``head_text``, the text of a group's first ``heads`` rows, so that titles and split points are both
    found from the flags and the cells are read once. ``keep`` names further columns of the rows.
    """
    cells, normed = F.col("cells"), F.col("__normed")
    words = [contains_keyword(cells, w).alias(f"word{i}") for i, w in enumerate(keywords)]
    text = [] if heads is None else [F.when(F.col("row_idx") < heads, C.row_text(cells)).alias("head_text")]
    kept = [*keep] if heads is None else [*keep, "head_text"]
    return rows.select(*keys, "row_idx", *keep, *text, C.norm_row(cells).alias("__normed"), *words).select(
        *keys,
        "row_idx",
        *kept,
        empty_ratio(normed, normed=True).alias("ratio"),
        looks_like_header(normed, tokens, normed=True).alias("header"),
        *[f"word{i}" for i in range(len(keywords))],
    )


def with_prior(
    flags: DataFrame,
    keys: Sequence[str],
    threshold: float,
    bucket_rows: int = BUCKET_ROWS,
    bucket: str | None = None,
    own: str | None = None,
    carry: bool = True,
) -> DataFrame:
    """Adds the latest earlier dense row and the latest earlier data row (dense, no header)."""
    dense = F.col("ratio") < threshold
    return running(
        flags,
        keys,
        "row_idx",
        last={
            "last_dense": F.when(dense, F.col("row_idx")),
            "last_data": F.when(dense & ~F.col("header"), F.col("row_idx")),
        },
        bucket_rows=bucket_rows,
        bucket=bucket,
        own=own,
        carry=carry,
    )


def run_start() -> Column:
    """Start of the sparse run just above a row, or the row itself (after ``with_prior``)."""
    return (F.coalesce(F.col("last_dense"), F.lit(-1)) + 1).cast("int")


def title_start() -> Column:
    """0 when every earlier row is sparse, else the row itself (after ``with_prior``)."""
    return F.when(F.col("last_dense").isNull(), 0).otherwise(F.col("row_idx"))


def split_candidates(
    rows: DataFrame,
    keys: Sequence[str],
    tokens: Iterable[str],
    keywords: Sequence[Iterable[str]],
    *,
    sparse_threshold: float = 0.85,
    dense_threshold: float = 0.5,
    max_lookahead: int = 2,
    confirm_header: bool = True,
    leading_title_rows: int = 0,
    title_threshold: float = 0.5,
    max_scan: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = True,
) -> DataFrame:
    """All split points: ``kind`` 0 for sparse runs, 1.. for the keyword lists, and ``hits``.

    ``leading_title_rows`` leaves out that many leading sparse rows, as taken by the titles.
    ``hits`` counts how often a point was found.
    """
    # the flags are few bytes a row: written once, for several passes read them
    return flagged_candidates(
        staged(row_flags(rows, keys, tokens, keywords)),
        keys,
        len(keywords),
        sparse_threshold=sparse_threshold,
        dense_threshold=dense_threshold,
        max_lookahead=max_lookahead,
        confirm_header=confirm_header,
        leading_title_rows=leading_title_rows,
        title_threshold=title_threshold,
        max_scan=max_scan,
        bucket_rows=bucket_rows,
        carry=carry,
    )


def flagged_candidates(
    flags: DataFrame,
    keys: Sequence[str],
    n_keywords: int,
    *,
    sparse_threshold: float = 0.85,
    dense_threshold: float = 0.5,
    max_lookahead: int = 2,
    confirm_header: bool = True,
    leading_title_rows: int = 0,
    title_threshold: float = 0.5,
    max_scan: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = True,
) -> DataFrame:
    """The same from staged ``row_flags`` with ``n_keywords`` keyword lists."""
    flags = flags.select(*keys, "row_idx", "ratio", "header", *[f"word{i}" for i in range(n_keywords)])
    if carry:
        flags = with_neighbours(flags, "row_idx", max_lookahead, 1, bucket_rows)
    else:  # pages of one bucket have no edges
        flags = flags.withColumns({"bucket": bucket_of("row_idx", bucket_rows), "own": F.lit(True)})
    if leading_title_rows:
        flags = drop_leading_rows(
            flags, keys, leading_title_rows, F.col("ratio") >= title_threshold
        )
    flags = with_prior(flags, keys, sparse_threshold, bucket_rows, "bucket", "own", carry)

    near = Window.partitionBy(*keys, "bucket").orderBy("row_idx")
    sparse = F.col("ratio") >= sparse_threshold
    scanned = F.lit(True) if max_scan is None else F.col("row_idx") < max_scan
    ends_run = ~F.coalesce(F.lead(sparse & scanned, 1).over(near), F.lit(False))
    confirmed = F.col("header") if confirm_header else F.lit(True)
    is_sparse_point = sparse & scanned & ends_run & F.col("last_dense").isNotNull() & confirmed

    stops = F.col("header") | (F.col("ratio") < dense_threshold)
    # hits and the point of each kind; few rows have any, and only those build records of them
    hits = {"__hits0": F.when(is_sparse_point, 1).otherwise(0)}
    for i in range(n_keywords):
        hit = F.col(f"word{i}") & ~F.col("header")
        count, clear = F.lit(0), F.lit(True)
        for back in range(1, max_lookahead + 1):
            here = F.coalesce(F.lag(hit, back).over(near), F.lit(False))
            count = count + F.when(clear & here, 1).otherwise(0)
            clear = clear & ~F.coalesce(F.lag(stops, back).over(near), F.lit(True))
        valid = F.col("header") & F.col("last_data").isNotNull()
        hits[f"__hits{i + 1}"] = F.when(valid, count).otherwise(0)
    found = [
        F.struct(
            F.lit(SPARSE + k).alias("kind"),
            (F.col("row_idx") if k == SPARSE else run_start()).alias("point"),
            F.col(name).alias("hits"),
        )
        for k, name in enumerate(hits)
    ]
    return (
        flags.withColumns(hits)
        .filter("own")
        .filter(F.greatest(*hits, F.lit(0)) > 0)
        .select(*keys, F.inline(F.filter(F.array(*found), lambda f: f["hits"] > 0)))
        .groupBy(*keys, "kind", "point")
        .agg(F.sum("hits").alias("hits"))
    )


def keep_apart(points: Column, last: Column, distance: int) -> Column:
    """Greedy choice from sorted points at least ``distance`` after the last one kept."""
    start = F.struct(last.cast("long").alias("last"), F.array().cast("array<int>").alias("kept"))

    def step(acc: Column, point: Column) -> Column:
        return F.when(
            point - acc["last"] >= distance,
            F.struct(
                point.cast("long").alias("last"),
                F.concat(acc["kept"], F.array(point)).alias("kept"),
            ),
        ).otherwise(acc)

    return F.aggregate(points, start, step)


def _gap_before(frame: DataFrame, keys: Sequence[str], distance: int, bucket_rows: int) -> DataFrame:
    """For each bucket, how far back the last kept point lies when the bucket begins.

    ``frame`` has one record per bucket with its sorted ``points``. A bucket is a function from
    the gap at its start to the gap at its end, both 1..``distance``; these short functions are
    composed, first inside chunks of buckets, then over the chunks, so that no record ever
    holds more than one small array per chunk.
    """
    gaps = range(1, distance + 1)
    begin = F.col("bucket") * bucket_rows

    def leave(gap: int) -> Column:
        kept = keep_apart(F.col("points"), begin - gap, distance)["last"]
        return F.least(begin + bucket_rows - kept, F.lit(distance)).cast("int")

    def follow(steps: Column, gap: Column) -> Column:
        return F.aggregate(steps, gap, lambda g, s: F.element_at(s["map"], g))

    def trail(steps: Column, gap: Column) -> Column:
        start = F.struct(gap.alias("gap"), F.array(gap).alias("seen"))
        walked = F.aggregate(
            steps,
            start,
            lambda acc, s: let(
                F.element_at(s["map"], acc["gap"]),
                lambda g: F.struct(g.alias("gap"), F.concat(acc["seen"], F.array(g)).alias("seen")),
            ),
        )
        return walked["seen"]

    steps = frame.select(
        *keys,
        bucket_of("bucket", CHUNK).alias("chunk"),
        F.struct("bucket", F.array(*[leave(g) for g in gaps]).alias("map")).alias("step"),
    )
    chunks = steps.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    summary = chunks.select(
        *keys,
        F.struct(
            "chunk", F.array(*[follow(F.col("steps"), F.lit(g)) for g in gaps]).alias("map")
        ).alias("step"),
    )
    entries = (
        summary.groupBy(*keys)
        .agg(F.sort_array(F.collect_list("step")).alias("steps"))
        .select(
            *keys,
            F.explode(
                F.arrays_zip(
                    F.transform("steps", lambda s: s["chunk"]).alias("chunk"),
                    trail(F.col("steps"), F.lit(distance)).alias("gap"),
                )
            ).alias("e"),
        )
        .select(*keys, F.col("e.chunk").alias("chunk"), F.col("e.gap").alias("gap"))
        .filter(F.col("chunk").isNotNull())
    )
    return (
        chunks.join(entries, [*keys, "chunk"])
        .select(
            *keys,
            F.explode(
                F.arrays_zip(
                    F.transform("steps", lambda s: s["bucket"]).alias("bucket"),
                    trail(F.col("steps"), F.col("gap")).alias("gap"),
                )
            ).alias("e"),
        )
        .select(*keys, F.col("e.bucket").alias("bucket"), F.col("e.gap").alias("gap"))
        .filter(F.col("bucket").isNotNull())
    )


def thin_points(
    points: DataFrame,
    keys: Sequence[str],
    distance: int,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Greedy choice, from the top of each group, of points at least ``distance`` apart."""
    buckets = points.groupBy(*keys, bucket_of("point", bucket_rows).alias("bucket")).agg(
        F.sort_array(F.collect_set("point")).alias("points")
    )
    # groups that reach into a second bucket, with their empty buckets
    spread = (
        buckets.groupBy(*keys)
        .agg(F.max("bucket").alias("__last"))
        .filter("__last > 0")
        .select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "__last")).alias("bucket"))
        .join(buckets, [*keys, "bucket"], "left")
        .withColumn("points", F.coalesce("points", F.array().cast("array<int>")))
    )
    gaps = _gap_before(spread, keys, distance, bucket_rows)
    start = F.col("bucket") * bucket_rows - F.coalesce("gap", F.lit(distance))
    kept = keep_apart(F.col("points"), start, distance)["kept"]
    return buckets.join(gaps, [*keys, "bucket"], "left").select(*keys, F.explode(kept).alias("point"))


def choose_points(
    candidates: DataFrame,
    heads: DataFrame,
    keys: Sequence[str],
    min_rows_per_table: int = 5,
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = True,
) -> DataFrame:
    """The split points that count, sorted, per page and bucket (``points``), and their ``kind``.

    Sparse runs win over the first keyword list, which wins over the next. Keyword points that
    come too thick (more than one per ``min_rows_per_table`` rows) are thinned out from the top.
    ``heads`` has one record per page with ``n_rows`` and ``first_row``.
    """
    per_kind = candidates.groupBy(*keys, "kind").agg(F.sum("hits").alias("hits"))
    winners = per_kind.groupBy(*keys).agg(F.min(F.struct("kind", "hits")).alias("__win"))
    pages = heads.join(winners, list(keys), "left").withColumns(
        {
            "kind": F.col("__win.kind"),
            "__thin": F.coalesce(
                (F.col("__win.kind") != SPARSE)
                & (F.col("__win.hits") > (F.col("n_rows") - F.col("first_row")) / min_rows_per_table),
                F.lit(False),
            ),
        }
    )
    per_bucket = candidates.groupBy(*keys, bucket_of("point", bucket_rows).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("kind", "point"))).alias("__found")
    )
    mine = F.filter(
        F.coalesce("__found", F.array().cast("array<struct<kind:int,point:int>>")),
        lambda f: f["kind"] == F.col("kind"),
    )
    buckets = (
        page_buckets(pages.drop("__win"), bucket_rows)
        .join(per_bucket, [*keys, "bucket"], "left")
        .withColumn("points", F.transform(mine, lambda f: f["point"]))
    )
    if carry:
        long_and_thick = buckets.filter(
            F.col("__thin") & (F.col("n_rows") > bucket_rows)
        ).select(*keys, "bucket", "points")
        gaps = _gap_before(long_and_thick, keys, min_rows_per_table, bucket_rows)
        buckets = buckets.join(gaps, [*keys, "bucket"], "left")
    else:
        buckets = buckets.withColumn("gap", F.lit(None).cast("int"))
    start = F.col("bucket") * bucket_rows - F.coalesce("gap", F.lit(min_rows_per_table))
    apart = keep_apart(F.col("points"), start, min_rows_per_table)["kept"]
    return buckets.withColumn(
        "points", F.when(F.col("__thin"), apart).otherwise(F.col("points"))
    ).drop("__found", "__thin", "gap")


def table_starts(points: DataFrame, keys: Sequence[str], carry: bool = True) -> DataFrame:
    """Adds to each page bucket the table ``starts`` in it, their base id and the open table.

    The first table of a page starts at ``first_row``; points outside the page are ignored.
    ``carry=False`` is for pages of one bucket each.
    """
    inside = F.filter(
        F.col("points"), lambda p: (p > F.col("first_row")) & (p < F.col("n_rows"))
    )
    first = F.when(
        (F.col("bucket") == 0) & (F.col("first_row") < F.col("n_rows")), F.array("first_row")
    ).otherwise(F.array().cast("array<int>"))
    placed = points.withColumn("starts", F.concat(first, inside))
    if not carry:
        return placed.withColumns(
            {"id_base": F.lit(0), "open_start": F.lit(None).cast("int")}
        )
    # the running values need two numbers per bucket, not the lists
    earlier = (
        Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        placed.filter(F.col("n_rows") > 0)
        .select(
            *keys,
            "bucket",
            F.size("starts").alias("__n"),
            F.try_element_at(F.col("starts"), F.lit(-1)).alias("__at"),
        )
        .select(
            *keys,
            "bucket",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).cast("int").alias("id_base"),
            F.last("__at", ignorenulls=True).over(earlier).alias("open_start"),
        )
    )
    return placed.join(before, [*keys, "bucket"])


def assign_tables(
    rows: DataFrame, starts: DataFrame, keys: Sequence[str], bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Adds ``table_id`` and ``table_start`` to the rows; rows above the first table go. A column ``bucket`` counts as theirs."""
    begun = F.filter(F.col("starts"), lambda s: s <= F.col("row_idx"))
    shared = [c for c in starts.columns if c in rows.columns and c not in (*keys, "bucket")]
    return (
        with_bucket(rows.drop(*shared), bucket_rows)
        .join(starts, [*keys, "bucket"])
        .filter(F.col("row_idx") >= F.col("first_row"))
        .withColumns(
            {
                "table_id": (F.col("id_base") + F.size(begun) - 1).cast("int"),
                "table_start": F.coalesce(
                    F.try_element_at(begun, F.lit(-1)), F.col("open_start")
                ),
            }
        )
        .drop("starts", "id_base", "open_start", "points", "kind")
    )
