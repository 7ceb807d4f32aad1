import pytest
from helpers import row, rows_of
from pyspark.sql import functions as F

from reportgrid.operators import enrich, parts as P, projection, quality, typing


def sliced(value, *head, width=6, **options):
    rows = F.array(*[row(*r) for r in head])
    got = value(p=P.side_by_side(rows, F.lit(width), **options))["p"]
    return [(p["part_id"], p["parent_id"], p["lo"], p["width"]) for p in got]


def test_side_by_side(value):
    second = ("u", "2025", "2024", "u", "2025", "2024")
    assert sliced(value, ("Dec", "", "Act", "YTD", "", "Act"), second) == [(1, None, 0, 6)]
    assert sliced(value, ("x", "Act", "Bdg", "y", "Act", "Bdg"), second) == [(11, 1, 0, 3), (12, 1, 3, 3)]
    off = ("u", "2025", "2024", "u", "2025", "2023")
    assert sliced(value, ("x", "Act", "Bdg", "y", "Act", "Bdg"), off) == [(1, None, 0, 6)]
    assert sliced(value, ("x", "Act", "Bdg", "y", "Act", "Bdg")) == [(1, None, 0, 6)]
    odd = ("a", "b", "a", "b", "c")
    assert sliced(value, odd, odd, width=5) == [(11, 1, 0, 2), (12, 1, 2, 3)]


def test_fallback_and_errors(spark):
    names = ["item_agg", "x", "y", "z"]
    records = [
        (5, 0, names, 4), (5, 2, None, 4), (5, 4, None, 3), (5, 6, names, 4),
        (6, 0, None, 4), (6, 2, names, 4),
        (7, 0, ["a", "b"], 2),
    ]
    parts = spark.createDataFrame(records, "page_num int, seq int, n array<string>, width int").select(
        "page_num", "seq", "width", F.when(F.col("n").isNotNull(), F.struct(F.col("n").alias("names"))).alias("header")
    )
    for bucket_rows in (2, 1024):
        out = P.stop_at_error(P.with_fallback(parts, ["page_num"], bucket_rows=bucket_rows), ["page_num"], bucket_rows)
        got = {(r.page_num, r.seq): (r.error, r.reached) for r in out.collect()}
        assert got == {
            (5, 0): (None, True), (5, 2): (None, True), (5, 4): ("HEADER_WIDTH", True), (5, 6): (None, False),
            (6, 0): ("NO_HEADER", True), (6, 2): (None, False), (7, 0): ("NO_ITEM_AGG", True),
        }
        second = out.filter("page_num = 5 and seq = 2").first()
        assert second.names == names


def test_quality(spark):
    names = [["run_id", "item_agg", "2025_act", "2025_act"], ["item_agg", "2024", "12,7%"], ["item_agg", "ok"]]
    parts = spark.createDataFrame([(i, 1, n) for i, n in enumerate(names)], "idx int, page_num int, names array<string>")
    checked = quality.with_checks(parts, F.col("names"))
    summary = quality.qc_summary(checked).orderBy("idx").collect()
    assert [r.issues for r in summary] == ["DUPLICATE_COLS", "NUMERIC_COLNAMES|BAD_CHARS", ""]
    assert summary[1].numeric_cols == ["2024", "12,7%"] and summary[1].bad_chars_cols == ["12,7%"]
    events = {r.e_des for r in quality.qc_events(checked).collect()}
    assert events == {
        "DUPLICATE_COLS: ['2025_act']", "NUMERIC_COLNAMES: ['2024', '12,7%']", "BAD_CHARS_IN_COLNAMES: ['12,7%']",
    }
    rows = spark.createDataFrame([(0,), (1,), (2,), (2,)], "idx int")
    clean, bad = quality.quarantine(rows, checked, ["idx"], reverse=True)
    assert rows_of(clean) == [(2,), (2,)] and [r.idx for r in bad.collect()] == [1, 0]
    assert clean.count() + bad.count() == rows.count()
    flagged = quality.flag_quarantine(rows, checked, ["idx"])
    assert rows_of(flagged) == [(0, True), (1, True), (2, False), (2, False)]


def text_rows(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")


def test_smart_percent(spark):
    nine = text_rows(spark, ["5%"] * 9 + ["x%"])
    out, decisions = typing.smart_types(nine, ["c"])
    assert decisions == {"c": "percent"} and out.filter("c is null").count() == 1
    lost = typing.lost_values(nine, typing.column_entries(["c"]), decisions, F.col("i")).collect()
    assert [(r["column"], r["index"], r["or_val"]) for r in lost] == [("c", 9, "x%")]
    two = text_rows(spark, ["5%"] * 8 + ["x%"] * 2)
    assert typing.smart_types(two, ["c"], kinds=["percent"])[1] == {"c": "text"}
    half = text_rows(spark, ["5%"] * 4 + ["7"] * 4 + [None])
    assert typing.smart_types(half, ["c"])[1] == {"c": "percent"}


def test_smart_numeric(spark):
    assert typing.smart_types(text_rows(spark, ["1.000", "2.000", "abc", "abc"]), ["c"])[1] == {"c": "text"}
    assert typing.smart_types(text_rows(spark, ["1.000", None, "2,5"]), ["c"])[1] == {"c": "number"}
    assert typing.smart_types(text_rows(spark, [None, None]), ["c"])[1] == {}


def test_group_label(spark):
    items = ["x", "Pharma", "a", "b", "Oncology", "c", "pharma"]
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(items)], "k int, i int, item string")
    for bucket_rows in (2, 1024):
        out = enrich.group_label(rows, ["k"], "i", F.col("item"), ["Pharma", "Oncology"], bucket_rows=bucket_rows)
        got = [r.item_agg_1 for r in out.orderBy("i").collect()]
        assert got == [None, "Pharma", "Pharma", "Pharma", "Oncology", "Oncology", "Oncology"]


def test_period_start(spark):
    labels = ["YTD", "December", "Q1", "gennaio", None, "December"]
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(labels)], "doc int, i int, p string")
    out = enrich.map_period_start(rows, ["doc"], "p", "i", 2025, F.lit("2026-03-15").cast("date"))
    got = [str(r.period_start) for r in out.orderBy("i").collect()]
    assert got == ["2026-03-01", "2025-12-01", "2025-12-01", "2025-01-01", "2025-01-01", "2025-12-01"]


def test_chapters(spark):
    from reportgrid.config import CHAPTERS

    pages = spark.createDataFrame([(p,) for p in (3, 4, 61, 62, 71, 72, 73, 76)], "page_num int")
    out = enrich.with_chapters(pages, enrich.chapter_index(spark, CHAPTERS))
    got = {r.page_num: (r.capitolo, r.sottocapitolo) for r in out.collect()}
    assert got == {
        3: ("OVERVIEW", "OVERVIEW"), 4: ("PHARMA", "OVERVIEW"), 61: ("PHARMA", "PRODUCTS"),
        62: ("CELL_BIOLOGY", "OVERVIEW"), 71: ("DIAGNOSTIC", "OVERVIEW"),
        72: (None, None), 73: (None, None), 76: (None, None),
    }
    assert enrich.overlapping_ranges(CHAPTERS) == [(62, 65)]


def test_projection(spark):
    a = spark.createDataFrame([("1",)], "a string")
    b = spark.createDataFrame([("2",)], "b string")
    assert rows_of(projection.unite([a, b])) == [("1", None), (None, "2")]
    with pytest.raises(ValueError):
        projection.unite([])
    with pytest.raises(ValueError):
        projection.rename_columns(a, ["a"], ["x", "y"])
    with pytest.raises(ValueError):
        projection.select_final(a, ["zz"])


def test_ranges_of_any_width(spark):
    """Random overlapping ranges against a page-by-page lookup, and ranges of 10^9 pages."""
    import random

    rng = random.Random(4)
    for n in (0, 1, 3, 12):
        ranges = []
        for k in range(n):
            lo = rng.randrange(0, 60)
            ranges.append((lo, lo + rng.choice([-1, 0, 1, 5, 30]), "c", f"s{k}"))
        chapters = {"c": {s: (lo, hi) for lo, hi, _, s in ranges}}
        want = {p: s for lo, hi, _, s in ranges for p in range(lo, hi + 1)}
        flat = enrich.disjoint_ranges(enrich.chapter_ranges(chapters))
        assert [p for lo, hi, *_ in flat for p in range(lo, hi + 1)] == sorted(want)
        assert {p: s for lo, hi, _, s in flat for p in range(lo, hi + 1)} == want
        depth = [sum(lo <= p <= hi for lo, hi, *_ in ranges) for p in range(100)]
        assert [p for lo, hi in enrich.overlapping_ranges(chapters) for p in range(lo, hi + 1)] == [p for p in range(100) if depth[p] > 1]
        pages = spark.range(-3, 100).withColumnRenamed("id", "page_num")
        out = enrich.with_chapters(pages, enrich.chapter_index(spark, chapters)).collect()
        assert {r.page_num: r.sottocapitolo for r in out} == {p: want.get(p) for p in range(-3, 100)}
    wide = {"a": {"x": (0, 10**9), "y": (10**8, 2 * 10**8)}, "b": {"z": (150_000_000, 10**9 + 7)}}
    index = enrich.chapter_index(spark, wide)
    assert index.blocks.count() <= 6
    pages = spark.createDataFrame([(0,), (10**8,), (10**8 - 1,), (149_999_999,), (150_000_000,), (10**9 + 8,), (None,)], "page_num long")
    got = {r.page_num: r.sottocapitolo for r in enrich.with_chapters(pages, index).collect()}
    assert got == {0: "x", 10**8: "y", 10**8 - 1: "x", 149_999_999: "y", 150_000_000: "z", 10**9 + 8: None, None: None}
