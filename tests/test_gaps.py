"""Pages with holes, repeated cells, missing pages, odd times, and headers named like helpers."""

import datetime
import unicodedata

import pytest
from helpers import grid, rows_of
from pyspark.sql import functions as F
from test_report import AS_OF, FINAL, H1, H2, PAGE, data, run, wide

from reportgrid.config import ReportConfig
from reportgrid.functions import names as N
from reportgrid.functions.numbers import utc_naive
from reportgrid.operators.scans import sparse_ordinals
from reportgrid.plans import report as R
from reportgrid.sources import grid as G

CFG = ReportConfig(final_columns=FINAL)


def report(spark, rows, pages=None, cfg=CFG, **options):
    return R.run_report(spark, rows, pages or {5: 8}, cfg, F.lit(AS_OF).cast("date"), **options)


def codes(out):
    return {(r.doc_id, r.page, r.e_des.split(":")[0]) for r in out.errors.collect()}


def test_a_gap_loses_no_row(spark):
    """Rows missing in the middle of a table, and another gap beyond the first bucket."""
    rows = grid(spark, {1: PAGE, 2: PAGE}, page=5)
    row = F.col("row_idx")
    moved = rows.withColumn("row_idx", F.when((F.col("doc_id") == 2) & (row >= 12), row + 2).otherwise(row))
    moved = moved.withColumn("row_idx", F.when((F.col("doc_id") == 2) & (row >= 13), row + 2000).otherwise(F.col("row_idx")).cast("int"))
    out = report(spark, moved)
    items = {d: [r.item_agg for r in out.facts.filter(f"doc_id = {d}").collect()] for d in (1, 2)}
    assert sorted(items[1]) == sorted(items[2])
    assert codes(out) == {(2, 5, "MISSING_ROWS")}


def test_blank_rows_come_back_from_cells(spark):
    blank = wide()
    page = [*PAGE[:6], blank, *PAGE[6:12], blank, *PAGE[12:]]
    want = report(spark, grid(spark, {1: page}, page=5)).facts.drop("doc_id").collect()
    cells = grid(spark, {1: page}, page=5).select(
        "doc_id", "page_num", "row_idx", "run_id", "timestamp_utc", F.posexplode("cells").alias("col_idx", "value")
    ).filter("value <> ''")
    rows = G.rows_from_cells(cells, G.page_config(spark, {5: 8}), ("run_id", "timestamp_utc"))
    assert rows.count() == len(page) and rows.filter("row_idx = 6").first().cells == [None] * 8
    got = report(spark, rows).facts.drop("doc_id").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(r.item_agg == "TOTAL" for r in got) == 2


def test_repeated_cells_are_a_page_error(spark):
    cells = grid(spark, {1: PAGE, 2: PAGE}, page=5).select(
        "doc_id", "page_num", "row_idx", "run_id", "timestamp_utc", F.posexplode("cells").alias("col_idx", "value")
    )
    cells = cells.unionByName(cells.filter("doc_id = 2 and row_idx = 6 and col_idx = 1").withColumn("value", F.lit("9")))
    rows = G.rows_from_cells(cells, G.page_config(spark, {5: 8}), ("run_id", "timestamp_utc"))
    out = report(spark, rows)
    assert codes(out) == {(2, 5, "REPEATED_CELLS")}
    assert {r.doc_id for r in out.facts.collect()} == {1}


@pytest.mark.parametrize("form", ["dict", "frame", "frame by document"])
def test_missing_pages_of_every_document(spark, form):
    rows = grid(spark, {1: PAGE, 2: PAGE}, page=5).unionByName(grid(spark, {3: PAGE}, page=77))
    pages = {5: 8, 6: 8}
    if form != "dict":
        pages = spark.createDataFrame([(0, 5, 8), (1, 6, 8)], "page_pos int, page_num int, n_col int")
    if form == "frame by document":
        pages = pages.join(spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id long"))
    want = {(1, 6), (2, 6), (3, 5), (3, 6)} | ({(4, 5), (4, 6)} if form == "frame by document" else set())
    assert codes(report(spark, rows, pages)) == {(d, p, "MISSING_PAGE") for d, p in want}


def test_headers_named_like_helpers(spark):
    """A header called width or cells names data; helper columns of that name stay out of the report."""
    cfg = ReportConfig(final_columns=["item_agg", "width", "cells", "n"])
    shaped = spark.createDataFrame([(1, 8, ["x"], {"item_agg": "Italy", "width": "2 m", "cells": "many"})],
                                   "doc_id long, width int, cells array<string>, values map<string,string>")
    out = R.final_projection(shaped, cfg, {}, ("doc_id",)).first()
    assert (out.item_agg, out.width, out.cells, out.n) == ("Italy", "2 m", "many", None)


def test_times_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2026-01-05T10:00:00Z", "2026-01-05T10:00:00.25", "2026-01-05T12:00:00+02:00", "2026-07-05 12:00:00 Europe/Rome", "garbage", None]
    want = [datetime.datetime(2026, 1, 5, 10), datetime.datetime(2026, 1, 5, 10, 0, 0, 250000), datetime.datetime(2026, 1, 5, 10),
            datetime.datetime(2026, 7, 5, 10), None, None]
    try:
        for name in ("UTC", "Europe/Rome", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
            assert [r.t for r in rows.select("k", utc_naive(F.col("t")).alias("t")).orderBy("k").collect()] == want
            instant = spark.range(1).select(F.timestamp_seconds(F.lit(1767607200)).alias("t"))
            assert instant.select(utc_naive(F.col("t"), "timestamp")).first()[0] == want[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unreadable_time_is_an_error_record(spark):
    rows = grid(spark, {1: PAGE, 2: PAGE}, page=5).withColumn(
        "timestamp_utc", F.when(F.col("doc_id") == 2, "yesterday").otherwise(F.col("timestamp_utc"))
    )
    out = report(spark, rows)
    assert codes(out) == {(2, 5, "BAD_TIMESTAMP")}
    assert {r.timestamp_utc for r in out.facts.filter("doc_id = 2").collect()} == {None}
    typed = grid(spark, {1: PAGE}, page=5).withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp"))
    assert {str(r.timestamp_utc) for r in report(spark, typed).facts.collect()} == {"2026-01-05 10:00:00"}


def test_word_characters(spark):
    """Python's classes: letters, numbers of any kind and the low line; written out by hand."""
    names = {"abc_1": False, "é": False, unicodedata.normalize("NFD", "é"): True, "m²": False, "½": False, "a‿b": True, "a b": False,
             "a*": True, "a-b": True, "Ⅻ": False, "東京": False, "a b": False}
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.bad for r in rows.select("n", N.has_bad_char(F.col("n")).alias("bad")).collect()} == names
    tokens = {"ytd": True, "x ytd": True, "ytd_x": False, "ytd²": False, "ytdé": False, "YTD*": True, "ytd" + "́": True}
    rows = spark.createDataFrame([(n,) for n in tokens], "n string")
    assert {r.n: r.bad for r in rows.select("n", N.has_bad_token(F.col("n"), ["ytd"]).alias("bad")).collect()} == tokens


def test_ordinals_of_sparse_positions(spark):
    """A third of all rows in one group, positions far apart; no window spans a whole group."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40).alias("g"), (F.col("id") * 1_000_003 % 99_999_989).alias("p")
    )
    out = sparse_ordinals(rows, ["g"], "p")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("__part" in line for line in plan.splitlines() if "row_number" in line and "windowspecdefinition" in line)
    by: dict = {}
    for r in out.collect():
        by.setdefault(r.g, []).append((r.p, r.ordinal))
    assert all([o for _, o in sorted(x)] == list(range(len(x))) for x in by.values())


def test_quarantine_is_packed_by_bytes(spark, tmp_path):
    """Many parts in few files, many files for many bytes; the manifest tells where a part is."""
    from reportgrid.sinks import writers

    odd = [*PAGE[:9], ["YTD", *H1[1:6], "vs Bdg*", ""], *PAGE[10:]]
    problems = run(spark, {1: odd, 2: odd, 3: PAGE}).quarantine
    whole = writers.write_quarantine(problems, str(tmp_path / "q.csv"))
    assert whole == str(tmp_path / "q") and len(list((tmp_path / "q" / "cells").glob("part-*.csv"))) == 1
    split = writers.write_quarantine(problems, str(tmp_path / "small"), file_bytes=300)
    assert len(list((tmp_path / "small" / "cells").glob("part-*.csv"))) > 2
    read = [rows_of(writers.read_quarantine(spark, folder)) for folder in (whole, split)]
    assert read[0] == read[1] and len(read[0]) == 48 and {r[:3] for r in read[0]} == {(1, 5, 1), (2, 5, 1)}
    listed = writers.read_manifest(spark, split).collect()
    assert sum(r.n_cells for r in listed) == 48 and {(r.doc_id, r.part_idx) for r in listed} == {(1, 1), (2, 1)}
    second = writers.read_quarantine(spark, split, F.col("doc_id") == 2)
    assert rows_of(second) == [r for r in read[0] if r[0] == 2]
    assert len(second.inputFiles()) < len(list((tmp_path / "small" / "cells").glob("part-*.csv")))
    assert writers.read_quarantine(spark, split, F.col("doc_id") == 3).count() == 0
    none = writers.write_quarantine(problems.limit(0), str(tmp_path / "none"))
    assert writers.read_quarantine(spark, none).count() == 0 and writers.read_manifest(spark, none).count() == 0


def test_a_failed_run_leaves_the_old_facts(spark):
    from reportgrid.sinks import writers

    old = spark.range(40).selectExpr("CAST(id % 8 AS BIGINT) AS doc_id", "id AS v")
    writers.replace_documents(old, "facts_kept", shares=4)
    fails = spark.range(0, 40, 1, 4).selectExpr("CAST(id % 8 AS BIGINT) AS doc_id", "IF(id = 39, raise_error('midway'), id + 100) AS v")
    with pytest.raises(Exception, match="midway"):
        writers.replace_documents(fails, "facts_kept", shares=4)
    assert rows_of(spark.table("facts_kept").select("doc_id", "v")) == rows_of(old)
    new = spark.createDataFrame([(3, 1000), (None, 5)], "doc_id bigint, v bigint")
    for _ in range(2):  # the same run again changes nothing
        writers.replace_documents(new, "facts_kept", shares=4)
        found = rows_of(spark.table("facts_kept").select("doc_id", "v"))
        assert found == sorted([r for r in rows_of(old) if r[0] != 3] + [(3, 1000), (None, 5)], key=repr)


def test_profiles_of_batches_add_up(spark):
    """Types decided over two batches, of which only the second is profiled, are those of both together."""
    half = {k: [*PAGE[:5], data("Italy", k), ["Spain", "x", "y", "z", "", "", "", ""]] for k in range(1, 5)}
    first, second = ({k: v for k, v in half.items() if k % 2 == odd} for odd in (0, 1))
    whole = run(spark, half, CFG, strict_columns=False)
    before = run(spark, first, CFG, strict_columns=False)
    after = run(spark, second, CFG, strict_columns=False, history=before.profile)
    assert after.decisions == whole.decisions
    assert rows_of(after.profile.select(sorted(after.profile.columns))) == rows_of(whole.profile.select(sorted(whole.profile.columns)))
