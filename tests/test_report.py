import json
import re
from dataclasses import replace

import pytest
from helpers import grid, rows_of
from pyspark.sql import functions as F

from reportgrid.config import ReportConfig
from reportgrid.operators import splits
from reportgrid.plans import report as R
from reportgrid.plans import views as V
from reportgrid.sinks import writers
from reportgrid.sources import grid as G
from reportgrid.sources import staging

AS_OF = "2026-03-15"
H1 = ["December", "Act", "Act", "Bdg", "vs Act", "", "vs Bdg", ""]
H2 = ["euro/000", "2025", "2024", "2025", "Eur", "%", "Eur", "%"]


def wide(*cells):
    return [*cells, *[""] * (8 - len(cells))]


def data(label, n):
    return [label, f"{n}.000,5", "n.s.", "2", "-1", "5%", "3", "-7,5%"]


PAGE = [
    wide("Net sales"), wide("", "euro"), wide("Europe"), H1, H2, data("Pharma", 1), data("Italy", 2),
    data("TOTAL", 3), wide("Oncology"), ["YTD", *H1[1:]], H2, data("Spain", 4), data("Oncology", 5), data("TOTAL", 6),
]
FINAL = [c for c in ReportConfig().final_columns if c not in ("item_agg_2", "eur_delta", "pct_delta")]


def run(spark, docs, cfg=None, **options):
    cfg = cfg or ReportConfig(final_columns=FINAL)
    return R.run_report(spark, grid(spark, docs, page=5), {5: 8}, cfg, F.lit(AS_OF).cast("date"), **options)


def test_two_tables(spark):
    out = run(spark, {1: PAGE})
    facts = out.facts.orderBy("table_id", "2025_act").collect()
    assert [(f.page_title, f.page_subtitle, f.page_subtitle_1, f.table_id, f.period_desc, str(f.period_start), f.item_agg_1, f.item_agg) for f in facts] == [
        ("NET SALES", "EURO", "EUROPE", 0, "MONTH", "2025-12-01", "Pharma", "Pharma"),
        ("NET SALES", "EURO", "EUROPE", 0, "MONTH", "2025-12-01", "Pharma", "Italy"),
        ("NET SALES", "EURO", "EUROPE", 0, "MONTH", "2025-12-01", "Pharma", "TOTAL"),
        ("NET SALES", "EURO", "ONCOLOGY", 1, "YTD", "2025-12-01", None, "Spain"),
        ("NET SALES", "EURO", "ONCOLOGY", 1, "YTD", "2025-12-01", "Oncology", "Oncology"),
        ("NET SALES", "EURO", "ONCOLOGY", 1, "YTD", "2025-12-01", "Oncology", "TOTAL"),
    ]
    first = facts[0]
    assert (first["2025_act"], first["2024_act"], first["pct_vs_act"], first["pct_vs_bdg"]) == (1000.5, None, 0.05, -0.075)
    assert (first.capitolo, first.sottocapitolo, str(first.timestamp_utc)) == ("PHARMA", "OVERVIEW", "2026-01-05 10:00:00")
    assert out.report().first().asDict() == {
        "facts_rows": 6, "facts_columns": len(FINAL) + 1, "qc_summary_rows": 2, "quarantine_parts": 0, "errors_rows": 0,
    }


def test_rules_for_failing_pages(spark):
    headless = [*PAGE[:9], *PAGE[11:]]
    broken = [*PAGE[:3], *PAGE[5:]]
    odd = [*PAGE[:9], ["YTD", *H1[1:6], "vs Bdg*", ""], *PAGE[10:]]
    narrow = [r[:7] for r in PAGE]
    out = run(spark, {1: PAGE, 2: headless, 3: broken, 4: odd, 5: narrow})
    counts = {r.doc_id: r["count"] for r in out.facts.groupBy("doc_id").count().collect()}
    assert counts == {1: 6, 2: 6, 4: 3}
    second = out.facts.filter("doc_id = 2 and table_id = 1").collect()
    assert {(r.item_agg, r["2025_act"], r.period_desc) for r in second} == {(None, None, None)}
    assert {r.item_agg_1 for r in second} == {None, "Oncology"}
    errors = {(r.doc_id, r.e_des.split(":")[0]) for r in out.errors.collect()}
    assert errors == {(3, "NO_HEADER"), (4, "BAD_CHARS_IN_COLNAMES"), (5, "NARROW_GRID")}
    assert out.quarantine.count() == 3
    kept = run(spark, {2: headless}, ReportConfig(final_columns=FINAL, fallback_keep_data=True))
    assert kept.facts.filter("table_id = 1 and item_agg is not null").count() == 3


def test_bucket_size_does_not_matter(spark):
    results = []
    for bucket_rows in (5, 1024):
        out = run(spark, {1: PAGE, 2: [*PAGE[:9], *PAGE[11:]]}, ReportConfig(final_columns=FINAL, bucket_rows=bucket_rows))
        results.append((rows_of(out.facts), rows_of(out.qc_summary), rows_of(out.lost_values)))
    assert results[0] == results[1]


def test_missing_column_and_empty_union(spark):
    with pytest.raises(ValueError, match="item_agg_2"):
        run(spark, {1: PAGE}, ReportConfig())
    with pytest.raises(ValueError, match="no part is left"):
        run(spark, {1: [*PAGE[:3], *PAGE[5:]]})


def test_decisions_are_reused(spark):
    first = run(spark, {1: PAGE})
    again = run(spark, {1: PAGE}, decisions=first.decisions)
    assert again.facts.schema == first.facts.schema
    assert rows_of(again.facts) == rows_of(first.facts)


def test_missing_page_is_reported(spark):
    rows = grid(spark, {1: PAGE}, page=5)
    out = R.run_report(spark, rows, {5: 8, 6: 9}, ReportConfig(final_columns=FINAL), F.lit(AS_OF).cast("date"))
    assert [(r.page, r.n_col) for r in out.errors.collect()] == [(6, 9)]


def test_sinks(spark, tmp_path):
    odd = [*PAGE[:9], ["YTD", *H1[1:6], "vs Bdg*", ""], *PAGE[10:]]
    out = run(spark, {1: PAGE, 2: odd})
    paths = writers.OutputPaths.in_folder(str(tmp_path), "DEC", table="facts_table")
    written = writers.write_outputs(out, paths)
    assert written == {"table": 9, "facts": 9, "qc_summary": 4, "errors": 1, "lost_values": 0, "quarantine": 1}
    assert spark.table("facts_table").count() == 9
    assert spark.read.option("header", True).csv(paths.facts).count() == 9
    problem = writers.read_quarantine(spark, paths.quarantine)
    assert problem.select("page_num", "part_idx").distinct().count() == 1 and problem.count() == 24
    text = next((tmp_path / "run_report_DEC.json").glob("part-*.json")).read_text()
    said = json.loads(text)
    assert said["facts_rows"] == 9 and said["outputs"][0] == {"output": "table", "forecast": 9, "written": 9, "agrees": True}
    assert {o["output"]: o.get("agrees") for o in said["outputs"]} == dict.fromkeys(written, True) | {"lost_values": None}
    for name in ("x.parquet", "x.json"):
        writers.write_file(out.qc_summary, str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "x.parquet")).count() == 4
    with pytest.warns(UserWarning):
        assert writers.write_file(out.qc_summary, str(tmp_path / "y.xlsx")).endswith("y.csv")


def test_sources(spark, tmp_path):
    cells = spark.createDataFrame(
        [(1, 5, 0, 1, "b"), (1, 5, 0, 0, "a"), (1, 5, 0, 3, "extra"), (1, 5, 1, 2, "c"), (1, 9, 0, 0, "z")],
        "doc_id bigint, page_num int, row_idx int, col_idx int, value string",
    )
    config = G.page_config(spark, {5: 3})
    rows = G.rows_from_cells(cells, config)
    assert sorted((r.row_idx, r.cells) for r in rows.collect()) == [(0, ["a", "b", None]), (1, [None, None, "c"])]
    with pytest.raises(ValueError):
        G.page_config(spark, {5: 0})
    grid(spark, {1: PAGE}).write.json(str(tmp_path / "rows"))
    assert G.read_rows(spark, str(tmp_path / "rows"), "json").count() == len(PAGE)


def test_config_from_nested_settings(tmp_path):
    raw = {
        "header_tokens": ["vs"], "title": {"max_title_rows": 2, "drop_row": False},
        "capitoli": {"A": {"page": [0, 1], "sottocapitoli": {"B": [2, 3]}}}, "year_ref": 2024, "unknown": 1,
    }
    path = tmp_path / "c.json"
    path.write_text(json.dumps(raw))
    cfg = ReportConfig.from_json(path)
    assert (cfg.max_title_rows, cfg.drop_title_rows, cfg.chapters, cfg.year_ref) == (2, False, {"A": {"B": (2, 3)}}, 2024)
    assert ReportConfig.january().header_tokens[-1] == "january"
    assert replace(cfg, period_placeholder="PER").rules()[-1]["placeholder"] == "PER"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_and_no_page_wide_windows(spark, sf_dir):
    rows, config = V.report_grid(spark, sf_dir)
    cfg = ReportConfig()
    fitted = G.configured_rows(rows, config)
    heads = R.find_pages(fitted, cfg)
    found = splits.split_candidates(fitted, R.PAGE, cfg.header_tokens, [cfg.keywords_primary])
    starts = splits.table_starts(splits.choose_points(found, heads, R.PAGE), R.PAGE)
    tables = splits.assign_tables(fitted, starts, R.PAGE)
    plan = plan_of(tables)
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    over_rows = [w for w in plan.splitlines() if " Window [" in w and "row_idx" in w]
    assert over_rows and all("bucket" in w for w in over_rows)


def test_a_page_with_most_rows_spreads(spark):
    """One long page among short ones: windows work on its buckets, results stay whole."""
    long_page = [*PAGE[:5], *[data(f"line {i}", 1) for i in range(3000)], *PAGE[7:]]
    cfg = ReportConfig(final_columns=FINAL, bucket_rows=256)
    out = run(spark, {1: long_page, 2: PAGE, 3: PAGE}, cfg)
    counts = {r.doc_id: r["count"] for r in out.facts.groupBy("doc_id").count().collect()}
    assert counts == {1: 3004, 2: 6, 3: 6}
    last = out.facts.filter("doc_id = 1 and table_id = 1").collect()
    assert {(r.page_subtitle_1, r.period_desc) for r in last} == {("ONCOLOGY", "YTD")}


def test_staged_rows_need_no_shuffle(spark):
    staged = G.stage_rows(grid(spark, {1: PAGE, 2: PAGE}, page=5), G.page_config(spark, {5: 8}))
    counted = staged.groupBy("doc_id", "page_num", "bucket").agg(F.max("row_idx"))
    assert "Exchange" not in plan_of(counted) and counted.count() == 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]


def exchanges_of_rows(plan):
    """The exchanges of a formatted plan that move rows with their cells."""
    nodes = plan.split("\n\n")
    return [n for n in nodes if " Exchange" in n.split("\n")[0] and any("cells#" in line for line in n.split("\n") if line.startswith("Input"))]


def plans_written(monkeypatch, *modules):
    """The plans of all frames that are staged, as they are before they run."""
    plans = []
    for module in modules:
        for name in ("staged", "staged_by"):
            make = getattr(module, name, None)
            if make:

                def seen(df, *args, make=make, **options):
                    plans.append(df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))
                    return make(df, *args, **options)

                monkeypatch.setattr(module, name, seen)
    return plans


@pytest.mark.parametrize("pages", ["listed", "by document"])
def test_rows_move_once(spark, sf_dir, monkeypatch, pages):
    """Over the whole job one exchange holds rows with their cells, broadcasts or not."""
    rows, config = V.report_grid(spark, sf_dir)
    rows = staging.staged(rows)
    if pages == "listed":
        rows, config = rows.withColumn("page_num", F.lit(3)), {3: 8}
    monkeypatch.setattr(G.staging, "staged_by", staging.staged_by)
    plans = plans_written(monkeypatch, R, splits)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = R.run_report(spark, rows, config, ReportConfig(), F.lit(AS_OF).cast("date"), strict_columns=False)
        plans.append(out.facts._sc._jvm.PythonSQLUtils.explainString(out.facts._jdf.queryExecution(), "formatted"))
        quarantine = out.quarantine._sc._jvm.PythonSQLUtils.explainString(out.quarantine._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) > 6
    assert sum(len(exchanges_of_rows(plan)) for plan in plans) == 1
    assert not exchanges_of_rows(quarantine)


def test_a_run_gives_its_folders_back(spark):
    out = run(spark, {1: PAGE})
    assert out.facts.count() == 6 and out.folders
    out.release()
    assert not out.folders
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound|FILE_NOT_EXIST"):
        out.rows.withColumn("again", F.lit(1)).count()


def cells_of(rows, keep=("run_id", "timestamp_utc")):
    cells = rows.select("doc_id", "page_num", "row_idx", *keep, F.posexplode("cells").alias("col_idx", "value"))
    return cells.filter("value <> ''"), G.page_extents(rows, keep)


def test_page_extents_tell_narrow_pages_and_blank_rows(spark):
    keep = ("run_id", "timestamp_utc")
    narrow, tail = [r[:7] for r in PAGE], [*PAGE, wide(), wide()]
    rows = grid(spark, {1: PAGE, 2: narrow, 3: tail, 4: [wide(), wide()], 5: [r + ["more"] for r in PAGE]}, page=5)
    cells, extents = cells_of(rows)
    for bucket_rows in (1024, 5):
        again = G.rows_from_cells(cells, G.page_config(spark, {5: 8}), keep, extents, bucket_rows)
        want = rows.select("doc_id", "row_idx", F.transform(F.slice("cells", 1, 8), lambda c: F.nullif(c, F.lit(""))).alias("cells"))
        assert rows_of(again.select("doc_id", "row_idx", "cells")) == rows_of(want)
        assert again.filter("run_id IS NULL OR timestamp_utc IS NULL").count() == 0
    out = R.run_report(spark, again, {5: 8}, ReportConfig(final_columns=FINAL), F.lit(AS_OF).cast("date"))
    assert {(r.doc_id, r.e_des.split(":")[0]) for r in out.errors.collect()} == {(2, "NARROW_GRID")}
    beyond = cells.withColumn("row_idx", F.col("row_idx") + 1000)
    assert G.rows_from_cells(beyond, G.page_config(spark, {5: 8}), keep, extents).filter("size(filter(cells, c -> c IS NOT NULL)) > 0").count() == 0
    assert G.rows_from_cells(cells, G.page_config(spark, {5: 8}), keep, extents.limit(0)).count() == 0


def test_titles_and_split_points_come_from_the_flags(spark, sf_dir, monkeypatch):
    """After the rows are laid out their cells are read three times: for flags, table heads and facts."""
    rows, config = V.report_grid(spark, sf_dir)
    rows = staging.staged(rows)
    plans = plans_written(monkeypatch, R, splits)
    R.run_report(spark, rows, config, ReportConfig(), F.lit(AS_OF).cast("date"), strict_columns=False)
    reads = [re.findall(r"ReadSchema: (.*)", plan) for plan in plans]
    reads = [[s for s in schemas if "cells:array<string>" in s] for schemas in reads]
    assert [len(schemas) for schemas in reads if schemas] == [1, 1, 1, 1], reads  # the layout itself, flags, table heads, facts


@pytest.mark.parametrize("most", [0, 1, 2])
@pytest.mark.parametrize("drop", [True, False])
def test_flags_serve_in_place_of_cells(spark, most, drop):
    """Titles and split points from the flags equal those from the cells; blank, null and short pages included."""
    pages = {1: PAGE, 2: [wide(), wide("x"), *PAGE], 3: [wide()], 4: [[None] * 8, *PAGE[:2]], 5: [data("a", 1)]}
    rows = G.configured_rows(grid(spark, pages, page=5), G.page_config(spark, {5: 8}))
    cfg = ReportConfig(max_title_rows=most, drop_title_rows=drop)
    flags = staging.staged(R.flag_rows(rows, cfg))
    assert "cells" not in flags.columns
    heads, want = R.find_pages(flags, cfg), R.find_pages(rows, cfg)
    assert rows_of(heads) == rows_of(want) and heads.count() == 5
    words = [cfg.keywords_primary, cfg.keywords_fallback]
    for bucket_rows in (1024, 5):
        found = splits.flagged_candidates(flags, R.PAGE, 2, bucket_rows=bucket_rows)
        assert rows_of(found) == rows_of(splits.split_candidates(rows, R.PAGE, cfg.header_tokens, words, bucket_rows=bucket_rows))
