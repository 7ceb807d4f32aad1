"""Work and memory of a task that must not grow faster than the input."""

import re

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from reportgrid.functions import numbers as X
from reportgrid.functions.cells import contains_keyword
from reportgrid.operators import parts as P
from reportgrid.operators import scans, splits, typing
from reportgrid.plans import queries as Q
from reportgrid.plans import views as V
from reportgrid.sinks import writers
from reportgrid.sources.staging import staged


def largest_method(df, capsys):
    """Bytes of the largest generated method; the JVM compiles none above 8,000."""
    capsys.readouterr()
    df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))


def test_facts_are_compiled(spark, sf_dir, capsys):
    assert largest_method(Q.run(spark, sf_dir).facts, capsys) < 8000


def test_report_grid_is_compiled(spark, sf_dir, capsys):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert largest_method(V.report_grid(spark, sf_dir)[0], capsys) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


TEXTS = ["1.234,5", "12,5%", " 7 %", "%", "", "1e5", "1e", ".", "-", "1d", "nan", "inf", " -Infinity%", " inf", " 12", "1 2", "x", None]


def test_what_a_parse_loses_is_told_without_it(spark):
    t = F.col("t")
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(
        "t", X.parse_percent(t).isNotNull().alias("p"), X.parse_eu_number(t).isNotNull().alias("n"),
        F.coalesce(X.is_percent(t), F.lit(False)).alias("is_p"), F.coalesce(X.is_eu_number(t), F.lit(False)).alias("is_n"),
    )
    for r in rows.collect():
        assert (r.is_p, r.is_n) == (r.p, r.n), r.t
    assert {r.t for r in rows.collect() if r.p} == {"12,5%", " 7 %", "1e5", "inf", " -Infinity%", " inf", " 12"}


def test_texts_are_cleaned_once_unfolded(spark):
    rows = spark.createDataFrame([("n.s.",), ("5",), (None,)], "a string")
    found = typing.column_profile(rows, typing.column_entries(["a"]), clean=X.null_sentinels).first()
    assert (found.n_values, found.lost_number) == (1, 0)


@pytest.mark.parametrize(("cells", "word", "want"), [
    (["grand", "total"], "grandtotal", False), (["a\nb"], "A\nB", True), ([], "", False), ([None], "", True), (None, "x", False),
])
def test_keywords_do_not_reach_over_cells(spark, cells, word, want):
    rows = spark.createDataFrame([(cells,)], "cells array<string>")
    assert rows.select(contains_keyword(F.col("cells"), [word])).first()[0] is want


def test_large_shares_are_dealt_to_several_tasks(spark):
    rows = spark.range(4000).select((F.col("id") % 3).alias("doc_id"), "id", F.lit(0).alias(writers.SHARE))
    sizes = writers._dealt(rows, 250).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) <= 1500


def test_cells_are_unfolded_by_as_many_tasks_as_the_text_asks_for(spark, sf_dir):
    size = spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    assert V.text_tasks(spark, sf_dir, 1000) == -(-size // 1000)
    rows = V.doc_rows(spark, sf_dir, 23)
    assert rows.rdd.getNumPartitions() == 23
    # cells meet their pages where they are
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    assert adaptive == "true"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = Q.grid_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert not [line for line in plan.split("\n") if "Exchange" in line and "col_idx" in line]


def test_split_points_come_from_the_flags_alone(spark, sf_dir, monkeypatch):
    wide = []
    monkeypatch.setattr(Q, "staged", lambda df: wide.extend(df.columns) or staged(df))
    Q.split_tables(spark, sf_dir)
    Q.split_cascade(spark, sf_dir)
    assert "ratio" in wide and "cells" not in wide


def test_pages_of_one_bucket_are_not_copied(spark, capsys):
    flags = spark.range(3000).select(
        F.floor(F.col("id") / 1000).alias("doc_id"), (F.col("id") % 1000).cast("int").alias("row_idx"),
        (F.col("id") % 10 / 10).alias("ratio"), (F.col("id") % 3 == 0).alias("header"), (F.col("id") % 7 == 0).alias("word0"),
    )
    found = [splits.flagged_candidates(flags, ["doc_id"], 1, sparse_threshold=0.8, carry=c) for c in (True, False)]
    assert rows_of(found[0]) == rows_of(found[1]) != []
    capsys.readouterr()
    found[1].explain(mode="extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
    assert "Generate explode" not in optimized.replace("Generate inline", "")


def test_edge_copies(spark):
    rows = spark.range(12).select(F.col("id").cast("int").alias("row_idx"))
    found = scans.with_neighbours(rows, "row_idx", 2, 1, 4)
    assert rows_of(found) == sorted(
        [(i, i // 4, True) for i in range(12)] + [(i, i // 4 + 1, False) for i in (2, 3, 6, 7, 10, 11)]
        + [(i, i // 4 - 1, False) for i in (4, 8)], key=repr)


def test_table_heads_are_found_in_one_pass(spark):
    rows = spark.createDataFrame(
        [(1, 1, i, 0, 0, 2, [f"a{i}", "b"]) for i in range(9)] + [(1, 1, 30, 1, 20, 2, ["x", "y"])],
        "doc_id bigint, page_num int, row_idx int, table_id int, table_start int, n_col int, cells array<string>",
    )
    heads = P.table_heads(rows, ["doc_id", "page_num"], ["n_col"], 3, 0.5, True)
    assert [(r.table_id, r.table_end, r.head) for r in heads.collect()] == [(0, 9, [["a0", "b"], ["a1", "b"]])]
    plan = heads._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_rows_of_cells_are_gathered_once(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(Q.report, "run_report", lambda spark, rows, *a, **b: seen.append(rows))
    Q.run_from_cells(spark, sf_dir)
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_profiled_once(spark, sf_dir):
    """The log of lost values reads the profile that decided the types, and moves no cell to the decisions."""
    result = Q.run(spark, sf_dir)
    plan = plan_text(result.lost_values)
    assert "Aggregate" not in plan and "Exchange hashpartitioning" not in plan
    assert "Aggregate" not in plan_text(result.profile)
    result.release()


def test_lost_values_by_a_frame_of_decisions(spark):
    rows = spark.createDataFrame([(1, "5%", "a"), (2, "x%", "5%"), (3, None, "")], "i int, p string, t string")
    decided = spark.createDataFrame([("p", "percent"), ("t", "text")], "name string, kind string")
    entries = typing.column_entries(["p", "t"])
    want = [("p", 2, "x%")]
    assert rows_of(typing.lost_values(rows, entries, decided, F.col("i"))) == want
    assert rows_of(typing.lost_values(rows, entries, {"p": "percent", "t": "text"}, F.col("i"))) == want
    # the pattern of a percentage is looked for in the cells that meet such a column, not below the join
    below = plan_text(typing.lost_values(rows, entries, decided, F.col("i"))).split("Join", 1)[1].split("\n", 1)[1]
    assert "RLIKE" not in below


def test_orders_are_dealt_once_to_the_report_grid(spark, sf_dir):
    """Sums, totals and both sides of a page follow from one exchange of the orders; one more gathers the pages."""
    plan = plan_text(V.report_grid(spark, sf_dir)[0])
    assert plan.count("Exchange hashpartitioning") <= 3 and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_only_rows_of_titles_are_looked_into(spark):
    rows = spark.createDataFrame([(1, 0, 0, 0, ["a", ""])], "k int, table_id int, table_start int, row_idx int, cells array<string>")
    plan = plan_text(P.table_heads(rows, ["k"], [], 1, 0.5, True))
    assert re.search(r"transform\(slice\(__head#\d+, 1, 1\)", plan)
