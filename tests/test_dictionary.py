import pytest
from pyspark.sql import functions as F

from reportgrid.operators import parts as P
from reportgrid.operators.dictionary import by_distinct, number_of
from reportgrid.plans import views as V

VALUES = [(1, ["a", "b"]), (2, ["ab"]), (3, ["a", "b"]), (4, None), (5, []), (6, ["a", None]), (7, [None, "a"]), (8, ["a"])]


@pytest.fixture
def lists(spark):
    return spark.createDataFrame(VALUES, "id int, x array<string>")


def joined(frame):
    return {"y": F.concat_ws("+", F.transform("x", lambda v: F.coalesce(v, F.lit("-"))))}


def test_results_come_back_to_each_record(lists):
    out = {r.id: r.y for r in by_distinct(lists, {"x": F.col("x")}, joined, 1.0).collect()}
    assert out == {k: "" if v is None else "+".join(i or "-" for i in v) for k, v in VALUES}
    some = by_distinct(lists, {"x": F.col("x")}, joined, 1.0, F.col("id") > 2)
    assert {r.id: r.y for r in some.collect() if r.y is None} == {1: None, 2: None}
    assert by_distinct(lists.limit(0), {"x": F.col("x")}, joined, 1.0).count() == 0


def test_numbers_drawn_twice(lists):
    """Two values with one number: the next draw is taken, or the job stops."""
    seen = []

    def poor(values, draw):
        seen.append(draw)
        return F.lit(7).cast("long") if draw < 2 else number_of(values, draw)

    out = by_distinct(lists, {"x": F.col("x")}, joined, 1.0, number=poor)
    assert seen == [0, 1, 2] and {r.id: r.y for r in out.collect()}[6] == "a+-"
    with pytest.raises(ValueError, match="one number"):
        by_distinct(lists, {"x": F.col("x")}, joined, 1.0, number=lambda values, draw: F.lit(7).cast("long"))


def test_headers_are_joined_by_number_in_many_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("reportgrid.operators.dictionary.TASK_COST", 50.0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = V.header_pairs(spark, sf_dir)
        out = P.infer_headers(pairs, F.col("row1"), F.col("row2"), ["act"], [])
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        join = next(n for n in plan.split("\n\n") if ") SortMergeJoin" in n.split("\n")[0])
        assert "__value" in join and "row1" not in join
        assert "REPARTITION_BY_NUM" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
