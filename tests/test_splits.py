import random

import pytest
from helpers import grid, rows_of
from pyspark.sql import functions as F

from reportgrid.config import ReportConfig
from reportgrid.operators import scans, splits, titles
from reportgrid.plans import queries as Q
from reportgrid.plans import views as V

TOKENS = ReportConfig().header_tokens
KEYS = ["doc_id", "page_num"]


def wide(*cells, width=8):
    return [*cells, *[""] * (width - len(cells))]


def dense(tag, width=8):
    return [tag, *[str(i) for i in range(1, width)]]


def test_titles(spark):
    rows = grid(spark, {1: [wide("Net sales", width=4), ["", "euro", "", ""], ["a", "b", "c", "1"]],
                        2: [wide(width=4), wide("x", width=4), ["a", "b", "c", "1"]]})
    one = titles.extract_titles(rows, KEYS, 1).orderBy("doc_id").collect()
    assert [(r.title, r.taken) for r in one] == [("NET SALES", 1), (None, 1)]
    three = titles.extract_titles(rows, KEYS, 3).orderBy("doc_id").collect()
    assert [(r.title, r.taken) for r in three] == [("NET SALES | EURO", 2), ("X", 2)]
    heads = titles.page_heads(rows, KEYS, [], 1, 0.5, True).orderBy("doc_id").collect()
    assert [(h.page_title, h.page_subtitle, h.first_row) for h in heads] == [("NET SALES", "EURO", 2), (None, "X", 2)]
    kept = titles.page_heads(rows, KEYS, [], 1, 0.5, False).orderBy("doc_id").first()
    assert (kept.page_title, kept.page_subtitle, kept.first_row) == ("NET SALES", "NET SALES", 0)


def points(spark, rows, keywords=(), **options):
    frame = grid(spark, {1: rows})
    found = splits.split_candidates(frame, KEYS, TOKENS, list(keywords), **options)
    return sorted((r["kind"], r["point"], r["hits"]) for r in found.collect())


@pytest.mark.parametrize("bucket_rows", [4, 1024])
def test_sparse_split(spark, bucket_rows):
    rows = [wide("T"), dense("a"), dense("b"), dense("c"), wide(), wide("Pharma"), dense("d")]
    assert points(spark, rows, bucket_rows=bucket_rows) == [(0, 5, 1)]
    rows[5] = wide()
    assert points(spark, rows, bucket_rows=bucket_rows) == []
    assert points(spark, rows, bucket_rows=bucket_rows, confirm_header=False) == [(0, 5, 1)]


HEAD = ["Act", "vs", "Bdg", "%"]


@pytest.mark.parametrize("bucket_rows", [4, 1024])
def test_keyword_split(spark, bucket_rows):
    rows = [HEAD, ["a", "1", "2", "3"], ["Total", "1", "2", "3"], HEAD, ["b", "4", "5", "6"]]

    def found(grid_rows):
        return points(spark, grid_rows, [["TOTAL"]], bucket_rows=bucket_rows)

    assert found(rows) == [(1, 3, 1)]
    assert found([*rows[:2], wide("Total", width=4), *rows[3:]]) == []
    assert found(rows[2:]) == [(1, 1, 1)]


def brute_thin(points, distance):
    kept, last = [], None
    for p in sorted(set(points)):
        if last is None or p - last >= distance:
            kept.append(p)
            last = p
    return kept


def test_thin_points(spark, monkeypatch):
    monkeypatch.setattr(splits, "CHUNK", 3)
    rng = random.Random(7)
    groups = {1: [2, 4, 8, 9, 20], 2: list(range(0, 400)), 3: [rng.randrange(600) for _ in range(200)], 4: [0, 500]}
    frame = spark.createDataFrame([(g, p) for g, ps in groups.items() for p in ps], "g int, point int")
    for bucket_rows in (8, 64, 1024):
        got = splits.thin_points(frame, ["g"], 5, bucket_rows).collect()
        for g, ps in groups.items():
            assert sorted(r.point for r in got if r.g == g) == brute_thin(ps, 5)
    assert brute_thin(groups[1], 5) == [2, 8, 20]


def test_choose_points(spark, monkeypatch):
    monkeypatch.setattr(splits, "CHUNK", 2)
    heads = spark.createDataFrame([(1, 22, 0), (2, 60, 0), (3, 100, 2), (4, 5, 0)], "doc_id int, n_rows long, first_row int")
    found = [(1, 1, p, 1) for p in (2, 4, 8, 9, 20)]
    found += [(2, 1, p, 1) for p in (2, 4, 8, 9, 20)]
    found += [(3, 2, p, 1) for p in range(3, 99)] + [(3, 1, 7, 2)]
    frame = spark.createDataFrame(found, "doc_id int, kind int, point int, hits long")
    for bucket_rows in (8, 1024):
        chosen = splits.choose_points(frame, heads, ["doc_id"], 5, bucket_rows)
        got = {}
        for r in chosen.collect():
            got.setdefault(r.doc_id, []).extend(r.points)
        assert {d: sorted(p) for d, p in got.items()} == {1: [2, 8, 20], 2: [2, 4, 8, 9, 20], 3: [7], 4: []}
    thick = frame.filter("kind = 2")
    for bucket_rows in (8, 1024):
        rows = splits.choose_points(thick, heads, ["doc_id"], 5, bucket_rows).filter("doc_id = 3").collect()
        assert sorted(p for r in rows for p in r.points) == brute_thin(range(3, 99), 5)


def test_running_does_not_depend_on_buckets(spark):
    rng = random.Random(3)
    records = [(g, p, rng.choice([None, None, None, p * 10])) for g in (1, 2) for p in range(200 if g == 1 else 3)]
    frame = spark.createDataFrame(records, "g int, p int, v int")
    results = []
    for bucket_rows in (5, 64, 1024):
        for backward in (False, True):
            out = scans.running(
                frame, ["g"], "p", last={"prev": F.col("v")}, total={"n": F.col("v").isNotNull().cast("int")},
                backward=backward, bucket_rows=bucket_rows,
            )
            results.append((backward, rows_of(out)))
    for backward in (False, True):
        same = [r for b, r in results if b == backward]
        assert same[0] == same[1] == same[2]
    last = {}
    for g, p, prev, n in sorted((g, p, prev, n) for g, p, _, prev, n in results[4][1]):
        assert prev == last.get(g)
        v = next(x for a, b, x in records if (a, b) == (g, p))
        last[g] = v if v is not None else last.get(g)


def test_runs(spark):
    frame = spark.createDataFrame([(1, p) for p in (0, 1, 2, 5, 9, 10)], "g int, p int")
    for bucket_rows in (2, 1024):
        assert rows_of(scans.group_runs(frame, ["g"], "p", bucket_rows)) == [(1, 0, 2), (1, 5, 5), (1, 9, 10)]


def test_tables_keep_all_rows_whatever_the_buckets(spark, sf_dir):
    rows = V.doc_rows(spark, sf_dir).cache()
    heads = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("first_row", F.lit(0))
    seen = []
    for bucket_rows in (16, 1024):
        found = splits.split_candidates(
            rows, ["doc_id"], V.DOC_TOKENS, [V.DOC_WORDS, V.DOC_WORDS_NEXT], bucket_rows=bucket_rows
        )
        chosen = splits.choose_points(found, heads, ["doc_id"], bucket_rows=bucket_rows)
        tables = splits.assign_tables(rows, splits.table_starts(chosen, ["doc_id"]), ["doc_id"], bucket_rows)
        seen.append(rows_of(tables.select("doc_id", "row_idx", "table_id", "table_start")))
    assert seen[0] == seen[1]
    assert len(seen[0]) == rows.count()
    rows.unpersist()
    assert "split_cascade" in Q.REGISTRY
