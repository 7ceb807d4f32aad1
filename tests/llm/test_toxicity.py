import random
import time

import pytest

from reportgrid.llm import toxicity


def slow_segments(scores):
    """Ruzzo and Tompa by their definition: the best segment, then the same left and right of it."""

    def best(low, high):
        top = None
        for i in range(low, high):
            total = 0
            for j in range(i, high):
                total += scores[j]
                if total > 1e-12 and (top is None or total > top[0] + 1e-9):
                    top = total, i, j
        return top

    def walk(low, high):
        top = best(low, high)
        if not top:
            return []
        total, i, j = top
        return walk(low, i) + [(i, j, total)] + walk(j + 1, high)

    return walk(0, len(scores))


def test_segments():
    rng = random.Random(11)
    for _ in range(200):
        scores = [rng.choice([-0.5, -0.5, -0.5, rng.uniform(-2, 3)]) for _ in range(rng.randint(0, 25))]
        told = [(k, s) for k, s in enumerate(scores) if s != -0.5]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(told, 0.5)]
        assert got == [(a, b, round(s, 6)) for a, b, s in slow_segments(scores)]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.judge(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() > 0.95
    assert rows[rows.toxic == 0].predicted.mean() < 0.02


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    calm = [f"word{k}" for k in range(300)]
    rows, marks = [], []
    for k in range(300):
        words = [rng.choice(calm) for _ in range(40)]
        if k % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(40), rng.choice(["nasty", "Vile!", "grimling"]))
        rows.append((k, " ".join(words)))
        marks.append((k, int(k % 4 == 0)))
    marks += [(None, 1), (5, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_edges_of_the_table(labelled, edge_docs, no_docs):
    docs, labels = labelled
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    rows = toxicity.add_score(edge_docs, model).collect()
    assert len(rows) == 12 and rows[0].key == "x" and rows[0].asDict().keys() >= set(edge_docs.columns)
    assert all(0 <= r.toxicity < 0.5 for r in rows)
    empty = [r.toxicity for r in rows if not (r.text or "").strip()]
    assert len(set(empty)) == 1
    assert toxicity.add_score(no_docs, model).count() == 0
    assert toxicity.judge(edge_docs, labels).count() == 12
    assert toxicity.judge(no_docs, labels).count() == 0


def test_passage_is_found(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    text = "word1 " * 500 + "nasty vile nasty grimling vile " + "word2 " * 500
    row = toxicity.add_score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.toxicity > 0.5
    assert [(p.first, p.last) for p in row.passages] == [(500, 504)]


def test_labels_of_one_class(spark, labelled):
    docs, labels = labelled
    for toxic, score in ((0, 0.0), (1, 1.0)):
        only = labels.filter(f"toxic = {toxic}")
        assert {r.score for r in toxicity.judge(docs, only).collect()} == {score}
    assert {r.score for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0.0}


def test_labels_of_held_out_rows_are_not_read(labelled):
    docs, labels = labelled
    held = toxicity.held_out(labels.doc_id)
    flipped = labels.withColumn("toxic", toxicity.F.when(held, 1 - labels.toxic).otherwise(labels.toxic))
    first, second = (
        {r.doc_id: r.score for r in toxicity.judge(docs, x).collect()} for x in (labels, flipped)
    )
    assert first == pytest.approx(second)


@pytest.mark.parametrize("first", [0.3, 1e6])
def test_segments_in_linear_time(first):
    """Sums that fall all the way, with nothing smaller before them or with one large segment that is held before."""
    n = 30_000
    told = [(0, first), *((4 * k, 0.6) for k in range(1, n))]
    before = time.process_time()
    got = toxicity.segments(told, 0.5)
    assert time.process_time() - before < 2
    assert [(a, b) for a, b, _ in got] == [(4 * k, 4 * k) for k in range(n)]
