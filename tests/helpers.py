from pyspark.sql import functions as F


def row(*cells):
    return F.array(*[F.lit(c) for c in cells]).cast("array<string>")


def text(value):
    return F.lit(value).cast("string")


def grid(spark, cells_by_doc, page=1):
    """A rows frame from {doc_id: [cells, ...]}."""
    records = [
        (doc, page, i, list(cells), "run", "2026-01-05T10:00:00Z")
        for doc, rows in cells_by_doc.items()
        for i, cells in enumerate(rows)
    ]
    return spark.createDataFrame(
        records,
        "doc_id bigint, page_num int, row_idx int, cells array<string>, run_id string, timestamp_utc string",
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
