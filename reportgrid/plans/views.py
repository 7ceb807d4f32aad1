"""Grids and text columns that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportgrid.functions.cells import let
from reportgrid.sources.staging import partitions

DOC_WIDTH = 8
DOC_TOKENS = [
    "the", "and", "of", "to", "in", "on", "for", "with", "by", "is", "de", "la", "le", "les",
    "un", "el", "en", "der", "die", "das", "und",
]
DOC_WORDS = ["ment", "tion"]
DOC_WORDS_NEXT = ["the", "der"]

# First and second header rows that orders pick from, eight columns each.
FIRST_ROWS = [
    ["December", "Act", "Act", "Bdg", "vs Act", "", "vs Bdg", ""],
    ["December", "Act", "Act", "Bdg", "", "vs Act", "", "vs Bdg"],
    ["", "Act", "", "Bdg", "", "vs Act", "", "vs Bdg"],
    ["YTD", "", "Act", "Bdg", "vs Act", "", "vs Bdg", "nan"],
    ["Month", "", "", "Act", "", "", "Bdg", ""],
    ["Pharma", "Oncology", "x y", "", "", "", "", ""],
    ["", "", "YTD", "YTD", "Act", "Act", "", "Bdg"],
    ["December", "Act", "Bdg", "Act", "Bdg", "Act", "Bdg", "Act"],
]
SECOND_ROWS = [
    ["euro/000", "2025", "2024", "2025", "Eur", "%", "Eur", "%"],
    ["euro/000", "2025", "2024", "2025", "2024", "2025", "2024", ""],
    ["mn", "Act", "Bdg", "Act", "Bdg", "pct", "", "pct"],
    ["", "Eur", "Act", "%", "Eur", "Act", "%", "vs"],
    ["k€", "Eur", "%", "", "Eur", "%", "", "2025"],
    ["euro/000", "", "Act", "Bdg", "Eur", "%", "Eur", "%"],
]
SPARE_CELLS = ["", "Act", "%", "Eur", "Bdg"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of text that one task unfolds into cells, each a record of some hundred bytes that is sorted twice.
TASK_TEXT = 4 << 20


def text_tasks(spark: SparkSession, sf_dir: str, task_bytes: int = TASK_TEXT) -> int:
    """How many tasks unfold ``documents`` into cells: as many as the bytes of the texts ask for, not fewer than there are cores."""
    size = table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))


def doc_rows(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """``documents`` as pages: each line gives rows of eight words, all words of all lines. ``tasks`` states how many share them, dealt by page."""

    def line_rows(line: Column) -> Column:
        return let(
            F.split(line, " "),
            lambda words: F.transform(
                F.sequence(F.lit(0), F.floor((F.size(words) - 1) / DOC_WIDTH).cast("int")),
                lambda i: F.slice(words, i * DOC_WIDTH + 1, F.lit(DOC_WIDTH)),
            ),
        )

    rows = F.flatten(F.transform(F.split("text", "\n"), line_rows))
    padded = F.concat("c", F.array_repeat(F.lit(""), F.lit(DOC_WIDTH) - F.size("c")))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.col("doc_id").cast("int").alias("page_num"), "text")
        # what follows works page by page: dealt once, before the rows unfold
        .repartition(*([tasks, "doc_id", "page_num"] if tasks else ["doc_id"]))
        .select("doc_id", "page_num", F.posexplode(rows).alias("row_idx", "c"))
        .select(
            "doc_id",
            "page_num",
            "row_idx",
            padded.alias("cells"),
        )
    )


def noisy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_rows`` with white space, ``NaN`` and nulls mixed in."""

    def noise(cell: Column, i: Column) -> Column:
        turn = (F.col("row_idx") + i) % 7
        return (
            F.when(turn == 0, F.concat(F.lit("\t"), cell, F.lit("  ")))
            .when(turn == 1, F.lit(" NaN"))
            .when(turn == 2, F.lit(None).cast("string"))
            .when(turn == 3, F.lit("  "))
            .otherwise(cell)
        )

    return doc_rows(spark, sf_dir).withColumn("cells", F.transform("cells", noise))


def _literal_rows(rows: list[list[str]]) -> Column:
    return F.array(*[F.array(*[F.lit(c) for c in row]) for row in rows])


def header_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair of header rows per order, with one cell of the first row changed.

    Dealt to a stated number of tasks: what is read from headers costs far more than their few bytes let one think.
    """
    spare = F.element_at(
        F.array(*[F.lit(c) for c in SPARE_CELLS]), (F.col("o_custkey") % 5 + 1).cast("int")
    )
    row1 = F.element_at(_literal_rows(FIRST_ROWS), (F.col("o_orderkey") % 8 + 1).cast("int"))
    row2 = F.element_at(_literal_rows(SECOND_ROWS), (F.col("o_custkey") % 6 + 1).cast("int"))
    at = F.floor(F.col("o_orderkey") / 8) % 8
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(partitions(spark), "o_orderkey").select(
        F.col("o_orderkey").alias("id"),
        F.transform(row1, lambda c, i: F.when(i == at, spare).otherwise(c)).alias("row1"),
        row2.alias("row2"),
    )


def eu_text(cents: Column) -> Column:
    """Whole cents as ``1.234,56``."""
    size = F.abs(cents)
    whole = F.translate(F.format_number(F.floor(size / 100), 0), ",", ".")
    return F.concat(
        F.when(cents < 0, "-").otherwise(""), whole, F.lit(","), F.lpad((size % 100).cast("string"), 2, "0")
    )


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with amounts and shares as text; some cells hold markers or no number."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    used = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    return table(spark, sf_dir, "lineitem").select(*used).repartition("l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        F.when(key % 17 == 0, "n.s.").when(key % 19 == 0, "").otherwise(eu_text(cents)).alias("price"),
        F.when(key % 23 == 0, "x%")
        .when(key % 29 == 0, F.lit(None))
        .otherwise(F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")))
        .alias("discount"),
        F.when(key % 3 == 0, "n.a.%").otherwise(
            F.concat(F.round(F.col("l_tax") * 1000).cast("int").cast("string"), F.lit(",5 %"))
        ).alias("tax"),
        F.when(key % 2 == 0, F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("part"),
        F.when(key % 31 == 0, "null").when(key % 37 == 0, " n.s.").otherwise(F.col("l_returnflag")).alias("flag"),
        F.lit(None).cast("string").alias("blank"),
    )


SALES_COLUMNS = ["price", "discount", "tax", "part", "flag", "blank"]
ITALIAN = [
    "gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto",
    "settembre", "ottobre", "novembre", "dicembre",
]


def period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with a period label per order."""
    day, turn = F.col("o_orderdate"), F.col("o_orderkey") % 7
    name = F.date_format(day, "MMMM")
    label = (
        F.when(turn == 0, F.lit("YTD"))
        .when(turn == 1, F.concat(F.date_format(day, "MMM"), F.lit("-2024")))
        .when(turn == 2, F.element_at(F.array(*[F.lit(m) for m in ITALIAN]), F.month(day)))
        .when(turn == 3, F.lit(None).cast("string"))
        .when(turn == 4, F.concat(F.lit(" "), F.upper(name), F.lit(" ")))
        .when(turn == 5, F.concat(F.lit("Q"), F.quarter(day).cast("string")))
        .otherwise(F.concat(name, F.lit(" /x")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", label.alias("period_agg")
    )


def part_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` per brand, the type at every fifth key in place of the name."""
    return table(spark, sf_dir, "part").select(
        "p_brand",
        "p_partkey",
        F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(F.col("p_name")).alias("item"),
    )


HEAD_1 = ["Act", "Act", "Bdg", "vs Act", "", "vs Bdg", ""]
HEAD_2 = ["euro/000", "2025", "2024", "2025", "Eur", "%", "Eur", "%"]


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-cent sums per customer, side (0: finished orders, 1: open ones) and line.

    Lines 1 to 5 are the order priorities, line 9 is the total, present on both sides. The orders are dealt by customer once, before
    they are added up and again to the totals, which then takes no further exchange.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    late = F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("side"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("line"),
        F.when(late, cents).otherwise(0).alias("a25"),
        F.when(late, 0).otherwise(cents).alias("a24"),
    )
    empty_totals = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("side"),
        F.lit(9).alias("line"),
        F.lit(0).cast("bigint").alias("a25"),
        F.lit(0).cast("bigint").alias("a24"),
    )

    def added(frame: DataFrame) -> DataFrame:
        return frame.groupBy("doc_id", "side", "line").agg(F.sum("a25").alias("a25"), F.sum("a24").alias("a24"))

    lines = added(orders.unionByName(empty_totals).repartition("doc_id"))
    # an empty total counts twice in the total: it is zero
    return added(lines.withColumn("line", F.explode(F.array("line", F.lit(9)))))


def _line_label() -> Column:
    # lines 2 and 4 carry the names of groups
    names = F.array(*[F.lit(x) for x in ["URGENT", "Pharma", "MEDIUM", "Diagnostic", "LOW"]])
    return F.when(F.col("line") == 9, F.lit("TOTAL")).otherwise(F.element_at(names, F.col("line")))


def _half_row(label: Column, a25: Column, a24: Column) -> Column:
    doc = F.col("doc_id")
    pct = F.concat((a25 % 97 - 48).cast("string"), F.lit("%"))
    odd = (doc % 20 == 2) & (F.col("line") == 1)
    # one expression over the list of amounts: one for each makes more generated code than the JVM compiles
    amounts = F.transform(F.array(a25, a24, a25 + a24, a25 - a24), eu_text)
    last = F.when(doc % 20 == 18, "n.s.").otherwise(eu_text(-a24))
    share = F.concat((a24 % 89).cast("string"), F.lit("%"))
    return F.concat(F.array(label), amounts, F.array(F.when(odd, "n.a.%").otherwise(pct), last, share))


def _cells(*texts: Column | str, width: int) -> Column:
    row = [F.lit(t) if isinstance(t, str) else t for t in texts]
    return F.array(*row, *[F.lit("")] * (width - len(row))).cast("array<string>")


def report_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One report page per customer, and the page list.

    Customers with an even key have two stacked tables of width 8, the others one page of
    width 16 with two tables side by side. Some pages have faults: a missing header, repeated
    or odd names, too few columns. Returns ``(rows, page_config)``.
    """
    doc = F.col("doc_id")
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("doc_id"), "c_name", "n_name", "c_mktsegment")
    )
    config = customers.select(
        "doc_id",
        F.lit(0).alias("page_pos"),
        (doc % 80).cast("int").alias("page_num"),
        F.when(doc % 2 == 0, 8).otherwise(16).alias("n_col"),
    )
    fault = doc % 20
    period = [
        F.when(doc % 7 == 0, "YTD").otherwise("December"),
        F.when(doc % 7 == 0, "December").otherwise("YTD"),
    ]

    # rows that do not depend on the amounts, keyed by (side, rank) inside the page
    last_pair = F.when(fault == 10, "vs Bdg*").when(fault == 14, "Delta").otherwise("vs Bdg")
    head_1 = [
        _cells(period[0], *HEAD_1, width=8),
        F.when(fault == 16, _cells(period[1], "", "Act", "Bdg", "vs Act", "", "vs Bdg", width=8)).otherwise(
            _cells(period[1], "Act", "Act", "Bdg", "vs Act", "", last_pair, width=8)
        ),
    ]
    head_2 = [
        _cells(*HEAD_2, width=8),
        F.when(fault == 16, _cells("euro/000", "", "2025", "2025", "Eur", "%", "Eur", "%", width=8))
        .when(fault == 8, _cells("euro/000", "2025", "2025", "2025", "Eur", "%", "Eur", "%", width=8))
        .otherwise(_cells(*HEAD_2, width=8)),
    ]
    def fixed(side: int, rank: int, cells: Column, present: Column) -> Column:
        return F.when(
            present, F.struct(F.lit(side).alias("side"), F.lit(rank).alias("rank"), cells.alias("cells"))
        )

    narrow_page, wide_page = doc % 2 == 0, doc % 2 == 1
    frame = customers.select(
        "doc_id",
        F.inline(
            F.array_compact(
                F.array(
                    fixed(0, -9, _cells(F.col("c_name"), width=8), narrow_page),
                    fixed(0, -8, _cells("", F.col("n_name"), width=8), narrow_page),
                    fixed(0, -7, _cells(F.col("c_mktsegment"), width=8), narrow_page),
                    fixed(0, -3, head_1[0], narrow_page & (fault != 6)),
                    fixed(0, -2, head_2[0], narrow_page & (fault != 6)),
                    fixed(1, -7, _cells("Oncology", width=8), narrow_page & ((doc % 3 > 0) | (fault == 4))),
                    fixed(1, -3, head_1[1], narrow_page & (fault != 4)),
                    fixed(1, -2, head_2[1], narrow_page & (fault != 4)),
                    fixed(0, -9, _cells(F.col("c_name"), width=16), wide_page),
                    fixed(0, -8, _cells("", F.col("n_name"), width=16), wide_page),
                    fixed(0, -3, F.concat(head_1[0], _cells(period[1], *HEAD_1, width=8)), wide_page),
                    fixed(0, -2, F.concat(_cells(*HEAD_2, width=8), _cells(*HEAD_2, width=8)), wide_page),
                )
            )
        ),
    )

    label = _line_label()
    measures = _measures(spark, sf_dir)
    half = F.col("half")
    coded = F.when(F.col("line") % 2 == 0, "HI").otherwise("LO")
    with_code = F.concat(
        F.array(label, coded), F.slice(half, 2, 1), F.slice(half, 4, 5)
    )
    stacked = measures.filter(narrow_page).withColumn("half", _half_row(label, F.col("a25"), F.col("a24"))).select(
        "doc_id",
        "side",
        F.col("line").alias("rank"),
        F.when((fault == 16) & (F.col("side") == 1), with_code).otherwise(half).alias("cells"),
    )
    blank_half = F.concat(F.array(label), F.array_repeat(F.lit(""), 7))
    # a page has one record per line and side: both sides' sums come into one, of which the rows are made
    amounts = [F.max(F.when(F.col("side") == k, F.col(c))).alias(f"{c}_{k}") for k in (0, 1) for c in ("a25", "a24")]
    held = [F.count_if(F.col("side") == k).alias(f"held_{k}") for k in (0, 1)]
    sums = measures.filter(wide_page).groupBy("doc_id", "line").agg(*amounts, *held)
    left, right = (
        F.when(F.col(f"held_{k}") > 0, _half_row(label, F.col(f"a25_{k}"), F.col(f"a24_{k}"))) for k in (0, 1)
    )
    sides = sums.select("doc_id", "line", left.alias("left"), right.alias("right"))
    beside = sides.select(
        "doc_id",
        F.lit(0).alias("side"),
        F.col("line").alias("rank"),
        F.concat(F.coalesce("left", blank_half), F.coalesce("right", blank_half)).alias("cells"),
    )
    placed = frame.unionByName(stacked).unionByName(beside)

    # a page has fewer than thirty rows: they are numbered in one window
    in_order = Window.partitionBy("doc_id").orderBy("side", "rank", "cells")
    cells = F.when(fault == 12, F.slice("cells", 1, 7)).otherwise(F.col("cells"))
    rows = placed.withColumn("row_idx", F.row_number().over(in_order) - 1).select(
        "doc_id",
        (doc % 80).cast("int").alias("page_num"),
        "row_idx",
        cells.alias("cells"),
        F.concat(F.lit("run-"), (doc % 4).cast("string")).alias("run_id"),
        F.concat(F.lit("2026-01-05T10:00:0"), (doc % 10).cast("string"), F.lit("Z")).alias("timestamp_utc"),
    )
    return rows, config
