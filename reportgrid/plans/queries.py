"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.config import CHAPTERS, ReportConfig
from reportgrid.functions import cells as C
from reportgrid.functions import headers as H
from reportgrid.functions import months as M
from reportgrid.functions import names as N
from reportgrid.functions import numbers as X
from reportgrid.operators import enrich, parts as P, projection, quality, scans, splits, titles, typing
from reportgrid.plans import report
from reportgrid.plans import views as V
from reportgrid.sinks import writers
from reportgrid.sources import grid
from reportgrid.sources.staging import new_folder, staged

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
PAGE = ["doc_id", "page_num"]
CFG = ReportConfig()
AS_OF = "2026-03-15"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def joined(cells: Column) -> Column:
    """An array as one text, nulls shown."""
    return F.array_join(cells, "|", "∅")


def _numbers(values: Column) -> Column:
    return joined(F.transform(values, lambda v: v.cast("string")))


# --- sources ---------------------------------------------------------------------------


@query
def grid_scan(spark, sf_dir):
    """Cells table back to rows, as wide as configured; empty cells have no record, so blank rows have none at all."""
    # cells are many times their text, which is what a shuffle's bytes are measured by
    rows = V.doc_rows(spark, sf_dir, V.text_tasks(spark, sf_dir))
    cells = rows.select(*PAGE, "row_idx", F.posexplode("cells").alias("col_idx", "value")).filter("value <> ''")
    config = rows.select(*PAGE).distinct().select(
        *PAGE, F.lit(0).alias("page_pos"), (F.col("doc_id") % 4 + 5).cast("int").alias("n_col")
    )
    out = grid.rows_from_cells(cells, config)
    filled = F.transform("cells", lambda c: F.coalesce(c, F.lit("")))
    return out.select("doc_id", "row_idx", "n_col", joined(filled).alias("cells"))


@query
def page_config_join(spark, sf_dir):
    """Only pages of labelled documents, cut or padded to the configured width."""
    labels = V.table(spark, sf_dir, "labels")
    config = labels.select(
        "doc_id",
        F.col("doc_id").cast("int").alias("page_num"),
        F.lit(0).alias("page_pos"),
        (F.col("quality") * 3 + F.col("toxic") * 2 + 5).cast("int").alias("n_col"),
    )
    out = grid.configured_rows(V.doc_rows(spark, sf_dir), grid.check_page_config(config))
    return out.select(
        "doc_id", "row_idx", "n_col", "narrow", joined(F.col("cells")).alias("cells")
    )


# --- scalar functions ------------------------------------------------------------------


@query
def cell_norm(spark, sf_dir):
    return V.noisy_rows(spark, sf_dir).select(
        "doc_id", "row_idx", joined(C.norm_row(F.col("cells"))).alias("cells")
    )


@query
def empty_cells(spark, sf_dir):
    flags = F.transform("cells", lambda c: F.when(C.is_empty(c), "1").otherwise("0"))
    return V.noisy_rows(spark, sf_dir).select(
        "doc_id", "row_idx", F.array_join(flags, "").alias("empty_flags")
    )


@query
def row_empty_ratio(spark, sf_dir):
    return V.noisy_rows(spark, sf_dir).select(
        "doc_id", "row_idx", C.empty_ratio(F.col("cells")).alias("ratio")
    )


@query
def numeric_cells(spark, sf_dir):
    return V.sales_text(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        *[C.is_simple_numeric(F.col(c)).alias(f"{c}_numeric") for c in V.SALES_COLUMNS[:5]],
    )


@query
def header_rows(spark, sf_dir):
    return V.doc_rows(spark, sf_dir).select(
        "doc_id", "row_idx", C.looks_like_header(F.col("cells"), V.DOC_TOKENS).alias("is_header")
    )


@query
def token_class(spark, sf_dir):
    pairs = V.header_pairs(spark, sf_dir)
    return pairs.select(
        "id",
        joined(H.signature(F.col("row1"))).alias("classes1"),
        joined(H.signature(F.col("row2"))).alias("classes2"),
    )


def _names(spark, sf_dir) -> DataFrame:
    return V.header_pairs(spark, sf_dir).withColumn("names", N.build_names(F.col("row1"), F.col("row2")))


@query
def token_hits(spark, sf_dir):
    hits = N.segment_hits(F.col("names"), ["December", "act", "pct"])
    return _names(spark, sf_dir).select("id", _numbers(hits).alias("hits"))


@query
def name_build(spark, sf_dir):
    return _names(spark, sf_dir).select("id", joined(F.col("names")).alias("names"))


@query
def month_start(spark, sf_dir):
    label = F.col("period_agg")
    return V.period_rows(spark, sf_dir).select(
        "o_orderkey",
        M.month_start(label, 2025).alias("month_start"),
        M.month_start_text(label, 2025).alias("month_text"),
    )


@query
def half_similarity(spark, sf_dir):
    halves = [
        C.positional_similarity(F.slice(F.col(r), 1, 4), F.slice(F.col(r), 5, 4)) for r in ("row1", "row2")
    ]
    return V.header_pairs(spark, sf_dir).select(
        "id", halves[0].alias("similarity1"), halves[1].alias("similarity2")
    )


@query
def null_sentinels(spark, sf_dir):
    return projection.without_sentinels(V.sales_text(spark, sf_dir))


@query
def pct_parse(spark, sf_dir):
    return V.sales_text(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        *[X.parse_percent(F.col(c)).alias(c) for c in ("discount", "tax", "part")],
    )


@query
def eu_number_parse(spark, sf_dir):
    return V.sales_text(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        *[X.parse_eu_number(F.col(c)).alias(c) for c in ("price", "discount", "part")],
    )


@query
def ts_utc_naive(spark, sf_dir):
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_id") % 3 == 0, F.concat(ts, F.lit("Z")))
        .when(F.col("event_id") % 3 == 1, F.concat(ts, F.lit("+02:00")))
        .otherwise(ts)
    )
    events = V.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.select("event_id", X.utc_naive(F.col("text")).alias("ts_utc"))


# --- projections and filters -----------------------------------------------------------


@query
def final_projection(spark, sf_dir):
    """Cells named by a map, the configured ones typed and in order."""
    sales = V.sales_text(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in V.SALES_COLUMNS])
    mapped = sales.select(
        "l_orderkey",
        "l_linenumber",
        projection.name_cells(names, F.array(*V.SALES_COLUMNS)).alias("values"),
    )
    named = projection.select_named(mapped, "values", ["tax", "price", "absent"])
    return projection.select_final(
        named.withColumn("price", X.parse_eu_number(F.col("price"))),
        ["price", "tax", "absent", "l_linenumber", "l_orderkey"],
    )


@query
def positional_rename(spark, sf_dir):
    sales = V.sales_text(spark, sf_dir).select("l_orderkey", "l_linenumber", "price", "part")
    return projection.rename_columns(sales, ["price", "part"], ["2025_act", "item_agg"])


@query
def keyword_rows(spark, sf_dir):
    rows = V.doc_rows(spark, sf_dir).filter(C.contains_keyword(F.col("cells"), V.DOC_WORDS))
    return rows.select("doc_id", "row_idx", joined(F.col("cells")).alias("cells"))


@query
def sparse_rows(spark, sf_dir):
    ratio = C.empty_ratio(F.col("cells"))
    rows = V.doc_rows(spark, sf_dir).withColumn("ratio", ratio).filter("ratio >= 0.5")
    return rows.select("doc_id", "row_idx", (F.col("ratio") >= 0.85).alias("very_sparse"))


# --- titles and splits -----------------------------------------------------------------


@query
def page_title(spark, sf_dir):
    return titles.extract_titles(V.doc_rows(spark, sf_dir), ["doc_id"], 3, 0.5)


@query
def drop_title_rows(spark, sf_dir):
    """Rows below the title, numbered anew."""
    rows = V.doc_rows(spark, sf_dir).withColumn("bucket", scans.bucket_of("row_idx"))
    sparse = C.empty_ratio(F.col("cells")) >= 0.5
    kept = titles.drop_leading_rows(rows, ["doc_id"], 3, sparse)
    out = scans.number_rows(kept, ["doc_id"], "row_idx", "new_idx")
    return out.select("doc_id", "row_idx", "new_idx")


@query
def sparse_runs(spark, sf_dir):
    sparse = V.doc_rows(spark, sf_dir).filter(C.empty_ratio(F.col("cells")) >= 0.5)
    return scans.group_runs(sparse, ["doc_id"], "row_idx")


def _doc_prior(spark, sf_dir) -> DataFrame:
    flags = staged(splits.row_flags(V.doc_rows(spark, sf_dir), ["doc_id"], V.DOC_TOKENS))
    return splits.with_prior(flags, ["doc_id"], 0.5)


@query
def backtrack_title(spark, sf_dir):
    return _doc_prior(spark, sf_dir).select(
        "doc_id", "row_idx", splits.title_start().alias("title_start")
    )


@query
def backtrack_run(spark, sf_dir):
    return _doc_prior(spark, sf_dir).select(
        "doc_id", "row_idx", splits.run_start().alias("run_start")
    )


@query
def has_data_before(spark, sf_dir):
    return _doc_prior(spark, sf_dir).select(
        "doc_id", "row_idx", F.col("last_data").isNotNull().alias("has_data")
    )


def _doc_candidates(rows: DataFrame) -> DataFrame:
    return splits.split_candidates(
        rows, ["doc_id"], V.DOC_TOKENS, [V.DOC_WORDS, V.DOC_WORDS_NEXT]
    )


@query
def split_points_sparse(spark, sf_dir):
    points = splits.split_candidates(staged(V.doc_rows(spark, sf_dir)), ["doc_id"], V.DOC_TOKENS, [])
    return points.select("doc_id", "point")


@query
def split_points_keyword(spark, sf_dir):
    """Split points of both keyword lists, before any thinning."""
    found = _doc_candidates(staged(V.doc_rows(spark, sf_dir)))
    return found.filter("kind > 0").select("doc_id", "kind", "point", "hits")


def _doc_flags(spark, sf_dir) -> DataFrame:
    """The flags of all rows, which are all that the split points need: the cells are never written."""
    # flags cost far more than the bytes of their text let adaptive merging think
    rows = V.doc_rows(spark, sf_dir, V.text_tasks(spark, sf_dir))
    return staged(splits.row_flags(rows, ["doc_id"], V.DOC_TOKENS, [V.DOC_WORDS, V.DOC_WORDS_NEXT]))


def _doc_points(flags: DataFrame) -> tuple[DataFrame, bool]:
    """The points that count, and whether some page reaches into a second bucket."""
    heads = flags.groupBy("doc_id").agg((F.max("row_idx") + 1).cast("long").alias("n_rows")).withColumn("first_row", F.lit(0))
    heads = staged(heads)
    carry = scans.reaches(heads, "n_rows", scans.BUCKET_ROWS + 1)
    candidates = splits.flagged_candidates(flags, ["doc_id"], 2, carry=carry)
    return splits.choose_points(staged(candidates), heads, ["doc_id"], carry=carry), carry


@query
def split_cascade(spark, sf_dir):
    """The points that count for each page, thinned where they come too thick."""
    points = _doc_points(_doc_flags(spark, sf_dir))[0]
    return points.select("doc_id", "kind", F.explode("points").alias("point"))


@query
def min_distance_points(spark, sf_dir):
    """Keyword rows at least five rows apart, from the top of each page."""
    rows = V.doc_rows(spark, sf_dir)
    hits = rows.filter(C.contains_keyword(F.col("cells"), V.DOC_WORDS))
    points = staged(hits.select("doc_id", F.col("row_idx").alias("point")))
    return splits.thin_points(points, ["doc_id"], 5)


@query
def split_tables(spark, sf_dir):
    flags = _doc_flags(spark, sf_dir)
    points, carry = _doc_points(flags)
    starts = splits.table_starts(points, ["doc_id"], carry)
    return splits.assign_tables(flags.select("doc_id", "row_idx"), starts, ["doc_id"]).select(
        "doc_id", "row_idx", "table_id", (F.col("row_idx") - F.col("table_start")).alias("new_idx")
    )


@query
def side_by_side(spark, sf_dir):
    """Both rows of a pair set beside those of another order's pair where they are alike."""
    pairs = V.header_pairs(spark, sf_dir)
    doubled = pairs.select(
        "id",
        F.array(
            F.concat("row1", F.transform("row1", lambda c: F.when(F.col("id") % 3 > 0, c).otherwise("x"))),
            F.concat("row2", F.transform("row2", lambda c, i: F.when((F.col("id") % 5 > 0) | (i > 1), c).otherwise("y"))),
        ).alias("head"),
    )
    parts = doubled.select("id", "head", F.inline(P.side_by_side(F.col("head"), F.size(F.get("head", F.lit(0))))))
    first = F.slice(F.get("head", F.lit(0)), F.col("lo") + 1, F.col("width"))
    return parts.select("id", "part_id", "parent_id", joined(first).alias("first_row"))


@query
def group_label_ffill(spark, sf_dir):
    rows = V.part_groups(spark, sf_dir)
    return enrich.group_label(
        rows, ["p_brand"], "p_partkey", F.col("item"), ["ECONOMY", "SMALL"], "item_agg_1"
    )


# --- header inference ------------------------------------------------------------------


@query
def fill_left_right(spark, sf_dir):
    row = F.col("row1")
    return V.header_pairs(spark, sf_dir).select(
        "id", joined(H.fill_left(row)).alias("fill_left"), joined(H.fill_right(row)).alias("fill_right")
    )


@query
def fill_score(spark, sf_dir):
    return V.header_pairs(spark, sf_dir).select(
        "id", H.fill_score(F.col("row1")).alias("score1"), H.fill_score(F.col("row2")).alias("score2")
    )


@query
def smart_fill(spark, sf_dir):
    return V.header_pairs(spark, sf_dir).select(
        "id", joined(H.smart_fill(F.col("row1"))).alias("filled")
    )


@query
def ngram_repeats(spark, sf_dir):
    """Repeated runs of two to four classes with their start positions."""
    signed = V.header_pairs(spark, sf_dir).select("id", H.signature(F.col("row2")).alias("sig"))
    per_n = [
        C.let(
            H.ngrams(F.col("sig"), n),
            lambda grams: F.transform(
                H.repeated_ngrams(grams),
                lambda g: F.struct(g.alias("gram"), _numbers(H.ngram_starts(grams, g)).alias("starts")),
            ),
        )
        for n in (2, 3, 4)
    ]
    return signed.select("id", F.inline(F.concat(*per_n)))


@query
def overlap_removal(spark, sf_dir):
    """Starts of the blocks left of each repeated run once overlaps are gone."""
    signed = V.header_pairs(spark, sf_dir).select("id", H.signature(F.col("row2")).alias("sig"))
    kept = C.let(
        H.ngrams(F.col("sig"), 2),
        lambda grams: F.transform(
            H.repeated_ngrams(grams),
            lambda g: F.struct(
                g.alias("gram"), _numbers(H.drop_overlaps(H.ngram_starts(grams, g), 2)).alias("starts")
            ),
        ),
    )
    return signed.select("id", F.inline(kept))


@query
def block_context(spark, sf_dir):
    """How well blocks of two cells at positions 1, 4 and 6 fit the first row."""
    starts = F.array(F.lit(1), F.lit(4), F.lit(6))
    rows = V.header_pairs(spark, sf_dir).select("id", C.norm_row(F.col("row1")).alias("r1"))
    return rows.select("id", H.block_context(F.col("r1"), starts, 2).alias("c")).select("id", "c.*")


@query
def best_block(spark, sf_dir):
    best = V.header_pairs(spark, sf_dir).select(
        "id", H.best_blocks(F.col("row1"), F.col("row2")).alias("b")
    )
    return best.select(
        "id", "b.forced", "b.fillable", "b.n", _numbers(F.col("b.starts")).alias("starts"),
        F.round("b.coverage_ratio", 6).alias("coverage"), "b.gram",
    )


@query
def block_fill(spark, sf_dir):
    """Blocks of two at positions 0, 4 and 6, filled on top of the left fill."""
    starts = F.array(F.lit(0), F.lit(4), F.lit(6))
    filled = H.block_fill(H.fill_left(F.col("row1")), F.col("row1"), starts, 2)
    return V.header_pairs(spark, sf_dir).select("id", joined(filled).alias("filled"))


@query
def name_score(spark, sf_dir):
    return _names(spark, sf_dir).select("id", N.name_score(F.col("names")).alias("score"))


RULES = [
    *CFG.header_rules,
    {"stage": "pre", "type": "replace_segment", "tokens": ["act", "BDG"], "placeholder": "val", "min_hits": 3},
    {"stage": "pre", "type": "set_colname", "col_idx": 99, "value": "never"},
    {"stage": "post", "type": "set_colname", "col_idx": 2, "value": "third"},
]


@query
def naming_rules(spark, sf_dir):
    return _names(spark, sf_dir).select(
        "id",
        joined(N.apply_rules(F.col("names"), RULES, "pre")).alias("pre"),
        joined(N.apply_rules(F.col("names"), RULES, "post")).alias("post"),
    )


def _inferred(spark, sf_dir) -> DataFrame:
    pairs = V.header_pairs(spark, sf_dir)
    headed = P.infer_headers(
        pairs, F.col("row1"), F.col("row2"), CFG.header_tokens, CFG.rules()
    )
    return headed.select("id", "header")


@query
def header_infer(spark, sf_dir):
    return _inferred(spark, sf_dir).select(
        "id",
        joined(F.col("header.names")).alias("names"),
        F.col("header.period_agg").alias("period_agg"),
        F.col("header.use_block").alias("use_block"),
    )


@query
def header_fallback(spark, sf_dir):
    """Pairs as the parts of a page per customer: names taken from the part before."""
    orders = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    parts = staged(_inferred(spark, sf_dir)).join(orders, "id").select(
        F.col("o_custkey").alias("page_num"), F.col("id").alias("seq"), "header",
        F.when(F.col("id") % 9 == 0, 7).otherwise(8).alias("width"),
    )
    out = P.stop_at_error(P.with_fallback(parts, ["page_num"]), ["page_num"])
    return out.select("page_num", "seq", "error", "reached", joined(F.col("names")).alias("names"))


# --- quality ---------------------------------------------------------------------------


@query
def dup_names(spark, sf_dir):
    return _names(spark, sf_dir).select("id", joined(N.duplicate_names(F.col("names"))).alias("dup"))


@query
def numeric_names(spark, sf_dir):
    """Names that look like numbers, among the texts of the sales columns."""
    return V.sales_text(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        *[N.is_numeric_name(F.col(c)).alias(c) for c in ("price", "discount", "part", "flag")],
    )


@query
def bad_names(spark, sf_dir):
    """Words of the documents checked as if they were names, with marks, other numbers and joiners among them."""
    ends = F.array(*[F.lit(x) for x in ("", "e\u0301", "m\u00b2", "\u00bd", "a\u203fb", "\u00e9")])
    end = F.element_at(ends, (F.col("row_idx") % 6 + 1).cast("int"))
    rows = V.doc_rows(spark, sf_dir).select("doc_id", "row_idx", F.explode("cells").alias("name"))
    rows = rows.withColumn("name", F.concat("name", end))
    per_row = rows.groupBy("doc_id", "row_idx").agg(
        F.count_if(N.has_bad_char(F.col("name"))).alias("bad_chars"),
        F.count_if(N.has_bad_token(F.col("name"), ["the", "de", "of", "un"])).alias("bad_tokens"),
    )
    return per_row


def _checked(spark, sf_dir) -> DataFrame:
    fixed = F.array(F.lit("run_id"), F.lit("page_num"))
    # the names are made once: the dictionary of the checks and its users read them
    pairs = staged(_names(spark, sf_dir).withColumn("page_num", (F.col("id") % 100).cast("int")))
    return quality.with_checks(pairs, F.concat(fixed, F.col("names"))).withColumn("idx", F.col("id"))


@query
def qc_summary(spark, sf_dir):
    out = quality.qc_summary(_checked(spark, sf_dir), preview_limit=3)
    lists = ["dup_cols", "numeric_cols", "bad_chars_cols", "bad_token_cols"]
    return out.withColumns({c: joined(F.col(c)) for c in lists})


@query
def qc_events(spark, sf_dir):
    return quality.qc_events(_checked(spark, sf_dir), ["id"])


@query
def quarantine(spark, sf_dir):
    """Rows of clean and of problem parts: the orders of headers with and without issues."""
    lines = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_quantity")
    return quality.flag_quarantine(lines, _checked(spark, sf_dir), ["id"])


# --- union -----------------------------------------------------------------------------


@query
def union_widen(spark, sf_dir):
    sales = V.sales_text(spark, sf_dir)
    orders = V.period_rows(spark, sf_dir)
    return projection.unite(
        [
            sales.select(F.col("l_orderkey").alias("key"), "price", "flag"),
            orders.select("period_agg", F.col("o_orderkey").alias("key")),
            sales.select("tax", F.col("l_orderkey").alias("key"), "flag"),
        ]
    )


@query
def row_ordinal(spark, sf_dir):
    rows = V.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return scans.sparse_ordinals(rows, ["o_custkey"], "o_orderkey")


# --- typing ----------------------------------------------------------------------------


@query
def column_profile(spark, sf_dir):
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir))
    return typing.column_profile(sales, typing.column_entries(V.SALES_COLUMNS))


@query
def merged_profile(spark, sf_dir):
    """The profile of all sales, added up from those of two batches."""
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir))
    entries = typing.column_entries(V.SALES_COLUMNS)
    batches = [sales.filter(F.col("l_orderkey") % 3 == 0), sales.filter(F.col("l_orderkey") % 3 != 0)]
    profiles = [staged(typing.with_rows(typing.column_profile(b, entries), F.lit(b.count()))) for b in batches]
    return typing.merge_profiles(*profiles)


@query
def smart_percent(spark, sf_dir):
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir))
    return typing.smart_types(sales, V.SALES_COLUMNS, kinds=[typing.PERCENT])[0]


@query
def smart_numeric(spark, sf_dir):
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir))
    return typing.smart_types(sales, V.SALES_COLUMNS, kinds=[typing.NUMBER])[0]


@query
def lost_values(spark, sf_dir):
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir))
    decisions = typing.smart_types(sales, V.SALES_COLUMNS)[1]
    index = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return typing.lost_values(sales, typing.column_entries(V.SALES_COLUMNS), decisions, index)


def _spoiled(spark, sf_dir) -> DataFrame:
    """Sales of forty documents; every fourth has words in half of its discounts, every fifth in half of its prices."""
    sales = projection.without_sentinels(V.sales_text(spark, sf_dir)).withColumn("doc", F.col("l_orderkey") % 40)
    odd = F.col("l_linenumber") % 2 == 0
    return sales.select(
        "l_orderkey",
        "l_linenumber",
        "doc",
        F.when((F.col("doc") % 4 == 0) & odd, "none%").otherwise(F.col("discount")).alias("discount"),
        F.when((F.col("doc") % 5 == 0) & odd, "4 or 5").otherwise(F.col("price")).alias("price"),
    )


@query
def smart_percent_by_doc(spark, sf_dir):
    out = typing.smart_types_by(_spoiled(spark, sf_dir), ["discount"], ["doc"], kinds=[typing.PERCENT])[0]
    return out.drop("price")


@query
def smart_numeric_by_doc(spark, sf_dir):
    out = typing.smart_types_by(_spoiled(spark, sf_dir), ["price"], ["doc"], kinds=[typing.NUMBER])[0]
    return out.drop("discount")


@query
def losses_by_doc(spark, sf_dir):
    """What each document's decisions cost, percent and number alike."""
    return typing.smart_types_by(_spoiled(spark, sf_dir), ["discount", "price"], ["doc"])[1]


# --- enrichment ------------------------------------------------------------------------


@query
def period_start(spark, sf_dir):
    rows = scans.sparse_ordinals(V.period_rows(spark, sf_dir), ["o_custkey"], "o_orderkey")
    return enrich.map_period_start(
        rows, ["o_custkey"], "period_agg", "ordinal", 2025, F.lit(AS_OF).cast("date")
    ).select("o_orderkey", "period_agg", "period_start")


@query
def period_desc(spark, sf_dir):
    return V.period_rows(spark, sf_dir).select(
        "o_orderkey", M.period_desc(F.col("period_agg")).alias("period_desc")
    )


@query
def chapter_lookup(spark, sf_dir):
    parts = V.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") + 28).alias("page_num"))
    return enrich.with_chapters(parts, enrich.chapter_index(spark, CHAPTERS))


#: Chapters of very many pages, which overlap: fixed values of the query.
WIDE_CHAPTERS = {
    "all": {"all": (0, 10**9)},
    "odd": {"low": (100, 4_999), "one": (7, 7), "none": (9, 8), "mid": (3_000, 20_000), "far": (400_000, 10**9 - 5)},
}


@query
def chapter_ranges(spark, sf_dir):
    """Orders looked up in ranges of up to a thousand million pages, of which the later ones win."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("page_num"))
    return enrich.with_chapters(orders, enrich.chapter_index(spark, WIDE_CHAPTERS))


# --- the whole job ---------------------------------------------------------------------


def run(spark: SparkSession, sf_dir: str, **options) -> report.ReportResult:
    rows, config = V.report_grid(spark, sf_dir)
    return report.run_report(
        spark, staged(rows), config, CFG, as_of=F.lit(AS_OF).cast("date"), **options
    )


@query
def report_facts(spark, sf_dir):
    return run(spark, sf_dir).facts


def run_from_cells(spark: SparkSession, sf_dir: str, **options) -> report.ReportResult:
    """The job on one record per cell that is not blank, and one per page with its extent as read."""
    rows, config = V.report_grid(spark, sf_dir)
    rows, kept = staged(rows), ("run_id", "timestamp_utc")
    cells = rows.select(*PAGE, "row_idx", F.posexplode("cells").alias("col_idx", "value")).filter("value <> ''")
    again = grid.rows_from_cells(cells, config, kept, grid.page_extents(rows, kept))
    # the job reads its rows more than once: they are gathered from the cells once
    return report.run_report(spark, staged(again), config, CFG, as_of=F.lit(AS_OF).cast("date"), **options)


@query
def report_from_cells(spark, sf_dir):
    """The facts again, from cells."""
    return run_from_cells(spark, sf_dir).facts


@query
def errors_from_cells(spark, sf_dir):
    """The errors again, from cells: narrow pages are told by their extents."""
    return run_from_cells(spark, sf_dir, decisions={}).errors


@query
def table_sink(spark, sf_dir):
    """Written as a managed table and read again."""
    name = f"sink_{uuid.uuid4().hex}"
    writers.write_table(V.sales_text(spark, sf_dir), name)
    return spark.table(name)


@query
def table_replace(spark, sf_dir):
    """A table of sales, then a further run in which some orders hold other lines: theirs are replaced, the rest stays."""
    name = f"sink_{uuid.uuid4().hex}"
    sales = V.sales_text(spark, sf_dir).select("l_orderkey", "l_linenumber", "part")
    writers.replace_documents(sales, name, "l_orderkey", 4)
    again = sales.filter("l_orderkey % 5 = 0 AND l_linenumber > 1").withColumn("part", F.lit("again"))
    writers.replace_documents(again, name, "l_orderkey", 4)
    return spark.table(name).drop(writers.SHARE)


@query
def file_sink(spark, sf_dir):
    """The same rows as parquet, JSON lines and CSV, read again."""
    sales = V.sales_text(spark, sf_dir).select("l_orderkey", "l_linenumber", "part", "tax")
    folder, shape = new_folder(spark, "files"), "l_orderkey bigint, l_linenumber int, part string, tax string"
    paths = [writers.write_file(sales, f"{folder}/sales{end}") for end in (".parquet", ".json", ".xlsx")]
    read = [
        spark.read.parquet(paths[0]),
        spark.read.schema(shape).json(paths[1]),
        spark.read.schema(shape).option("header", True).csv(paths[2]),
    ]
    return projection.unite([
        r.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "part", "tax", F.lit(k).alias("sink"))
        for k, r in enumerate(read)
    ])


def _packed(spark, sf_dir) -> str:
    """The folder of the packed quarantine of a run."""
    return writers.write_quarantine(run(spark, sf_dir, decisions={}).quarantine, new_folder(spark, "problems"))


@query
def quarantine_sink(spark, sf_dir):
    """The cells of problem parts, packed into files by their bytes and read again."""
    found = writers.read_quarantine(spark, _packed(spark, sf_dir))
    return found.groupBy("doc_id", "page_num").agg(
        F.count_distinct("part_idx").alias("parts"),
        F.count_distinct("row_idx").alias("n_rows"),
        F.count(F.lit(1)).alias("n_cells"),
    )


@query
def quarantine_manifest(spark, sf_dir):
    """What the manifest says of each part: its rows and cells, over all files that hold some."""
    found = writers.read_manifest(spark, _packed(spark, sf_dir))
    return found.groupBy("doc_id", "page_num", "part_idx").agg(
        F.sum("n_cells").alias("n_cells"), F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row")
    )


@query
def report_errors(spark, sf_dir):
    return run(spark, sf_dir, decisions={}).errors


@query
def report_parts(spark, sf_dir):
    """The parts of all pages: where they start, how they are named, what became of them."""
    parts = run(spark, sf_dir, decisions={}).parts
    return parts.select(
        "doc_id", "table_id", "part_id", "parent_id", "first_data", "n_data", "page_subtitle_1",
        "period_agg", joined(F.col("data_names")).alias("names"), "error", "emitted", "is_problem",
    )


@query
def refined_parts(spark, sf_dir):
    """The named cells of every data row, one record per name."""
    rows, config = V.report_grid(spark, sf_dir)
    rows = report.stage_pages(spark, staged(rows), config, CFG)
    flags = staged(report.flag_rows(rows, CFG))
    starts = staged(report.find_tables(flags, staged(report.find_pages(flags, CFG)), CFG))
    parts = report.add_periods(
        report.check_parts(report.find_parts(rows, starts, CFG), CFG), CFG, F.lit(AS_OF).cast("date")
    )
    named = report.part_rows(rows, staged(parts).filter("emitted"), CFG)
    return named.select(
        "doc_id", "row_idx", "table_id", "part_id", "item_agg_1", F.explode("values").alias("name", "value")
    )


@query
def report_lost_values(spark, sf_dir):
    return run(spark, sf_dir).lost_values


@query
def run_report(spark, sf_dir):
    return run(spark, sf_dir, decisions={}).report()


@query
def written_report(spark, sf_dir):
    """What the sinks of a run wrote, as they counted it, beside the forecast from the parts."""
    folder = new_folder(spark, "outputs")
    paths = writers.OutputPaths(
        facts=f"{folder}/facts.parquet", qc_summary=f"{folder}/qc.parquet", errors=f"{folder}/errors.parquet",
        quarantine=f"{folder}/problems", run_report=f"{folder}/report.json",
    )
    writers.write_outputs(run(spark, sf_dir, decisions={}), paths)
    return spark.read.schema(f"outputs {writers.OUTPUTS}").json(paths.run_report).select(F.inline("outputs"))
