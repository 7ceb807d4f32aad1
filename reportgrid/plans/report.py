"""The whole job: grid rows in, typed fact table and quality artefacts out.

The rows are dealt by page and row bucket once, and written so. Three passes over their cells, none of which moves a row again: one
flags every row, one gathers the head of every table, one shapes the facts. Titles and split points come from the flags, a few
bytes a row. Everything between works on one short record per page, table or part.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportgrid.config import ReportConfig
from reportgrid.functions.months import period_desc
from reportgrid.functions.numbers import null_sentinels, utc_naive
from reportgrid.operators import enrich, parts as part_ops, quality, splits, titles, typing
from reportgrid.operators.scans import bucket_of, reaches, running, with_bucket
from reportgrid.sources import grid
from reportgrid.sources.staging import folders_made, partitions, remove, staged, staged_by

PAGE = ["doc_id", "page_num"]
TEXT_STATICS = ("page_title", "page_subtitle", "page_subtitle_1", "period_agg", "item_agg_1")


@dataclass
class ReportResult:
    """The five results of a run; each frame is planned when it is first asked for."""

    cfg: ReportConfig
    rows: DataFrame
    pages: Mapping[int | str, int] | DataFrame
    heads: DataFrame
    parts: DataFrame
    shaped: DataFrame
    decisions: dict[str, str]
    decided: DataFrame | None
    long_pages: bool
    keys: tuple[str, ...]
    documents: DataFrame
    profile: DataFrame | None = None
    folders: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Gives the folders of the run back, once its frames are written or read; they cannot be read any more then."""
        for folder in self.folders:
            remove(self.rows.sparkSession, folder)
        self.folders = []

    @cached_property
    def facts(self) -> DataFrame:
        return final_projection(self.shaped, self.cfg, self.decisions, self.keys)

    @cached_property
    def emitted(self) -> DataFrame:
        return self.parts.filter("emitted")

    @cached_property
    def qc_summary(self) -> DataFrame:
        return quality.qc_summary(self.emitted, ["doc_id"], self.cfg.preview_limit)

    @cached_property
    def quarantine(self) -> DataFrame:
        problems = self.parts.filter("emitted and is_problem")
        return part_rows(self.rows, problems, self.cfg, self.long_pages)

    @cached_property
    def lost_values(self) -> DataFrame:
        decided = self.decisions if self.decided is None else self.decided
        return typing.lost_values(
            self.shaped, text_entries(self.cfg), decided, F.col("row_ordinal"), ["doc_id"], null_sentinels
        )

    @cached_property
    def errors(self) -> DataFrame:
        """Failed pages and the quality events of all parts."""

        def records(frame: DataFrame, code: Column) -> DataFrame:
            text = part_ops.error_text(code).alias("e_des")
            return frame.select("doc_id", F.col("page_num").alias("page"), "n_col", text)

        failed = self.parts.filter(F.col("reached") & F.col("error").isNotNull())
        flagged = F.array_compact(
            F.array(
                *[
                    F.when(F.col(flag), F.lit(code))
                    for flag, code in (
                        ("narrow", part_ops.NARROW),
                        ("gaps", part_ops.GAPS),
                        ("repeated", part_ops.REPEATED),
                        ("bad_time", part_ops.BAD_TIME),
                    )
                ]
            )
        )
        pages = self.heads.select("doc_id", "page_num", "n_col", F.explode(flagged).alias("code"))
        missing = grid.missing_pages(self.heads, self.pages, self.documents)
        frames = [
            records(failed, F.col("error")),
            records(pages, F.col("code")),
            records(missing, F.lit(part_ops.MISSING)),
        ]
        return quality.flatten_errors([*frames, quality.qc_events(self.emitted, ["doc_id"])])

    def report(self) -> DataFrame:
        """Counts of a run, taken from the parts without another look at the rows."""
        kept = F.col("emitted")
        clean_rows = F.when(kept & ~F.col("is_problem"), F.col("n_data"))
        counts = self.parts.agg(
            F.coalesce(F.sum(clean_rows), F.lit(0)).alias("facts_rows"),
            F.lit(len(self.facts.columns)).alias("facts_columns"),
            F.count_if(kept).alias("qc_summary_rows"),
            F.count_if(kept & F.col("is_problem")).alias("quarantine_parts"),
        )
        errors = self.errors.agg(F.count(F.lit(1)).alias("errors_rows"))
        both = counts.unionByName(errors, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])


def flag_rows(rows: DataFrame, cfg: ReportConfig) -> DataFrame:
    """All that titles and split points need of the rows, without their cells."""
    return splits.row_flags(
        rows,
        PAGE,
        cfg.header_tokens,
        [cfg.keywords_primary, cfg.keywords_fallback],
        heads=2 * cfg.max_title_rows,
        keep=[c for c in ("page_pos", "n_col", "narrow", "repeated", "bad_time") if c in rows.columns],
    )


def find_pages(flags: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One record per page: titles, number of rows, first row below the titles."""
    return titles.page_heads(
        flags,
        PAGE,
        ["page_pos", "n_col"],
        cfg.max_title_rows,
        cfg.title_empty_threshold,
        cfg.drop_title_rows,
    )


def find_tables(
    flags: DataFrame, heads: DataFrame, cfg: ReportConfig, long_pages: bool = True
) -> DataFrame:
    """One record per page and row bucket: titles and the table starts in the bucket."""
    candidates = splits.flagged_candidates(
        flags,
        PAGE,
        2,
        sparse_threshold=cfg.split_empty_threshold,
        max_lookahead=cfg.max_lookahead,
        confirm_header=cfg.confirm_header,
        leading_title_rows=2 * cfg.max_title_rows if cfg.drop_title_rows else 0,
        title_threshold=cfg.title_empty_threshold,
        bucket_rows=cfg.bucket_rows,
        carry=long_pages,
    )
    points = splits.choose_points(
        staged(candidates), heads, PAGE, cfg.min_rows_per_table, cfg.bucket_rows, long_pages
    )
    return splits.table_starts(points, PAGE, long_pages)


def find_parts(rows: DataFrame, starts: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One record per part of every table, with names, errors and its range of data rows."""
    in_tables = splits.assign_tables(rows, starts.filter("not narrow and not repeated"), PAGE, cfg.bucket_rows)
    tables = part_ops.table_heads(
        in_tables,
        PAGE,
        ["page_pos", "n_col", "page_title", "page_subtitle"],
        cfg.max_title_rows,
        cfg.title_empty_threshold,
        cfg.drop_title_rows,
        max(2, max(cfg.slicer_header_rows) + 1),
    )
    parts = staged(part_ops.split_parts(tables, cfg.slicer_header_rows, cfg.slicer_thresholds))
    parts = staged(part_ops.with_headers(parts, cfg.header_tokens, cfg.rules()).drop("head"))
    many = reaches(parts, "seq", cfg.bucket_rows)
    parts = parts.withColumn("part_bucket", bucket_of("seq", cfg.bucket_rows))
    shared = {"bucket_rows": cfg.bucket_rows, "carry": many, "bucket": "part_bucket"}
    parts = part_ops.with_fallback(parts, PAGE, **shared)
    return part_ops.stop_at_error(parts, PAGE, **shared)


def check_parts(parts: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Adds the checks of the names, and where the part's rows stand in the whole document."""
    data_names = F.coalesce(F.col("header.names"), F.array().cast("array<string>"))
    if cfg.fallback_keep_data:
        data_names = F.coalesce(F.col("names"), data_names)
    fixed = F.array(*[F.lit(c) for c in [*cfg.audit_columns, *cfg.static_columns]])
    parts = parts.withColumns(
        {
            "emitted": F.col("reached") & F.col("error").isNull(),
            "data_names": data_names,
            "period_agg": F.col("header.period_agg"),
            "n_data": F.greatest(F.col("table_end") - F.col("first_data"), F.lit(0)),
        }
    )
    parts = quality.with_checks(parts, F.concat(fixed, F.col("data_names")), cfg.bad_tokens)
    clean_rows = F.when(F.col("emitted") & ~F.col("is_problem"), F.col("n_data")).otherwise(0)
    shown = F.col("emitted").cast("long")
    top = parts.agg(
        F.coalesce(F.max("page_pos"), F.lit(0)).alias("page"),
        F.coalesce(F.max("seq"), F.lit(0)).alias("part"),
    ).first()
    pages = parts.groupBy("doc_id", "page_num", "page_pos").agg(
        F.sum(clean_rows).alias("__rows"), F.sum(shown).alias("__parts")
    )
    pages = running(
        pages,
        ["doc_id"],
        "page_pos",
        total={"__row_base": F.col("__rows"), "__part_base": F.col("__parts")},
        bucket_rows=cfg.bucket_rows,
        carry=top["page"] >= cfg.bucket_rows,
    ).drop("__rows", "__parts", "page_pos")
    parts = running(
        parts,
        PAGE,
        "seq",
        total={"__row_at": clean_rows, "__part_at": shown},
        bucket_rows=cfg.bucket_rows,
        carry=top["part"] >= cfg.bucket_rows,
        bucket="part_bucket",
    )
    return (
        parts.join(pages, PAGE)
        .withColumn("ordinal", F.col("__row_base") + F.col("__row_at"))
        .withColumn("idx", (F.col("__part_base") + F.col("__part_at")).cast("int"))
        .drop("__row_base", "__row_at", "__part_base", "__part_at", "part_bucket")
    )


def add_periods(parts: DataFrame, cfg: ReportConfig, as_of: Column) -> DataFrame:
    """Adds ``period_start`` to the parts that reach the fact table."""
    reaching = parts.filter(F.col("emitted") & ~F.col("is_problem") & (F.col("n_data") > 0))
    labels = reaching.groupBy("doc_id", "period_agg").agg(F.min("ordinal").alias("first"))
    far = reaches(parts, "ordinal", enrich.LABEL_BUCKET)
    dated = enrich.period_starts(
        labels, ["doc_id"], "period_agg", "first", cfg.year_ref, as_of, carry=far
    )
    return enrich.join_periods(parts, dated, ["doc_id"], "period_agg")


def part_rows(
    rows: DataFrame, parts: DataFrame, cfg: ReportConfig, long_pages: bool = True
) -> DataFrame:
    """The data rows of the given parts, cells named in a map ``values``.

    What depends on the names alone is worked out once a part.
    """
    distinct = (F.size(F.array_distinct("data_names")) == F.size("data_names")) & (F.size("data_names") > 0)
    parts = parts.withColumns({
        "__item_at": F.array_position("names", "item_agg").cast("int") - 1,
        "__distinct": F.coalesce(distinct, F.lit(False)),
    })
    columns = [
        "lo", "width", "table_id", "part_id", "parent_id", "seq", "idx", "ordinal", "first_data",
        "table_end", "names", "data_names", "is_problem", "page_title", "page_subtitle",
        "page_subtitle_1", "period_agg", "period_start",
        *[c for c in ("capitolo", "sottocapitolo") if c in parts.columns], "__item_at", "__distinct",
    ]
    placed = part_ops.place_parts(
        parts.select(*PAGE, *columns), PAGE, "first_data", "table_end", cfg.bucket_rows
    )
    mine = F.filter(
        "parts",
        lambda p: (p["first_data"] <= F.col("row_idx")) & (F.col("row_idx") < p["table_end"]),
    )
    cells = F.slice(F.col("cells"), F.col("lo") + 1, F.col("width"))
    item = F.get("cells", F.col("lo") + F.col("__item_at"))
    item = F.when((F.col("__item_at") >= 0) & (F.col("__item_at") < F.col("width")), item)
    shaped = (
        with_bucket(rows, cfg.bucket_rows)
        .join(placed, [*PAGE, "bucket"])
        .select(
            "doc_id", "page_num", "page_pos", "bucket", "row_idx", "cells",
            *cfg.audit_columns, F.inline(mine),
        )
        .withColumn("item_raw", item)
        .withColumn(
            "values",
            F.when(F.col("__distinct"), F.map_from_arrays("data_names", cells)).otherwise(
                F.create_map().cast("map<string,string>")
            ),
        )
        .withColumn("row_ordinal", F.col("ordinal") + F.col("row_idx") - F.col("first_data"))
    )
    labelled = enrich.group_label(
        shaped, [*PAGE, "seq"], "row_idx", F.col("item_raw"), cfg.aggregation_keywords,
        bucket_rows=cfg.bucket_rows, bucket="bucket", carry=long_pages,
    )
    return labelled.drop("first_data", "table_end", "ordinal", "item_raw", "bucket", "__item_at", "__distinct")


def text_entries(cfg: ReportConfig) -> Column:
    """All text columns of a shaped row: named cells, statics, run id. Sentinels are nulled once the entries are unfolded."""
    fixed = [c for c in (*TEXT_STATICS, "run_id") if c not in cfg.typing_exclude]
    named = F.map_entries("values").cast("array<struct<name:string,text:string>>")
    static = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("text")) for c in fixed])
    entries = F.concat(named, static)
    if cfg.typing_exclude:
        return F.filter(entries, lambda e: ~e["name"].isin(*cfg.typing_exclude))
    return entries


def static_columns(cfg: ReportConfig) -> set[str]:
    """The report's own columns; every other name is one that a header gives, also if a helper is called so."""
    made = {"page_num", "table_id", "capitolo", "sottocapitolo", "period_start", "period_desc", "timestamp_utc", "run_id"}
    return made | set(TEXT_STATICS) | set(cfg.audit_columns)


def final_projection(
    rows: DataFrame, cfg: ReportConfig, decisions: dict[str, str], keys: tuple[str, ...]
) -> DataFrame:
    """Typed columns in the configured order.

    Columns of one kind are converted by one expression over their list: an expression a column makes generated code of more than
    8,000 bytes, which the JVM does not compile. Sentinels are no numbers, so only texts need them nulled.
    """
    made = ("page_num", "table_id", "capitolo", "sottocapitolo", "period_start", "timestamp_utc")
    texts = {
        c: F.col("period_agg") if c == "period_desc"
        else F.col(c) if c in static_columns(cfg)
        else F.try_element_at("values", F.lit(c))
        for c in cfg.final_columns
        if c not in made
    }
    kinds = {c: decisions.get("period_agg" if c == "period_desc" else c, typing.TEXT) for c in texts}
    kept = [c for c in dict.fromkeys([*keys, *cfg.final_columns]) if c in keys or c in made]
    lists, values = {}, {}
    for kind in sorted(set(kinds.values())):
        mine = [c for c in texts if kinds[c] == kind]
        raw = F.array(*[texts[c].cast("string") for c in mine])
        lists[f"__{kind}"] = F.transform(raw, null_sentinels if kind == typing.TEXT else lambda t: typing.convert(t, kind))  # noqa: B023
        values |= {c: F.get(f"__{kind}", F.lit(i)) for i, c in enumerate(mine)}
    if kinds.get("period_desc") == typing.TEXT:
        values["period_desc"] = period_desc(values["period_desc"])
    rows = rows.select(*kept, *[v.alias(k) for k, v in lists.items()])
    if "timestamp_utc" in cfg.final_columns:
        values["timestamp_utc"] = utc_naive(F.col("timestamp_utc"), rows.schema["timestamp_utc"].dataType.simpleString())
    return rows.select(*keys, *[values.get(c, F.col(c)).alias(c) for c in cfg.final_columns])


def check_final_columns(parts: DataFrame, cfg: ReportConfig) -> None:
    """Every configured column must be known or occur as a name in some clean part."""
    wanted = [c for c in cfg.final_columns if c not in static_columns(cfg)]
    seen = parts.filter(F.col("emitted") & ~F.col("is_problem")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.coalesce(F.bool_or(F.array_contains("data_names", c)), F.lit(False)).alias(c) for c in wanted],
    )
    found = seen.first()
    if found["__n"] == 0:
        raise ValueError("no part is left to unite: all failed or have problem names")
    missing = [c for c in wanted if not found[c]]
    if missing:
        raise ValueError(f"final columns that no header names: {missing}")


def run_report(
    spark: SparkSession,
    rows: DataFrame,
    pages: Mapping[int | str, int] | DataFrame,
    cfg: ReportConfig | None = None,
    as_of: Column | None = None,
    decisions: dict[str, str] | None = None,
    strict_columns: bool = True,
    keys: tuple[str, ...] = ("doc_id",),
    history: DataFrame | None = None,
) -> ReportResult:
    """Runs the job on a rows table (``doc_id, page_num, row_idx, cells, run_id, timestamp_utc``).

    ``pages`` maps page to column count, or is a frame ``[doc_id,] page_pos, page_num, n_col``.
    ``decisions`` reuses the column types of an earlier run and saves the profiling pass. ``history`` is the ``profile`` of earlier
    batches: the types are then decided over all batches, while only this one's rows are profiled.
    """
    cfg = cfg or ReportConfig()
    as_of = F.current_date() if as_of is None else as_of
    with folders_made() as made:
        result = _run(spark, rows, pages, cfg, as_of, decisions, strict_columns, keys, history)
    result.folders = made
    return result


def stage_pages(spark: SparkSession, rows: DataFrame, config: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The rows of the configured pages as the job needs them, dealt by page and bucket once and for all.

    Every later pass over the rows joins, groups or orders them inside these buckets, so none of them moves a row again.
    """
    n = partitions(spark)
    rows = grid.configured_rows(rows, config, cfg.bucket_rows, n)
    if "timestamp_utc" in rows.columns:
        kind = rows.schema["timestamp_utc"].dataType.simpleString()
        read = utc_naive(F.col("timestamp_utc"), kind)
        rows = rows.withColumn("bad_time", F.col("timestamp_utc").isNotNull() & read.isNull())
    return staged_by(rows, [*PAGE, "bucket"], ["row_idx"], n)


def _run(spark, rows, pages, cfg, as_of, decisions, strict_columns, keys, history) -> ReportResult:
    config = pages if isinstance(pages, DataFrame) else grid.page_config(spark, pages)
    documents = rows.select("doc_id").distinct()
    rows = stage_pages(spark, rows, config, cfg)

    flags = staged(flag_rows(rows, cfg))
    heads = staged(find_pages(flags, cfg))
    long_pages = reaches(heads, "n_rows", cfg.bucket_rows + 1)
    starts = staged(find_tables(flags, heads, cfg, long_pages))
    parts = staged(check_parts(find_parts(rows, starts, cfg), cfg))
    parts = staged(add_periods(parts, cfg, as_of))

    clean = parts.filter(F.col("emitted") & ~F.col("is_problem"))
    # chapters are looked up for the parts, so that the rows need no join of their own
    chapters = enrich.chapter_index(spark, cfg.chapters)
    shaped = part_rows(rows, enrich.with_chapters(clean, chapters), cfg, long_pages)
    if strict_columns:
        check_final_columns(parts, cfg)

    decided = profile = None
    if decisions is None:
        # the facts and the profile read the named cells alone
        shaped = staged(shaped.drop(*[c for c in ("cells", "names", "data_names") if c not in keys]))
        total = clean.agg(F.sum("n_data")).first()[0] or 0
        found = typing.column_profile(shaped, text_entries(cfg), clean=null_sentinels)
        # one record per column, which the decisions and the log of lost values both read: the rows are profiled once
        profile = staged(typing.with_rows(found, F.lit(total)))
        if history is not None:
            profile = staged(typing.merge_profiles(profile, history))
        decided = typing.decide_types(
            profile,
            F.col("n_rows"),
            cfg.percent_threshold,
            cfg.percent_max_loss,
            cfg.numeric_threshold,
            cfg.numeric_max_loss,
        )
        decisions = typing.collect_decisions(decided, [*cfg.final_columns, "period_agg"])
    return ReportResult(
        cfg, rows, pages, heads, parts, shaped, decisions, decided, long_pages, keys, documents, profile
    )
