"""Deciding from column profiles which text columns are percentages or numbers.

Columns come in long form, ``array<struct(name, text)>`` per row, so that any number of columns
is profiled by one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.functions.numbers import is_eu_number, is_percent, parse_eu_number, parse_percent

PERCENT, NUMBER, TEXT = "percent", "number", "text"


def column_entries(columns: Sequence[str]) -> Column:
    """Wide string columns as ``array<struct(name, text)>``."""
    return F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("text")) for c in columns]
    )


def column_profile(
    rows: DataFrame, entries: Column, keys: Sequence[str] = (), clean: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Per column: non-null values, how many hold ``%`` or a digit, and how many each parse loses.

    Columns without any value have no record. ``clean`` is applied to the texts once they are unfolded. What a parse loses is told by
    patterns, without a cast.
    """
    text = F.col("text")
    cells = rows.select(*keys, F.inline(entries))
    if clean is not None:
        cells = cells.withColumn("text", clean(text))
    return (
        cells.filter(text.isNotNull())
        .groupBy(*keys, "name")
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.count_if(F.contains(text, F.lit("%"))).alias("n_percent"),
            F.count_if(text.rlike(r"\p{Nd}")).alias("n_digit"),
            F.count_if(~is_percent(text)).alias("lost_percent"),
            F.count_if(~is_eu_number(text)).alias("lost_number"),
        )
    )


def wide_profile(rows: DataFrame, columns: Sequence[str], kinds: Sequence[str] = (PERCENT, NUMBER)) -> DataFrame:
    """The same profile for named wide columns, from one aggregation without a shuffle of rows.

    One record per column; ``n_rows`` counts all rows. Only what the ``kinds`` need is measured, the rest is 0.
    """
    measures = []
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`")
        percent = [
            F.count_if(F.contains(text, F.lit("%"))),
            F.count_if(~is_percent(text)),
        ]
        number = [
            F.count_if(text.rlike(r"\p{Nd}")),
            F.count_if(~is_eu_number(text)),
        ]
        none = [F.lit(0).cast("long")] * 2
        (p, lp), (d, ln) = (m if k in kinds else none for k, m in ((PERCENT, percent), (NUMBER, number)))
        measures += [F.count(text).alias(f"v{i}"), p.alias(f"p{i}"), d.alias(f"d{i}"), lp.alias(f"lp{i}"), ln.alias(f"ln{i}")]
    one = rows.agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    records = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.col(f"v{i}").alias("n_values"),
                F.col(f"p{i}").alias("n_percent"),
                F.col(f"d{i}").alias("n_digit"),
                F.col(f"lp{i}").alias("lost_percent"),
                F.col(f"ln{i}").alias("lost_number"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select("n_rows", F.inline(records)).filter("n_values > 0")


#: What a profile counts; two profiles merge by adding these up.
COUNTS = ("n_values", "n_percent", "n_digit", "lost_percent", "lost_number")


def with_rows(profile: DataFrame, n_rows: Column) -> DataFrame:
    """A profile with the number of rows it was taken over, as :func:`merge_profiles` needs it."""
    return profile.withColumn("n_rows", n_rows.cast("long"))


def merge_profiles(*profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The profile of all rows from those of batches, each with ``n_rows``; no row is read again.

    A column that a batch does not hold counts as null in its rows. Each profile has at least one column of its batch.
    """
    batches = [p.withColumn("__batch", F.lit(k)) for k, p in enumerate(profiles)]
    every = batches[0]
    for batch in batches[1:]:
        every = every.unionByName(batch)
    sums = every.groupBy(*keys, "name").agg(*[F.sum(c).alias(c) for c in COUNTS])
    sizes = every.groupBy(*keys, "__batch").agg(F.max("n_rows").alias("n_rows"))
    if keys:
        return sums.join(sizes.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows")), list(keys))
    total = sizes.agg(F.sum("n_rows").alias("n_rows")).withColumn("__one", F.lit(1))
    return sums.withColumn("__one", F.lit(1)).join(F.broadcast(total), "__one").drop("__one")


def decide_types(
    profile: DataFrame,
    total_rows: Column,
    percent_threshold: float = 0.5,
    percent_max_loss: float = 0.1,
    numeric_threshold: float = 0.5,
    numeric_max_loss: float = 0.1,
) -> DataFrame:
    """Adds ``kind``: percent, number or text. Losses are shares of all rows, nulls included."""
    n = F.col("n_values")
    percent = (F.col("n_percent") / n >= percent_threshold) & (
        F.col("lost_percent") / total_rows <= percent_max_loss
    )
    number = (F.col("n_digit") / n >= numeric_threshold) & (
        F.col("lost_number") / total_rows <= numeric_max_loss
    )
    return profile.withColumn(
        "kind", F.when(percent, PERCENT).when(number, NUMBER).otherwise(TEXT)
    )


def convert(text: Column, kind: str) -> Column:
    if kind == PERCENT:
        return parse_percent(text)
    if kind == NUMBER:
        return parse_eu_number(text)
    return text


def typed_columns(rows: DataFrame, decisions: dict[str, str]) -> DataFrame:
    """Wide rows with the decided columns replaced by their values."""
    return rows.withColumns(
        {c: convert(F.col(f"`{c}`"), k) for c, k in decisions.items() if k in (PERCENT, NUMBER)}
    )


def collect_decisions(decided: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The decisions for the given columns: one short record per column on the driver."""
    wanted = decided.filter(F.col("name").isin(list(columns))).select("name", "kind")
    return {r["name"]: r["kind"] for r in wanted.collect()}


def smart_types(
    rows: DataFrame,
    columns: Sequence[str],
    percent_threshold: float = 0.5,
    percent_max_loss: float = 0.1,
    numeric_threshold: float = 0.5,
    numeric_max_loss: float = 0.1,
    kinds: Sequence[str] = (PERCENT, NUMBER),
) -> tuple[DataFrame, dict[str, str]]:
    """Profiles wide text columns, decides and converts; the decisions can be used again."""
    decided = decide_types(
        wide_profile(rows, columns, kinds),
        F.col("n_rows"),
        percent_threshold if PERCENT in kinds else 2.0,
        percent_max_loss,
        numeric_threshold if NUMBER in kinds else 2.0,
        numeric_max_loss,
    )
    decisions = collect_decisions(decided, columns)
    return typed_columns(rows, decisions), decisions


def lost_values(
    rows: DataFrame, entries: Column, decided: DataFrame | dict[str, str], index: Column,
    keys: Sequence[str] = (), clean: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Log of the values a percent conversion turns into null: ``column, index, or_val``.

    With the decisions as a dict only the cells of percent columns are unfolded and parsed. A frame of them, best a staged one, is
    joined by name; texts are looked at once their column is known to hold percentages. ``clean`` is applied to the unfolded texts.
    """
    if isinstance(decided, dict):
        percent = [c for c, kind in decided.items() if kind == PERCENT]
        entries = F.filter(entries, lambda e: e["name"].isin(percent) if percent else F.lit(False))
    cells = rows.select(*keys, index.alias("index"), F.inline(entries))
    if clean is not None:
        cells = cells.withColumn("text", clean(F.col("text")))
    lost = ~is_percent(F.col("text"))
    if isinstance(decided, dict):
        cells = cells.filter(lost)
    else:
        percent = decided.filter(F.col("kind") == PERCENT).select(F.col("name").alias("__name"), F.col("kind").alias("__kind"))
        # as a part of the join, which names the kind, the pattern is not pushed to the cells of all columns
        found = (F.col("name") == F.col("__name")) & F.when(F.col("__kind") == PERCENT, lost)
        cells = cells.join(percent, found, "left_semi")
    return cells.select(*keys, F.col("name").alias("column"), "index", F.col("text").alias("or_val"))


def smart_types_by(
    rows: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    percent_threshold: float = 0.5,
    percent_max_loss: float = 0.1,
    numeric_threshold: float = 0.5,
    numeric_max_loss: float = 0.1,
    kinds: Sequence[str] = (PERCENT, NUMBER),
) -> tuple[DataFrame, DataFrame]:
    """Decides for each group of ``keys`` (a document) alone.

    The rows have each column as a number where its group decided so, and ``<column>_text`` with the text where it did not. The
    second frame has a record per group and column: its ``kind``, and in ``lost`` how many values the conversion nulls.
    """
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    profile = column_profile(rows, column_entries(columns), keys).join(totals, list(keys))
    decided = decide_types(
        profile,
        F.col("n_rows"),
        percent_threshold if PERCENT in kinds else 2.0,
        percent_max_loss,
        numeric_threshold if NUMBER in kinds else 2.0,
        numeric_max_loss,
    )
    lost = F.when(F.col("kind") == PERCENT, F.col("lost_percent")).when(F.col("kind") == NUMBER, F.col("lost_number"))
    decided = decided.select(*keys, "name", "kind", F.coalesce(lost, F.lit(0)).alias("lost"))
    # one short record per group: at most one entry for each column
    by_group = (
        decided.filter(F.col("kind") != TEXT)
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "kind"))).alias("__kinds"))
    )
    out = rows.join(by_group, list(keys), "left")
    values = {}
    for c in columns:
        text, kind = F.col(f"`{c}`"), F.try_element_at("__kinds", F.lit(c))
        values[c] = F.when(kind == PERCENT, parse_percent(text)).when(kind == NUMBER, parse_eu_number(text))
        values[f"{c}_text"] = F.when(kind.isNull(), text)
    return out.withColumns(values).drop("__kinds"), decided
