"""Checks of the column names of a part, and the split into clean and problem parts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.functions.cells import let
from reportgrid.functions.names import (
    BAD_TOKENS,
    duplicate_names,
    has_bad_char,
    has_bad_token,
    is_numeric_name,
)
from reportgrid.operators.dictionary import by_distinct

#: About the milliseconds that checking a list of names takes.
CHECK_COST = 1.0
# Issue codes in reporting order, and their names in the event texts.
ISSUES = (
    ("dup", "DUPLICATE_COLS", "DUPLICATE_COLS"),
    ("numeric", "NUMERIC_COLNAMES", "NUMERIC_COLNAMES"),
    ("bad_chars", "BAD_CHARS", "BAD_CHARS_IN_COLNAMES"),
    ("bad_tokens", "BAD_TOKENS", "BAD_TOKENS_IN_COLNAMES"),
)


def name_checks(names: Column, bad_tokens: Iterable[str] | None = None) -> Column:
    """Per check the offending names, as a struct of arrays."""
    tokens = list(BAD_TOKENS if bad_tokens is None else bad_tokens)
    return let(
        names,
        lambda n: F.struct(
            duplicate_names(n).alias("dup"),
            F.filter(n, is_numeric_name).alias("numeric"),
            F.filter(n, has_bad_char).alias("bad_chars"),
            F.filter(n, lambda x: has_bad_token(x, tokens)).alias("bad_tokens"),
        ),
    )


def with_checks(
    parts: DataFrame, names: Column, bad_tokens: Iterable[str] | None = None
) -> DataFrame:
    """Adds ``checks``, ``n_names``, the joined ``issues`` and ``is_problem``.

    Parts share their lists of names, as they share their headers: each different list is checked once.
    """
    checked = by_distinct(
        parts, {"names": names}, lambda lists: {"checks": name_checks(F.col("names"), bad_tokens)}, CHECK_COST
    )
    issues = F.concat_ws(
        "|", *[F.when(F.size(F.col(f"checks.{c}")) > 0, code) for c, code, _ in ISSUES]
    )
    return (
        checked.withColumn("n_names", F.size(names))
        .withColumn("issues", issues)
        .withColumn("is_problem", F.col("issues") != "")
    )


def qc_summary(parts: DataFrame, keep: Sequence[str] = (), preview_limit: int = 8) -> DataFrame:
    """One record per checked part (``idx``, ``page``): counts and the first offending names."""
    lists = {"dup": "dup_cols", "numeric": "numeric_cols", "bad_chars": "bad_chars_cols"}
    lists["bad_tokens"] = "bad_token_cols"
    return parts.select(
        *keep,
        F.col("idx"),
        F.col("page_num").alias("page"),
        F.col("n_names").alias("n_col"),
        "is_problem",
        "issues",
        *[F.size(f"checks.{c}").alias(f"{c}_n") for c, _, _ in ISSUES],
        *[F.slice(F.col(f"checks.{c}"), 1, preview_limit).alias(name) for c, name in lists.items()],
    )


def qc_events(parts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One record per part and issue, with all offending names in the text."""

    def text(check: str, label: str) -> Column:
        names = F.col(f"checks.{check}")
        quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
        listed = F.concat(F.lit(f"{label}: ["), F.array_join(quoted, ", "), F.lit("]"))
        return F.when(F.size(names) > 0, listed)

    events = F.array_compact(F.array(*[text(c, label) for c, _, label in ISSUES]))
    return parts.select(
        *keep,
        F.col("page_num").alias("page"),
        F.col("n_names").alias("n_col"),
        F.explode(events).alias("e_des"),
    )


def flag_quarantine(rows: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``quarantined``, true for the rows of problem parts; one pass over the rows."""
    flags = parts.select(*keys, F.col("is_problem").alias("__flag"))
    return (
        rows.join(flags, list(keys), "left")
        .withColumn("quarantined", F.coalesce("__flag", F.lit(False)))
        .drop("__flag")
    )


def quarantine(
    rows: DataFrame, parts: DataFrame, keys: Sequence[str], reverse: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of clean parts and rows of problem parts; ``reverse`` lists problems last to first."""
    problems = parts.filter("is_problem").select(*keys)
    clean = rows.join(problems, list(keys), "left_anti")
    bad = rows.join(problems, list(keys), "left_semi")
    if reverse:
        bad = bad.orderBy(*[F.col(k).desc() for k in keys])
    return clean, bad


def flatten_errors(frames: Sequence[DataFrame]) -> DataFrame:
    """Error frames of all stages as one."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
