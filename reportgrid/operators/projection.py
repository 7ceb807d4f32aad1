"""Renaming, projecting and uniting frames by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.functions.numbers import null_sentinels


def rename_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Renames by position; both lists must be equally long."""
    if len(old) != len(new):
        raise ValueError(f"{len(old)} columns cannot take {len(new)} names")
    return df.withColumnsRenamed(dict(zip(old, new)))


def name_cells(names: Column, cells: Column) -> Column:
    """Cells as a map by name; null when a name is repeated, for a map cannot hold it."""
    return F.when(
        F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, cells)
    )


def select_final(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The configured columns in order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def select_named(df: DataFrame, values: str, columns: Sequence[str]) -> DataFrame:
    """Named cells of a map column as columns of their own; absent names give null."""
    named = [F.try_element_at(F.col(values), F.lit(c)).alias(c) for c in columns]
    return df.select(*[c for c in df.columns if c != values], *named)


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames one below the other by column name; absent columns are null."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def without_sentinels(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null in every string column."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: null_sentinels(F.col(f"`{c}`")) for c in strings})
