"""What the operators share: reading the tables, word splitting, column names of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: the space and the five ASCII control characters after the backspace.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def remembered(name: str, make):
    """What ``make`` gives, made once in a Python worker and kept for its next tasks."""
    import sys

    store = sys.__dict__.setdefault("_reportgrid_remembered", {})
    if name not in store:
        store[name] = make()
    return store[name]
