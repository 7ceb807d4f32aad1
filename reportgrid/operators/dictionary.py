"""Dear expressions over values that repeat: each different value is worked on once.

Records get a 64-bit number of their value, a dictionary holds each different value under its number, and results come back
by a join on the number alone; no value is shuffled but those of the dictionary. Two values with one number are found by
counting, and the numbers are then drawn anew.

How many tasks work on the dictionary follows from its rows and what one costs. Adaptive execution merges partitions by their
bytes, which says nothing here: a thousand short headers are a few kilobytes and seconds of work.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged

#: Draws of the numbers before giving up; one draw fails for a million values in 10**-8 of all cases.
DRAWS = 4
#: What one task should work, in units of the costs given, which are about milliseconds.
TASK_COST = 500.0


def number_of(values: Mapping[str, Column], draw: int = 0) -> Column:
    """The number of a value: nulls, and the borders between the items of a list, count."""
    text = F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})
    return F.xxhash64(F.lit(draw), text)


def by_distinct(
    df: DataFrame,
    values: Mapping[str, Column],
    results: Callable[[DataFrame], Mapping[str, Column]],
    cost: float,
    known: Column | None = None,
    number: Callable[[Mapping[str, Column], int], Column] = number_of,
) -> DataFrame:
    """Adds the ``results``, expressions over columns named as the ``values``, computed once per different value.

    ``cost`` is about the milliseconds that a value takes. Records for which ``known`` is not true get nulls.
    ``df`` is read once for the dictionary, which is written, and once by whoever uses the outcome.
    """
    for draw in range(DRAWS):
        key = number(values, draw)
        if known is not None:
            key = F.when(known, key)
        keyed = df.withColumn("__value", key)
        # a frame that reads the columns of the values alone
        entries = df.select(key.alias("__value"), *[v.alias(k) for k, v in values.items()]).filter("__value IS NOT NULL")
        entries = staged(entries.distinct())
        size = entries.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("__value").alias("numbers")).first()
        if size["n"] == size["numbers"]:
            break
    else:
        raise ValueError(f"different values with one number in each of {DRAWS} draws")
    tasks = max(1, int(size["n"] * cost / TASK_COST))
    entries = entries.repartition(tasks, "__value")
    found = entries.select("__value", *[c.alias(k) for k, c in results(entries).items()])
    return keyed.join(found, "__value", "left").drop("__value")
