"""Judges URLs by rules on host and path, and by a character language model where no rule fits.

The rules label the URLs they fit. Two character models, one of the allowed and one of the blocked
URLs, count every n-gram up to ``ORDER`` characters. A character's probability starts from the
uniform one and is refined by each longer context that was seen (Witten-Bell smoothing), so the
order varies with what the corpus knows. A URL's score is the difference of both log-likelihoods
divided by its length; the threshold is the score that separates best the ruled URLs held out of
the counting.

All of it is DataFrames. What a character adds to the score depends on the ``ORDER`` characters that end with it, its window. So
the windows of all URLs are counted by class, the counts of shorter n-grams and of contexts follow from theirs, and each different
n-gram gets its probabilities once, from those of its suffix, in ``ORDER`` small joins. The tables grow with what the corpus
holds; nothing is hashed together, cut off or sent to the driver. The URLs then meet the values of their windows: windows
that hold at least one character in ``FREQUENT``, of which there can be only so many, by a broadcast, all others by a join, in which no key is hot.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule; the model
judges it like any other, and what has no characters at all scores zero. Where one of the classes
has no example, there is no model and what no rule fits is allowed. Repeated rows get the same answer
each; ``url`` and the id are the only columns read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportgrid.functions.cells import let
from reportgrid.sources.staging import staged

#: The longest n-gram, in characters.
ORDER = 5
#: Symbols that the uniform distribution spreads over.
ALPHABET = 256
#: An n-gram is frequent if it ends at one in so many characters; there are at most ``ORDER`` times as many such.
FREQUENT = 1 << 14
#: Values are summed in units of 10 ** -9, so that the sums do not depend on their order.
UNIT = 1_000_000_000
#: One ruled URL in so many, by its hash, is held out for the threshold.
HOLD_OUT = 5
#: Bins of the score histogram from which the threshold is chosen, over scores from -LIMIT to LIMIT.
BINS, LIMIT = 4000, 10.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of place and verdict; null where none does."""
    found = F
    for rule in sorted(rules, key=lambda r: (-len(r.place), r.place)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = found.when(
            fits, F.struct(F.lit(rule.place).alias("place"), F.lit(rule.verdict).alias("verdict"))
        )
    return found


def windows(url: Column) -> Column:
    """For each character of a URL, and its end, the up to ``ORDER`` characters that end with it; the first ones with the mark of the begin."""
    marked = F.split(F.concat(F.lit("^"), url, F.lit("$")), "")

    def window(chars: Column, k: Column) -> Column:
        first = F.greatest(k - ORDER, F.lit(0))
        return F.array_join(F.slice(chars, first + 1, k - first), "")

    return let(marked, lambda chars: F.transform(F.sequence(F.lit(2), F.size(chars)), lambda k: window(chars, k)))


def ngrams(rows: DataFrame) -> DataFrame:
    """All n-grams of all URLs: how often each ends a character (``n``), and in the allowed and blocked ones to learn from (``n0, n1``).

    ``rows`` has ``url`` and ``blocked``, null where a URL is not to learn from. With the counts of its context: ``c0, c1``
    how often it was seen, ``t0, t1`` how many different characters followed.
    """
    counted = (
        rows.select("blocked", F.explode(windows(F.col("url"))).alias("window"))
        .groupBy("window")
        .agg(F.count("*").alias("n"), F.count_if(F.col("blocked") == 0).alias("n0"), F.count_if(F.col("blocked") == 1).alias("n1"))
    )
    size = F.char_length("window")
    suffixes = F.transform(F.sequence(F.lit(1), size), lambda k: F.substring("window", size - k + 1, k))
    grams = counted.select(F.explode(suffixes).alias("gram"), "n", "n0", "n1").groupBy("gram")
    grams = grams.agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")]).withColumn("size", F.char_length("gram"))
    # a context is followed by no more n-grams than there are characters
    same = Window.partitionBy(F.substring("gram", F.lit(1), F.col("size") - 1), "size")
    return grams.withColumns(
        {f"c{k}": F.sum(f"n{k}").over(same) for k in (0, 1)}
        | {f"t{k}": F.sum((F.col(f"n{k}") > 0).cast("long")).over(same) for k in (0, 1)}
    )


def values(grams: DataFrame) -> DataFrame:
    """What each n-gram adds to the score of a URL that has it as a window (``value``), and whether it is ``frequent``.

    A probability is that of the n-gram's suffix, refined by its own context if that was seen; level by level.
    """
    total = grams.filter("size = 1").agg(F.sum("n")).first()[0] or 0
    uniform = F.lit(1.0 / ALPHABET)

    def refined(k: int) -> Column:
        n, c, t = F.col(f"n{k}"), F.col(f"c{k}"), F.col(f"t{k}")
        return F.when(c > 0, (n + t * F.col(f"p{k}")) / (c + t)).otherwise(F.col(f"p{k}"))

    levels = []
    for size in range(1, ORDER + 1):
        level = grams.filter(F.col("size") == size)
        if levels:
            shorter = levels[-1].select(F.col("gram").alias("suffix"), "p0", "p1")
            level = level.withColumn("suffix", F.substring("gram", 2, size)).join(shorter, "suffix").drop("suffix")
        else:
            level = level.withColumns({"p0": uniform, "p1": uniform})
        levels.append(staged(level.select("gram", "n", refined(0).alias("p0"), refined(1).alias("p1"))))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    value = F.round((F.log("p0") - F.log("p1")) * UNIT).cast("long")
    return every.select("gram", value.alias("value"), (F.col("n") * FREQUENT >= F.lit(total)).alias("frequent"))


def scored(rows: DataFrame, value: DataFrame) -> DataFrame:
    """Adds ``score`` to rows with a number ``row`` of their own and ``url``: above zero if likelier allowed than blocked; per character."""
    ends = rows.select("row", F.explode(windows(F.col("url"))).alias("gram"))
    both = ends.join(F.broadcast(value.filter("frequent").drop("frequent")), "gram", "left")
    near = both.filter("value IS NOT NULL").select("row", "value")
    far = both.filter("value IS NULL").select("row", "gram").join(value.filter("NOT frequent"), "gram").select("row", "value")
    sums = near.unionByName(far).groupBy("row").agg(F.sum("value").alias("__sum"))
    size = F.char_length("url")
    score = F.when(size == 0, F.lit(0.0)).otherwise(F.col("__sum") / UNIT / (size + 1))
    return rows.join(sums, "row").withColumn("score", score).drop("__sum")


def threshold(held_out: DataFrame) -> float:
    """The score at which the shares of wrongly judged URLs of both classes add up to the least.

    ``held_out`` has ``score`` and ``blocked``; the driver gets a histogram of fixed size.
    """
    step = 2 * LIMIT / BINS
    bin_ = F.least(F.greatest(F.floor((F.col("score") + LIMIT) / step), F.lit(0)), F.lit(BINS - 1))
    rows = held_out.groupBy("blocked", bin_.cast("int").alias("bin")).count().toPandas()
    found = {k: np.zeros(BINS) for k in (0, 1)}
    for k, part in rows.groupby("blocked"):
        found[int(k)][part["bin"].to_numpy()] = part["count"].to_numpy()
    if not found[0].sum() or not found[1].sum():
        return 0.0
    lost = np.concatenate([[0], np.cumsum(found[0])]) / found[0].sum()  # allowed ones below the edge
    passed = 1 - np.concatenate([[0], np.cumsum(found[1])]) / found[1].sum()
    wrong = lost + passed
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(best[len(best) // 2] * step - LIMIT)


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the model's score where no rule fits."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.select(
        "id", "url", "host", "path", F.col("found.place").alias("rule"), F.col("found.verdict").alias("verdict")
    )
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()))
    held_out = F.pmod(F.xxhash64("url"), F.lit(HOLD_OUT)) == 0
    blocked = F.when(F.col("rule").isNotNull(), (F.col("verdict") == "block").cast("int"))
    grams = staged(ngrams(rows.select("url", F.when(~held_out, blocked).alias("blocked"))))
    seen = grams.filter("size = 1").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not (seen["n0"] and seen["n1"]):
        return rows.select(
            F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
            F.lit(None).cast("double").alias("score"),
        )
    known = staged(scored(rows, values(grams)))
    edge = threshold(known.filter(F.col("rule").isNotNull() & held_out).select("score", blocked.alias("blocked")))
    by_model = F.when(F.col("score") < edge, "block").otherwise("allow")
    return known.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", by_model).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
    )
