"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a condition under which a text is rejected. What a rule costs and how often it rejects
is measured on a bounded sample; the rules then run in the order of rejections per cost, and a text
that a rule rejects is not looked at by the later ones. The order changes the cost and the name of
the first failing rule, never which texts are kept.

Defined results: a null or blank text has no words and fails the base rules; an empty table gives an
empty result; repeated rows get the same answer each; further columns are ignored.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportgrid.llm.tables import WORD_GAP, words_of

#: Words in a window of which repetitions are counted.
WINDOW = 5
#: Rows on which the cost and the selectivity of the rules are measured.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``fails`` holds; ``fails`` is made from the columns of ``measures``."""

    name: str
    fails: Column


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the text, the words and the counts that the rules are made of."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("lines", lines)
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn(
        "hashes",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(F.col("words"), i, F.lit(WINDOW))),
            ),
        ),
    )
    # only texts with a repeated window pay for finding where the repetitions are
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn(
        "sorted",
        F.when(
            repeats,
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )

    def same(x: Column, j: Column, step: int) -> Column:
        return F.coalesce(F.get("sorted", j + step)["h"] == x["h"], F.lit(False))

    rows = rows.withColumn(
        "starts",
        F.sort_array(
            F.transform(
                F.filter("sorted", lambda x, j: same(x, j, -1) | same(x, j, 1)), lambda x: x["i"]
            )
        ),
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(
            p.alias("last"),
            (a["n"] + F.least(p - a["last"], F.lit(WINDOW))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    return rows.select(
        "doc_id",
        "text",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> list[Rule]:
    """The rules beside the base ones; all are shares of what the text itself holds."""
    text = F.coalesce(F.col("text"), F.lit(""))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    ended = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        Rule(
            "word_length",
            (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 25 * F.col("n_words")),
        ),
        Rule("shouting", 2 * upper > letters),
        Rule("cut_lines", 10 * ended > 3 * F.col("n_lines")),
    ]


def ordered(sample: DataFrame, given: list[Rule]) -> list[Rule]:
    """The rules by rejections per cost, measured on a sample of ``measures`` that is small and kept in memory."""
    sample = sample.cache()
    try:
        rows = sample.count()

        def seconds(what: Column) -> tuple[float, int]:
            start = time.perf_counter()
            hits = sample.agg(F.sum(what.cast("long"))).first()[0]
            return time.perf_counter() - start, hits or 0

        if not rows:
            return given
        seconds(F.lit(True))  # the first job pays for compiling
        idle, _ = seconds(F.lit(True))
        rated = []
        for k, rule in enumerate(given):
            took, hits = min(seconds(rule.fails) for _ in range(2))
            rated.append((-hits / rows / max(took - idle, 1e-3), k, rule))
        return [rule for *_, rule in sorted(rated, key=lambda x: x[:2])]
    finally:
        sample.unpersist()


def cascade(measured: DataFrame, given: list[Rule]) -> DataFrame:
    """Adds ``failed``: the name of the first rule that rejects a row, null where none does.

    Later rules are not evaluated for a row that an earlier one rejects.
    """
    first = F
    for rule in given:
        first = first.when(rule.fails, F.lit(rule.name))
    return measured.withColumn("failed", first if given else F.lit(None).cast("string"))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Per row of ``docs``: its counts, ``base_failed``, and ``kept``."""
    base = Rule("base", base_failed())
    sample = measures(docs.limit(sample_rows), id_col, text_col)
    found = cascade(measures(docs, id_col, text_col), [base, *ordered(sample, rules())])
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.fails.alias("base_failed"),
        F.col("failed").isNull().alias("kept"),
    )
