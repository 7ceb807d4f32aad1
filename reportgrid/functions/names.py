"""Column expressions on lists of column names: building, scoring, rules and checks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportgrid.functions.cells import let, norm, strip

# Tokens that mark a name as suspicious unless others are given.
BAD_TOKENS = ("december", "ytd", "eur_pct_vs_bdg", "eur_act", "eur_ytd", "eur_december")

# Year, percentage, number with thousands dots, number with one decimal mark.
NUMERIC_NAME = (
    r"^(\p{Nd}{4}|[+-]?\p{Nd}+([.,]\p{Nd}+)?%|[+-]?\p{Nd}{1,3}(\.\p{Nd}{3})*"
    r"|[+-]?\p{Nd}+([.,]\p{Nd}+)?)$"
)
# A letter, a number of any kind or the low line belong to a word; marks such as combining accents do not.
WORD_CHAR = r"\p{L}\p{N}_"
BAD_CHAR = rf"(?U)[^{WORD_CHAR}\s]"


def _text_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def build_names(row1: Column, row2: Column) -> Column:
    """``second first`` per column, lower-cased, with ``_`` and ``pct``; blank gives ``col_i``."""

    def one(pair: Column, i: Column) -> Column:
        text = F.concat_ws(" ", F.nullif(pair["b"], F.lit("")), F.nullif(pair["a"], F.lit("")))
        clean = F.replace(F.replace(F.lower(text), F.lit(" "), F.lit("_")), F.lit("%"), F.lit("pct"))
        return F.when(text == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(clean)

    pairs = F.zip_with(row1, row2, lambda a, b: F.struct(norm(a).alias("a"), norm(b).alias("b")))
    return let(pairs, lambda p: F.transform(p, one))


def name_score(names: Column) -> Column:
    """1000 per duplicate plus 50 per name made up for a blank column."""
    duplicates = F.size(names) - F.size(F.array_distinct(names))
    made_up = F.size(F.filter(names, lambda n: F.startswith(n, F.lit("col_"))))
    return duplicates * 1000 + made_up * 50


def has_segment(name: Column, tokens: Iterable[str]) -> Column:
    """Some ``_`` separated segment of the name is one of the tokens, whatever the case."""
    return F.arrays_overlap(F.split(F.lower(name), "_"), _text_array({t.lower(): 0 for t in tokens}))


def segment_hits(names: Column, tokens: Iterable[str]) -> Column:
    """0-based positions of the names holding one of the tokens as a segment."""
    tokens = list(tokens)
    marked = F.transform(names, lambda n, i: F.when(has_segment(n, tokens), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _keep_if_unique(candidate: Column, current: Column) -> Column:
    return let(
        candidate,
        lambda c: F.when(F.size(F.array_distinct(c)) == F.size(c), c).otherwise(current),
    )


def _set_name(names: Column, rule: dict) -> Column:
    at = int(rule.get("col_idx", -1))
    when = rule.get("when") or {"op": "always"}
    op = when.get("op", "always")
    if at < 0 or op not in ("always", "col_segment_in"):
        return names
    value = F.lit(rule.get("value")).cast("string")
    allowed = F.size(names) > at
    if op == "col_segment_in":
        name = F.get(names, F.lit(at))
        allowed = allowed & F.coalesce(has_segment(name, when.get("tokens", [])), F.lit(False))
    replaced = F.transform(names, lambda n, i: F.when(i == at, value).otherwise(n))
    return F.when(allowed, _keep_if_unique(replaced, names)).otherwise(names)


def _replace_segments(names: Column, rule: dict) -> Column:
    tokens = [t.lower() for t in rule.get("tokens", [])]
    if not tokens:
        return names
    placeholder = F.lit(rule.get("placeholder")).cast("string")

    def rewrite(name: Column) -> Column:
        parts = F.transform(
            F.split(name, "_"),
            lambda p: F.when(F.lower(p).isin(tokens), placeholder).otherwise(p),
        )
        return F.array_join(parts, "_")

    hits = F.size(F.filter(names, lambda n: has_segment(n, tokens)))
    enough = hits >= int(rule.get("min_hits", 2))
    return F.when(enough, _keep_if_unique(F.transform(names, rewrite), names)).otherwise(names)


def _bound(step: Callable[[Column, dict], Column], names: Column, rule: dict) -> Column:
    return let(names, lambda current: step(current, rule))


def apply_rules(names: Column, rules: Sequence[dict], stage: str) -> Column:
    """Applies the rules of a stage in order; a rule that would duplicate a name is skipped."""
    steps = {"set_colname": _set_name, "replace_segment": _replace_segments}
    for rule in rules:
        step = steps.get(rule.get("type"))
        if step is not None and rule.get("stage") == stage:
            names = _bound(step, names, rule)
    return names


def duplicate_names(names: Column) -> Column:
    """Names that occur more than once, each listed once, in order of first appearance."""
    return F.filter(
        F.array_distinct(names), lambda n: F.size(F.filter(names, lambda m: m == n)) > 1
    )


def is_numeric_name(name: Column) -> Column:
    return strip(name).rlike(NUMERIC_NAME)


def has_bad_char(name: Column) -> Column:
    return name.rlike(BAD_CHAR)


def has_bad_token(name: Column, tokens: Iterable[str] = BAD_TOKENS) -> Column:
    words = "|".join(re.escape(t) for t in tokens)
    return name.rlike(rf"(?iU)(?<![{WORD_CHAR}])({words})(?![{WORD_CHAR}])")
