"""Header inference from two adjacent rows, as array expressions.

All functions take and return columns. Blocks are described by their sorted 0-based start
positions and one common length.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportgrid.functions.cells import let, looks_like_header, norm_row, token_class
from reportgrid.functions.names import apply_rules, build_names, name_score


def first_filled(cells: Column) -> Column:
    return F.try_element_at(F.filter(cells, lambda c: c != ""), F.lit(1))


def fill_left(cells: Column) -> Column:
    """Empty cells take the nearest label on their left."""

    def fill(row: Column) -> Column:
        def nearest(_: Column, i: Column) -> Column:
            seen = F.filter(F.slice(row, F.lit(1), i + 1), lambda c: c != "")
            return F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(""))

        return F.transform(row, nearest)

    return let(norm_row(cells), fill)


def fill_right(cells: Column) -> Column:
    """Empty cells take the nearest label on their right."""

    def fill(row: Column) -> Column:
        return F.transform(
            row,
            lambda _, i: F.coalesce(first_filled(F.slice(row, i + 1, F.size(row))), F.lit("")),
        )

    return let(norm_row(cells), fill)


def fill_score(cells: Column) -> Column:
    """100 per empty cell, 2 per change between neighbours, 50 for an empty last cell."""

    def score(row: Column) -> Column:
        empties = F.size(F.filter(row, lambda c: c == ""))
        changes = F.size(
            F.filter(
                F.transform(row, lambda c, i: (i > 0) & (c != F.get(row, i - 1))),
                lambda changed: changed,
            )
        )
        open_end = F.coalesce(F.try_element_at(row, F.lit(-1)) == "", F.lit(False)).cast("int")
        return empties * 100 + changes * 2 + open_end * 50

    return let(norm_row(cells), score)


def smart_fill(cells: Column) -> Column:
    """The right fill when it scores strictly lower, else the left fill."""
    both = F.struct(fill_left(cells).alias("l"), fill_right(cells).alias("r"))
    return let(
        both, lambda b: F.when(fill_score(b["r"]) < fill_score(b["l"]), b["r"]).otherwise(b["l"])
    )


def signature(cells: Column) -> Column:
    return F.transform(cells, token_class)


def ngrams(classes: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring classes, joined by a comma, by start position."""
    starts = F.when(
        F.size(classes) >= n, F.sequence(F.lit(0), F.size(classes) - n)
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(classes, i + 1, F.lit(n)), ","))


def repeated_ngrams(grams: Column, min_count: int = 2) -> Column:
    """The n-grams seen at least ``min_count`` times, by first appearance."""
    return F.filter(
        F.array_distinct(grams),
        lambda g: F.size(F.filter(grams, lambda x: x == g)) >= min_count,
    )


def ngram_starts(grams: Column, gram: Column) -> Column:
    found = F.transform(grams, lambda g, i: F.when(g == gram, i))
    return F.filter(found, lambda i: i.isNotNull())


def drop_overlaps(starts: Column, n: Column | int) -> Column:
    """Keeps, from the left, each block that begins after the end of the last kept one."""
    length = F.lit(n) if isinstance(n, int) else n
    return F.aggregate(
        starts,
        F.array().cast("array<int>"),
        lambda kept, s: F.when(
            s >= F.coalesce(F.try_element_at(kept, F.lit(-1)) + length, F.lit(0)),
            F.concat(kept, F.array(s)),
        ).otherwise(kept),
    )


def pattern_priority(gram: Column) -> Column:
    parts = F.split(gram, ",")
    pct, cur = F.array_contains(parts, "PCT"), F.array_contains(parts, "CUR")
    return F.when(pct & cur, 3).when(pct, 2).when(cur, 1).otherwise(0)


def block_context(row1: Column, starts: Column, n: int) -> Column:
    """How well blocks fit the first header row: fillable and covered empties, penalty."""

    def one(start: Column) -> Column:
        def measure(cells: Column) -> Column:
            empties = F.size(F.filter(cells, lambda c: c == ""))
            labels = F.size(F.array_distinct(F.filter(cells, lambda c: c != "")))
            return F.struct(
                F.when(labels > 0, empties).otherwise(0).alias("fillable"),
                empties.alias("covered"),
                (F.greatest(labels - 1, F.lit(0)) * 10).alias("penalty"),
            )

        return let(F.slice(row1, start + 1, F.lit(n)), measure)

    def total(blocks: Column, field: str) -> Column:
        return F.aggregate(blocks, F.lit(0), lambda acc, b: acc + b[field])

    return let(
        F.transform(starts, one),
        lambda blocks: F.struct(
            total(blocks, "fillable").alias("fillable"),
            total(blocks, "covered").alias("covered"),
            total(blocks, "penalty").alias("penalty"),
        ),
    )


def pair_starts(classes: Column) -> Column:
    """Starts of the neighbouring pairs (currency, percent)."""
    return ngram_starts(ngrams(classes, 2), F.lit("CUR,PCT"))


NO_BLOCKS = (
    "struct<fillable:int,coverage:int,priority:int,merit:int,n:int,early:int,"
    "starts:array<int>,gram:string>"
)


def _candidates(row1: Column, classes: Column, n: int, min_count: int) -> Column:
    def of_grams(grams: Column) -> Column:
        def of_gram(gram: Column, order: Column) -> Column:
            def rank(starts: Column) -> Column:
                return let(
                    block_context(row1, starts, n),
                    lambda ctx: F.struct(
                        ctx["fillable"].alias("fillable"),
                        (F.size(starts) * n).alias("coverage"),
                        pattern_priority(gram).alias("priority"),
                        (-ctx["penalty"]).alias("merit"),
                        F.lit(n).alias("n"),
                        (-order).alias("early"),
                        starts.alias("starts"),
                        gram.alias("gram"),
                    ),
                )

            return let(drop_overlaps(ngram_starts(grams, gram), n), rank)

        return F.transform(repeated_ngrams(grams, min_count), of_gram)

    return let(ngrams(classes, n), of_grams)


def best_blocks(row1: Column, row2: Column, min_count: int = 2, max_n: int = 4) -> Column:
    """The blocks that guide the fill of the first row.

    Pairs (currency, percent) win when they fill at least one empty cell. Otherwise the best
    repeated n-gram by fillable empties, coverage, priority, low penalty and length; ties go
    to the first seen. ``starts`` is empty when there is no block.
    """

    def choose(given: Column) -> Column:
        r1, classes = given["r1"], given["sig"]
        width = F.greatest(F.size(classes), F.lit(1))
        ranked = F.array_max(
            F.concat(*[_candidates(r1, classes, n, min_count) for n in range(2, max_n + 1)])
        )

        def forced(pairs: Column) -> Column:
            def decide(fillable: Column) -> Column:
                return F.when(
                    fillable > 0,
                    F.struct(
                        F.lit(True).alias("forced"),
                        fillable.alias("fillable"),
                        F.lit(2).alias("n"),
                        pairs.alias("starts"),
                        (F.size(pairs) * 2 / width).alias("coverage_ratio"),
                        F.lit("CUR,PCT").alias("gram"),
                    ),
                ).otherwise(
                    let(
                        ranked.cast(NO_BLOCKS),
                        lambda best: F.struct(
                            F.lit(False).alias("forced"),
                            F.coalesce(best["fillable"], F.lit(0)).alias("fillable"),
                            F.coalesce(best["n"], F.lit(0)).alias("n"),
                            F.coalesce(best["starts"], F.array().cast("array<int>")).alias("starts"),
                            F.coalesce(best["coverage"] / width, F.lit(0.0)).alias("coverage_ratio"),
                            best["gram"].alias("gram"),
                        ),
                    )
                )

            return let(block_context(r1, pairs, 2)["fillable"], decide)

        return let(pair_starts(classes), forced)

    return let(F.struct(norm_row(row1).alias("r1"), signature(row2).alias("sig")), choose)


def block_fill(current: Column, original: Column, starts: Column, n: Column | int) -> Column:
    """Fills, inside each block only, the cells empty in ``original`` with the block's label."""
    length = F.lit(n) if isinstance(n, int) else n

    def fill(rows: Column) -> Column:
        cur, orig = rows["cur"], rows["orig"]

        def cell(value: Column, i: Column) -> Column:
            start = F.try_element_at(
                F.filter(starts, lambda s: (s <= i) & (i < s + length)), F.lit(1)
            )
            label = F.coalesce(
                first_filled(F.slice(orig, start + 1, length)),
                first_filled(F.slice(cur, start + 1, length)),
            )
            return F.when(F.get(orig, i) == "", F.coalesce(label, value)).otherwise(value)

        return F.transform(cur, cell)

    return let(F.struct(norm_row(current).alias("cur"), norm_row(original).alias("orig")), fill)


def infer_header(
    row1: Column,
    row2: Column,
    tokens: Iterable[str],
    rules: Sequence[dict] = (),
) -> Column:
    """``struct(names, period_agg, use_block)`` from two rows, or null when they are no header."""

    def names_of(first: Column, second: Column) -> Column:
        return apply_rules(build_names(first, second), rules, "pre")

    def with_blocks(given: Column) -> Column:
        r1, r2, smart, blocks = given["r1"], given["r2"], given["smart"], given["blocks"]
        usable = (F.size(blocks["starts"]) > 0) & (
            (blocks["fillable"] > 0) | (blocks["coverage_ratio"] >= 0.40)
        )
        filled_by_block = block_fill(smart, r1, blocks["starts"], blocks["n"])
        candidates = F.struct(
            smart.alias("row_a"),
            names_of(smart, r2).alias("names_a"),
            F.when(usable, filled_by_block).alias("row_b"),
            blocks.alias("blocks"),
            r2.alias("r2"),
        )
        return let(candidates, with_both)

    def with_both(c: Column) -> Column:
        return let(
            F.struct(
                c["row_a"].alias("row_a"),
                c["names_a"].alias("names_a"),
                c["row_b"].alias("row_b"),
                F.when(c["row_b"].isNotNull(), names_of(c["row_b"], c["r2"])).alias("names_b"),
                c["blocks"].alias("blocks"),
            ),
            decide,
        )

    def decide(c: Column) -> Column:
        score_a, score_b = name_score(c["names_a"]), name_score(c["names_b"])
        telling = (
            c["blocks"]["forced"]
            | (c["blocks"]["fillable"] > 0)
            | (c["blocks"]["coverage_ratio"] >= 0.60)
        )
        use_block = F.coalesce(
            c["names_b"].isNotNull()
            & (
                (score_b < score_a)
                | ((score_b == score_a) & (c["names_b"] != c["names_a"]) & telling)
            ),
            F.lit(False),
        )
        row = F.when(use_block, c["row_b"]).otherwise(c["row_a"])
        names = F.when(use_block, c["names_b"]).otherwise(c["names_a"])
        return F.struct(
            apply_rules(names, rules, "post").alias("names"),
            F.get(row, F.lit(0)).alias("period_agg"),
            use_block.alias("use_block"),
        )

    valid = (
        row1.isNotNull()
        & row2.isNotNull()
        & F.coalesce(looks_like_header(row1, tokens), F.lit(False))
        & F.coalesce(looks_like_header(row2, tokens), F.lit(False))
    )
    given = F.struct(
        norm_row(row1).alias("r1"),
        norm_row(row2).alias("r2"),
        smart_fill(row1).alias("smart"),
        best_blocks(row1, row2).alias("blocks"),
    )
    return F.when(valid, let(given, with_blocks))
