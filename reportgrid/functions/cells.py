"""Column expressions on single cells and on rows of cells (``array<string>``)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space when it strips text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Decimal digits of any script plus the super- and subscript digits.
DIGITS_ONLY = "^[\\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds ``value`` once inside an expression, so ``body`` may use it many times."""
    return F.transform(F.array(value), body)[0]


def strip(cell: Column) -> Column:
    return F.btrim(cell, F.lit(WHITESPACE))


def norm(cell: Column) -> Column:
    """Stripped text; null and any spelling of ``nan`` become the empty string."""
    text = strip(cell)
    return F.when(cell.isNull() | (F.lower(text) == "nan"), F.lit("")).otherwise(text)


def is_empty(cell: Column) -> Column:
    return norm(cell) == ""


def norm_row(cells: Column) -> Column:
    """All cells normalised; each is stripped once. Only texts of three bytes can be a ``nan``."""
    return F.transform(
        F.transform(cells, strip),
        lambda t: F.when(t.isNull() | ((F.octet_length(t) == 3) & (F.lower(t) == "nan")), F.lit("")).otherwise(t),
    )


def filled(cells: Column, normed: bool = False) -> Column:
    """The non-empty normalised cells of a row, in order."""
    return F.filter(cells if normed else norm_row(cells), lambda c: c != "")


def empty_ratio(cells: Column, normed: bool = False) -> Column:
    """Share of empty cells; null for a row without cells. ``normed`` cells are taken as is."""
    width = F.size(cells)
    empty = F.filter(cells if normed else norm_row(cells), lambda c: c == "")
    return F.when(width > 0, F.size(empty) / width)


def is_simple_numeric(text: Column) -> Column:
    """Only digits are left once ``% , . -`` are dropped."""
    return F.translate(text, "%,.-", "").rlike(DIGITS_ONLY)


def known_tokens(tokens: Iterable[str]) -> list[str]:
    return sorted({t.lower().strip() for t in tokens})


def looks_like_header(
    cells: Column,
    tokens: Iterable[str],
    max_unknown: int = 1,
    numeric_threshold: float = 0.5,
    normed: bool = False,
) -> Column:
    """At most ``max_unknown`` words outside ``tokens`` and not mostly numbers.

    The words are looked at first: few rows of data pass, and only of those each cell is matched with the pattern of a number.
    """
    known = F.array(*[F.lit(t) for t in known_tokens(tokens)]).cast("array<string>")

    def decide(values: Column) -> Column:
        numeric = F.size(F.filter(values, is_simple_numeric))
        words = F.split(F.array_join(values, " "), " ")
        return (
            (F.size(values) > 0)
            & (F.size(F.array_except(words, known)) <= max_unknown)
            & (numeric <= F.size(values) * numeric_threshold)
        )

    return let(F.transform(filled(cells, normed), F.lower), decide)


def token_class(cell: Column) -> Column:
    """EMPTY, YEAR, PCT, UNIT, CUR or TXT, tested in that order."""

    def classify(t: Column) -> Column:
        def has_any(*parts: str) -> Column:
            found = F.contains(t, F.lit(parts[0]))
            for part in parts[1:]:
                found = found | F.contains(t, F.lit(part))
            return found

        return (
            F.when(t == "", "EMPTY")
            .when(t.rlike(DIGITS_ONLY) & (F.length(t) == 4), "YEAR")
            .when(t.isin("%", "pct", "percent"), "PCT")
            .when(has_any("/000", "k€", "k eur", "mn"), "UNIT")
            .when(has_any("eur", "€", "usd", "$", "gbp"), "CUR")
            .otherwise("TXT")
        )

    return let(F.lower(norm(cell)), classify)


def contains_keyword(cells: Column, keywords: Iterable[str]) -> Column:
    """Any cell holds any keyword, whatever the case.

    The cells are searched as one text, with a mark between them that no keyword holds.
    """
    words = [k.lower() for k in keywords]
    if not words:
        return F.lit(False)
    mark = next(m for m in ("\n", *map(chr, range(32))) if all(m not in w for w in words))
    text = F.lower(F.array_join(F.when(F.size(cells) > 0, cells), mark))
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return F.coalesce(found, F.lit(False))


def row_text(cells: Column) -> Column:
    """The non-empty cells of a row joined by a space."""
    return F.array_join(filled(cells), " ")


def title_text(row_texts: Column) -> Column:
    """Upper-cased texts of the title rows joined by a bar; null when all are blank."""
    return F.nullif(
        F.upper(F.array_join(F.filter(row_texts, lambda t: t != ""), " | ")), F.lit("")
    )


def positional_similarity(left: Column, right: Column) -> Column:
    """Share of equal cells, position by position, once the empty cells are dropped."""

    def compare(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        shorter = F.least(F.size(a), F.size(b))
        same = F.zip_with(F.slice(a, 1, shorter), F.slice(b, 1, shorter), lambda x, y: x == y)
        return F.when(shorter == 0, F.lit(0.0)).otherwise(
            F.size(F.filter(same, lambda s: s)) / shorter
        )

    return let(F.struct(filled(left).alias("a"), filled(right).alias("b")), compare)
