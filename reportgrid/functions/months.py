"""Month names and the first day of the month they name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportgrid.functions.cells import strip

# English and Italian month names and their short forms.
MONTHS = {
    "january": 1, "jan": 1, "gennaio": 1, "gen": 1,
    "february": 2, "feb": 2, "febbraio": 2,
    "march": 3, "mar": 3, "marzo": 3,
    "april": 4, "apr": 4, "aprile": 4,
    "may": 5, "maggio": 5, "mag": 5,
    "june": 6, "jun": 6, "giugno": 6, "giu": 6,
    "july": 7, "jul": 7, "luglio": 7, "lug": 7,
    "august": 8, "aug": 8, "agosto": 8, "ago": 8,
    "september": 9, "sep": 9, "sept": 9, "settembre": 9, "set": 9,
    "october": 10, "oct": 10, "ottobre": 10, "ott": 10,
    "november": 11, "nov": 11, "novembre": 11,
    "december": 12, "dec": 12, "dicembre": 12, "dic": 12,
}


def _month_map() -> Column:
    return F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])


def month_start(label: Column, year: int) -> Column:
    """First day of the month named by the first word of the label; null when unknown."""
    word = F.lower(F.get(F.split(strip(label), r"(?U)[\s,/_-]+"), F.lit(0)))
    return F.make_date(F.lit(int(year)), F.try_element_at(_month_map(), word), F.lit(1))


def month_start_text(label: Column, year: int, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(month_start(label, year), pattern)


def period_desc(label: Column) -> Column:
    """``MONTH`` when the whole label is a month name, else the label."""
    return F.when(strip(F.lower(label)).isin(*MONTHS), F.lit("MONTH")).otherwise(label)
