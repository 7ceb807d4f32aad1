"""Text to number and text to time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportgrid.functions.cells import WHITESPACE, strip

# Cell texts that stand for a missing value.
SENTINELS = (" ", "", "n.s.", "null", "n.s")

# Plain decimal or exponent text, and infinity, as patterns. A cast is tried only on what fits: one that fails costs as much as
# many patterns. ``cast`` drops the white space below 0x21, ``strip`` all of it.
_DECIMAL = r"[+-]?+(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+"
_INFINITY = "(?i:[+-]?+inf(?:inity)?+)"
PLAIN_NUMBER = rf"^(?:[ \t\n\x0B\f\r]*+{_DECIMAL}[ \t\n\x0B\f\r]*+|[ \t-\r\x1C-\x1F]*+{_INFINITY}[ \t-\r\x1C-\x1F]*+)\z"
PADDED_NUMBER = rf"^[{WHITESPACE}]*+(?:{_DECIMAL}|{_INFINITY})[{WHITESPACE}]*+\z"


def null_sentinels(text: Column) -> Column:
    """Null when the whole text is a sentinel; no trimming, case matters."""
    return F.when(~text.isin(*SENTINELS), text)


def strict_double(text: Column) -> Column:
    """A double for plain decimal or exponent text; null for anything else, also for what a cast would take (``1d``, ``0x1p3``, ``nan``)."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def _percent_text(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))


def _eu_text(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def is_percent(text: Column) -> Column:
    """Does :func:`parse_percent` find a number? Null for null."""
    return _percent_text(text).rlike(PADDED_NUMBER)


def is_eu_number(text: Column) -> Column:
    """Does :func:`parse_eu_number` find a number? Null for null."""
    return _eu_text(text).rlike(PLAIN_NUMBER)


def parse_percent(text: Column) -> Column:
    """``12,5%`` gives 0.125."""
    plain = _percent_text(text)
    return F.when(plain.rlike(PADDED_NUMBER), strip(plain).try_cast("double")) / 100


def parse_eu_number(text: Column) -> Column:
    """``1.426.832,5`` gives 1426832.5; every dot counts as a thousands mark."""
    return strict_double(_eu_text(text))


# Endings that name a zone: an offset, Z, UTC or a region.
ZONED = r"([zZ]|[+-]\d{2}:?\d{2}|UTC|GMT|[A-Za-z]+/[A-Za-z_/+-]+)\s*$"


def utc_naive(time: Column, kind: str = "string") -> Column:
    """An instant as UTC wall time without zone; ``kind`` is the type of the column.

    Text is read as UTC unless it names a zone, whatever the session's zone; text that cannot be read is null. A
    timestamp is an instant already, one without zone is kept.
    """
    if kind == "timestamp_ntz":
        return time
    if kind == "timestamp":
        instant = time
    else:
        instant = F.when(time.rlike(ZONED), time).otherwise(F.concat(time, F.lit("Z"))).try_cast("timestamp")
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")
