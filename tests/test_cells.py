from helpers import row, text

from reportgrid.config import ReportConfig
from reportgrid.functions import cells as C
from reportgrid.functions import months as M
from reportgrid.functions import numbers as X

TOKENS = ReportConfig().header_tokens


def test_norm_and_empty(value):
    got = value(
        a=C.norm(text("  x\t")), b=C.norm(text(" NaN ")), c=C.norm(text(None)),
        d=C.is_empty(text("  ")), e=C.is_empty(text("0")),
    )
    assert got == {"a": "x", "b": "", "c": "", "d": True, "e": False}


def test_empty_ratio(value):
    got = value(a=C.empty_ratio(row("", None, "nan ", "x")), b=C.empty_ratio(row()))
    assert got == {"a": 0.75, "b": None}


def test_simple_numeric(value):
    cases = ["1.426,5%", "-", "+5", "12", "a1", "", "٣"]
    got = value(**{f"c{i}": C.is_simple_numeric(text(c)) for i, c in enumerate(cases)})
    assert list(got.values()) == [True, False, False, True, False, False, True]


def test_header_rows(value):
    cases = [
        (("euro/000", "2024", "2025", "2024", "2025"), False),
        (("Pharma", "", ""), True),
        (("Pharma", "Oncology", ""), False),
        (("", "nan", None), False),
        (("Act", "2025"), True),
        (("vs  Act",), True),
    ]
    got = value(**{f"c{i}": C.looks_like_header(row(*c), TOKENS) for i, (c, _) in enumerate(cases)})
    assert list(got.values()) == [want for _, want in cases]


def test_token_class(value):
    cases = {"": "EMPTY", "2025": "YEAR", "%": "PCT", "euro/000": "UNIT", "k€": "UNIT", "Eur": "CUR", "$": "CUR", "Act": "TXT"}
    got = value(**{f"c{i}": C.token_class(text(c)) for i, c in enumerate(cases)})
    assert list(got.values()) == list(cases.values())


def test_similarity(value):
    got = value(
        a=C.positional_similarity(row("Dec", "", "Act"), row("YTD", "", "Act")),
        b=C.positional_similarity(row("", ""), row("x")),
        c=C.positional_similarity(row("x", "Act", "Bdg"), row("y", "Act", "Bdg")),
    )
    assert got["a"] == 0.5 and got["b"] == 0.0 and abs(got["c"] - 2 / 3) < 1e-12


def test_sentinels(value):
    cases = [" ", "", "n.s.", "null", "n.s", "  ", "N.S.", " n.s."]
    got = value(**{f"c{i}": X.null_sentinels(text(c)) for i, c in enumerate(cases)})
    assert list(got.values()) == [None] * 5 + ["  ", "N.S.", " n.s."]


def test_percent(value):
    cases = {"12,5%": 0.125, "-5%": -0.05, " 7 %": 0.07, "1.234,5%": None, "abc%": None}
    got = value(**{f"c{i}": X.parse_percent(text(c)) for i, c in enumerate(cases)})
    assert list(got.values()) == list(cases.values())


def test_number(value):
    cases = {
        "1.426.832": 1426832.0, "1.234,56": 1234.56, "12.7": 127.0, "-3,5": -3.5,
        "1d": None, "1_000": None, "nan": None, "1e5": 1e5, " 12 ": 12.0, "-inf": float("-inf"),
    }
    got = value(**{f"c{i}": X.parse_eu_number(text(c)) for i, c in enumerate(cases)})
    assert list(got.values()) == list(cases.values())


def test_utc(value):
    got = value(a=X.utc_naive(text("2026-01-02 03:04:05+02:00")), b=X.utc_naive(text("2026-01-02T03:04:05")), c=X.utc_naive(text("x")))
    assert str(got["a"]) == "2026-01-02 01:04:05"
    assert str(got["b"]) == "2026-01-02 03:04:05"
    assert got["c"] is None


def test_month_start(value):
    cases = {
        "December": 12, "dic": 12, "Dec-2024": 12, " dec/x": 12, "sept": 9, "gennaio": 1,
        "YTD": None, "/dec": None, None: None,
    }
    got = value(**{f"c{i}": M.month_start(text(c), 2025) for i, c in enumerate(cases)})
    assert [d and (d.year, d.month, d.day) for d in got.values()] == [
        m and (2025, m, 1) for m in cases.values()
    ]


def test_period_desc(value):
    got = value(a=M.period_desc(text(" December ")), b=M.period_desc(text("Dec 2025")), c=M.period_desc(text("YTD")), d=M.period_desc(text(None)))
    assert got == {"a": "MONTH", "b": "Dec 2025", "c": "YTD", "d": None}
