from helpers import row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportgrid.config import ReportConfig
from reportgrid.functions import headers as H
from reportgrid.functions import names as N

CFG = ReportConfig()
SECOND = ["euro/000", "2025", "2024", "2025", "Eur", "%", "Eur", "%"]
NAMES = ["item_agg", "2025_act", "2024_act", "2025_bdg", "eur_vs_act", "pct_vs_act", "eur_vs_bdg", "pct_vs_bdg"]


def second_row():
    return row(*SECOND)


def infer(first, second):
    return H.infer_header(first, second, CFG.header_tokens, CFG.rules())


def test_clean_pair(value):
    first = row("December", "Act", "Act", "Bdg", "vs Act", "", "vs Bdg", "")
    got = value(
        left=H.fill_score(H.fill_left(first)), right=H.fill_score(H.fill_right(first)),
        sig=H.signature(second_row()), best=H.best_blocks(first, second_row()), header=infer(first, second_row()),
    )
    assert (got["left"], got["right"]) == (8, 160)
    assert got["sig"] == ["UNIT", "YEAR", "YEAR", "YEAR", "CUR", "PCT", "CUR", "PCT"]
    assert got["best"]["forced"] and got["best"]["fillable"] == 2 and got["best"]["starts"] == [4, 6]
    assert got["header"] == {"names": NAMES, "period_agg": "December", "use_block": False}


def test_labels_above_the_right_cell(value):
    first = row("December", "Act", "Act", "Bdg", "", "vs Act", "", "vs Bdg")
    got = value(smart=H.smart_fill(first), header=infer(first, second_row()))
    assert got["smart"] == ["December", "Act", "Act", "Bdg", "Bdg", "vs Act", "vs Act", "vs Bdg"]
    assert got["header"] == {"names": NAMES, "period_agg": "December", "use_block": True}


def test_fill_scores(value):
    first = row("", "Act", "", "Bdg", "")
    got = value(
        left=H.fill_left(first), right=H.fill_right(first),
        sl=H.fill_score(H.fill_left(first)), sr=H.fill_score(H.fill_right(first)),
    )
    assert got == {
        "left": ["", "Act", "Act", "Bdg", "Bdg"], "right": ["Act", "Act", "Bdg", "Bdg", ""],
        "sl": 104, "sr": 154,
    }


def test_no_header(value):
    got = value(a=infer(row("x", "y", "z"), row("1", "2", "3")), b=infer(F.lit(None).cast("array<string>"), second_row()))
    assert got == {"a": None, "b": None}


def test_repeated_ngram_without_pairs(value):
    first = row("December", "Act", "", "Bdg", "")
    second = row("euro/000", "x", "2025", "x", "2025")
    best = value(b=H.best_blocks(first, second))["b"]
    # the pattern TXT,YEAR twice: both blocks have one empty cell to fill
    assert (best["gram"], best["starts"], best["fillable"], best["forced"]) == ("TXT,YEAR", [1, 3], 2, False)


def test_overlaps(value):
    got = value(a=H.drop_overlaps(F.array(*[F.lit(i) for i in (0, 1, 2, 3, 7)]), 2), b=H.pattern_priority(F.lit("CUR,TXT")))
    assert got == {"a": [0, 2, 7], "b": 1}


def test_rules(value):
    placeholder = {"stage": "pre", "type": "replace_segment", "tokens": ["december"], "placeholder": "PER", "min_hits": 2}
    both = {**placeholder, "tokens": ["december", "ytd"], "min_hits": 1}
    got = value(
        a=N.apply_rules(row("euro/000_december", "december_2025", "2024_act"), CFG.header_rules, "pre"),
        b=N.apply_rules(row("x", "item_agg", "y"), CFG.header_rules, "pre"),
        c=N.apply_rules(row("a", "act_december", "bdg_december"), [placeholder], "pre"),
        d=N.apply_rules(row("a", "act_december", "b"), [placeholder], "pre"),
        e=N.apply_rules(row("act_december", "act_ytd"), [both], "pre"),
        f=N.apply_rules(row("a"), CFG.header_rules, "post"),
    )
    assert got["a"] == ["item_agg", "item_agg_2", "2024_act"]
    assert got["b"] == ["x", "item_agg", "y"]
    assert got["c"] == ["a", "act_PER", "bdg_PER"]
    assert got["d"] == ["a", "act_december", "b"]
    assert got["e"] == ["act_december", "act_ytd"]
    assert got["f"] == ["a"]


def test_name_checks(value):
    names = ["run_id", "2024", "12,7%", "1.426.832", "euro/000_december", "december 2025", "eur_ytd", "città"]
    got = value(
        n=F.filter(row(*names), N.is_numeric_name), b=F.filter(row(*names), N.has_bad_char),
        t=F.filter(row(*names), lambda n: N.has_bad_token(n)), d=N.duplicate_names(row("a", "b", "a", "a")),
        s=N.name_score(row("a", "a", "col_1")),
    )
    assert got["n"] == ["2024", "12,7%", "1.426.832"]
    assert got["b"] == ["12,7%", "1.426.832", "euro/000_december"]
    assert got["t"] == ["december 2025", "eur_ytd"]
    assert got["d"] == ["a"] and got["s"] == 1050


CELL = st.sampled_from(["", "Act", "Bdg", "x", "2025", "act_december", "act_ytd"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(CELL, min_size=1, max_size=6), min_size=1, max_size=20))
def test_fill_is_idempotent_and_rules_add_no_duplicates(spark, lists):
    rule = {"stage": "pre", "type": "replace_segment", "tokens": ["december", "ytd"], "placeholder": "p", "min_hits": 1}
    frame = spark.createDataFrame([(x,) for x in lists], "c array<string>").coalesce(1)
    c = F.col("c")
    for r in frame.select(
        H.fill_left(c).alias("l"), H.fill_left(H.fill_left(c)).alias("ll"),
        H.fill_right(c).alias("r"), H.fill_right(H.fill_right(c)).alias("rr"),
        c.alias("names"), N.apply_rules(c, [rule, *CFG.header_rules], "pre").alias("ruled"),
    ).collect():
        assert r.l == r.ll and r.r == r.rr
        assert len(r.ruled) - len(set(r.ruled)) <= len(r.names) - len(set(r.names))
