"""Functions on single values, each case by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import formula as M
from tidemark.functions import text as T

day = dt.date.fromisoformat


def of(spark, fn, values, kind="string"):
    """fn on each value; kind: the column's type."""
    rows = spark.createDataFrame([(i, v if v is None else str(v)) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", fn(F.col("v").cast(kind)).alias("x")).orderBy("i").collect()]


def test_month_ends_and_periods(spark):
    assert of(spark, D.snap_to_month_end, ["2026-07-04", "2026-03-15", "2026-03-16", None], "date") == [day("2026-06-30"), day("2026-02-28"), day("2026-03-31"), None]
    assert of(spark, lambda c: D.quarter_label(D.period_of(c, F.lit(6))), ["2026-06-30", "2026-09-28", "2026-10-03", "2026-05-31"], "date") == ["FY2026Q4", "FY2027Q1", "FY2027Q1", None]
    assert of(spark, lambda c: D.last_quarter_end_before(c, F.lit(1)), ["2026-04-30", "2026-05-01", "2026-02-10"], "date") == [day("2026-01-31"), day("2026-04-30"), day("2026-01-31")]
    assert of(spark, D.parse_period, ["FY2026Q3", "FY2026", "2026Q3", "FY2026Q5"]) == [(2026, 3), (2026, None), None, None]
    assert of(spark, lambda c: D.period_from_index(D.period_index(D.parse_period(c)) + 3), ["FY2026Q3", "FY2026Q1"]) == ["FY2027Q2", "FY2026Q4"]
    assert of(spark, lambda c: D.quarter_end(F.year(c), F.lit(1), F.lit(6)), ["2026-01-01"], "date") == [day("2025-09-30")]
    assert of(spark, lambda c: D.shift_years(c, -1), ["2024-02-29"], "date") == [day("2023-02-28")]
    assert of(spark, D.due_date, ["2026", "2026-Q1", "2026-H1", "2026-02-03", "soon", "2026-Q5"]) == [day("2026-12-31"), day("2026-03-31"), day("2026-06-30"), day("2026-02-03"), None, None]


def test_business_days(spark):
    cal = D.business_calendar(spark, 2020, 2027)
    closed = {r.day for r in cal.where("not is_business and weekday(day) < 5 and year(day) in (2021, 2022, 2026)").collect()}
    assert {day("2021-12-31"), day("2021-07-05"), day("2021-06-18"), day("2022-06-20"), day("2026-07-03"), day("2026-11-26"), day("2026-05-25"), day("2026-10-12")} <= closed
    assert day("2022-12-26") in closed and len([d for d in closed if d.year == 2026]) == 11
    rows = spark.createDataFrame([(day("2026-11-24"),), (day("2026-11-28"),), (day("2026-12-23"),)], "d date")
    assert [r.x for r in D.add_business_days(rows, "d", 5, cal, "x").orderBy("d").collect()] == [day("2026-12-02"), day("2026-12-04"), day("2026-12-31")]
    assert [r.x for r in D.previous_business_day(rows, "d", cal, "x").orderBy("d").collect()] == [day("2026-11-24"), day("2026-11-27"), day("2026-12-23")]


def test_deadlines_cross_daylight_saving(spark):
    utc = lambda s: dt.datetime.fromisoformat(s)
    assert of(spark, lambda c: D.deadline(c).cast("timestamp_ntz"), ["2026-03-10", "2026-11-03"], "date") == [utc("2026-03-10 03:59:59"), utc("2026-11-03 04:59:59")]
    assert of(spark, lambda c: F.from_utc_timestamp(D.merge_by(D.deadline(c)), D.NEW_YORK).cast("timestamp_ntz"), ["2026-03-10"], "date") == [utc("2026-03-06 22:59:59")]
    assert of(spark, lambda c: D.parse_acceptance(c).cast("timestamp_ntz"), ["20260109163000", "2026-07-01T20:00:00.000Z", "yesterday"]) == [utc("2026-01-09 21:30:00"), utc("2026-07-01 20:00:00"), None]


def test_identifiers(spark):
    assert of(spark, T.normalize_cik, ["320193", "CIK0000320193", "x1", "12345678901"]) == ["0000320193", "0000320193", None, None]
    assert of(spark, T.normalize_accession, ["000032019324000123", "0000320193-24-000123", "12"]) == ["0000320193-24-000123"] * 2 + [None]
    assert of(spark, T.form_key, ["10-Q", "DEF 14A", "8-K/A", "FORM3", "Schedule 13G"]) == ["10Q", "DEF14A", "8KA", "3", "SC13G"]
    got = of(spark, T.parse_tag, ["BRK.B-10Q-FY2026Q2", "X-8K-2026-01-02-3", "X-8K-2026-02-31", "X-OTHER-thing", "nothing"])
    assert [g and (g.ticker, g.form, g.period, g.date, g.ordinal) for g in got] == [("BRK.B", "10Q", "FY2026Q2", None, 1), ("X", "8K", None, day("2026-01-02"), 3), None, ("X", "OTHER", None, None, 1), None]


def test_texts(spark):
    assert of(spark, T.estimate_tokens, ["", "a" * 26, "é" * 3 + "ab", None]) == [0, 10, 3, None]
    page = "<html><head><title>no</title></head><body><script>x</script><p>202<span>5</span> a&amp;b<br>next&nbsp;&lt;line</p>\n\n</body></html>"
    assert of(spark, T.html_to_text, [page, None]) == ["2025 a&b\nnext <line", None]
    assert of(spark, lambda c: T.redact(c, ["key", "key-long"]), ["the key-long and key"]) == ["the *** and ***"]
    assert of(spark, T.parse_money, ["$1,304.00", "n/a"]) == [1304.0, None]
    assert of(spark, T.parse_number, ["(1,200)", "−3.5%", "$7", ""]) == [-1200.0, -3.5, 7.0, None]
    assert of(spark, T.front_matter, ["---\na: 1\n---\nbody", "plain"]) == [("a: 1", "body"), (None, "plain")]
    got = of(spark, lambda c: T.headings(c, 2), ["intro\n## One\nx\n### deep\n## Two"])
    assert [(s.title, s.body) for s in got[0]] == [("", "intro"), ("One", "x\n### deep"), ("Two", "")]
    assert len(set(of(spark, T.content_hash, ["a \nb\r\n", "a\nb", "a\nb\n\n"]))) == 1
    assert of(spark, lambda c: T.stems(c, ["with"]), ["Margins with margin expansions, expansion"]) == [["margin", "expansi"]]
    assert of(spark, T.sentences, ["It rose. Then fell; See 3.5 of it! (Yes)"]) == [["It rose.", "Then fell;", "See 3.5 of it!", "(Yes)"]]


def test_figures(spark):
    text = "Revenue of $1,234.5M in FY2026Q2, up 7% from (3.2) on 2026-01-02; −4 bps, 2.5x, item 10-K, 1999, 12 points [src:X-10K-FY2025] and $2 billion."
    got = of(spark, T.figures, [text, None])
    assert [(f.value, f.unit, f.decimals) for f in got[0]] == [(1234.5, "M", 1), (7.0, "%", 0), (-3.2, "", 1), (-4.0, "bp", 0), (2.5, "x", 1), (12.0, "pt", 0), (2.0, "B", 0)]
    assert got[1] is None
    assert of(spark, T.distinctive, ["$7", "1.5", "120", "012"]) == [False, True, True, False]
    assert of(spark, lambda c: T.same_number(c, F.lit(-3.24), F.lit(1)), ["3.2", "3.3", "3.19"], "double") == [True, False, True]


@pytest.mark.parametrize(
    ("text", "want"),
    [("1 + 2", 3.0), ("$3,700M + $0.5B", 4200.0), ("(236.90 − 208.88) ÷ 208.88", (236.9 - 208.88) / 208.88), ("1.08 ^ 10", 1.08**10), ("21% × 200", 42.0), ("2 x (3)", 6.0), ("1 / 0", None), ("12", None), ("a + 1", None), ("9 ^ 999", None), ("08 + 1", 9.0), (None, None), ("(" * 300 + "1+1" + ")" * 300, None)],
)
def test_formulas(text, want):
    got = M.evaluate(text)
    assert got == pytest.approx(want) if want is not None and got is not None else got is None or want is not None


def test_written_statements(spark):
    got = of(spark, M.written, ["so 2 × $3.50 = $7.00 and 10 − 4 = 5; x = 9"])
    assert [(s.formula, s.result, s.decimals) for s in got[0]] == [("2 × $3.50", 7.0, 2), ("10 − 4", 5.0, 0)]
    assert of(spark, M.value_of, ["2 × $3.50", "oops", None]) == [7.0, None, None]
