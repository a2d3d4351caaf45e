"""Formulas, figures, printed values, requests, locators, units and edits on cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import formula as M
from tidemark.functions import requests as R
from tidemark.functions import text as T
from tidemark.functions import values as V
from tidemark.operators import checks as C
from tidemark.operators import documents as D
from tidemark.operators import edits as E
from tidemark.operators import joins as J
from tidemark.operators import selection as S
from tidemark.operators import units as U


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return rows.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "value"),
    [("$3,700M + $0.5B", 4200), ("1.08 ^ 10", 1.08**10), ("(236.90 − 208.88) ÷ 208.88", 0.134144), ("2 x 3", 6), ("10% × 5", 0.5), ("-2^2 + 1", -3), ("2^-1", 0.5), ("2^3^2", 512), ("8 − 2 − 1", 5), ("2 + 3 × 4", 14), ("1,234 - 34", 1200),
     ("5", None), ("-3", None), ("4 / 0", None), ("4 /", None), ("(1 + 2", None), ("1 + two", None), ("9 ^ 999", None), ("", None), (None, None)],
)
def test_formulas(text, value):
    assert M.evaluate(text) == (None if value is None else pytest.approx(value, rel=1e-5))


def test_rounding_of_formulas(spark):
    assert M.bounds("1.5 + 2.5") == pytest.approx((3.9, 4.1)) and M.bounds("100 × 3") == (300, 300)  # short whole numbers are exact
    assert M.bounds("1200 + 1") == (1200.5, 1201.5) and M.bounds("1 ÷ 0.0") is None
    assert M.chain("1.053^10 ÷ 1.072^10", "1.676 ÷ 2.004") == "holds" and M.chain("2 + 2", "5 + 0") == "wrong"
    assert M.chain("1.5 × 2", "1.54 × 2") == "loose" and M.chain("$3,700M + $0.5B", "$4.2B + $0B") == "holds" and M.chain("two", "2 + 2") is None
    rows = spark.createDataFrame([("2 × $1,000.50",), ("1 + 2 + 3",), ("5 ÷ 0",), (None,)], "f string")
    assert [r.v for r in rows.select(M.value_of("f").alias("v")).collect()] == [2001.0, 6.0, None, None]
    assert rows.select(M.bounds_of("f").alias("b")).first().b.low == pytest.approx(2000.99)
    said = spark.createDataFrame([(3.0, 2.5, 3.5, r, 0) for r in (3.0, -3.0, 4.0, 5.0)], "v double, l double, h double, r double, d int")
    assert [r.s for r in said.select(M.written_status(*(F.col(c) for c in "vlhrd")).alias("s")).collect()] == ["holds", "holds", "loose", "wrong"]
    row = spark.createDataFrame([([100.0, 20.0, 5.0, 85.0],), ([100.0, None, 5.0, 85.0],)], "c array<double>")
    found = [r.x for r in row.select(M.running_total(F.col("c"), F.array(*(F.lit(s) for s in "A−+="))).alias("x")).collect()]
    assert [(f.place, f.total, f.stated) for f in found[0]] == [(3, 85.0, 85.0)] and found[1] == []


def test_figures(spark):
    text = "On 1995-01-02 the FY1999Q1 total was $123.45M, or (1.2)%, in 1998 after 17 points. Item 7 says 5 million (up 5%) on March 3, a 30-day 10-K −2.5x [src:A-1] 12 1,234. $2024 0001234567-24-000001 5th"
    got = [(f.value, f.unit, f.decimals) for f in one(spark, T.figures("t"), t=text)]
    assert got == [(123.45, "M", 2), (-1.2, "%", 1), (17, "pt", 0), (5, "M", 0), (5, "%", 0), (-2.5, "x", 1), (12, "", 0), (1234, "", 0), (2024, "", 0)]
    assert one(spark, T.figures("t"), t="") == []


def test_visible_text_and_headings(spark):
    html = "<p>A&#8217;s&nbsp;&nbsp;b &mdash; &amp;lt; &#x41; &zz; <b>c</b>d</p><ix:header>zz</ix:header><td>x<td>y a < b"
    assert one(spark, T.html_to_text("t"), t=html) == "A’s b — &lt; A &zz; cd\nx\ny a < b"
    assert [(s.title, s.body) for s in one(spark, T.headings("t", 1), t="x\n# A\nb\n```\n# no\n```\n# B\n")] == [("", "x"), ("A", "b\n```\n# no\n```"), ("B", "")]


@pytest.mark.parametrize(
    ("value", "unit", "forms"),
    [(16698.0, "", ["16,698", "16698"]), (17.0, "", ["17", "17.0"]), (135.2, "", ["135.2", "135.20"]), (-3.0, "", ["(3)", "(3.0)", "-3", "-3.0", "−3", "−3.0"]), (0.0, "", []), (7.876, "USD bn", ["7.876", "7,876", "7876"]), (1500.0, "USD m", ["1,500", "1500", "1.5", "1.50"]), (2.0, "bn shares", ["2", "2.0"]), (48.1234, "USD m", ["48.1234"])],
)
def test_printed_forms(spark, value, unit, forms):
    assert one(spark, V.value_forms("v", "u"), v=value, u=unit) == forms


def test_patterns_and_labels(spark):
    hit = lambda form, text: one(spark, F.regexp_like(F.col("t"), V.form_pattern(F.col("f"))), t=text, f=form)
    assert hit("16,698", "sold 16,698.") and not hit("16,698", "116,698") and not hit("5", "5.2") and hit("(3)", "lost (3) in") and hit("one month", "a One-month bill")
    assert one(spark, V.printed_numbers("t"), t="5.2 (46) 1,234, .7") == ["5.2", "46", "1,234", "(46)"]
    forms = F.array(*(F.lit(x) for x in ("2019", "5", "5.0", "12.5", "short", "a text of some length")))
    assert one(spark, V.distinctive_forms(forms), t="") == ["12.5", "a text of some length"]
    assert set(one(spark, V.keywords("t", ["with"]), t="ROE and staff costs rose with liabilities, taxes and two analyses of turnover")) == {"return", "equity", "employe", "cost", "rose", "liabili", "tax", "analys", "revenue"}
    assert one(spark, V.keywords("t", [], 5, {}, {"growth": "rise"}), t="Growth of shares") == ["rise", "share"]
    figures = spark.createDataFrame([(1, "s", 100.0, 0, ["sales"]), (2, "s", 100.0, 0, ["costs"]), (3, "s", 50.0, 0, ["sales"])], "k int, s string, v double, d int, l array<string>")
    numbers = spark.createDataFrame([("s", 100.0, ["sales"]), ("s", 101.0, ["costs"]), ("s", 51.0, ["sales"])], "s string, n double, w array<string>")
    got = {r.k: (r.found, r.slips) for r in C.singled_out(figures, numbers, ["s"], "k", "v", "d", "n", "l", "w").collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (False, True)}
    assert one(spark, V.clip("t", F.lit(60), 40), t="word " * 30).startswith("…word") and one(spark, V.row_cells("t"), t="| a | b |") == ["a", "b"]


def test_requests(spark):
    text = "10-Q and 10-K (the notes; MD&A). Press releases of the company; 8-K Item 5.02, Exhibit 99.1; Delta's earnings call"
    assert one(spark, R.clauses("t"), t=text) == ["10-Q and 10-K (the notes; MD&A)", "Press releases of the company", "8-K Item 5.02, Exhibit 99.1", "Delta's earnings call"]
    ask = lambda c, foreign=False: one(spark, R.requests(F.col("t"), F.lit(foreign), F.array(F.lit("Acme"))), t=c)
    assert [(r.kind, r.sections) for r in ask("10-Q and 10-K (the notes; MD&A)").requests] == [("quarterly", ["mdna", "financials"]), ("annual", ["mdna", "financials"])]
    assert [(r.kind, r["items"], r.exhibits) for r in ask("8-K Item 5.02, Exhibit 99.1").requests] == [("current", ["5.02"], ["EX-99.1"])]
    assert [(r.kind, r["items"]) for r in ask("8-K Items 2.02 and 9.01 with results").requests] == [("release", ["2.02"]), ("current", ["9.01"])]
    assert [r.kind for r in ask("Acme's press releases").requests] == ["press"] and ask("Delta's press releases").requests == []
    assert [(r.kind, r.periods) for r in ask("10-K of FY2021-2023 and the 10-Q for the third quarter of 2024, Q1 2025 and 2025Q2").requests] == [("quarterly", p := ["2021", "2022", "2023", "2024Q3", "2025Q1", "2025Q2"]), ("annual", p)]
    assert one(spark, R.periods("t"), t="fiscal 2024, FY2024Q3; call of 2019, item 7") == ["2024", "2024Q3"] and one(spark, R.periods("t"), t="") == []
    assert [r.kind for r in ask("the proxy statement, Form 4 filings and 13G").requests] == ["proxy", "ownership", "beneficial"]
    assert ask("Acme Corp's announcement of results").requests[0]["items"] == ["2.02"] and ask("a ministry's announcement").notes == ["a ministry's announcement: no filing of the company"]
    own = R.requests(F.col("t"), F.lit(False), F.array(F.lit("Acme")), [R.Rule("anything", (), ("spoken",))])
    assert [r.kind for r in one(spark, own, t="whatever").requests] == ["anything"]
    assert [r.kind for r in ask("6-K results", True).requests] == ["release"] and "spoken" in ask("Delta's earnings call").notes[0]


def test_files_of_filings(spark):
    names = ["main.htm", "R4.htm", "q-ex99-1.htm", "ex992.pdf", "release.htm", "logo.gif", "bad name.htm"]
    files = spark.createDataFrame([("a", n) for n in names], "accession string, name string")
    filings = spark.createDataFrame([("a", "main.htm")], "accession string, primary_document string")
    page = "<table><tr><td>1</td><td>Release</td><td><a href='x'>release.htm</a> iXBRL</td><td>EX-99.3</td></tr><tr><td>2</td></tr></table>"
    types = D.index_types(spark.createDataFrame([("a", page)], "accession string, html string"), ["accession"], "html")
    got = {r.name: (r.kind, r.exhibit, r.order) for r in D.filing_documents(files, filings, ["accession"], types).collect()}
    assert got == {"main.htm": ("primary", None, 0), "R4.htm": ("xbrl_viewer", None, 0), "q-ex99-1.htm": ("exhibit", "EX-99.1", 1), "ex992.pdf": ("exhibit", "EX-99.2", 2), "release.htm": ("exhibit", "EX-99.3", 3), "logo.gif": ("other", None, 0)}


def test_notes_and_statements(spark):
    text = """Item 8
CONSOLIDATED STATEMENTS OF INCOME
Sales 5
Costs 3
CONSOLIDATED BALANCE SHEETS
Cash 1
Debt 2
Notes to the Consolidated Financial Statements
Note 1 – Basis
Note 2 – Debt
Note 1 – Basis
Text of one.
Note 2 – Debt
Text of two.
More of two.
NOTE 3
Leases
Text of three."""
    docs = spark.createDataFrame([("d", text), ("e", None), ("f", "(1)\nAlpha\n(2)\nBeta\nx\n(9)\nNine")], "doc string, text string")
    lines = D.numbered_lines(docs.where("text is not null"), ["doc"], "text")
    heads = sorted((r.line, r.number) for r in D.note_headings(lines, ["doc"]).where("doc = 'd'").collect())
    assert heads == [(11, 1), (13, 2), (16, 3)]  # lines 9 and 10 are an index
    assert D.note_headings(lines, ["doc"]).where("doc = 'f'").count() == 0  # two in a row are too few
    wanted = spark.createDataFrame([("d", 2), ("d", 7)], "doc string, number int")
    spans = D.locate_notes(lines, ["doc"], wanted)
    assert [tuple(r) for r in spans.collect()] == [("d", 2, 13, 15)]
    got = {r.doc: (r.found, r.part) for r in D.located(docs, ["doc"], "text", spans, most=10).collect()}
    assert got["d"] == (True, "Note 2 – Debt\nText of two.\nMore of two.") and got["e"] == (False, None) and got["f"] == (False, None)
    assert sorted(tuple(r) for r in D.statement_spans(lines, ["doc"]).collect()) == [("d", "BS", 5, 7), ("d", "IS", 2, 4)]


def test_units_of_markdown(spark):
    text = "---\na: 1\n---\nLead in [src:A-1].\n\n- first 5 [src:B-2]. Second 6.\n\n| x | Source |\n|---|---|\n| 7 | [src:C-3] |\n| 8 | |\n\nFoot [src:D-4]."
    units = U.markdown_units(spark.createDataFrame([("d", text)], "doc string, text string"), ["doc"], "text")
    got = [(r.line, r.kind, r.unit, r.own, r.context) for r in units.orderBy("line", "place").collect()]
    assert got == [
        (4, "sentence", "Lead in [src:A-1].", ["A-1"], ["A-1"]),
        (6, "sentence", "- first 5 [src:B-2].", ["B-2"], ["B-2", "A-1"]),
        (6, "sentence", "Second 6.", [], ["B-2", "A-1"]),
        (10, "row", "| 7 | [src:C-3] |", [], ["C-3", "B-2", "D-4"]),
        (11, "row", "| 8 | |", [], ["B-2", "D-4"]),
        (13, "sentence", "Foot [src:D-4].", ["D-4"], ["D-4"]),
    ]
    assert [r.unit for r in U.untagged(units, ["doc"]).collect()] == ["Second 6."]


def test_nested_documents_of_any_depth(spark):
    deep = '{"source":"T","a":' + '{"b":' * 12 + "5" + "}" * 12 + ',"skip":1,"l":[{"source":"U","x":"y"}]}'
    docs = spark.createDataFrame([(1, deep), (2, None)], "k int, t string").select("k", F.parse_json("t").alias("d"))
    got = sorted((r.path, r.value, r.tags) for r in U.nested_units(docs, "k", "d", ["skip"]).collect())
    assert got == [("a" + ".b" * 12, "5", ["T"]), ("l[0].x", "y", ["T", "U"])]
    assert {r.path for r in S.walk(docs, "k", "d").collect()} >= {"$.a" + ".b" * 12, "$.l[0].x"}


def test_edits(spark):
    docs = spark.createDataFrame([("d", "# t\n## 1. One\na\n## Two\nb")], "doc string, text string")
    sections = E.sections_of(docs, ["doc"], "text")
    changes = spark.createDataFrame([("d", "two", "B"), ("d", "Version history", "v1"), ("d", "nine", "x")], "doc string, section string, body string")
    patched, lost = E.patch_sections(sections, ["doc"], changes)
    assert E.joined_sections(patched, ["doc"]).first().text == "# t\n## 1. One\na\n## Two\n\nB\n\n## Version history\n\nv1\n" and lost.first().section == "nine"
    left, missing = E.without_sections(sections, ["doc"], spark.createDataFrame([("d", "one"), ("d", "7")], "doc string, name string"))
    assert E.joined_sections(left, ["doc"]).first().text == "# t\n## Two\nb" and missing.first().name == "7"
    assert one(spark, E.newest_first(F.col("t"), "## List", F.lit("new")), t="x\n## List\n\nold\n") == "x\n## List\n\nnew\n\nold\n"
    assert one(spark, E.mark_effective("t"), t="a\ndoc_status: proposed\nb") == "a\ndoc_status: effective\nb" and one(spark, E.mark_effective("t"), t="a") is None


def test_containment_of_short_quotes_and_scripts_without_blanks(spark):
    quotes = spark.createDataFrame([(1, "漢字の文章を比べる試験です"), (2, "twelve chars"), (3, "short"), (4, "three words inside"), (5, "a b c d e f g"), (6, "before a unit of well over thirty six characters after")], "q int, quote string")
    units = spark.createDataFrame([(10, "前に漢字の文章を比べる試験です後ろ"), (11, "xtwelve  charsx"), (12, "short"), (13, "all three words\ninside it"), (14, "z a b c d e f g"), (15, "a unit of well over thirty six characters")], "u int, text string")
    got = {r.q: r.u for r in J.containment_join(quotes, units, "quote", "text", ["u"], "q").collect()}
    assert got == {1: 10, 2: 11, 4: 13, 5: 14, 6: 15}


def test_ranked_excerpts(spark):
    kinds = "d int, t string, w array<string>, c array<string>, h array<string>"
    rows = [(1, "sales rose by 1,200 in all", ["sales", "rose"], None, None), (2, "| Sales of goods | 900 | 1,200 |", ["sales", "goods"], ["Sales of goods", "900", "1,200"], ["", "2023", "2024"]), (3, "| Sales of goods | 1,200 | 900 |", ["sales", "goods"], ["Sales of goods", "1,200", "900"], ["", "2023", "2024"]), (4, "nothing but 1,200 here " + "and more " * 80, ["nothing"], None, None), (5, "also 31.5", ["also"], None, None)]
    units = spark.createDataFrame(rows, kinds)
    values = spark.createDataFrame([("both", 1200.0, ["sales", "goods"], 2024), ("other", 1200.0, ["sales", "goods"], 2023), ("none asked", 1200.0, ["profit"], 2024), ("first", 31.5, ["profit"], 2024), ("small", 5.0, ["profit"], 2024), ("null", None, ["profit"], None)], "k string, v double, w array<string>, y int")
    ask = lambda u, **more: {r.k: (r.d, r.how, r.score) for r in D.ranked_excerpts(values, "k", "v", None, "w", u, ["d"], "t", "w", year="y", cells="c", header="h", **more).collect()}
    assert ask(units) == {"both": (2, "ranked", 2), "other": (3, "ranked", 2), "none asked": (1, "first", None), "first": (5, "first", None), "small": (None, "none", None), "null": (None, "none", None)}
    assert ask(units.where("d in (3, 4)"), strict=True)["both"] == (3, "first", None) and ask(units.where("d in (3, 4)"))["both"] == (3, "ranked", 2)
    clipped = D.ranked_excerpts(values, "k", "v", None, "w", units.where("d = 4"), ["d"], "t", "w", least=0, width=40).where("k = 'both'").first()
    assert clipped.how == "ranked" and len(clipped.excerpt) <= 42 and "1,200" in clipped.excerpt and clipped.excerpt.endswith("…")
    assert one(spark, D.in_year_column(F.array(F.lit("x"), F.lit("7")), F.array(F.lit(""), F.lit("FY2024")), F.lit(2024), F.lit("7")), t="") is True


def test_prose_units_and_agents(spark):
    assert [one(spark, V.unit_kind("t"), t=x) for x in ("%", "basis points", "USD", "diluted shares", "x", None)] == ["percent", "percent", "money", "shares", "ratio", "none"]
    assert one(spark, V.is_prose("t"), t="A sentence of words that goes on for a good while before it ends here") and not one(spark, V.is_prose("t"), t="5 | 6 | 7")
