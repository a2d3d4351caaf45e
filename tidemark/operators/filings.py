"""Issuers' filings as tables: columnar submissions, fiscal calendars, results events and release estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates as D
from .joins import between_marks
from .merge import keep_first

#: Fixed value: the columns of a block of filings.
BLOCK = {"accessionNumber": "accession", "filingDate": "filing_date", "reportDate": "report_date", "acceptanceDateTime": "accepted", "form": "form", "items": "items", "primaryDocument": "primary_document"}


def from_blocks(blocks: DataFrame, cik: str, block: str) -> DataFrame:
    """A row a filing from columnar blocks (struct of equal-length arrays): first listed wins by accession, newest blocks
    (smallest `part`) first. Dates and the acceptance moment are parsed, items split; blanks are null."""
    zipped = F.arrays_zip(*(F.col(f"{block}.{c}").alias(n) for c, n in BLOCK.items()))
    rows = blocks.select(cik, "part", F.posexplode(zipped).alias("place", "f")).select(cik, "part", "place", "f.*")
    rows = keep_first(rows.where("accession is not null"), [cik, "accession"], ["part", "place"])
    items = F.filter(F.split(F.coalesce("items", F.lit("")), ","), lambda x: x != "")
    return rows.select(
        F.lpad(F.col(cik).cast("string"), 10, "0").alias("cik"), "accession", F.col("filing_date").try_cast("date").alias("filing_date"), F.col("report_date").try_cast("date").alias("report_date"),
        D.parse_acceptance("accepted").alias("accepted"), "form", F.transform(items, lambda x: F.trim(x)).alias("items"), "primary_document",
    )


def filer_type(filings: DataFrame, last: int = 600) -> DataFrame:
    """domestic or foreign for each issuer, by the forms among its last filings."""
    w = Window.partitionBy("cik").orderBy(F.desc("filing_date"), F.desc("accession"))
    recent = filings.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= last)
    home, abroad = F.bool_or(F.col("form").isin("10-K", "10-Q")), F.bool_or(F.col("form").isin("20-F", "40-F", "6-K"))
    return recent.groupBy("cik").agg(F.when(home, "domestic").when(abroad, "foreign").otherwise("domestic").alias("filer_type"))


def fiscal_year(day: Column, end_month: Column) -> Column:
    return D.period_of(day, end_month)["fiscal_year"]


def learned_quarter_ends(filings: DataFrame, end_month: str) -> DataFrame:
    """cik, fiscal_year, quarter, quarter_end that issuers' own reports give: year ends from 10-Ks (years with two
    different ones are dropped); the three 10-Q dates strictly between two consecutive year ends, if exactly three."""
    period = D.period_of("report_date", F.col(end_month))
    ends = filings.where("form = '10-K' and report_date is not null").withColumn("__p", period).where("__p.quarter = 4")
    ends = ends.groupBy("cik", F.col("__p.fiscal_year").alias("fiscal_year")).agg(F.min("report_date").alias("quarter_end"), F.max("report_date").alias("__last"), F.first(end_month).alias(end_month)).where("quarter_end = __last").drop("__last")
    quarters = filings.where("form = '10-Q' and report_date is not null").select("cik", F.col("report_date").alias("quarter_end"), F.lit(None).cast("int").alias("fiscal_year")).distinct()
    marks = ends.select("cik", "quarter_end", "fiscal_year").unionByName(quarters)
    inside = between_marks(marks, ["cik"], ["quarter_end"], F.col("fiscal_year").isNotNull(), 3)
    opened = ends.withColumn("interval", F.row_number().over(Window.partitionBy("cik").orderBy("quarter_end")).cast("long"))
    opened = opened.withColumn("__next", F.lead("fiscal_year").over(Window.partitionBy("cik").orderBy("quarter_end")))
    years = opened.where(F.col("__next") == F.col("fiscal_year") + 1).select("cik", "interval", F.col("__next").alias("__y"))
    third = inside.join(years, ["cik", "interval"]).select("cik", F.col("__y").alias("fiscal_year"), F.col("nth").cast("int").alias("quarter"), "quarter_end")
    return ends.select("cik", "fiscal_year", F.lit(4).alias("quarter"), "quarter_end").unionByName(third)


def project_quarter_ends(known: DataFrame, years: int) -> DataFrame:
    """Known ends and, for fiscal years after all known ones of an issuer, the last known end of the quarter, 364 days on a year."""
    latest = known.groupBy("cik", "quarter").agg(F.max_by("quarter_end", "fiscal_year").alias("__end"), F.max("fiscal_year").alias("__year"))
    top = known.groupBy("cik").agg(F.max("fiscal_year").alias("__top"))
    ahead = latest.join(top, "cik").withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(years)))).withColumn("fiscal_year", F.col("__top") + F.col("__n"))
    ahead = ahead.select("cik", "fiscal_year", "quarter", F.date_add("__end", ((F.col("fiscal_year") - F.col("__year")) * 364).cast("int")).alias("quarter_end"))
    return known.select("cik", "fiscal_year", "quarter", "quarter_end").withColumn("projected", F.lit(False)).unionByName(ahead.withColumn("projected", F.lit(True)))


def release_date(filing_date: Column, accepted: Column, report_date: Column, items: Column) -> Column:
    """struct(date, basis): the Eastern date of acceptance, else the filing date; the report date where it lies one to
    four days earlier and the only items are 2.02 and 9.01."""
    base = F.coalesce(D.eastern_date(accepted), filing_date)
    plain = F.size(F.array_except(items, F.array(F.lit("2.02"), F.lit("9.01")))) == 0
    early = plain & F.datediff(base, report_date).between(1, 4)
    return F.struct(F.when(early, report_date).otherwise(base).alias("date"), F.when(early, "report_date").when(accepted.isNotNull(), "acceptance").otherwise("filing_date").alias("basis"))


def domestic_events(filings: DataFrame, end_month: str, calendar: DataFrame) -> DataFrame:
    """A row a fiscal quarter with a results 8-K (item 2.02): the first one opens it, later ones are related, amendments
    are listed; the first 10-Q or 10-K of the quarter closes it, or the fifth business day after filing does.

    A periodic report accepted on an earlier day than the release is the release.
    """
    results = filings.where("array_contains(items, '2.02') and form in ('8-K', '8-K/A')")
    found = results.withColumn("__r", release_date(F.col("filing_date"), F.col("accepted"), F.col("report_date"), F.col("items")))
    found = found.withColumn("period_end", D.last_quarter_end_before(F.col("__r.date"), F.col(end_month))).withColumn("period", D.quarter_label(D.period_of("period_end", F.col(end_month))))
    order = Window.partitionBy("cik", "period", "form").orderBy("filing_date", "accession")
    found = found.withColumn("__k", F.row_number().over(order))
    first = found.where("form = '8-K' and __k = 1")
    rest = found.where("form = '8-K/A' or __k > 1").groupBy("cik", "period").agg(
        F.array_sort(F.collect_list(F.when(F.col("form") == "8-K", F.col("accession")))).alias("related"), F.array_sort(F.collect_list(F.when(F.col("form") == "8-K/A", F.col("accession")))).alias("amendments")
    )
    closing = filings.where("form in ('10-Q', '10-K') and report_date is not null").withColumn("period", D.quarter_label(D.period_of("report_date", F.col(end_month)))).where("period is not null")
    closing = keep_first(closing, ["cik", "period"], ["filing_date", "accession"]).select("cik", "period", F.col("form").alias("__form"), F.col("accession").alias("closing"), F.col("filing_date").alias("__filed"), D.eastern_date("accepted").alias("__on"))
    events = D.add_business_days(first.join(closing, ["cik", "period"], "left").join(rest, ["cik", "period"], "left"), "filing_date", 5, calendar, "__t5")
    earlier = F.col("__on") < F.col("__r.date")
    in_time = F.col("__filed") <= F.col("__t5")
    none = F.array().cast("array<string>")
    return events.select(
        "cik", "period", "period_end", "accession", "filing_date",
        F.when(earlier, F.col("__on")).otherwise(F.col("__r.date")).alias("release_date"),
        F.when(earlier, "closing").otherwise(F.col("__r.basis")).alias("release_basis"),
        "closing",
        F.when(in_time, F.greatest("filing_date", "__filed")).otherwise(F.col("__t5")).alias("closes_on"),
        F.when(in_time, F.col("__form")).otherwise("T+5").alias("closed_by"),
        F.coalesce("related", none).alias("related"), F.coalesce("amendments", none).alias("amendments"),
    )


#: How a results headline reads, and how it must not.
HEADLINE, NOTICE = r"(?i)\b(announces|reports)\b", r"(?i)\b(to|will) (announce|report)\b"


def results_headline(text: Column) -> Column:
    """The first of the first 80 lines that announces a quarter's results: struct(title, quarter, year); null if none does."""
    lines = F.slice(F.split(text, "\n"), 1, 80)
    fits = F.filter(lines, lambda x: x.rlike(HEADLINE) & x.rlike(r"(?i)\bquarter\b") & x.rlike(r"(?i)\bresults\b") & ~x.rlike(NOTICE))
    title = F.try_element_at(fits, F.lit(1))
    named = r"\b(first|second|third|fourth) quarter\b(?: (?:of )?(?:fiscal (?:year )?)?([0-9]{4}))?"
    word, year = F.regexp_extract(F.lower(title), named, 1), F.regexp_extract(F.lower(title), named, 2).try_cast("int")
    number = F.when(word == "first", 1).when(word == "second", 2).when(word == "third", 3).when(word == "fourth", 4)
    return F.when(title.isNotNull(), F.struct(F.substring(title, 1, 300).alias("title"), number.alias("quarter"), year.alias("year")))


def foreign_events(filings: DataFrame, texts: DataFrame, end_month: str) -> DataFrame:
    """A row a fiscal quarter with a results 6-K: the release text (accession, text) has a results headline. The headline's
    quarter, if it names one, counts above the last quarter end before the release."""
    known = texts.withColumn("__h", results_headline(F.col("text"))).where("__h is not null").select("accession", "__h")
    six = filings.where("form in ('6-K', '6-K/A')").join(known, "accession")
    six = six.withColumn("release_date", F.coalesce(D.eastern_date("accepted"), F.col("filing_date"))).withColumn("__e", D.last_quarter_end_before("release_date", F.col(end_month)))
    back = F.pmod(D.period_of("__e", F.col(end_month))["quarter"] - F.coalesce("__h.quarter", D.period_of("__e", F.col(end_month))["quarter"]), F.lit(4))
    six = six.withColumn("period_end", F.last_day(F.add_months("__e", (-3 * back).cast("int")))).withColumn("period", D.quarter_label(D.period_of("period_end", F.col(end_month))))
    first = keep_first(six.where("form = '6-K'"), ["cik", "period"], ["filing_date", "accession"])
    amended = six.where("form = '6-K/A'").groupBy("cik", "period").agg(F.array_sort(F.collect_list("accession")).alias("amendments"))
    return first.join(amended, ["cik", "period"], "left").select(
        "cik", "period", "period_end", "accession", "filing_date", "release_date", F.col("filing_date").alias("closes_on"), F.lit("6-K").alias("closed_by"), F.col("__h.title").alias("title"), F.coalesce("amendments", F.array().cast("array<string>")).alias("amendments")
    )


def estimate_releases(wanted: DataFrame, events: DataFrame, key: str, calendar: DataFrame, years: int = 3) -> DataFrame:
    """When a quarter's results will come. wanted: key, fiscal_year, quarter, period_end; events: key, fiscal_year, quarter,
    period_end, release_date.

    The earliest month and day of the same quarter in the `years` years before, moved to this year, less three days, back
    to a business day; without such history the latest earlier event's lag from its period end, likewise. basis says
    which; expected is null where an issuer has neither.
    """
    w, e = wanted.alias("w"), events.alias("e")
    same = w.join(e, F.expr(f"w.{key} = e.{key} and w.quarter = e.quarter and e.fiscal_year between w.fiscal_year - {years} and w.fiscal_year - 1"))
    history = same.groupBy(F.col(f"w.{key}").alias(key), "w.fiscal_year", "w.quarter").agg(F.min(D.shift_years(F.col("e.release_date"), F.expr("w.fiscal_year - e.fiscal_year"))).alias("__first"), F.count("*").cast("int").alias("n_history"))
    from .joins import asof_join

    past = events.select(key, "period_end", F.datediff("release_date", "period_end").alias("__lag"))
    lagged = asof_join(wanted, past, [key], "period_end", "period_end", ["__lag"], strict=True)
    both = lagged.join(history, [key, "fiscal_year", "quarter"], "left")
    both = both.withColumn("__from", F.date_sub(F.coalesce("__first", F.expr("date_add(period_end, __lag)")), D.LEAD_DAYS))
    dated = D.previous_business_day(both, "__from", calendar, "expected")
    basis = F.when(F.col("__first").isNotNull(), "history").when(F.col("__lag").isNotNull(), "lag")
    return dated.select(*wanted.columns, "expected", basis.alias("basis"), F.coalesce("n_history", F.lit(0)).alias("n_history"))
