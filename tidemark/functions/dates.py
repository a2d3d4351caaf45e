"""Calendar arithmetic as Spark expressions: month ends, fiscal quarters, business days, deadlines in US Eastern time.

A fiscal year is named for the year in which it ends. Business days come from a dimension table with one row a day,
bounded by its years (366 rows each), so joins with it may be broadcast; every other function is a plain expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


NEW_YORK = "America/New_York"
LEAD_DAYS = 3

# Federal holidays on a fixed day (month, day, first year), on the n-th weekday of a month (month, ISO
# weekday, n; -1: the last), and days on which the government was closed by order.
FIXED_HOLIDAYS = [(1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)]
FLOATING_HOLIDAYS = [(1, 1, 3), (2, 1, 3), (5, 1, -1), (9, 1, 1), (10, 1, 2), (11, 4, 4)]
CLOSURES = ["2018-12-05", "2018-12-24", "2019-12-24", "2020-12-24", "2024-12-24", "2025-01-09", "2025-12-24", "2025-12-26"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snap_to_month_end(day: Column | str) -> Column:
    """Days up to the 15th go to the month end before, later ones to that of their month."""
    d = _col(day)
    return F.when(F.dayofmonth(d) <= 15, F.date_sub(F.trunc(d, "month"), 1)).otherwise(F.last_day(d))


def quarter_end(fiscal_year: Column | str, quarter: Column | str, end_month: Column | str) -> Column:
    """The month end that closes a quarter of a fiscal year which ends in end_month."""
    return F.last_day(F.add_months(F.make_date(_col(fiscal_year), _col(end_month), F.lit(1)), (_col(quarter) - 4) * 3))


def period_of(day: Column | str, end_month: Column | str) -> Column:
    """struct(fiscal_year, quarter) of a quarter end a few days around a month end; null where it is none."""
    s, m = snap_to_month_end(day), _col(end_month)
    offset = F.pmod(F.month(s) - m, F.lit(12))
    year = F.year(s) + F.when(F.month(s) > m, 1).otherwise(0)
    quarter = F.when(offset == 0, 4).otherwise((offset / 3).cast("int"))
    return F.when(offset % 3 == 0, F.struct(year.alias("fiscal_year"), quarter.alias("quarter")))


def quarter_label(period: Column) -> Column:
    return F.when(period["quarter"].isNotNull(), F.format_string("FY%dQ%d", period["fiscal_year"], period["quarter"]))


def last_quarter_end_before(day: Column | str, end_month: Column | str) -> Column:
    """The latest month-end quarter end strictly before a day."""
    d, m = _col(day), _col(end_month)
    base = F.date_sub(F.trunc(d, "month"), 1)  # the month end before the day's month
    back = F.pmod(F.month(base) - m, F.lit(3)).cast("int")
    return F.last_day(F.add_months(base, -back))


def parse_period(text: Column | str) -> Column:
    """FY2026 or FY2026Q3 as struct(fiscal_year, quarter); null for anything else."""
    t = F.trim(_col(text))
    year = F.regexp_extract(t, "^FY([0-9]{4})(Q[1-4])?$", 1)
    quarter = F.regexp_extract(t, "^FY([0-9]{4})Q([1-4])$", 2)
    return F.when(year != "", F.struct(year.cast("int").alias("fiscal_year"), F.when(quarter != "", quarter.cast("int")).alias("quarter")))


def period_index(period: Column) -> Column:
    """Quarters counted from year 0, so that adjacent quarters differ by one."""
    return period["fiscal_year"] * 4 + period["quarter"] - 1


def period_from_index(index: Column) -> Column:
    return F.when(index.isNotNull(), F.format_string("FY%dQ%d", F.floor(index / 4).cast("int"), (F.pmod(index, F.lit(4)) + 1).cast("int")))


def shift_years(day: Column | str, years: Column | int) -> Column:
    """The same day so many years on; 29 February becomes the 28th."""
    n = F.lit(years) if isinstance(years, int) else years
    return F.add_months(_col(day), n * 12)


def deadline(release: Column | str) -> Column:
    """The UTC moment of 23:59:59 US Eastern on the day before a release."""
    local = F.concat(F.date_sub(_col(release), 1).cast("string"), F.lit(" 23:59:59")).cast("timestamp")
    return F.to_utc_timestamp(local, NEW_YORK)


def merge_by(moment: Column, hours: int = 72) -> Column:
    """So many elapsed hours before a UTC moment, whatever daylight saving does meanwhile."""
    return moment - F.expr(f"make_dt_interval(0, {hours}, 0, 0)")


def eastern_date(moment: Column | str) -> Column:
    """The US Eastern date of a UTC moment."""
    return F.from_utc_timestamp(_col(moment), NEW_YORK).cast("date")


def parse_acceptance(text: Column | str) -> Column:
    """Acceptance stamps as UTC moments: 14 digits are Eastern wall time, ISO text with Z or an offset is absolute."""
    t = F.trim(_col(text))
    digits = F.to_utc_timestamp(F.try_to_timestamp(t, F.lit("yyyyMMddHHmmss")), NEW_YORK)
    return F.when(t.rlike("^[0-9]{14}$"), digits).when(t.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.try_to_timestamp(t))


def is_holiday(day: Column | str) -> Column:
    """Federal holidays, moved to Friday from a Saturday and to Monday from a Sunday, and days closed by order."""
    d = _col(day)

    def fixed(x: Column) -> Column:
        any_of = F.lit(False)
        for month, dom, since in FIXED_HOLIDAYS:
            any_of = any_of | ((F.month(x) == month) & (F.dayofmonth(x) == dom) & (F.year(x) >= since))
        return any_of

    weekday = F.weekday(d) + 1
    out = (fixed(d) & (weekday <= 5)) | (fixed(F.date_add(d, 1)) & (weekday == 5)) | (fixed(F.date_sub(d, 1)) & (weekday == 1))
    for month, iso, n in FLOATING_HOLIDAYS:
        nth = F.dayofmonth(F.last_day(d)) - F.dayofmonth(d) < 7 if n < 0 else F.ceil(F.dayofmonth(d) / 7) == n
        out = out | ((F.month(d) == month) & (weekday == iso) & nth)
    return out | d.cast("string").isin(CLOSURES)


def business_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """day, is_business and ordinal (business days up to and including the day), a row a day of the years given."""
    days = spark.sql(f"SELECT explode(sequence(date'{first_year:04d}-01-01', date'{last_year:04d}-12-31', interval 1 day)) AS day")
    open_ = days.withColumn("is_business", (F.weekday("day") < 5) & ~is_holiday("day"))
    by_year = open_.withColumn("y", F.year("day"))
    before = by_year.groupBy("y").agg(F.count_if("is_business").alias("n"))
    earlier = before.alias("a").join(before.alias("b"), F.expr("b.y < a.y"), "left").groupBy("a.y").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("base"))
    inside = F.expr("count_if(is_business) over (partition by y order by day rows between unbounded preceding and current row)")
    return by_year.join(earlier, "y").select("day", "is_business", (F.col("base") + inside).alias("ordinal"))


def add_business_days(df: DataFrame, day: str, count: int, calendar: DataFrame, out: str) -> DataFrame:
    """df with the count-th business day after `day`. Days outside the calendar give null. calendar: of business_calendar, 366 rows
    a year at most, so it is broadcast."""
    at = F.broadcast(calendar.select(F.col("day").alias("__day"), (F.col("ordinal") + count).alias("__ordinal")))
    to = F.broadcast(calendar.where("is_business").select(F.col("ordinal").alias("__ordinal"), F.col("day").alias(out)))
    return df.join(at, F.col(day).cast("date") == F.col("__day"), "left").join(to, "__ordinal", "left").drop("__day", "__ordinal")


def previous_business_day(df: DataFrame, day: str, calendar: DataFrame, out: str) -> DataFrame:
    """df with `day` itself if it is a business day, else the one before it. calendar: as above, broadcast."""
    at = F.broadcast(calendar.select(F.col("day").alias("__day"), F.col("ordinal").alias("__ordinal")))
    to = F.broadcast(calendar.where("is_business").select(F.col("ordinal").alias("__ordinal"), F.col("day").alias(out)))
    return df.join(at, F.col(day).cast("date") == F.col("__day"), "left").join(to, "__ordinal", "left").drop("__day", "__ordinal")


def due_date(text: Column | str) -> Column:
    """A date, yyyy-Qn, yyyy-Hn or yyyy as the last day it names; null for anything else."""
    t = F.trim(_col(text))
    year = F.substring(t, 1, 4).try_cast("int")
    part = F.substring(t, 7, 1).try_cast("int")
    month = F.when(t.rlike("^[0-9]{4}-Q[1-4]$"), part * 3).when(t.rlike("^[0-9]{4}-H[12]$"), part * 6).when(t.rlike("^[0-9]{4}$"), 12)
    return F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), t.try_cast("date")).otherwise(F.last_day(F.make_date(year, month, F.lit(1))))
