"""Calendars, deadlines and release estimates on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import filings as L
from .registry import query

YEARS = (1994, 2006)

# The business calendar in SQL: fixed days with their moves, floating days, and the running count of business days.
CALENDAR = """
days AS (SELECT d::DATE AS d FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2006-12-31', INTERVAL 1 DAY)) AS d)),
fixed AS (SELECT make_date(y::INT, m, k) AS f FROM (SELECT unnest(range(1993, 2008)) AS y) CROSS JOIN (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) v(m, k)),
moved AS (SELECT CASE isodow(f) WHEN 6 THEN f - 1 WHEN 7 THEN f + 1 ELSE f END AS h FROM fixed),
floating AS (SELECT d AS h FROM days WHERE (month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21) OR (month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21) OR (month(d) = 5 AND isodow(d) = 1 AND day(d) > 24)
  OR (month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7) OR (month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14) OR (month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28)),
cal AS (SELECT d, isodow(d) < 6 AND d NOT IN (SELECT h FROM moved) AND d NOT IN (SELECT h FROM floating) AS b FROM days),
ord AS (SELECT d, b, sum(b::INT) OVER (ORDER BY d)::BIGINT AS n FROM cal)
"""


@query(f"WITH {CALENDAR} SELECT d AS day, b AS is_business, n AS ordinal, count(o_orderkey) AS orders FROM ord LEFT JOIN orders ON o_orderdate::DATE = d GROUP BY ALL")
def business_days(t):
    """Days of the calendar with the orders that fall on them."""
    placed = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    return D.business_calendar(t.spark, *YEARS).join(placed, "day", "left").withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))


@query(f"WITH {CALENDAR} SELECT o_orderkey, z.d AS closes_on FROM orders JOIN ord a ON a.d = o_orderdate::DATE JOIN ord z ON z.b AND z.n = a.n + 5")
def fifth_business_day(t):
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return D.add_business_days(o, "day", 5, D.business_calendar(t.spark, *YEARS), "closes_on").select("o_orderkey", "closes_on")


@query("""
WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS d, n_nationkey % 12 + 1 AS m FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
s AS (SELECT *, last_day(CASE WHEN day(d) <= 15 THEN (date_trunc('month', d) - INTERVAL 1 DAY)::DATE ELSE d END) AS snapped, last_day((date_trunc('month', d) - INTERVAL 1 DAY - to_months((month((date_trunc('month', d) - INTERVAL 1 DAY)::DATE) - m + 12) % 3))::DATE) AS e FROM x)
SELECT o_orderkey, snapped, e AS quarter_end, 'FY' || (year(e) + (month(e) > m)::INT) || 'Q' || CASE (month(e) - m + 12) % 12 WHEN 0 THEN 4 WHEN 3 THEN 1 WHEN 6 THEN 2 ELSE 3 END AS label FROM s
""")
def fiscal_quarters(t):
    o = t.orders.join(t.customer, F.expr("c_custkey = o_custkey")).select("o_orderkey", F.to_date("o_orderdate").alias("d"), (F.col("c_nationkey") % 12 + 1).alias("m"))
    o = o.withColumn("quarter_end", D.last_quarter_end_before("d", F.col("m")))
    return o.select("o_orderkey", D.snap_to_month_end("d").alias("snapped"), "quarter_end", D.quarter_label(D.period_of("quarter_end", F.col("m"))).alias("label"))


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE - 1 AS d FROM orders),
y AS (SELECT *, make_date(year(d), 4, 1) AS a, make_date(year(d), 10, 31) AS z FROM d),
w AS (SELECT *, d >= a + ((7 - isodow(a)) % 7)::INT AND d < z - (isodow(z) % 7)::INT AS dst FROM y)
SELECT o_orderkey, d + INTERVAL '23:59:59' + to_hours(CASE WHEN dst THEN 4 ELSE 5 END) AS deadline, d + INTERVAL '23:59:59' + to_hours(CASE WHEN dst THEN 4 ELSE 5 END) - INTERVAL 72 HOUR AS merge_by FROM w
""")
def deadlines(t):
    end = D.deadline(F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", end.alias("deadline"), D.merge_by(end).alias("merge_by")).select("o_orderkey", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("deadline", "merge_by")))


_EVENTS = """
q AS (SELECT c_nationkey AS k, o_orderdate::DATE AS d, last_day((date_trunc('month', o_orderdate) - INTERVAL 1 DAY - to_months((month((date_trunc('month', o_orderdate) - INTERVAL 1 DAY)::DATE)) % 3))::DATE) AS e, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey ),
ev AS (SELECT k, e, year(e) AS fy, (month(e) // 3)::INT AS qt, min(d) AS r FROM q GROUP BY ALL)
"""


@query(f"""
WITH {CALENDAR}, {_EVENTS},
w AS (SELECT n_nationkey AS k, y::INT AS fy, qt::INT AS qt, last_day(make_date(y::INT, qt::INT * 3, 1)) AS e FROM nation CROSS JOIN (SELECT unnest(range(1995, 2005)) AS y) CROSS JOIN (SELECT unnest(range(1, 5)) AS qt)),
h AS (SELECT w.k, w.fy, w.qt, min((r + to_years(w.fy - ev.fy))::DATE) AS f, count(*)::INT AS n FROM w JOIN ev ON ev.k = w.k AND ev.qt = w.qt AND ev.fy BETWEEN w.fy - 3 AND w.fy - 1 GROUP BY ALL),
l AS (SELECT w.*, ev.r - ev.e AS lag FROM w ASOF LEFT JOIN ev ON w.k = ev.k AND w.e > ev.e),
b AS (SELECT l.*, h.f, coalesce(h.n, 0) AS n, (coalesce(h.f, l.e + l.lag::INT) - 3)::DATE AS start FROM l LEFT JOIN h USING (k, fy, qt))
SELECT b.k, b.fy AS fiscal_year, b.qt AS quarter, b.e AS period_end, z.d AS expected, CASE WHEN f IS NOT NULL THEN 'history' WHEN lag IS NOT NULL THEN 'lag' END AS basis, b.n AS n_history
FROM b LEFT JOIN ord a ON a.d = b.start LEFT JOIN ord z ON z.b AND z.n = a.n
""")
def release_estimates(t):
    orders = t.orders.join(t.customer, F.expr("c_custkey = o_custkey")).select(F.col("c_nationkey").alias("k"), F.to_date("o_orderdate").alias("d"))
    ends = orders.withColumn("period_end", D.last_quarter_end_before("d", F.lit(12))).withColumn("p", D.period_of("period_end", F.lit(12)))
    events = ends.groupBy("k", "period_end", F.col("p.fiscal_year").alias("fiscal_year"), F.col("p.quarter").alias("quarter")).agg(F.min("d").alias("release_date"))
    grid = t.nation.select(F.col("n_nationkey").alias("k"), F.explode(F.sequence(F.lit(1995), F.lit(2004))).alias("fiscal_year")).select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("quarter"))
    wanted = grid.withColumn("period_end", D.quarter_end("fiscal_year", "quarter", F.lit(12)))
    return L.estimate_releases(wanted, events, "k", D.business_calendar(t.spark, *YEARS))


@query("""
WITH f AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS d, o_orderstatus = 'P' AS y FROM orders WHERE o_orderstatus IN ('P', 'F')),
g AS (SELECT k, d, bool_or(y) AS y FROM f GROUP BY ALL),
h AS (SELECT *, CASE WHEN day(d) <= 15 THEN (date_trunc('month', d) - INTERVAL 1 DAY)::DATE ELSE d END AS s FROM g WHERE y),
a AS (SELECT k, year(s) AS fy, min(d) AS e, max(d) AS x FROM h WHERE month(s) = 12 GROUP BY ALL HAVING min(d) = max(d)),
b AS (SELECT *, lag(e) OVER (PARTITION BY k ORDER BY e) AS pe, lag(fy) OVER (PARTITION BY k ORDER BY e) AS py FROM a),
n AS (SELECT b.k, b.fy, g.d, row_number() OVER (PARTITION BY b.k, b.fy ORDER BY g.d) AS q, count(*) OVER (PARTITION BY b.k, b.fy) AS c FROM b JOIN g ON g.k = b.k AND NOT g.y AND g.d > pe AND g.d < e WHERE py = b.fy - 1)
SELECT k, fy::INT AS fiscal_year, 4 AS quarter, e AS quarter_end FROM a UNION ALL SELECT k, fy::INT, q::INT, d FROM n WHERE c = 3
""")
def quarter_ends_between_year_ends(t):
    """Learned calendars: three reports strictly between two consecutive year ends. Pending orders of a last quarter are annual reports."""
    g = t.orders.where("o_orderstatus in ('P', 'F')").groupBy(F.col("o_custkey").alias("cik"), F.to_date("o_orderdate").alias("report_date")).agg(F.bool_or(F.col("o_orderstatus") == "P").alias("y"))
    filings = g.withColumn("form", F.when(F.col("y"), "10-K").otherwise("10-Q")).withColumn("end_month", F.lit(12))
    return L.learned_quarter_ends(filings, "end_month").withColumnRenamed("cik", "k")


@query("SELECT o_orderkey, last_day(make_date(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) ELSE year(o_orderdate) END, CASE o_orderstatus WHEN 'F' THEN 12 WHEN 'P' THEN ((month(o_orderdate) + 5) // 6) * 6 ELSE ((month(o_orderdate) + 2) // 3) * 3 END, 1)) AS due FROM orders")
def due_dates(t):
    y, m = F.year("o_orderdate").cast("string"), F.month("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", y).when(F.col("o_orderstatus") == "P", F.concat(y, F.lit("-H"), F.ceil(m / 6).cast("string"))).otherwise(F.concat(y, F.lit("-Q"), F.ceil(m / 3).cast("string")))
    return t.orders.select("o_orderkey", D.due_date(text).alias("due"))
