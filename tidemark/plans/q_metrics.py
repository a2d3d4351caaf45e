"""Queries on metrics by written formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from .registry import query

#: A supplier's quantities by line of an order, a quarter each, stand for reported concepts.
FORMULAS = [
    ("air_share", "air / (air + rail + ship + truck)"),
    ("cash_cover", "sum_4q(mail - fob) / sum_4q(truck)"),
    ("seats_growth", "rail_t / rail_{t-4q} - 1"),
    ("spread", "yoy(ship) - yoy(truck)"),
    ("pooled", "sum_2q(air + mail)_t / sum_2q(air + mail)_{t-1y} − 1"),
    ("two_years", "sum_2y(rail) / sum_2y(truck)"),
    ("balance_yield", "4 × ship / avg_bal(rail)"),
    ("peak", "max_4q(truck) - min_4q(truck)"),
    ("larger", "max(air_t, mail_t); 0 if none recorded"),
    ("floor", "min(abs(fob - mail), truck, sum(air, 2q))"),
    ("no_rail", "tunnel / rail"),
]


@query("""
WITH r AS (SELECT l_suppkey, year(l_shipdate) * 4 + quarter(l_shipdate) AS p, (['AIR','RAIL','SHIP','TRUCK','MAIL','FOB','REG AIR'])[l_linenumber] AS c, CAST(sum(l_quantity) AS DOUBLE) AS v FROM lineitem GROUP BY ALL),
w AS (SELECT l_suppkey, p, max(v) FILTER (c = 'AIR') AS air, max(v) FILTER (c = 'RAIL') AS rail, max(v) FILTER (c = 'SHIP') AS ship, max(v) FILTER (c = 'TRUCK') AS truck, max(v) FILTER (c = 'MAIL') AS mail, max(v) FILTER (c = 'FOB') AS fob FROM r WHERE c <> 'REG AIR' GROUP BY ALL),
a AS (SELECT *, count(mail - fob) OVER y AS n1, sum(mail - fob) OVER y AS s1, count(truck) OVER y AS n2, sum(truck) OVER y AS s2, max(truck) OVER y AS hi, min(truck) OVER y AS lo,
  max(rail) OVER b4 AS rail4, max(ship) OVER b4 AS ship4, max(truck) OVER b4 AS truck4, CASE WHEN count(air + mail) OVER h = 2 THEN sum(air + mail) OVER h END AS pool,
  CASE WHEN count(rail) OVER e = 8 THEN sum(rail) OVER e END AS rail8, CASE WHEN count(truck) OVER e = 8 THEN sum(truck) OVER e END AS truck8, CASE WHEN count(rail) OVER h = 2 THEN avg(rail) OVER h END AS railavg, CASE WHEN count(air) OVER h = 2 THEN sum(air) OVER h END AS air2
  FROM w WINDOW y AS (PARTITION BY l_suppkey ORDER BY p RANGE BETWEEN 3 PRECEDING AND CURRENT ROW), b4 AS (PARTITION BY l_suppkey ORDER BY p RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING), h AS (PARTITION BY l_suppkey ORDER BY p RANGE BETWEEN 1 PRECEDING AND CURRENT ROW), e AS (PARTITION BY l_suppkey ORDER BY p RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)),
b AS (SELECT *, max(pool) OVER (PARTITION BY l_suppkey ORDER BY p RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING) AS pool4 FROM a),
m AS (SELECT l_suppkey, p, unnest([
  {'m': 'air_share', 'v': air / (air + rail + ship + truck)}, {'m': 'cash_cover', 'v': CASE WHEN n1 = 4 AND n2 = 4 AND s2 <> 0 THEN s1 / s2 END}, {'m': 'seats_growth', 'v': rail / rail4 - 1}, {'m': 'spread', 'v': (ship / ship4 - 1) - (truck / truck4 - 1)},
  {'m': 'pooled', 'v': pool / pool4 - 1}, {'m': 'two_years', 'v': rail8 / truck8}, {'m': 'balance_yield', 'v': 4 * ship / railavg}, {'m': 'peak', 'v': CASE WHEN n2 = 4 THEN hi - lo END}, {'m': 'larger', 'v': NULL},
  {'m': 'floor', 'v': CASE WHEN fob - mail IS NOT NULL AND truck IS NOT NULL AND air2 IS NOT NULL THEN least(abs(fob - mail), truck, air2) END}, {'m': 'no_rail', 'v': NULL}]) AS x FROM b)
SELECT l_suppkey, p, x.m AS metric, round(x.v, 6) AS value, CASE WHEN x.m = 'larger' THEN 'unreadable' WHEN x.v IS NULL THEN 'missing' END AS reason FROM m
""")
def metrics_by_formulas(t):
    quarter = F.year("l_shipdate") * 4 + F.quarter("l_shipdate")
    readings = t.lineitem.groupBy("l_suppkey", quarter.alias("p"), F.element_at(F.array(*map(F.lit, ["air", "rail", "ship", "truck", "mail", "fob", "reg"])), F.col("l_linenumber").cast("int")).alias("c")).agg(F.sum("l_quantity").cast("double").alias("v"))
    return M.by_formulas(readings, FORMULAS, ["l_suppkey"], "p", "c", "v").withColumn("value", F.round("value", 6))
