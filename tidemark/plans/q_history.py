"""Queries on versions over time and on hashes of structured content. An order is a change of its customer's record."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import history as H
from .registry import query

_LOG = "SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_totalprice >= 20000 THEN o_orderstatus || ' ' || o_orderpriority END AS record FROM orders"


def _log(t):
    """Orders below 20,000 remove the record."""
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey", F.when(F.col("o_totalprice") >= 20000, F.concat("o_orderstatus", F.lit(" "), "o_orderpriority")).alias("record"))


@query(f"""
WITH log AS ({_LOG}), d AS (SELECT o_custkey, o_orderdate, max_by({{'k': o_orderkey, 'r': record}}, o_orderkey) AS v FROM log GROUP BY ALL),
c AS (SELECT *, lag(v.r) OVER w AS b, row_number() OVER w AS n FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
e AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS until FROM c WHERE n = 1 OR v.r IS DISTINCT FROM b)
SELECT o_custkey, o_orderdate AS since, until, v.k AS o_orderkey, sha256(v.r) AS content_hash FROM e WHERE v.r IS NOT NULL
""")
def versions_of_records(t):
    return H.versions(_log(t), ["o_custkey"], "o_orderdate", ["o_orderkey"], "record").select("o_custkey", "since", "until", "o_orderkey", "content_hash")


@query(f"""
WITH log AS ({_LOG}) SELECT o_custkey, min(o_orderdate) AS first_added FROM log WHERE record IS NOT NULL GROUP BY 1
""")
def paths_first_added(t):
    return H.first_added(_log(t), ["o_custkey"], "o_orderdate", "record")


@query(f"""
WITH log AS ({_LOG}), d AS (SELECT o_custkey, o_orderdate, max_by({{'k': o_orderkey, 'r': record}}, o_orderkey) AS v FROM log GROUP BY ALL),
a AS (SELECT DISTINCT o_custkey, l_shipdate AS moment FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT a.o_custkey, moment, d.v.k AS o_orderkey, d.v.r AS record FROM a ASOF LEFT JOIN d ON a.o_custkey = d.o_custkey AND a.moment > d.o_orderdate
""")
def content_before_a_moment(t):
    asked = t.lineitem.join(t.orders, F.expr("o_orderkey = l_orderkey")).select("o_custkey", F.col("l_shipdate").alias("moment")).distinct()
    return H.before(asked, _log(t), ["o_custkey"], "moment", "o_orderdate", ["o_orderkey"], "record", lambda c: F.date_trunc("year", c))


@query("""
SELECT o_custkey, min(o_orderdate) AS o_orderdate, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'F' GROUP BY 1
""")
def first_change_that_meets(t):
    return H.first_where(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], F.expr("o_totalprice > 300000 and o_orderstatus = 'F'"))


@query("""
WITH e AS (SELECT event_id, '{"id":' || event_id || ',"in":{"props":' || replace(props, ' ', '') || ',"zone":[1,{"a":"x","b":null}]},"type":"' || event_type || '"}' AS c FROM events)
SELECT event_id, sha256(c) AS one, sha256(c) AS other, event_id % 7 = 0 AS broken FROM e
""")
def json_hashes_of_events(t):
    """Two texts of one value, keys and blanks apart, hash alike; a seventh has a third text that isn't JSON."""
    e = t.events
    one = F.concat(F.lit('{ "type" : "'), "event_type", F.lit('", "id": '), F.col("event_id").cast("string"), F.lit(', "in": {"zone": [1, {"b": null, "a": "x"}], "props": '), "props", F.lit("}}"))
    other = F.concat(F.lit('{"in":{"props":'), "props", F.lit(',"zone":[1,{"a":"x","b":null}]},"id":'), F.col("event_id").cast("string"), F.lit(',"type":"'), "event_type", F.lit('"}'))
    broken = T.json_hash(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), one)).otherwise(one)).isNull()
    return e.select("event_id", T.json_hash(one).alias("one"), T.json_hash(other).alias("other"), broken.alias("broken"))
