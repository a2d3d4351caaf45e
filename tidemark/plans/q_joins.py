"""Join operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from .registry import query

_epoch = F.unix_micros


@query("""
SELECT p.event_id, p.user_id, v.event_id AS view_id, round(v.value, 4) AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def asof_close_on_or_before(t):
    e = t.events
    views = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    out = J.asof_join(e.where("event_type = 'purchase'"), views, ["user_id"], "ts", "ts", ["view_id", "view_value"], bucket=lambda c: F.date_trunc("week", c))
    return out.select("event_id", "user_id", "view_id", F.round("view_value", 4).alias("view_value"))


@query("""
WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT * FROM events WHERE event_type = 'click'),
m AS (SELECT p.event_id, c.event_id AS click_id, abs(epoch_us(c.ts) - epoch_us(p.ts)) AS d,
  row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(c.ts) - epoch_us(p.ts)), c.event_id) AS k
  FROM p JOIN c ON p.user_id = c.user_id AND abs(epoch_us(c.ts) - epoch_us(p.ts)) <= 3600000000)
SELECT p.event_id, m.click_id, m.d::BIGINT AS micros FROM p LEFT JOIN m ON m.event_id = p.event_id AND k = 1
""")
def nearest_within_tolerance(t):
    e = t.events
    clicks = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    near = J.nearest_join(e.where("event_type = 'purchase'"), clicks, ["user_id"], _epoch("ts"), _epoch("click_ts"), 3_600_000_000, ["click_id"], ["event_id"])
    return near.select("event_id", "click_id", F.col("distance").cast("long").alias("micros"))


@query("""
WITH o AS (SELECT *, o_totalprice > 250000 AS m, sum((o_totalprice > 250000)::INT) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
x AS (SELECT *, max(i) OVER (PARTITION BY o_custkey) AS last FROM o),
n AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, i) AS c FROM x WHERE NOT m AND i > 0 AND i < last)
SELECT o_custkey, o_orderkey, i::BIGINT AS interval, row_number() OVER (PARTITION BY o_custkey, i ORDER BY o_orderdate, o_orderkey) AS nth FROM n WHERE c = 3
""")
def interval_exactly_three(t):
    found = J.between_marks(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice") > 250000, 3)
    return found.select("o_custkey", "o_orderkey", "interval", "nth")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit FROM lineitem)
SELECT p_partkey, l_orderkey, l_linenumber FROM part JOIN l ON unit BETWEEN p_retailprice - 0.01 AND p_retailprice + 0.01 WHERE abs(p_retailprice - unit) <= 0.005 + 1e-9
""")
def band_to_the_last_digit(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    return J.band_join(t.part.select("p_partkey", "p_retailprice"), lines, "p_retailprice", "unit", 0.005).select("p_partkey", "l_orderkey", "l_linenumber")


@query("""
WITH s AS (SELECT s_suppkey, abs(s_acctbal) AS a FROM supplier WHERE abs(s_acctbal) >= 1), c AS (SELECT c_custkey, abs(c_acctbal) AS b FROM customer)
SELECT s_suppkey, c_custkey, f::BIGINT AS scale, f = 1 AS as_written FROM s, c, (VALUES (1.0::DOUBLE), (10.0), (100.0)) v(f) WHERE abs(a - b * f) <= 0.05 + 1e-9
""")
def band_over_scales(t):
    s = t.supplier.select("s_suppkey", F.abs("s_acctbal").alias("a")).where("a >= 1")
    c = t.customer.select("c_custkey", F.abs("c_acctbal").alias("b"))
    return J.band_join(s, c, "a", "b", 0.05, (1.0, 10.0, 100.0)).select("s_suppkey", "c_custkey", F.col("scale").cast("long").alias("scale"), "as_written")


_SQUEEZED = r"trim(regexp_replace({}, '[ \t\n\x0B\f\r]+', ' ', 'g'))"


@query(rf"""
WITH i AS (SELECT item_id, {_SQUEEZED.format('text')} AS x FROM benchmark),
q AS (SELECT item_id || 'whole' AS quote_id, x FROM i UNION ALL SELECT item_id || 'start', substr(x, 1, 13) FROM i UNION ALL SELECT item_id || 'words', array_to_string(string_split(x, ' ')[3:6], ' ') FROM i),
u AS (SELECT doc_id, {_SQUEEZED.format('text')} AS y FROM documents)
SELECT quote_id, min(doc_id) AS doc_id FROM q JOIN u ON length(x) >= 12 AND y <> '' AND (contains(y, x) OR (length(y) > 36 AND contains(x, y))) GROUP BY quote_id
""")
def containment_first_unit(t):
    x = J.squeezed(F.col("text"))
    quotes = {"whole": x, "start": F.substring(x, 1, 13), "words": F.array_join(F.slice(F.split(x, " "), 3, 4), " ")}
    q = t.benchmark.select("item_id", F.explode(F.create_map(*(c for k, v in quotes.items() for c in (F.lit(k), v)))).alias("kind", "quote"))
    q = q.select(F.concat(F.col("item_id").cast("string"), "kind").alias("quote_id"), "quote")
    return J.containment_join(q, t.documents.select("doc_id", "text"), "quote", "text", ["doc_id"], "quote_id", cut=True).select("quote_id", "doc_id").distinct()


@query("""
SELECT doc_id, problem FROM (
  SELECT doc_id, 'missing' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL SELECT doc_id, 'extra' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
  UNION ALL SELECT doc_id, 'duplicate' FROM labels GROUP BY doc_id HAVING count(*) > 1)
""")
def coverage_of_labels(t):
    return J.coverage(t.documents, t.labels, "doc_id")


@query("""
WITH s AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN s.l_orderkey IS NULL THEN 'missing' WHEN abs(o_totalprice - total) > 50000 THEN 'mismatch' ELSE 'ok' END AS status,
  CASE WHEN s.l_orderkey IS NOT NULL AND abs(o_totalprice - total) > 50000 THEN 'total' ELSE '' END AS problems FROM orders LEFT JOIN s ON o_orderkey = l_orderkey
""")
def reconcile_totals(t):
    lines = t.lineitem.where("l_linenumber <= 3").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return J.reconcile(t.orders, lines, "o_orderkey", {"total": ("o_totalprice", "total")}, 50000).select("o_orderkey", "status", "problems")


@query("""
WITH m AS (SELECT user_id, month(ts) AS mo, day(ts) AS d, event_type, event_id FROM events),
a AS (SELECT user_id, max_by(event_type, event_id) AS v FROM m WHERE d <= 10 GROUP BY 1), b AS (SELECT user_id, max_by(event_type, event_id) AS v FROM m WHERE d > 20 GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.v AS old, b.v AS new FROM a FULL JOIN b ON a.user_id = b.user_id WHERE a.v IS DISTINCT FROM b.v
""")
def diff_of_two_versions(t):
    def latest(cond):
        return t.events.where(cond).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("v"))

    return J.diff(latest("day(ts) <= 10"), latest("day(ts) > 20"), "user_id", "v")


@query("""
WITH v AS (SELECT user_id, ts AS since, event_id AS version, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM events WHERE event_type = 'signup')
SELECT e.event_id, v.version FROM (SELECT * FROM events WHERE event_type = 'error') e LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.since AND (v.until IS NULL OR e.ts < v.until)
""")
def validity_interval(t):
    e = t.events
    versions = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("since"), F.col("event_id").alias("version"))
    return J.valid_at(e.where("event_type = 'error'"), versions, ["user_id"], "ts", "since", ["version"], bucket=lambda c: F.date_trunc("week", c)).select("event_id", "version")


@query("""
WITH o AS (SELECT DISTINCT lower(source) AS k, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
old AS (SELECT k, lang, max(verdict) AS verdict FROM (SELECT lower(d.source) AS k, lang, CASE WHEN quality = 1 THEN 'accept' END AS verdict FROM documents d JOIN labels USING (doc_id)) GROUP BY k, lang)
SELECT o.k, o.lang, old.verdict, false AS stale FROM o LEFT JOIN old USING (k, lang)
UNION ALL SELECT k, lang, verdict, true FROM old ANTI JOIN o USING (k, lang)
""")
def carry_verdicts(t):
    key = F.lower("source").alias("k")
    items = t.documents.join(t.labels, "doc_id", "left_anti").select(key, "lang", F.lit(None).cast("string").alias("verdict")).distinct()
    before = t.documents.join(t.labels, "doc_id").select(key, "lang", F.when(F.col("quality") == 1, "accept").alias("verdict"))
    return J.carry(items, before, ["k", "lang"], ["verdict"])


@query("""
WITH a AS (SELECT s_nationkey AS c_nationkey, min(s_suppkey) AS v FROM supplier GROUP BY 1 HAVING count(DISTINCT s_suppkey) = 1),
g AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS v FROM customer WHERE c_acctbal < 0 GROUP BY ALL HAVING count(DISTINCT c_custkey) = 1)
SELECT c_custkey, coalesce(a.v, g.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'nation' WHEN g.v IS NOT NULL THEN 'segment' END AS tier
FROM customer LEFT JOIN a USING (c_nationkey) LEFT JOIN g USING (c_nationkey, c_mktsegment)
""")
def cascade_lookup(t):
    x = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("v"))
    segment = t.customer.where("c_acctbal < 0").select("c_nationkey", "c_mktsegment", F.col("c_custkey").alias("v"))
    return J.cascade(x, [("nation", nation, ["c_nationkey"]), ("segment", segment, ["c_nationkey", "c_mktsegment"])], ["c_custkey"], "v").select("c_custkey", "v", "tier")


@query("""
WITH f AS (SELECT o_orderkey, string_split(o_orderpriority, '-') AS tags FROM orders),
d AS (SELECT p_brand, p_partkey, p_size, 'P' || (p_size % 5 + 1) AS tag FROM part),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY p_size, p_partkey) AS k FROM d) WHERE k = 1)
SELECT o_orderkey, 'P' || trim(tags[1]) AS tag, p_partkey FROM f JOIN b ON 'P' || trim(tags[1]) = tag
""")
def tags_to_preferred_documents(t):
    facts = t.orders.select("o_orderkey", F.array(F.concat(F.lit("P"), F.trim(F.split("o_orderpriority", "-")[0]))).alias("tags"))
    docs = t.part.select(F.concat(F.lit("P"), (F.col("p_size") % 5 + 1).cast("string")).alias("tag"), "p_partkey", F.struct("p_size", "p_partkey").alias("rank"))
    return J.expand_preferred(facts, "tags", docs, "tag", "rank", "o_orderkey").select("o_orderkey", "tag", "p_partkey")
