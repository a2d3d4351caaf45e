"""Selections, overrides, shape checks and reports on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection as S
from .registry import query


@query("""
SELECT p_partkey FROM part WHERE 30 >= coalesce(CASE WHEN p_size > 5 THEN p_size END, 30) AND (CASE WHEN p_retailprice > 1000 THEN p_size + 20 END IS NULL OR 30 < p_size + 20) AND p_retailprice <= 1500
""")
def due_tests(t):
    tests = t.part.select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_size")).alias("since"), F.when(F.col("p_retailprice") > 1000, F.col("p_size") + 20).alias("until"), "p_retailprice")
    return S.due(tests, F.lit(30), "since", "until", "p_retailprice", F.lit(1500.0)).select("p_partkey")


@query("""
WITH d AS (SELECT l_suppkey, 'm' || l_suppkey AS id, list(DISTINCT l_returnflag) FILTER (WHERE l_quantity > 48) AS h FROM lineitem GROUP BY l_suppkey)
SELECT id || '[' || x || ']' AS id, x AS holder FROM (SELECT id, unnest(h) AS x FROM d) UNION ALL SELECT id, NULL FROM d WHERE h IS NULL OR len(h) = 0
""")
def definitions_by_holder(t):
    d = t.lineitem.groupBy("l_suppkey").agg(F.collect_set(F.when(F.col("l_quantity") > 48, F.col("l_returnflag"))).alias("h")).withColumn("id", F.concat(F.lit("m"), F.col("l_suppkey").cast("string")))
    return S.fan_out(d, "id", "h").select("id", "holder")


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey) AS k FROM orders) WHERE k = 1
""")
def preferred_else_latest(t):
    return S.fallback(t.orders, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT", [F.desc("o_orderdate"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)) WHERE k = 1
""")
def latest_without_a_blocker(t):
    o = t.orders
    return S.only_without(o.where("o_orderstatus = 'F'"), o.where("o_totalprice > 400000"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
WITH r AS (SELECT conv_id, turn, role = 'assistant' AS f, sha256('seed' || turn::VARCHAR) AS h FROM conversations),
a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM r WHERE NOT f), b AS (SELECT conv_id, turn AS id, row_number() OVER (PARTITION BY conv_id ORDER BY h) AS n FROM r WHERE NOT f)
SELECT conv_id, id, turn AS place FROM a JOIN b USING (conv_id, n) UNION ALL SELECT conv_id, turn, turn FROM r WHERE f
""")
def shuffled_but_fixed(t):
    rows = t.conversations.select("conv_id", F.col("turn").alias("id"), F.col("turn").alias("place"), "role")
    return S.seeded_shuffle(rows, ["conv_id"], "place", F.col("role") == "assistant", "id", "seed").select("conv_id", "id", "place")


@query("""
WITH m AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'purchase') AS last FROM events GROUP BY 1) SELECT event_id FROM events JOIN m USING (user_id) WHERE last IS NULL OR event_id > last
""")
def pending_after_latest(t):
    return S.after_latest(t.events, ["user_id"], "event_id", F.col("event_type") == "purchase").select("event_id")


@query("""
WITH r AS (SELECT c_custkey * 10 + i AS request_id, c_custkey AS k, CASE i WHEN 1 THEN 'F' ELSE 'O' END AS form, CASE WHEN i = 1 THEN TIMESTAMP '1996-01-01' END AS since, CASE WHEN i = 2 THEN TIMESTAMP '2000-01-01' END AS until, CASE WHEN c_acctbal > 0 THEN 2 END AS latest FROM customer, (VALUES (1), (2)) v(i)),
m AS (SELECT r.*, o_orderkey, row_number() OVER (PARTITION BY request_id ORDER BY o_orderdate DESC, o_orderkey) AS nth FROM r JOIN orders ON o_custkey = k AND o_orderstatus = form AND (since IS NULL OR o_orderdate >= since) AND (until IS NULL OR o_orderdate <= until))
SELECT request_id, o_orderkey, nth::INT AS nth FROM m WHERE latest IS NULL OR nth <= latest
""")
def filings_by_request(t):
    i = F.explode(F.array(F.lit(1), F.lit(2))).alias("i")
    r = t.customer.select("c_custkey", "c_acctbal", i).select(
        (F.col("c_custkey") * 10 + F.col("i")).alias("request_id"), F.col("c_custkey").alias("k"), F.when(F.col("i") == 1, "F").otherwise("O").alias("form"),
        F.when(F.col("i") == 1, F.lit("1996-01-01").cast("timestamp")).alias("since"), F.when(F.col("i") == 2, F.lit("2000-01-01").cast("timestamp")).alias("until"), F.when(F.col("c_acctbal") > 0, 2).alias("latest"),
    )
    filings = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("form"), "o_orderkey", "o_orderdate")
    return S.select_by_request(r, filings, "k", "o_orderdate", [F.desc("o_orderdate"), "o_orderkey"]).select("request_id", "o_orderkey", "nth")


@query("""
SELECT d.doc_id, coalesce(toxic::DOUBLE, least(n_chars / 4000.0::DOUBLE, 1.0)) AS p, toxic IS NOT NULL AS overridden FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id)
""")
def owner_overrides(t):
    own = t.documents.select("doc_id", F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("p"))
    return S.override(own, t.labels.select("doc_id", F.col("toxic").cast("double").alias("p")), ["doc_id"], "p")


@query("""
WITH m AS (SELECT conv_id * 1000 + turn AS old, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS new FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn, [conv_id * 1000 + turn, conv_id * 1000 + turn - 1] AS refs FROM conversations), e AS (SELECT conv_id, turn, unnest(refs) AS old, unnest([0, 1]) AS i FROM r)
SELECT conv_id, turn, string_agg(coalesce(new, e.old)::VARCHAR, ',' ORDER BY i) AS refs FROM e LEFT JOIN m ON m.old = e.old GROUP BY ALL
""")
def references_remapped(t):
    from pyspark.sql.window import Window

    c = t.conversations.withColumn("old", F.col("conv_id") * 1000 + F.col("turn"))
    mapping = c.where("role = 'user'").select("old", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long").alias("new"))
    rows = c.select("conv_id", "turn", F.array(F.col("old"), F.col("old") - 1).alias("refs"))
    return S.remapped(rows, mapping, "old", "new", ["conv_id", "turn"], "refs").select("conv_id", "turn", F.array_join("refs", ",").alias("refs"))


@query("""
SELECT doc_id, 'text is missing' AS error FROM documents WHERE text IS NULL UNION ALL SELECT doc_id, 'lang is missing' FROM documents WHERE lang IS NULL
UNION ALL SELECT doc_id, 'lang is ' || lang FROM documents WHERE lang NOT IN ('en', 'de') UNION ALL SELECT d.doc_id, 'of toxic, quality: ' || ((toxic IS NOT NULL)::INT + (quality IS NOT NULL)::INT) FROM documents d LEFT JOIN labels l USING (doc_id) WHERE (toxic IS NOT NULL)::INT + (quality IS NOT NULL)::INT <> 1
""")
def shape_errors(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    return S.structure_errors(d, ["doc_id"], ["text", "lang"], {"lang": ["en", "de"]}, [["toxic", "quality"]])


@query("""
WITH m AS (SELECT page_id AS k, md5(CASE WHEN length(html) > 2000 THEN html ELSE html || 'x' END) AS h FROM pages WHERE length(html) > 1200), f AS (SELECT page_id AS k, md5(html) AS h FROM pages WHERE length(html) < 6000)
SELECT coalesce(m.k, f.k) AS k, CASE WHEN f.k IS NULL THEN 'missing' WHEN m.k IS NULL THEN 'unlisted' ELSE 'changed' END AS problem FROM m FULL JOIN f ON m.k = f.k WHERE m.h IS DISTINCT FROM f.h
""")
def files_against_manifest(t):
    k = F.col("page_id").alias("k")
    manifest = t.pages.where("length(html) > 1200").select(k, F.md5(F.when(F.length("html") > 2000, F.col("html")).otherwise(F.concat("html", F.lit("x")))).alias("h"))
    return S.verify_files(manifest, t.pages.where("length(html) < 6000").select(k, F.md5("html").alias("h")), "k", "h")


@query("""
SELECT event_id FROM events e WHERE ts >= '2024-01-16' AND NOT EXISTS (SELECT 1 FROM events b WHERE b.ts < '2024-01-16' AND b.user_id = e.user_id AND b.event_type = e.event_type AND b.props = e.props)
""")
def errors_not_known_before(t):
    e = t.events
    return S.new_errors(e.where("ts < '2024-01-16'"), e.where("ts >= '2024-01-16'"), ["user_id", "event_type", "props"]).select("event_id")


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 25")
def top_suppliers(t):
    return S.top(t.lineitem, "l_suppkey", 25)


@query("SELECT l_suppkey, round(sum(p_retailprice), 2) AS p_retailprice FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey GROUP BY 1")
def distinct_sizes(t):
    lines = t.lineitem.select("l_suppkey", F.col("l_partkey").alias("p_partkey"))
    return S.distinct_weight(lines, ["l_suppkey"], "p_partkey", t.part, "p_retailprice").withColumn("p_retailprice", F.round("p_retailprice", 2))


@query("SELECT event_id, '$.k' AS path, json_extract_string(props, '$.k') AS value FROM events")
def nested_leaves(t):
    return S.walk(t.events.select("event_id", F.parse_json("props").alias("d")), "event_id", "d")


@query("SELECT id, row_number() OVER (ORDER BY p, n) AS place FROM (SELECT p_brand || '-F' || p_partkey AS id, p_brand AS p, p_partkey AS n FROM part)")
def natural_places(t):
    from pyspark.sql.window import Window

    rows = t.part.select(F.concat("p_brand", F.lit("-F"), F.col("p_partkey").cast("string")).alias("id"), "p_brand", "p_partkey")
    by = [F.regexp_extract("id", "^(.*)-F", 1), *S.natural_order(F.regexp_extract("id", "(F[0-9]+)$", 1))]
    inside = rows.withColumn("n", F.row_number().over(Window.partitionBy("p_brand").orderBy(*by)))
    before = rows.groupBy("p_brand").agg(F.count("*").alias("c")).withColumn("base", F.expr("sum(c) over (order by p_brand) - c"))
    return inside.join(before, "p_brand").select("id", (F.col("base") + F.col("n")).alias("place"))


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k, l_shipdate AS day FROM lineitem JOIN orders ON o_orderkey = l_orderkey), x AS (SELECT a.*, unnest(['annual', 'proxy']) AS kind FROM a),
f AS (SELECT o_custkey AS k, o_orderdate, CASE o_orderpriority WHEN '5-LOW' THEN 'proxy' ELSE 'annual' END AS kind, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY ALL)
SELECT x.k, day, x.kind, o_orderkey FROM x ASOF LEFT JOIN f ON x.k = f.k AND x.kind = f.kind AND x.day >= f.o_orderdate
""")
def documents_in_force(t):
    asked = t.lineitem.join(t.orders, F.expr("o_orderkey = l_orderkey")).select(F.col("o_custkey").alias("k"), F.col("l_shipdate").alias("day")).distinct()
    filings = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("form"), "o_orderdate", "o_orderkey")
    return S.in_force(asked, filings, "k", "day", "o_orderdate", {"annual": ["1-URGENT", "2-HIGH"], "proxy": ["5-LOW"]}, ["o_orderkey"], lambda c: F.date_trunc("year", c))


@query("""
WITH r AS (SELECT c_custkey AS request_id, c_custkey AS k, CASE WHEN c_custkey % 3 > 0 THEN ['1', (c_custkey % 5 + 2)::VARCHAR] ELSE [] END AS items FROM customer),
f AS (SELECT o_custkey AS k, o_orderkey, o_orderdate, list(DISTINCT l_linenumber::VARCHAR) FILTER (l_quantity > 40) AS items FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
m AS (SELECT request_id, o_orderkey, row_number() OVER (PARTITION BY request_id ORDER BY o_orderdate DESC, o_orderkey)::INT AS nth FROM r JOIN f USING (k) WHERE len(r.items) = 0 OR len(list_intersect(r.items, coalesce(f.items, []))) > 0)
SELECT request_id, o_orderkey, nth FROM m WHERE nth <= 2
""")
def filings_with_items_asked_for(t):
    """Requests that name items: lines of more than forty pieces stand for the items of an order."""
    items = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_quantity") > 40, F.col("l_linenumber").cast("string"))).alias("items"))
    filings = t.orders.join(items, F.expr("l_orderkey = o_orderkey")).select(F.col("o_custkey").alias("k"), F.lit("any").alias("form"), "o_orderkey", "o_orderdate", "items")
    k, null = F.col("c_custkey"), F.lit(None).cast("timestamp")
    asked = F.when(k % 3 > 0, F.array(F.lit("1"), (k % 5 + 2).cast("string"))).otherwise(F.array().cast("array<string>"))
    r = t.customer.select(k.alias("request_id"), k.alias("k"), F.lit("any").alias("form"), null.alias("since"), null.alias("until"), F.lit(2).alias("latest"), asked.alias("items"))
    return S.select_by_request(r, filings, "k", "o_orderdate", [F.desc("o_orderdate"), "o_orderkey"], "items").select("request_id", "o_orderkey", "nth")
