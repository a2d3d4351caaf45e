"""Merges, ordinals, aggregates and islands on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sizes import small
from ..operators import aggregates as A
from ..operators import holdings as H
from ..operators import islands as I
from ..operators import merge as M
from .registry import query


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL")
def last_wins(t):
    return M.keep_first(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def keep_first(t):
    return M.keep_first(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("""
WITH u AS (SELECT l_partkey AS k, 0 AS p, l_orderkey AS v FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_partkey, 1, l_orderkey FROM lineitem WHERE l_returnflag = 'A'),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, v) AS n, row_number() OVER (PARTITION BY k ORDER BY p DESC, v DESC) AS m FROM u)
SELECT k, max(CASE WHEN n = 1 THEN v END) AS first_listed, max(CASE WHEN m = 1 THEN v END) AS last_group FROM r GROUP BY k
""")
def union_with_priority(t):
    parts = [t.lineitem.where(f"l_returnflag = '{f}'").select(F.col("l_partkey").alias("k"), F.col("l_orderkey").alias("v")) for f in "RA"]
    first = M.first_listed(parts, ["k"], ["v"]).withColumnRenamed("v", "first_listed")
    return first.join(M.last_group_wins(parts, ["k"], ["v"]).withColumnRenamed("v", "last_group"), "k")


@query("""
WITH o AS (SELECT c_custkey AS k, c_mktsegment AS s, c_nationkey AS n FROM customer WHERE c_acctbal > 0), w AS (SELECT c_custkey AS k, CASE WHEN c_nationkey < 5 THEN 'X' ELSE c_mktsegment END AS s, c_nationkey AS n FROM customer)
SELECT w.k, w.s, w.n, CASE WHEN o.k IS NULL THEN 'insert' WHEN o.s IS NOT DISTINCT FROM w.s AND o.n IS NOT DISTINCT FROM w.n THEN 'skip' ELSE 'conflict' END AS action FROM w LEFT JOIN o ON o.k = w.k
""")
def insert_only_merge(t):
    base = [F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"), F.col("c_nationkey").alias("n")]
    new = t.customer.select(*base).withColumn("s", F.when(F.col("n") < 5, "X").otherwise(F.col("s")))
    return M.insert_only(t.customer.where("c_acctbal > 0").select(*base), new, "k")


@query("""
SELECT o.o_orderkey, coalesce(CASE WHEN o.o_totalprice > 150000 THEN o.o_orderstatus END, n.s) AS o_orderstatus, coalesce(CASE WHEN o.o_orderstatus = 'F' THEN o_orderpriority END, n.p) AS o_orderpriority
FROM orders o LEFT JOIN (SELECT o_orderkey, 'Z' AS s, 'none' AS p FROM orders WHERE o_orderdate >= '1996-01-01') n USING (o_orderkey)
""")
def fill_nulls_only(t):
    old = t.orders.select("o_orderkey", F.when(F.col("o_totalprice") > 150000, F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("o_orderpriority"))
    new = t.orders.where("o_orderdate >= '1996-01-01'").select("o_orderkey", F.lit("Z").alias("o_orderstatus"), F.lit("none").alias("o_orderpriority"))
    return M.fill_nulls(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("""
WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS x FROM orders WHERE o_orderdate < '1999-01-01'), n AS (SELECT o_orderkey AS k, CASE WHEN o_totalprice < 100000 THEN 'P' ELSE 'F' END AS x FROM orders WHERE o_orderdate >= '1996-01-01')
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.x = 'F' THEN o.x ELSE coalesce(n.x, o.x) END AS x,
  CASE WHEN o.x = 'F' AND n.x <> o.x THEN 'conflict' WHEN o.x IS NULL THEN 'added' WHEN (CASE WHEN o.x = 'F' THEN o.x ELSE coalesce(n.x, o.x) END) = o.x THEN 'kept' ELSE 'changed' END AS status
FROM o FULL JOIN n ON o.k = n.k
""")
def monotone_upsert(t):
    key = F.col("o_orderkey").alias("k")
    old = t.orders.where("o_orderdate < '1999-01-01'").select(key, F.col("o_orderstatus").alias("x"))
    new = t.orders.where("o_orderdate >= '1996-01-01'").select(key, F.when(F.col("o_totalprice") < 100000, "P").otherwise("F").alias("x"))
    return M.upsert_unless_final(old, new, ["k"], "x", ["F"])


@query("SELECT p_partkey, 'planned' AS origin FROM part WHERE p_size < 20 UNION ALL SELECT p_partkey, 'disk' FROM part WHERE p_size >= 20 AND p_retailprice > 1000")
def overlay_scan(t):
    planned = t.part.where("p_size < 20").select("p_partkey", F.lit("planned").alias("origin"))
    return M.overlay(planned, t.part.where("p_retailprice > 1000").select("p_partkey", F.lit("disk").alias("origin")), ["p_partkey"])


@query("""
WITH s AS (SELECT l_orderkey AS k, l_linenumber > 5 AS whole, CASE WHEN l_quantity > 45 THEN NULL ELSE [l_returnflag, l_linestatus] END AS parts FROM lineitem)
SELECT k, bool_or(whole) AS whole, CASE WHEN bool_or(parts IS NULL) THEN NULL ELSE array_to_string(list_sort(list_distinct(flatten(list(parts)))), ',') END AS parts FROM s GROUP BY k
""")
def null_means_everything(t):
    s = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") > 5).alias("whole"), F.when(F.col("l_quantity") <= 45, F.array("l_returnflag", "l_linestatus")).alias("parts"))
    return M.merge_selections(s, "k", ["whole"], ["parts"]).withColumn("parts", F.array_join("parts", ","))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders)
SELECT *, CASE WHEN ordinal > 1 THEN '-' || ordinal ELSE '' END AS suffix FROM o
""")
def same_year_ordinals(t):
    return M.ordinals(t.orders.withColumn("y", F.year("o_orderdate")), ["o_custkey", "y"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey", "ordinal", "suffix")


@query("""
WITH x AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id % 8, conv_id, turn) AS number FROM conversations)
SELECT conv_id, turn, number, 'F' || lpad(number::VARCHAR, 6, '0') AS label FROM x
""")
def renumber_turns(t):
    return M.renumber(t.conversations.select("conv_id", "turn"), ["conv_id", "turn"], "F", F.col("conv_id") % 8, 6)


@query("""
WITH d AS (SELECT conv_id AS k, list(conv_id * 1000 + turn ORDER BY turn) AS i FROM conversations GROUP BY 1), f AS (SELECT conv_id * 1000 + turn AS k, role FROM conversations WHERE length(text) > 60),
e AS (SELECT d.k, unnest(i) AS x FROM d), g AS (SELECT e.k, count(*) AS n, count(role) AS m, string_agg(role, '|' ORDER BY x) AS v FROM e LEFT JOIN f ON f.k = e.x GROUP BY e.k)
SELECT k, CASE WHEN n = m THEN v END AS roles FROM g
""")
def all_inputs_or_none(t):
    c = t.conversations.withColumn("x", F.col("conv_id") * 1000 + F.col("turn"))
    derived = c.groupBy(F.col("conv_id").alias("k")).agg(F.array_sort(F.collect_list("x")).alias("i"))
    facts = c.where("length(text) > 60").select(F.col("x").alias("k"), "role")
    return M.full_or_nothing(derived, facts, "k", "i", "role").select("k", F.array_join("values", "|").alias("roles"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'fast' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '5-LOW' THEN 'later' ELSE 'queue' END AS destination FROM orders
""")
def first_matching_rule(t):
    rules = t.spark.createDataFrame([("F", "1-URGENT", 1, "fast"), ("F", None, 2, "done"), (None, "5-LOW", 3, "later")], "o_orderstatus string, o_orderpriority string, order int, destination string")
    return M.route(t.orders, small(rules), "o_orderkey", ["o_orderstatus", "o_orderpriority"], "queue").select("o_orderkey", "destination")


@query("""
WITH x AS (SELECT lang, source, least(n_chars / 4000.0::DOUBLE, 1.0) AS p, toxic::DOUBLE AS o FROM documents JOIN labels USING (doc_id))
SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' ELSE 'all' END AS scope, coalesce(lang, source) AS value, count(*) AS n,
  round_even(avg(power(p - o, 2)), 4) AS brier, round_even(avg(p), 4) AS mean_probability, round_even(avg(o), 4) AS observed FROM x GROUP BY GROUPING SETS ((), (lang), (source))
""")
def calibration(t):
    x = t.documents.join(t.labels, "doc_id").select("lang", "source", F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("p"), F.col("toxic").cast("double").alias("o"))
    return A.calibration(x, "p", "o", ["lang", "source"])


@query("""
WITH m AS (SELECT user_id, strftime(date_trunc('month', ts), '%Y-%m') AS month, round(sum(value), 4) AS spent FROM events GROUP BY ALL)
SELECT *, round(spent / 4000 + 1e-9, 4) AS fraction, CASE WHEN round(spent / 4000 + 1e-9, 4) >= 1 THEN 'stop' WHEN round(spent / 4000 + 1e-9, 4) >= 0.85 THEN 'ask' WHEN round(spent / 4000 + 1e-9, 4) >= 0.7 THEN 'warn' ELSE 'normal' END AS stage FROM m
""")
def budget_ladder(t):
    return A.budget_stage(t.events, ["user_id"], F.date_format("ts", "yyyy-MM"), "value", 4000, [(0.7, "warn"), (0.85, "ask"), (1.0, "stop")])


@query("""
WITH u AS (SELECT l_orderkey, l_returnflag AS c, sum(l_quantity * 100) AS n FROM lineitem GROUP BY ALL), p AS (SELECT * FROM (VALUES ('A', 3.0::DOUBLE), ('N', 15.0), ('R', 0.3)) v(c, price))
SELECT l_orderkey, round(sum(round_even(n * price / 1000000, 6)), 6) AS cost FROM u JOIN p USING (c) GROUP BY 1
""")
def token_costs(t):
    usage = t.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("c")).agg(F.sum(F.col("l_quantity") * 100).alias("n"))
    prices = t.spark.createDataFrame([("A", 3.0), ("N", 15.0), ("R", 0.3)], "c string, price double")
    return A.token_cost(usage, small(prices), "l_orderkey", "c", "n", "price")


@query("""
WITH k AS (SELECT user_id, max(event_id) FILTER (WHERE event_type NOT IN ('error', 'view')) AS ok FROM events GROUP BY 1)
SELECT e.user_id, count(*) AS streak FROM events e JOIN k USING (user_id) WHERE event_id > coalesce(ok, -1) GROUP BY 1 HAVING count(*) >= 2
""")
def trailing_failures(t):
    return A.trailing_streak(t.events, ["user_id"], ["ts", "event_id"], F.col("event_type").isin("error", "view"))


@query("""
SELECT token, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS token FROM documents) GROUP BY 1 HAVING count(*) >= 3
""")
def document_frequency(t):
    return A.document_frequency(t.documents, ["doc_id"], F.regexp_extract_all("text", F.lit("([A-Za-z]{3,})"), F.lit(1)), 3)


@query("""
WITH y AS (SELECT c_nationkey, year(o_orderdate) AS y, round(sum(o_totalprice), 2) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
l AS (SELECT *, lag(y) OVER w AS py, lag(v) OVER w AS pv FROM y WINDOW w AS (PARTITION BY c_nationkey ORDER BY y)) SELECT c_nationkey, y::INT AS y, v FROM l WHERE py = y - 1 AND v < pv
""")
def decline_years(t):
    y = t.orders.join(t.customer, F.expr("c_custkey = o_custkey")).groupBy("c_nationkey", F.year("o_orderdate").alias("y")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return A.declines(y, ["c_nationkey"], "y", "v")


@query("""
WITH x AS (SELECT l_suppkey % 10 AS item, CASE l_returnflag WHEN 'A' THEN 'us' WHEN 'N' THEN 'ifrs' ELSE 'own' END AS concept, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE 2 END AS pref, year(l_shipdate) AS e, l_shipdate AS filed, l_extendedprice AS v, l_orderkey FROM lineitem),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item, concept, e ORDER BY filed DESC, v DESC) AS n FROM x) WHERE n = 1),
b AS (SELECT item, concept, max(e) AS me, count(*) AS c, min(pref) AS p FROM l GROUP BY ALL), ch AS (SELECT item, concept FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY me DESC, c DESC, p) AS k FROM b) WHERE k = 1),
o AS (SELECT * FROM (SELECT l.*, row_number() OVER (PARTITION BY item ORDER BY e DESC) AS k FROM l JOIN ch USING (item, concept)) WHERE k <= 5)
SELECT o.item, o.concept, o.e::INT AS e, o.v, coalesce(bool_or(l.concept <> o.concept AND abs(l.v - o.v) > 0.02 * abs(o.v)), false) AS differs FROM o LEFT JOIN l ON l.item = o.item AND l.e = o.e GROUP BY ALL
""")
def concept_choice(t):
    pick = lambda a, n, o: F.when(F.col("l_returnflag") == "A", a).when(F.col("l_returnflag") == "N", n).otherwise(o)
    x = t.lineitem.select((F.col("l_suppkey") % 10).alias("item"), pick("us", "ifrs", "own").alias("concept"), pick(1, 0, 2).alias("pref"), F.year("l_shipdate").alias("e"), F.col("l_shipdate").alias("filed"), F.col("l_extendedprice").alias("v"))
    return A.concept_series(x, ["item"], "concept", "e", "filed", "v", "pref", years=5)


@query("""
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'all' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS "n_F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "n_O", count(*) FILTER (WHERE o_orderstatus = 'X') AS "n_X" FROM orders GROUP BY ROLLUP (o_orderpriority)
""")
def rollup_of_outcomes(t):
    return A.rollup_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "X"])


@query("""
SELECT o_custkey, CASE max(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END) WHEN 0 THEN 'F' WHEN 1 THEN 'P' ELSE 'O' END AS worst, count(*) AS n FROM orders GROUP BY 1
""")
def worst_of_statuses(t):
    return A.worst_status(t.orders, ["o_custkey"], "o_orderstatus", ["F", "P", "O"])


@query("""
WITH x AS (SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS marked FROM lineitem GROUP BY 1)
SELECT *, CASE WHEN total <> 0 THEN round_even(marked / total, 4) END AS coverage FROM x
""")
def coverage_share(t):
    return A.share_of_total(t.lineitem, ["l_suppkey"], "l_extendedprice", F.col("l_returnflag") == "R")


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders)
SELECT o_custkey, coalesce(string_agg(o_orderkey::VARCHAR, '; ' ORDER BY k) FILTER (WHERE k <= 3), '') AS first, greatest(count(*) - 3, 0) AS more FROM r GROUP BY 1
""")
def first_and_more(t):
    return A.top_then_more(t.orders.withColumn("m", F.col("o_orderkey").cast("string")), ["o_custkey"], "m", ["o_orderdate", "o_orderkey"], 3)


@query("SELECT user_id, 'k' AS component, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS amount FROM events GROUP BY 1")
def json_map_totals(t):
    return A.map_totals(t.events.select("user_id", F.from_json("props", "map<string,bigint>").alias("u")), ["user_id"], "u")


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) // 1000000 AS s FROM events WHERE event_type = 'error'), w AS (SELECT user_id, s - 720 AS a, s + 720 AS b FROM e),
m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM w),
i AS (SELECT *, sum(CASE WHEN r IS NULL OR a > r THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, min(a)::BIGINT AS a, max(b)::BIGINT AS b, count(*) AS n FROM i GROUP BY user_id, g
""")
def merged_windows(t):
    s = F.unix_seconds("ts")
    return I.merge_spans(t.events.where("event_type = 'error'").select("user_id", (s - 720).alias("a"), (s + 720).alias("b")), ["user_id"], "a", "b")


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
h AS (SELECT doc_id, i, 0 AS p FROM l WHERE regexp_matches(x, '[0-9]{4}') UNION ALL SELECT doc_id, i, 1 FROM l WHERE regexp_matches(x, '@')),
f AS (SELECT doc_id, greatest(i - 2, 0) AS a, i + 2 AS b FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM h) WHERE k <= 3),
m AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM f),
g AS (SELECT *, sum(CASE WHEN r IS NULL OR a > r THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT doc_id, min(a)::INT AS "start", max(b)::INT AS "end", count(*) AS n FROM g GROUP BY doc_id, g
""")
def windows_around_hits(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "x"))
    return I.hit_windows(lines, ["doc_id"], "line", "x", ["[0-9]{4}", "@"], around=2, hits=3)


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS s FROM orders) SELECT o_custkey, o_orderkey FROM c WHERE s <= 600000
""")
def prefix_within_budget(t):
    return I.cut_at_budget(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", 600000).select("o_custkey", "o_orderkey")


@query("""
WITH d AS (SELECT user_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS day, sum(value) AS v FROM events GROUP BY ALL),
h AS (SELECT *, v < 150 AS h, lag(day) OVER w AS pd, lag(v < 150) OVER w AS ph FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
g AS (SELECT *, sum(CASE WHEN NOT h OR pd IS NULL OR pd <> day - 1 OR NOT ph THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS g FROM h),
s AS (SELECT user_id, day, CASE WHEN h THEN row_number() OVER (PARTITION BY user_id, g ORDER BY day) ELSE 0 END AS streak FROM g)
SELECT user_id, day::INT AS day, streak, streak >= 3 AS triggered FROM s
""")
def consecutive_rule(t):
    d = t.events.groupBy("user_id", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day")).agg(F.sum("value").alias("v"))
    return I.consecutive(d, ["user_id"], "day", F.col("v") < 150, 3).select("user_id", "day", "streak", "triggered")


@query("""
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type IN ('signup', 'purchase') THEN event_type END AS h FROM events),
n AS (SELECT * FROM (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS heading FROM e) WHERE heading IS NOT NULL),
c AS (SELECT *, CASE WHEN heading IS DISTINCT FROM lag(heading) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS c FROM n),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS r FROM c), s AS (SELECT user_id, heading, r, min(event_id) AS "start", max(event_id) AS "end" FROM r GROUP BY ALL)
SELECT user_id, heading, "start", "end" FROM (SELECT *, row_number() OVER (PARTITION BY user_id, heading ORDER BY "end" - "start" DESC, "start") AS k FROM s) WHERE k = 1
""")
def longest_sections(t):
    head = F.when(F.col("event_type").isin("signup", "purchase"), F.col("event_type"))
    return I.sections(t.events, ["user_id"], "event_id", head).select("user_id", "heading", "start", "end")


@query("""
WITH w AS (SELECT o_orderkey AS path, o_orderkey // 8 AS bundle, o_custkey, md5(o_orderstatus || o_orderkey) AS h, o_orderpriority = '1-URGENT' AS wanted FROM orders),
b AS (SELECT bundle, min(coalesce(l, 0))::INT AS level FROM w LEFT JOIN (SELECT c_custkey, (CASE WHEN c_acctbal > 0 THEN 3 ELSE 1 END) AS l FROM customer WHERE c_custkey % 50 > 0) ON c_custkey = o_custkey GROUP BY 1),
s AS (SELECT l_orderkey AS path, max_by(md5(CASE WHEN l_linenumber % 3 = 0 THEN 'x' ELSE o_orderstatus || o_orderkey END), l_linenumber) AS have FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
SELECT path, level, CASE WHEN level < 2 THEN 'staged' WHEN wanted AND have = h THEN 'published' ELSE 'branch' END AS destination FROM w JOIN b USING (bundle) LEFT JOIN s USING (path)
""")
def writes_by_trust(t):
    key = F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))
    writes = t.orders.select(F.col("o_orderkey").alias("path"), F.floor(F.col("o_orderkey") / 8).alias("bundle"), F.col("o_custkey").alias("company"), F.md5(key).alias("h"), (F.col("o_orderpriority") == "1-URGENT").alias("wanted"))
    trust = t.customer.where("c_custkey % 50 > 0").select(F.col("c_custkey").alias("company"), F.when(F.col("c_acctbal") > 0, 3).otherwise(1).alias("level"))
    staged = t.lineitem.join(t.orders, F.expr("o_orderkey = l_orderkey")).select(F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("at"), F.md5(F.when(F.col("l_linenumber") % 3 == 0, "x").otherwise(key)).alias("h"))
    return M.route_by_trust(writes, trust, staged, "bundle", "path", "company", "h", "wanted").select("path", "level", "destination")


@query("""
WITH p AS (SELECT o_orderkey AS k, md5(o_orderstatus || o_orderpriority) AS d, md5(o_orderpriority) AS b, o_orderdate < TIMESTAMP '1998-01-01' AS closed FROM orders),
e AS (SELECT o_orderkey AS k, md5(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'N' END || CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE o_orderpriority END) AS d, md5(CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE o_orderpriority END) AS b FROM orders WHERE o_orderkey % 7 > 0)
SELECT p.k, CASE WHEN e.k IS NULL THEN 'new' WHEN e.d = p.d THEN 'same' WHEN e.b = p.b THEN 'header' WHEN closed THEN 'refused' ELSE 'replaced' END AS does FROM p LEFT JOIN e USING (k)
""")
def writes_against_existing(t):
    k, o = F.col("o_orderkey"), t.orders
    planned = o.select(k.alias("k"), F.md5(F.concat("o_orderstatus", "o_orderpriority")).alias("d"), F.md5("o_orderpriority").alias("b"), (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).alias("closed"))
    body = F.when(k % 5 == 0, "none").otherwise(F.col("o_orderpriority"))
    existing = o.where(k % 7 > 0).select(k.alias("k"), F.md5(F.concat(F.when(k % 3 == 0, F.col("o_orderstatus")).otherwise("N"), body)).alias("d"), F.md5(body).alias("b"))
    return M.against_existing(planned, existing, "k", "d", "b", F.col("closed")).select("k", "does")


@query("""
WITH c AS (SELECT o_orderpriority AS kind, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL)
SELECT kind, month, sum(n)::BIGINT AS n, string_agg(s || '=' || n, ',' ORDER BY s) AS outcomes FROM c GROUP BY ALL
""")
def outcomes_by_month(t):
    got = A.monthly_outcomes(t.orders, ["o_orderpriority"], "o_orderdate", "o_orderstatus")
    shown = F.transform(F.map_entries("outcomes"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return got.select(F.col("o_orderpriority").alias("kind"), "month", "n", F.array_join(shown, ",").alias("outcomes"))


@query("""
WITH c AS (SELECT l_suppkey AS s, l_shipdate::DATE AS d, max(l_extendedprice) AS close FROM lineitem GROUP BY ALL), y AS (SELECT o_orderdate::DATE AS d, round(avg(o_totalprice), 2) AS rate FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
l AS (SELECT s, year(d) AS year, max(d) AS d, max_by(close, d) AS close FROM c GROUP BY ALL)
SELECT l.s, l.year::INT AS year, l.d, close, rate FROM l ASOF LEFT JOIN y ON l.d >= y.d
""")
def closes_of_year_ends(t):
    closes = t.lineitem.groupBy(F.col("l_suppkey").alias("s"), F.to_date("l_shipdate").alias("d")).agg(F.max("l_extendedprice").alias("close"))
    yields = t.orders.where("o_orderpriority = '5-LOW'").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.round(F.avg("o_totalprice"), 2).alias("rate"))
    return H.year_end_closes(closes, yields, "s", "d", "close", "rate").select("s", "year", "d", "close", "rate")
