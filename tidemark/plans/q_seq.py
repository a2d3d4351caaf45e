"""Folds, windows of readings and rules on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import facts as X
from ..operators import holdings as H
from ..operators import packing as P
from ..operators import rules as R
from .registry import query

_COST = "length(coalesce(text, ''))"


@query(f"""
WITH RECURSIVE x AS (SELECT conv_id, turn, {_COST} AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
r AS (SELECT conv_id, k, turn, c <= 250 AS kept, CASE WHEN c <= 250 THEN c ELSE 0 END AS used FROM x WHERE k = 1
  UNION ALL SELECT x.conv_id, x.k, x.turn, used + c <= 250, CASE WHEN used + c <= 250 THEN used + c ELSE used END FROM r JOIN x ON x.conv_id = r.conv_id AND x.k = r.k + 1)
SELECT conv_id, turn FROM r WHERE kept
""")
def knapsack_in_order(t):
    return P.within_budget(t.conversations.withColumn("c", F.expr(_COST)), ["conv_id"], ["turn"], "c", 250, "turn")


@query(f"""
WITH RECURSIVE x AS (SELECT conv_id, turn, {_COST} AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
r AS (SELECT conv_id, k, turn, 1 AS slice, c AS size FROM x WHERE k = 1
  UNION ALL SELECT x.conv_id, x.k, x.turn, CASE WHEN size + c > 200 THEN slice + 1 ELSE slice END, CASE WHEN size + c > 200 THEN c ELSE size + c END FROM r JOIN x ON x.conv_id = r.conv_id AND x.k = r.k + 1)
SELECT conv_id, turn, slice FROM r
""")
def slices_in_order(t):
    return P.slices(t.conversations.withColumn("c", F.expr(_COST)), ["conv_id"], ["turn"], "c", 200, "turn")


@query(f"""
WITH RECURSIVE x AS (SELECT conv_id, turn, {_COST} AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
r AS (SELECT conv_id, k, turn, least(c, 120, 300) AS given, c, least(c, 120) AS used, least(c, 120) > 300 AS over FROM x WHERE k = 1
  UNION ALL SELECT x.conv_id, x.k, x.turn, CASE WHEN over OR 300 - used < 20 THEN 0 ELSE least(x.c, 120, 300 - used) END, x.c, used + CASE WHEN over OR 300 - used < 20 THEN 0 ELSE least(x.c, 120, 300 - used) END, over OR 300 - used < 20 OR least(x.c, 120) > 300 - used
  FROM r JOIN x ON x.conv_id = r.conv_id AND x.k = r.k + 1)
SELECT conv_id, turn, given::DOUBLE AS given, given < c AS cut FROM r
""")
def room_left(t):
    return P.room_left(t.conversations.withColumn("c", F.expr(_COST)), ["conv_id"], ["turn"], "c", "turn", 120, 300, 20)


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS neg, l_quantity, round(sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING), 2) AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem),
w AS (SELECT *, CASE WHEN l_quantity > 45 THEN abs(s) END AS written FROM x), b AS (SELECT l_orderkey, s, written, k FROM w WHERE written IS NOT NULL AND abs(s - written) > 0.005)
SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY k)::INT AS i, s AS expected, written FROM b
""")
def running_totals(t):
    from pyspark.sql.window import Window

    sign = F.when(F.col("l_returnflag") == "R", "-").otherwise("+")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    w = Window.partitionBy("l_orderkey").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.abs(F.round(F.sum(F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))).over(w), 2))
    rows = t.lineitem.withColumn("sign", sign).withColumn("written", F.when(F.col("l_quantity") > 45, total))
    return P.running_total(rows, ["l_orderkey"], order, "l_quantity", "sign", "written")


@query()
def packed_by_documents(t):
    """Best fit depends on all slices so far: tested against a brute-force version."""
    facts = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))).alias("docs"))
    sizes = t.part.select(F.col("p_partkey").cast("string").alias("doc"), F.col("p_retailprice").alias("size"))
    out = P.pack_by_documents(facts, ["l_suppkey"], "l_orderkey", "docs", sizes, "doc", "size", 60, 160_000, 500_000)
    return out.select("l_suppkey", "l_orderkey", "slice", F.size("full").alias("n_full"), F.size("cut").alias("n_cut"))


_RULES = [
    ("spend", "spend_low", "value", "<", 120.0, None, 2, "fail", None, None),
    ("spend", "spend_soft", "value", "<", 250.0, None, 2, "warn", None, None),
    ("band", "band_out", "value", "outside", 60.0, 900.0, 1, "fail", None, None),
    ("fall", "falling", "value", "decrease", None, None, 2, "fail", None, None),
    ("count", "many", "n", ">=", 4.0, None, 3, "warn", None, None),
    ("later", "later_low", "value", "<", 500.0, None, 1, "fail", 25, None),
]
_RULE_COLUMNS = "test_id string, rule_id string, metric string, op string, low double, high double, n int, severity string, since int, until int"


@query("""
WITH rules AS (SELECT * FROM (VALUES ('spend', 'spend_low', 'value', '<', 120.0::DOUBLE, NULL::DOUBLE, 2, 'fail', NULL::INT), ('spend', 'spend_soft', 'value', '<', 250.0, NULL, 2, 'warn', NULL), ('band', 'band_out', 'value', 'outside', 60.0, 900.0, 1, 'fail', NULL),
  ('fall', 'falling', 'value', 'decrease', NULL, NULL, 2, 'fail', NULL), ('count', 'many', 'n', '>=', 4.0, NULL, 3, 'warn', NULL), ('later', 'later_low', 'value', '<', 500.0, NULL, 1, 'fail', 25)) v(test_id, rule_id, metric, op, low, high, n, severity, since)),
d AS (SELECT user_id, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day, round(sum(value), 4) AS value, count(*)::DOUBLE AS n FROM events GROUP BY ALL),
m AS (SELECT user_id, day, 'value' AS metric, value AS v FROM d UNION ALL SELECT user_id, day, 'n', n FROM d),
b AS (SELECT *, CASE WHEN lag(day) OVER w = day - 1 THEN lag(v) OVER w END AS before FROM m WINDOW w AS (PARTITION BY user_id, metric ORDER BY day)),
h AS (SELECT user_id, day, r.*, CASE op WHEN '<' THEN v < low WHEN '>=' THEN v >= low WHEN 'outside' THEN v < low OR v > high ELSE v < before END AS h FROM b JOIN rules r USING (metric)),
g AS (SELECT *, sum(CASE WHEN coalesce(h, false) AND lag_day = day - 1 AND lag_h THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, rule_id ORDER BY day) AS g FROM (SELECT *, lag(day) OVER w AS lag_day, coalesce(lag(h) OVER w, false) AS lag_h FROM h WINDOW w AS (PARTITION BY user_id, rule_id ORDER BY day))),
s AS (SELECT *, CASE WHEN coalesce(h, false) THEN row_number() OVER (PARTITION BY user_id, rule_id, g ORDER BY day) ELSE 0 END AS streak FROM g),
f AS (SELECT user_id, rule_id, CASE WHEN h IS NOT NULL THEN streak >= n END AS t, streak FROM s WHERE day = 20),
a AS (SELECT u.user_id, r.*, f.t, f.streak FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN rules r LEFT JOIN f ON f.user_id = u.user_id AND f.rule_id = r.rule_id)
SELECT user_id, test_id, CASE WHEN NOT bool_or(20 >= coalesce(since, 20)) THEN 'not_due' WHEN coalesce(bool_or(severity = 'fail' AND t), false) THEN 'fail' WHEN bool_or(severity = 'fail' AND t IS NULL) THEN 'undetermined' WHEN coalesce(bool_or(severity = 'warn' AND t), false) THEN 'warn' ELSE 'pass' END AS outcome,
  coalesce(max(CASE WHEN severity = 'fail' THEN streak END), 0)::BIGINT AS streak FROM a GROUP BY ALL
""")
def rule_outcomes(t):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day")
    d = t.events.groupBy("user_id", day).agg(F.round(F.sum("value"), 4).alias("value"), F.count("*").cast("double").alias("n"))
    readings = d.unpivot(["user_id", "day"], ["value", "n"], "metric", "v")
    return R.evaluate(readings, t.spark.createDataFrame(_RULES, _RULE_COLUMNS), t.events, ["user_id"], "day", "v", 20)


@query("""
WITH d AS (SELECT user_id, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day, round(sum(value), 2) AS v FROM events GROUP BY ALL)
SELECT a.user_id, a.day, CASE WHEN count(b.v) = 4 THEN round(sum(b.v), 2) END AS sum_4, max(CASE WHEN o.v <> 0 THEN round(100 * (a.v - o.v) / abs(o.v), 3) END) AS change_7
FROM d a JOIN d b ON b.user_id = a.user_id AND b.day BETWEEN a.day - 3 AND a.day LEFT JOIN d o ON o.user_id = a.user_id AND o.day = a.day - 7 GROUP BY a.user_id, a.day
""")
def trailing_and_yearly(t):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day")
    d = t.events.groupBy("user_id", day).agg(F.round(F.sum("value"), 2).alias("v"))
    out = R.year_over_year(R.trailing(d, ["user_id"], "day", "v", 4, F.sum, "s"), ["user_id"], "day", "v", 7, "y")
    return out.select("user_id", "day", F.round("s", 2).alias("sum_4"), F.round("y", 3).alias("change_7"))


@query("""
WITH r AS (SELECT user_id AS k, max(date_diff('day', DATE '2024-01-01', ts::DATE)) AS last FROM events WHERE event_type = 'signup' GROUP BY 1), u AS (SELECT DISTINCT user_id AS k FROM events)
SELECT u.k, last::INT AS last, last IS NULL OR 30 - last > 8 AS stale FROM u LEFT JOIN r USING (k)
""")
def stale_reviews(t):
    day = F.when(F.col("event_type") == "signup", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    return R.stale(t.events.select(F.col("user_id").alias("k"), day.alias("d")), ["k"], "d", 30, 8)


_NUMBERS = "SELECT l_orderkey, l_linenumber, l_quantity AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS k FROM lineitem"


@query(f"""
WITH x AS ({_NUMBERS}), p AS (SELECT f.l_orderkey, f.l_linenumber, f.k, f.v, a.v AS a, b.v AS b, a.k AS i, b.k AS j FROM x f JOIN x a ON a.l_orderkey = f.l_orderkey JOIN x b ON b.l_orderkey = f.l_orderkey AND a.k <> b.k
  WHERE f.v >= 10 AND a.v <> 0 AND b.v <> 0 AND abs(a.v - f.v) > 0.5 + 1e-9 AND abs(b.v - f.v) > 0.5 + 1e-9),
o AS (SELECT *, CASE WHEN least(a, b) >= 10 AND abs(v - (a + b)) <= 0.5 + 1e-9 THEN '+' WHEN least(a, b) >= 10 AND abs(v - abs(a - b)) <= 0.5 + 1e-9 THEN '-' WHEN abs(v - a * b) <= 0.5 + 1e-9 THEN '*' WHEN abs(v - a / b) <= 0.5 + 1e-9 THEN '/'
  WHEN abs(v - 100 * a / b) <= 0.5 + 1e-9 THEN '/ %' WHEN abs(v - abs(100 * (a - b) / b)) <= 0.5 + 1e-9 THEN 'growth %' WHEN abs(v - a * b / 100) <= 0.5 + 1e-9 THEN '* %' END AS op FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, k ORDER BY i, j) AS n FROM o WHERE op IS NOT NULL)
SELECT x.l_orderkey, x.l_linenumber, r.op, r.a, r.b FROM x LEFT JOIN r ON r.l_orderkey = x.l_orderkey AND r.k = x.k AND n = 1
""")
def recomputed_figures(t):
    pool = t.lineitem.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda x: x["l_quantity"]).alias("pool"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("v"), F.lit(0).alias("d")).join(pool, "l_orderkey")
    return rows.withColumn("r", C.recompute(rows, "v", "d", "pool")).select("l_orderkey", "l_linenumber", "r.op", "r.a", "r.b")


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, l_extendedprice AS e, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS k FROM lineitem),
w AS (SELECT l_orderkey, e, row_number() OVER (PARTITION BY l_orderkey ORDER BY e) AS k FROM (SELECT DISTINCT l_orderkey, round(e / 100, 0) AS e FROM x) d WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.l_orderkey = d.l_orderkey AND x.v = d.e)),
p AS (SELECT l_orderkey, v, k, true AS own FROM x UNION ALL SELECT l_orderkey, e, 1000 + k, false FROM w WHERE k <= 5
  UNION ALL SELECT o_orderkey, round(o_totalprice / 1000, 0), 2000, EXISTS (SELECT 1 FROM x WHERE x.l_orderkey = o_orderkey AND x.v = round(o_totalprice / 1000, 0)) FROM orders UNION ALL SELECT o_orderkey, 365, 2001, false FROM orders),
q AS (SELECT f.l_orderkey, f.k, f.v, a.v AS a, b.v AS b, a.k AS i, b.k AS j FROM x f JOIN p a ON a.l_orderkey = f.l_orderkey JOIN p b ON b.l_orderkey = f.l_orderkey AND a.k <> b.k
  WHERE f.v >= 10 AND (a.own OR b.own) AND a.v <> 0 AND b.v <> 0 AND abs(a.v - f.v) > 0.5 + 1e-9 AND abs(b.v - f.v) > 0.5 + 1e-9),
o AS (SELECT *, CASE WHEN least(a, b) >= 10 AND abs(v - (a + b)) <= 0.5 + 1e-9 THEN '+' WHEN least(a, b) >= 10 AND abs(v - abs(a - b)) <= 0.5 + 1e-9 THEN '-' WHEN abs(v - a * b) <= 0.5 + 1e-9 THEN '*' WHEN abs(v - a / b) <= 0.5 + 1e-9 THEN '/'
  WHEN abs(v - 100 * a / b) <= 0.5 + 1e-9 THEN '/ %' WHEN abs(v - abs(100 * (a - b) / b)) <= 0.5 + 1e-9 THEN 'growth %' WHEN abs(v - a * b / 100) <= 0.5 + 1e-9 THEN '* %' END AS op FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, k ORDER BY i, j) AS n FROM o WHERE op IS NOT NULL)
SELECT x.l_orderkey, x.l_linenumber, r.op, r.a, r.b FROM x LEFT JOIN r ON r.l_orderkey = x.l_orderkey AND r.k = x.k AND n = 1
""")
def recomputed_at_full_width(t):
    """An order's quantities recomputed from each other, from its prices in hundreds (five at most), its total and the days of a year."""
    quantities = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda x: x["l_quantity"].cast("double"))
    pool = t.lineitem.groupBy("l_orderkey").agg(quantities.alias("pool"), F.array_sort(F.collect_set(F.round(F.col("l_extendedprice") / 100, 0))).alias("wider"))
    keys = t.orders.select("o_orderkey", F.array(F.round(F.col("o_totalprice") / 1000, 0), F.lit(365.0)).alias("keys"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("v"), F.lit(0).alias("d")).join(pool, "l_orderkey").join(keys, F.expr("o_orderkey = l_orderkey"))
    return rows.withColumn("r", C.recompute(rows, "v", "d", "pool", 5, "wider", "keys")).select("l_orderkey", "l_linenumber", "r.op", "r.a", "r.b")


@query("""
WITH f AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 0) AS v FROM orders), s AS (SELECT o_custkey, l_extendedprice AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderkey, coalesce(bool_or(abs(v - n) <= 0.5 + 1e-9), false) AS found, coalesce(bool_or(abs(v + 1 - n) <= 0.5 + 1e-9 OR abs(v - 1 - n) <= 0.5 + 1e-9), false) AS slips FROM f LEFT JOIN s ON s.o_custkey = f.o_custkey AND n BETWEEN v - 3 AND v + 3 GROUP BY o_orderkey
""")
def singled_out_figures(t):
    figures = t.orders.select("o_orderkey", "o_custkey", F.round("o_totalprice", 0).alias("v"), F.lit(0).alias("d"))
    numbers = t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey")).select("o_custkey", F.col("l_extendedprice").alias("n"))
    return C.singled_out(figures, numbers, ["o_custkey"], "o_orderkey", "v", "d", "n")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'debtor' WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.09) THEN 'discount' ELSE 'unverified' END AS class FROM orders
""")
def cascade_of_classes(t):
    o = t.orders
    debtor = o.join(t.customer.where("c_acctbal < 0"), F.expr("c_custkey = o_custkey"), "left_semi")
    cheap = t.lineitem.where("l_discount >= 0.09").select(F.col("l_orderkey").alias("o_orderkey"))
    return C.classify(o, "o_orderkey", [("large", o.where("o_totalprice > 400000")), ("debtor", debtor), ("discount", cheap)]).select("o_orderkey", "class")


@query("""
WITH x AS (SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem), c AS (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'A') AS accepted, count(*) FILTER (WHERE l_returnflag = 'R') AS blocked, count(*) AS n FROM x GROUP BY 1)
SELECT l_suppkey, accepted, blocked, n - accepted - blocked AS open, n - accepted - blocked = 0 AND blocked = 0 AS passed FROM c
""")
def review_gate(t):
    return C.gate(t.lineitem, ["l_suppkey"], "l_returnflag", ["a"], ["r"])


@query("""
WITH h AS (SELECT l_suppkey, l_partkey % 50 AS s, min(l_shipdate) AS a, max(l_shipdate) AS z, sum(l_extendedprice) AS v FROM lineitem GROUP BY ALL), c AS (SELECT l_partkey % 50 AS s, date_trunc('week', l_shipdate) AS d, max(l_extendedprice / l_quantity) AS p FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
m AS (SELECT x.*, c2.p AS pz FROM (SELECT h.*, c.p AS pa FROM h ASOF LEFT JOIN c ON h.s = c.s AND h.a >= c.d) x ASOF LEFT JOIN c c2 ON x.s = c2.s AND x.z >= c2.d),
k AS (SELECT l_suppkey, v, round_even(v * pz / pa, 0) AS marked FROM m)
SELECT l_suppkey, round(sum(v), 2) AS total, round(sum(CASE WHEN marked IS NOT NULL THEN v END), 2) AS marked_before, sum(marked) AS marked_value, round(sum(marked) - round(sum(CASE WHEN marked IS NOT NULL THEN v END), 2), 2) AS change,
  CASE WHEN round(sum(v), 2) <> 0 THEN round_even(coalesce(round(sum(CASE WHEN marked IS NOT NULL THEN v END), 2), 0) / round(sum(v), 2), 4) END AS coverage FROM k GROUP BY 1
""")
def marked_holdings(t):
    l = t.lineitem.withColumn("s", F.col("l_partkey") % 50)
    held = l.groupBy("l_suppkey", "s").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("z"), F.sum("l_extendedprice").alias("v"))
    closes = l.where("l_returnflag = 'A'").groupBy(F.col("s").alias("symbol"), F.date_trunc("week", "l_shipdate").alias("date")).agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("close"))
    return H.totals(H.mark(held, closes, "s", "a", "z", "v"), ["l_suppkey"], "v")


@query("""
WITH RECURSIVE n AS (SELECT conv_id * 1000 + turn AS k, CASE WHEN turn > 0 AND role = 'assistant' THEN conv_id * 1000 + turn - 1 END AS a, CASE WHEN turn > 1 AND length(text) > 80 THEN conv_id * 1000 + turn - 2 END AS b FROM conversations),
e AS (SELECT k, a AS x FROM n WHERE a IN (SELECT k FROM n) UNION ALL SELECT k, b FROM n WHERE b IN (SELECT k FROM n)),
d AS (SELECT k, 0 AS depth FROM n UNION SELECT e.k, d.depth + 1 FROM d JOIN e ON e.x = d.k)
SELECT k, max(depth)::INT AS depth FROM d GROUP BY k
""")
def derivation_depth(t):
    k = F.col("conv_id") * 1000 + F.col("turn")
    a = F.when((F.col("turn") > 0) & (F.col("role") == "assistant"), k - 1)
    b = F.when((F.col("turn") > 1) & (F.length("text") > 80), k - 2)
    facts = t.conversations.select(k.alias("k"), F.array_compact(F.array(a, b)).alias("inputs"))
    return X.depth(facts, "k", "inputs").select("k", "depth")


@query(r"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, i, k, substr(x, (k * 299 + 1)::BIGINT, 299) AS x, k = 0 AND regexp_matches(x, '^[A-M]') AS b FROM (SELECT *, unnest(range(greatest(1, (length(x) + 298) // 299))) AS k FROM l)),
r AS (SELECT doc_id, row_number() OVER w AS j, b, sum(length(x) + 1) OVER w AS t, count(*) OVER (PARTITION BY doc_id) AS n FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p AS (SELECT doc_id, 1::BIGINT AS s, 0::HUGEINT AS o, (SELECT max(j) FROM r WHERE r.doc_id = d.doc_id AND t <= 300) AS e FROM (SELECT DISTINCT doc_id FROM r) d
  UNION ALL SELECT doc_id, s, o, (SELECT max(j) FROM r WHERE r.doc_id = q.doc_id AND t - o <= 300) FROM (
    SELECT doc_id, s, (SELECT t FROM r WHERE r.doc_id = z.doc_id AND r.j = z.s - 1) AS o FROM (
      SELECT p.doc_id, coalesce((SELECT max(j) FROM r WHERE r.doc_id = p.doc_id AND b AND j > p.s AND j <= p.e + 1), p.e + 1) AS s FROM p WHERE p.e < (SELECT max(j) FROM r WHERE r.doc_id = p.doc_id)) z) q),
f AS (SELECT doc_id, s, o, lead(o) OVER (PARTITION BY doc_id ORDER BY s) AS u FROM p)
SELECT doc_id, count(*) AS pieces, max(coalesce(u, (SELECT max(t) FROM r WHERE r.doc_id = f.doc_id)) - o)::BIGINT AS largest, (SELECT max(t) FROM r WHERE r.doc_id = f.doc_id)::BIGINT AS total, max(coalesce(u, (SELECT max(t) FROM r WHERE r.doc_id = f.doc_id)) - o) <= 300 AS within FROM f GROUP BY doc_id
""")
def documents_cut_to_size(t):
    cut = t.documents.where("text is not null").select("doc_id", P.cut_long("text", 300, lambda x: x.rlike("^[A-M]")).alias("c"))
    sizes = F.transform("c", lambda x: x["size"].cast("long"))
    return cut.select("doc_id", F.size("c").cast("long").alias("pieces"), F.array_max(sizes).alias("largest"), F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b).alias("total"), (F.array_max(sizes) <= 300).alias("within"))
