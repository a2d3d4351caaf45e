"""Dimensions, blind views, windows, proofs and resolved sources on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import filings as L
from ..operators import records as R
from ..operators import selection as S
from .registry import query


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name WHEN c_custkey % 3 = 0 THEN 'intake' ELSE c_phone END AS name, c_nationkey AS nation, CASE WHEN c_custkey % 2 = 0 THEN 'thesis' WHEN c_custkey % 3 = 0 THEN 'intake' ELSE 'submissions' END AS basis FROM (SELECT *, 'phone' AS c_phone FROM customer)
""")
def filer_dimension(t):
    k, c = F.col("c_custkey"), t.customer
    none = F.lit(None)
    theses = c.where(k % 2 == 0).select("c_custkey", F.col("c_name").alias("name"), none.cast(c.schema["c_nationkey"].dataType).alias("nation"))
    intake = c.where(k % 3 == 0).select("c_custkey", F.lit("intake").alias("name"), none.cast(c.schema["c_nationkey"].dataType).alias("nation"))
    return R.filers(theses, intake, c.select("c_custkey", F.lit("phone").alias("name"), F.col("c_nationkey").alias("nation")), "c_custkey", ["name", "nation"])


@query("SELECT l_partkey, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS l_suppkey, count(DISTINCT l_suppkey) AS issuers FROM lineitem GROUP BY l_partkey")
def issuers_that_are_unique(t):
    return R.unique_issuers(t.lineitem, "l_partkey", "l_suppkey")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN l_returnflag ELSE p_brand END AS d, CASE WHEN l_quantity > 25 THEN 'own' WHEN p_brand IS NOT NULL THEN 'registry' END AS basis FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey
""")
def definitions_that_hold(t):
    tests = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("metric"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("own"))
    registry = t.part.where("p_size > 10").select(F.col("p_partkey").alias("metric"), F.col("p_brand").alias("d"))
    return R.definitions(tests, registry, "metric", "own", "d").select("l_orderkey", "l_linenumber", "d", "basis")


@query("""
SELECT DISTINCT name, metric FROM (SELECT p_brand AS metric, unnest(CASE WHEN p_size % 2 = 0 THEN [p_brand || '.' || p_type_, p_brand || '.total'] ELSE [p_brand] END) AS name FROM (SELECT *, 's' || (p_size % 5) AS p_type_ FROM part))
""")
def names_of_metrics(t):
    parts = F.when(F.col("p_size") % 2 == 0, F.create_map(F.concat(F.lit("s"), (F.col("p_size") % 5).cast("string")), F.lit(1), F.lit("total"), F.lit(1)))
    return R.metric_parts(t.part.select(F.col("p_brand").alias("metric"), parts.alias("parts")), "metric", "parts")


@query("SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'met' WHEN 'O' THEN 'open' END AS settle_as FROM orders")
def blind_items(t):
    return R.blind(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_custkey"), ["o_totalprice", "o_custkey", "o_orderstatus"], {"F": "met", "O": "open"}, "o_orderstatus")


@query("SELECT s_suppkey, s_name || '/' || s_nationkey AS kept FROM supplier")
def without_a_nested_key(t):
    rows = t.supplier.select("s_suppkey", F.struct("s_name", "s_nationkey", F.struct("s_acctbal").alias("loss")).alias("x"))
    return R.without_nested(rows, "x", ["loss"]).select("s_suppkey", F.concat_ws("/", "x.s_name", F.col("x.s_nationkey").cast("string")).alias("kept"))


@query("SELECT event_id FROM events WHERE event_type = 'click' AND ts::DATE >= DATE '2024-01-05' AND ts::DATE <= DATE '2024-01-20'")
def artefacts_of_a_window(t):
    rows = t.events.select("event_id", F.col("event_type").alias("label"), F.to_date("ts").alias("day"))
    return R.artefacts(rows, "click", F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")).select("event_id")


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders), a AS (SELECT DISTINCT o_custkey, unnest(['A', 'N', 'R']) AS output FROM orders),
l AS (SELECT l_orderkey, l_returnflag, count(*) AS content FROM lineitem GROUP BY ALL)
SELECT a.o_custkey, output, content, CASE WHEN content IS NULL THEN 'not in the run' END AS reason FROM a JOIN r ON r.o_custkey = a.o_custkey AND k = 1 LEFT JOIN l ON l_orderkey = o_orderkey AND l_returnflag = output
""")
def outputs_of_latest_runs(t):
    runs = t.orders.select("o_custkey", F.col("o_orderkey").alias("run_id"), "o_orderdate")
    outputs = t.lineitem.groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("output")).agg(F.count("*").alias("content"))
    return R.latest_outputs(runs, outputs, ["o_custkey"], ["o_orderdate", "run_id"], ["A", "N", "R"]).select("o_custkey", "output", "content", "reason")


@query("SELECT event_id FROM events WHERE sha256(user_id::VARCHAR) = sha256('7')")
def own_log_lines(t):
    log = t.events.select("event_id", F.sha2(F.col("user_id").cast("string"), 256).alias("input"))
    return R.own_log(log, "input", F.sha2(F.lit("7"), 256)).select("event_id")


@query("""
WITH s AS (SELECT o_orderkey, unnest(['text', 'settle', 'audit']) AS stage FROM orders)
SELECT o_orderkey, stage, CASE WHEN stage = 'text' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') THEN 'no text metrics' WHEN stage = 'settle' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) THEN 'nothing to settle' END AS skip_reason FROM s
""")
def stages_that_are_skipped(t):
    stages = t.orders.select("o_orderkey", F.explode(F.array(*(F.lit(x) for x in ("text", "settle", "audit")))).alias("stage"))
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return R.skip_reasons(stages, [("text", lines.where("l_returnflag = 'A'"), ["o_orderkey"], "no text metrics"), ("settle", lines.where("l_quantity > 45"), ["o_orderkey"], "nothing to settle")])


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderdate::DATE BETWEEN DATE '1993-01-01' AND DATE '1996-12-31' THEN 'PASS' WHEN o_orderstatus <> 'F' AND o_orderdate::DATE <= DATE '1996-12-31' THEN 'PENDING' ELSE 'FAIL' END AS state FROM orders
""")
def acceptance_in_a_window(t):
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", R.in_window(day, F.lit("1993-01-01").cast("date"), F.lit("1996-12-31").cast("date"), F.col("o_orderstatus") == "F", day).alias("state"))


@query("""
WITH r AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS record, bool_or(o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
SELECT c_custkey, record FROM customer LEFT JOIN r ON o_custkey = c_custkey WHERE f IS NULL OR NOT f
""")
def records_not_final(t):
    records = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "final").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("version"))
    return R.unfinished(records, t.customer, ["c_custkey"])


@query("SELECT url FROM (SELECT url, regexp_extract(url, '([^/]*)$', 1) AS n FROM pages) WHERE n IN ('25#top', 'index') OR n LIKE '%.md' OR n LIKE '%1.md'")
def writes_to_the_archive(t):
    return R.archive_documents(t.pages.select("url"), "url", ["25#top", "index"])


@query("""
WITH c AS (SELECT l_orderkey, min(l_shipdate::DATE) AS a, max(l_shipdate::DATE) AS b FROM lineitem GROUP BY 1), o AS (SELECT o_custkey, o_orderpriority AS kind, o_orderdate::DATE + 30 AS deadline, min(a) AS first, max(b) AS last FROM orders LEFT JOIN c ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT *, coalesce(first < deadline, false) AS in_time, coalesce(last < deadline, false) AS unchanged FROM o
""")
def merges_before_deadlines(t):
    files = t.orders.select("o_custkey", F.col("o_orderkey").alias("path"), F.col("o_orderpriority").alias("kind"), F.date_add(F.to_date("o_orderdate"), 30).alias("deadline"))
    commits = t.lineitem.select(F.col("l_orderkey").alias("path"), F.to_date("l_shipdate").alias("merged_at"))
    return R.merged_in_time(files, commits, ["o_custkey"], "deadline")


@query("""
WITH e AS (SELECT o_custkey AS company, o_orderkey AS tag, 0 AS priority FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderstatus = 'O')
SELECT company AS reader, tag, priority, NULL::INT AS unit FROM e UNION ALL SELECT reader, tag, priority, unit FROM e JOIN (SELECT DISTINCT s_suppkey::INT AS unit, s_suppkey AS company, s_suppkey % 7 + 1 AS reader FROM supplier) USING (company) WHERE company <> reader
""")
def evidence_by_priority(t):
    rows = t.orders.select(F.col("o_custkey").alias("company"), F.col("o_orderkey").alias("tag"), F.lit("").alias("text"), "o_orderstatus")
    mentions = t.supplier.select((F.col("s_suppkey") % 7 + 1).alias("reader"), F.col("s_suppkey").cast("int").alias("unit"), F.col("s_suppkey").alias("company"))
    return R.evidence([rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), rows.where("o_orderstatus = 'O'").drop("o_orderstatus")], mentions).select("reader", "tag", "priority", "unit")


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'error' WHEN 2 THEN 'attested' WHEN 3 THEN 'pending' ELSE 'error' END AS state, CASE p_size % 5 WHEN 2 THEN 800000 + p_size END AS block FROM part
""")
def states_of_proofs(t):
    n = F.col("p_size")
    said = F.when(n % 5 == 0, None).when(n % 5 == 2, F.concat(F.lit("BlockHeaderAttestation(900000) BlockHeaderAttestation("), (n + 800000).cast("string"), F.lit(")"))).when(n % 5 == 4, "nothing").otherwise("PendingAttestation('https://a')")
    digest = F.when(n % 5 == 1, "bb").otherwise("AA")
    return R.proof_state(t.part.select("p_partkey", F.lit("aa").alias("want"), digest.alias("have"), said.alias("said")), "p_partkey", "want", "have", "said").withColumn("block", F.col("block").cast("int"))


@query("""
SELECT o_custkey, unnest(range(len(l)))::INT AS place, unnest(l) AS id FROM (SELECT o_custkey, list('F' || o_orderkey ORDER BY o_orderkey) AS l FROM orders GROUP BY 1)
""")
def ids_of_listed_facts(t):
    each = F.concat(F.lit('{"id":"F'), F.col("o_orderkey").cast("string"), F.lit('"}'))
    listed = t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", each.alias("t")))), lambda x: x["t"]), ",").alias("l"))
    whole = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit('{"facts":['), "l", F.lit("]}"))).otherwise(F.concat(F.lit("["), "l", F.lit("]")))
    return R.listed_ids(listed.select("o_custkey", F.parse_json(whole).alias("d")), "o_custkey", "d")


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'price' WHEN 1 THEN 'report' ELSE 'filing' END AS kind, CASE p_size % 4 WHEN 0 THEN p_retailprice END AS value, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 'no provider' WHEN 2 THEN NULL ELSE 'not known' END AS missing FROM part
""")
def sources_resolved(t):
    n = F.col("p_size") % 4
    tag = F.concat_ws("-", F.lit("ABC"), F.when(n == 0, "PX").when(n == 1, "RPT").otherwise("10K"), F.col("p_partkey").cast("string"))
    rows = t.part.select("p_partkey", tag.alias("tag"), n.alias("n"), "p_retailprice")
    prices = rows.where("n = 0").select("tag", F.lit(None).cast("string").alias("text"), F.col("p_retailprice").cast("double").alias("value"))
    filings = rows.where("n = 2").select("tag", F.lit("words").alias("text"), F.lit(None).cast("double").alias("value"))
    got = R.resolved(rows, "tag", {"price": prices, "filing": filings})
    return rows.join(got.select("tag", "kind", "value", "missing"), "tag").select("p_partkey", "kind", "value", "missing")


@query("""
SELECT DISTINCT l_orderkey, v, l_returnflag FROM (SELECT l_orderkey, l_quantity::DOUBLE AS v, l_returnflag FROM lineitem UNION ALL SELECT l_orderkey, l_quantity::DOUBLE / 1e6, l_returnflag FROM lineitem WHERE l_returnflag = 'A')
""")
def values_of_one_filing(t):
    facts = t.lineitem.select("l_orderkey", F.col("l_quantity").cast("double").alias("v"), F.when(F.col("l_returnflag") == "A", "USD").otherwise(F.col("l_returnflag")).alias("unit"))
    return R.accession_values(facts, "l_orderkey", "v", "unit").select("l_orderkey", "v", F.when(F.col("unit") == "USD", "A").otherwise(F.col("unit")).alias("l_returnflag"))


@query("SELECT o_custkey::VARCHAR AS company, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey DESC)::INT AS place FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate::DATE <= DATE '1999-01-01' QUALIFY place <= 3")
def filings_of_an_assembly(t):
    f = t.orders.select(F.col("o_custkey").cast("string").alias("company"), F.col("o_orderpriority").alias("form"), F.to_date("o_orderdate").alias("filing_date"), F.col("o_orderkey").alias("accession"))
    return R.assembled(f, "pressing", F.lit("1999-01-01").cast("date"), assemblies={"pressing": (["1-URGENT", "2-HIGH"], 3)}).select("company", F.col("accession").alias("o_orderkey"), "place")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'open' WHEN o_orderstatus = 'F' AND o_custkey % 2 = 0 THEN 'warned' WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS state FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def figures_of_planned_writes(t):
    figures = t.orders.select(F.col("o_orderkey").alias("figure"), F.col("o_custkey").alias("path"))
    verdicts = t.orders.where("o_totalprice >= 50000").select(F.col("o_orderkey").alias("figure"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("verdict"), F.when(F.col("o_custkey") % 2 != 0, "by its source").alias("how"))
    planned = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("path"))
    return R.gate_planned(figures, verdicts, planned, "path", "figure").select(F.col("figure").alias("o_orderkey"), "state")


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'unknown metric' WHEN p_size % 5 = 1 THEN 'no quarter' WHEN p_size % 5 = 2 THEN 'no number' WHEN p_size % 5 = 3 THEN 'no source' END AS reason FROM part WHERE p_size % 5 <> 4
""")
def readings_not_used(t):
    n = F.col("p_size") % 5
    rows = t.part.select("p_partkey", F.when(n == 0, "x").otherwise("m").alias("metric"), F.when(n == 1, "FY2024").otherwise("FY2024Q1").alias("period"), F.when(n == 2, "many").otherwise("(1,234.5)%").alias("value"), F.when(n == 3, "").otherwise("A-10K").alias("source"))
    _, bad = R.readings(rows, F.lit("r1"), t.region.select(F.lit("m").alias("metric")))
    return bad.select("p_partkey", "reason")


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) - 7200000000 WHEN event_id % 3 = 1 THEN epoch_us(date_trunc('second', ts)) END AS micros FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)
""")
def moments_with_a_zone(t):
    n, s = F.col("event_id") % 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(n == 0, F.concat(s, F.lit("+02:00"))).when(n == 1, F.concat(s, F.lit("Z"))).otherwise(s)
    return t.events.select("event_id", F.unix_micros(V.zoned_timestamp(text)).alias("micros"))


# ---------------------------------------------------------------- issuers' filings, which had pytest cases only


@query("""
WITH w AS (SELECT o_custkey, o_orderpriority AS form, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey::VARCHAR DESC) AS k FROM orders)
SELECT o_custkey AS cik, CASE WHEN bool_or(form = '1-URGENT') THEN 'domestic' WHEN bool_or(form = '2-HIGH') THEN 'foreign' ELSE 'domestic' END AS filer_type FROM w WHERE k <= 5 GROUP BY 1
""")
def filer_types(t):
    form = F.when(F.col("o_orderpriority") == "1-URGENT", "10-K").when(F.col("o_orderpriority") == "2-HIGH", "20-F").otherwise("8-K")
    f = t.orders.select(F.col("o_custkey").alias("cik"), form.alias("form"), F.to_date("o_orderdate").alias("filing_date"), F.col("o_orderkey").cast("string").alias("accession"))
    return L.filer_type(f, 5)


@query("""
WITH i AS (SELECT c_custkey, c_nationkey FROM customer), q AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT c_custkey, o_orderkey FROM i JOIN q ON o_custkey = c_custkey WHERE d BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)
""")
def releases_coming_up(t):
    quarters = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("period"), F.to_date("o_orderdate").alias("d"))
    released = t.lineitem.where("l_quantity > 48").join(t.orders, F.expr("o_orderkey = l_orderkey")).select(F.col("o_custkey").alias("c_custkey"), F.col("l_orderkey").alias("period"))
    day = lambda x: F.lit(x).cast("date")
    return S.upcoming(t.customer.select("c_custkey"), quarters, released, "c_custkey", "d", day("1995-01-01"), day("1995-12-31")).select("c_custkey", F.col("period").alias("o_orderkey"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS n FROM lineitem
""")
def numbers_as_people_write_them(t):
    v = F.format_number("l_extendedprice", 2)
    text = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("($"), v, F.lit(")"))).otherwise(F.concat(F.lit("$"), v))
    return t.lineitem.select("l_orderkey", "l_linenumber", T.parse_number(text).alias("n"))
