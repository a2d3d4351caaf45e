"""Documents, units, printed values, requests and edits on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import requests as R
from ..functions import text as T
from ..functions import values as V
from ..functions.sizes import spread
from ..operators import documents as D
from ..operators import edits as E
from ..operators import holdings as H
from ..operators import units as U
from .registry import query

# ---------------------------------------------------------------- printed values


@query("""
WITH p AS (SELECT p_partkey, p_retailprice::DECIMAL(18,2) AS v, rtrim(rtrim(printf('%.2f', p_retailprice), '0'), '.') AS s, p_size AS n FROM part),
f AS (SELECT p_partkey, s, regexp_replace(reverse(regexp_replace(reverse(string_split(s, '.')[1]), '([0-9]{3})', '\\1,', 'g')), '^,', '') || CASE WHEN contains(s, '.') THEN '.' || string_split(s, '.')[2] ELSE '' END AS g FROM p),
a AS (SELECT p_partkey, unnest(CASE WHEN regexp_matches(s, '[.][0-9]$') THEN [g, s, g || '0', s || '0'] WHEN NOT contains(s, '.') AND s::DOUBLE < 1000 THEN [g, s, s || '.0'] ELSE [g, s] END) AS form FROM f)
SELECT DISTINCT p_partkey, form FROM a
""")
def printed_forms(t):
    return t.part.select("p_partkey", F.explode(V.value_forms("p_retailprice")).alias("form"))


@query("""
SELECT c_custkey, CASE WHEN v = 0 THEN [] WHEN v < 0 THEN ['(' || g || ')', '-' || g, '−' || g] ELSE [g] END AS forms FROM (SELECT c_custkey, trunc(c_acctbal / 1000) AS v, abs(trunc(c_acctbal / 1000))::INT::VARCHAR AS g FROM customer) WHERE abs(v) >= 1000 OR v = 0
UNION ALL SELECT c_custkey, CASE WHEN v < 0 THEN ['(' || g || ')', '(' || g || '.0)', '-' || g, '-' || g || '.0', '−' || g, '−' || g || '.0'] ELSE [g, g || '.0'] END FROM (SELECT c_custkey, trunc(c_acctbal / 1000) AS v, abs(trunc(c_acctbal / 1000))::INT::VARCHAR AS g FROM customer) WHERE abs(v) < 1000 AND v <> 0
""")
def forms_of_negatives(t):
    v = F.when(F.col("c_acctbal") < 0, F.ceil(F.col("c_acctbal") / 1000)).otherwise(F.floor(F.col("c_acctbal") / 1000))
    return t.customer.select("c_custkey", V.value_forms(v).alias("forms"))


@query("""
WITH d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[0-9.,]+'))) AS x FROM documents)
SELECT n, count(DISTINCT doc_id) AS docs FROM (SELECT DISTINCT p_size AS n FROM part) JOIN d ON rtrim(x, '.,') IN (n::VARCHAR, n::VARCHAR || '.0') GROUP BY n
""")
def sizes_stated_in_documents(t):
    sizes = t.part.select(F.col("p_size").alias("n")).distinct()
    return D.stated(sizes, "n", "n", None, t.documents, "text").groupBy("n").agg(F.count_distinct("doc_id").alias("docs"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%B ') || day(o_orderdate)::VARCHAR || strftime(o_orderdate, ', %Y') AS long, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders
""")
def dates_as_printed(t):
    f = V.date_forms("o_orderdate")
    return t.orders.select("o_orderkey", F.get(f, F.lit(0)).alias("long"), F.get(f, F.lit(1)).alias("iso"))


@query("""
WITH x AS (SELECT p_partkey, p_size AS a, p_size + (p_partkey % 7) - 2 AS b FROM part)
SELECT p_partkey, CASE WHEN a < b THEN [a || '% to ' || b || '%', a || ' to ' || b, a || '%-' || b || '%'] ELSE [] END AS forms FROM x WHERE b >= 0
""")
def ranges_as_printed(t):
    x = t.part.select("p_partkey", F.col("p_size").alias("a"), (F.col("p_size") + F.col("p_partkey") % 7 - 2).alias("b")).where("b >= 0")
    return x.select("p_partkey", V.range_forms(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"))).alias("forms"))


@query("""
SELECT l_orderkey, l_linenumber, round(l_extendedprice + 0.01, 2) AS up, CASE WHEN l_extendedprice >= 0.01 THEN round(l_extendedprice - 0.01, 2) END AS down FROM lineitem
""")
def slips_of_prices(t):
    s = V.slips(F.round("l_extendedprice", 2), F.lit(2))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.get(s, F.lit(0)), 2).alias("up"), F.round(F.get(s, F.lit(1)), 2).alias("down"))


@query(r"""
WITH w AS (SELECT item_id, unnest(string_split(CASE w WHEN 'opex' THEN 'operating expenses' WHEN 'roe' THEN 'return equity' WHEN 'nii' THEN 'interest income' WHEN 'cogs' THEN 'cost goods sold' WHEN 'arr' THEN 'annual recurring revenue' WHEN 'aum' THEN 'assets under management' ELSE w END, ' ')) AS w FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark)),
o AS (SELECT item_id, CASE WHEN regexp_matches(w, '...ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '(s|x|z|ch|sh)es$') THEN regexp_replace(w, 'es$', '') WHEN regexp_matches(w, '[^sui]s$') THEN regexp_replace(w, 's$', '') ELSE w END AS x FROM w WHERE length(w) >= 4 AND w NOT IN ('with', 'from', 'that', 'this')),
s AS (SELECT DISTINCT item_id, left(CASE x WHEN 'turnover' THEN 'revenue' WHEN 'taking' THEN 'revenue' WHEN 'outlay' THEN 'spending' WHEN 'staff' THEN 'employee' WHEN 'headcount' THEN 'employee' WHEN 'borrowing' THEN 'debt' ELSE x END, 7) AS stem FROM o)
SELECT stem, count(*) AS n FROM s GROUP BY stem
""")
def keywords_of_items(t):
    return t.benchmark.select("item_id", F.explode(V.keywords("text", ["with", "from", "that", "this"])).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents),
c AS (SELECT doc_id, i, x, sum((length(x) + 1) / 2.6::DOUBLE - length(regexp_replace(x, '[\x00-\x7F]', '', 'g')) / 2.6::DOUBLE + length(regexp_replace(x, '[\x00-\x7F]', '', 'g'))) OVER (PARTITION BY doc_id ORDER BY i) AS t FROM l)
SELECT doc_id, coalesce(count(*) FILTER (WHERE t <= 100), 0) AS lines FROM c GROUP BY doc_id
""")
def lines_within_a_budget(t):
    cut = V.cut_to_tokens("text", 100)
    return t.documents.where("text is not null").select("doc_id", F.when(cut == "", F.when(F.startswith("text", F.lit("\n")), 1).otherwise(0)).otherwise(F.size(F.split(cut, "\n"))).cast("long").alias("lines"))


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN ['Acme ' || s_suppkey || ' Holdings Inc.', 'Acme ' || s_suppkey, 'Acme'] ELSE ['Acme ' || s_suppkey, 'Acme'] END AS names FROM supplier
""")
def owner_names(t):
    name = F.concat(F.lit("Acme "), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, " Holdings Inc.").otherwise(""))
    return t.supplier.select("s_suppkey", V.owner_names(name).alias("names"))


@query("""
SELECT page_id, regexp_matches(lower(substr(ltrim(html), 1, 200)), '^(<!doctype html|<html|<head|<body)') AS html, false AS json FROM pages
""")
def content_validity(t):
    return t.pages.select("page_id", F.coalesce(V.looks_like_html("html"), F.lit(False)).alias("html"), V.is_json("html").alias("json"))


# ---------------------------------------------------------------- requests

@query("""
WITH x AS (SELECT p_partkey, p_size AS n FROM part)
SELECT p_partkey, 3 AS clauses, 'annual' || CASE WHEN n % 3 = 0 THEN '[risk_factors,financials]' ELSE '[]' END || ' release[2.02]' || ' current[' || (n % 9 + 1) || '.01]' AS asked, CASE WHEN n % 2 = 0 THEN 'Press releases of Delta''s board: no filing of the company' ELSE 'Transcripts of the call: spoken, not filed' END AS notes FROM x
""")
def requests_in_words(t):
    n = F.col("p_size")
    text = F.concat(F.lit("10-K of FY"), (n + 1990).cast("string"), F.when(n % 3 == 0, " (risk factors; notes)").otherwise(""), F.lit("; 8-K items 2.02 and "), (n % 9 + 1).cast("string"), F.lit(".01 on results"), F.when(n % 2 == 0, ". Press releases of Delta's board").otherwise(". Transcripts of the call"))
    c = spread(t.part.select("p_partkey", "p_size"), "p_partkey").select("p_partkey", F.posexplode(R.clauses(text)).alias("i", "c")).withColumn("r", R.requests("c", F.lit(False), F.array(F.lit("Acme"))))
    show = lambda q: F.concat(q["kind"], F.lit("["), F.array_join(F.concat(q["items"], q["sections"]), ","), F.lit("]"))
    each = c.select("p_partkey", "i", F.transform("r.requests", show).alias("asked"), "r.notes")
    listed = each.groupBy("p_partkey").agg(F.count("*").cast("int").alias("clauses"), F.array_sort(F.collect_list(F.struct("i", "asked", "notes"))).alias("l"))
    flat = lambda name, sep: F.array_join(F.flatten(F.transform("l", lambda x: x[name])), sep)
    return listed.select("p_partkey", "clauses", flat("asked", " ").alias("asked"), flat("notes", " ").alias("notes"))


# ---------------------------------------------------------------- files of filings


@query("""
WITH f AS (SELECT o_orderkey, o_custkey AS accession, CASE o_orderkey % 5 WHEN 0 THEN 'main' || o_custkey || '.htm' WHEN 1 THEN 'R' || o_orderkey || '.htm' WHEN 2 THEN 'q-ex99-' || (o_orderkey % 12 + 1) || '.htm' WHEN 3 THEN 'exhibit99.pdf' ELSE 'logo.gif' END AS name FROM orders)
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'primary' WHEN 1 THEN 'xbrl_viewer' WHEN 2 THEN 'exhibit' WHEN 3 THEN 'exhibit' ELSE 'other' END AS kind, CASE o_orderkey % 5 WHEN 2 THEN 'EX-99.' || (o_orderkey % 12 + 1) WHEN 3 THEN 'EX-99' END AS exhibit, CASE o_orderkey % 5 WHEN 2 THEN o_orderkey % 12 + 1 ELSE 0 END::INT AS "order" FROM f
""")
def filing_files(t):
    n = F.col("o_orderkey")
    name = F.when(n % 5 == 0, F.concat(F.lit("main"), F.col("o_custkey").cast("string"), F.lit(".htm"))).when(n % 5 == 1, F.concat(F.lit("R"), n.cast("string"), F.lit(".htm"))).when(n % 5 == 2, F.concat(F.lit("q-ex99-"), (n % 12 + 1).cast("string"), F.lit(".htm"))).when(n % 5 == 3, "exhibit99.pdf").otherwise("logo.gif")
    files = t.orders.select("o_orderkey", F.col("o_custkey").alias("accession"), name.alias("name"))
    filings = t.customer.select(F.col("c_custkey").alias("accession"), F.concat(F.lit("main"), F.col("c_custkey").cast("string"), F.lit(".htm")).alias("primary_document"))
    return D.filing_documents(files, filings, ["accession"]).select("o_orderkey", "kind", "exhibit", "order")


@query("""
WITH d AS (SELECT o_custkey AS accession, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'exhibit' WHEN o_orderpriority = '2-HIGH' THEN 'primary' ELSE 'other' END AS kind, o_orderkey % 7 AS ord FROM orders)
SELECT accession, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY accession ORDER BY CASE WHEN kind = 'exhibit' THEN 0 ELSE 1 END, ord, o_orderkey) AS k FROM d WHERE kind <> 'other') WHERE k = 1
""")
def release_documents(t):
    p = F.col("o_orderpriority")
    d = t.orders.select(F.col("o_custkey").alias("accession"), F.col("o_orderkey").alias("name"), F.when(p == "1-URGENT", "exhibit").when(p == "2-HIGH", "primary").otherwise("other").alias("kind"), (F.col("o_orderkey") % 7).alias("order"))
    return D.release_document(d, ["accession"]).select("accession", F.col("name").alias("o_orderkey"))


@query("""
WITH e AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders), d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'exhibit' WHEN l_returnflag = 'R' THEN 'primary' ELSE 'other' END AS kind FROM lineitem),
h AS (SELECT l_orderkey, bool_or(kind = 'exhibit') AS x FROM d GROUP BY 1)
SELECT o_orderkey, 'release' AS part, l_linenumber FROM e JOIN d ON l_orderkey = o_orderkey JOIN h USING (l_orderkey) WHERE kind = 'exhibit' OR (kind = 'primary' AND NOT x)
UNION ALL SELECT o_orderkey, 'closing', l_linenumber FROM e JOIN d ON l_orderkey = o_orderkey WHERE kind = 'primary' AND o_orderdate <= DATE '1996-01-01'
""")
def documents_of_events(t):
    flag = F.col("l_returnflag")
    docs = t.lineitem.select(F.col("l_orderkey").alias("accession"), "l_linenumber", F.when(flag == "A", "exhibit").when(flag == "R", "primary").otherwise("other").alias("kind"))
    events = t.orders.select(F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("period"), F.col("o_orderkey").alias("accession"), F.col("o_orderkey").alias("closing"), F.col("o_orderdate").cast("date").alias("closing_filed"))
    return D.event_documents(events, docs, F.lit("1996-01-01").cast("date")).select(F.col("period").alias("o_orderkey"), "part", "l_linenumber")


@query("""
SELECT l_partkey AS accession, list_sort(list(DISTINCT l_suppkey)) AS tests FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity > 40 GROUP BY l_partkey
""")
def documents_of_all_tests(t):
    request = F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))).alias("request")
    plans = t.lineitem.where("l_quantity > 40").select(F.col("l_suppkey").alias("test_id"), request)
    rows, _ = D.supplied(plans, t.lineitem.select(request, F.col("l_partkey").alias("accession")).distinct(), t.part.select(F.col("p_partkey").alias("accession")))
    return rows.select("accession", "tests")


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS a FROM orders WHERE o_orderpriority = '1-URGENT'), u AS (SELECT o_custkey, o_orderkey, 0 AS tier, a AS n FROM o WHERE a <= 1),
p AS (SELECT o_custkey, o_orderkey, 1 AS tier, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F'), q AS (SELECT * FROM p WHERE n <= 3),
r AS (SELECT o_custkey, o_orderkey, 2 AS tier, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders WHERE o_totalprice > 200000),
x AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderkey ORDER BY tier, n) AS k FROM (SELECT * FROM u UNION ALL SELECT * FROM q UNION ALL SELECT * FROM r))
SELECT o_custkey, o_orderkey, tier, row_number() OVER (PARTITION BY o_custkey ORDER BY tier, n)::INT AS place FROM x WHERE k = 1
""")
def selection_by_priority(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    tiers = [o.where("o_orderpriority = '1-URGENT'"), o.where("o_orderstatus = 'F'"), o.where("o_totalprice > 200000")]
    got = D.selection_in_order(tiers, "o_orderkey", ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], {0: 1, 1: 3})
    return got.select("o_custkey", "o_orderkey", "tier", "place")


# ---------------------------------------------------------------- parts and units of texts


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, i, unnest(list_filter(string_split(regexp_replace(x, '([.;!?])[ \t\r\n]+([A-Z("“$−-])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda y: trim(y) <> '')) AS unit FROM l WHERE trim(x, ' ') <> '' AND left(ltrim(x, ' '), 1) <> '|')
SELECT doc_id, i::INT AS line, count(*) AS n, sum(length(unit))::BIGINT AS chars FROM s GROUP BY ALL
""")
def sentences_of_documents(t):
    docs = t.documents.where("text is not null").select("doc_id", F.concat(F.lit("\n"), "text").alias("text"))  # no front matter
    units = U.markdown_units(docs, ["doc_id"], "text").where("kind = 'sentence'")
    return units.groupBy("doc_id", (F.col("line") - 1).alias("line")).agg(F.count("*").alias("n"), F.sum(F.length("unit")).alias("chars"))


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)
SELECT x.event_id, CASE WHEN max(b.i) IS NULL OR max(h.i) >= max(b.i) THEN max(h.i) END AS above FROM l x
LEFT JOIN l h ON h.user_id = x.user_id AND h.i < x.i AND h.i >= x.i - 3 AND h.event_type = 'purchase' LEFT JOIN l b ON b.user_id = x.user_id AND b.i < x.i AND b.i >= x.i - 3 AND b.event_type = 'error' GROUP BY x.event_id
""")
def nearest_heading_above(t):
    from pyspark.sql.window import Window

    lines = t.events.select("event_id", "user_id", "event_type", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).alias("i"))
    got = D.nearest_above(lines, ["user_id"], "i", F.when(F.col("event_type") == "purchase", F.col("i")), F.col("event_type") == "error", 3)
    return got.select("event_id", "above")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
SELECT doc_id, i::INT AS line FROM l WHERE regexp_matches(x, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]')
""")
def lines_in_cjk(t):
    return U.cjk_lines(t.documents, ["doc_id"], "text")


@query("""
WITH w AS (SELECT s_suppkey, unnest([1, 2, 3]) AS section FROM supplier), sp AS (SELECT ps.s_suppkey, ps.section, ps.start, ps.stop FROM (SELECT s_suppkey, 1 AS section, 1 AS start, 10 AS stop FROM supplier UNION ALL SELECT s_suppkey, 2, 8, 20 + s_suppkey % 3 FROM supplier UNION ALL SELECT s_suppkey, 3, 40, 50 FROM supplier WHERE s_suppkey % 4 <> 0) ps)
SELECT s_suppkey, 1 AS start, 99 AS "end", ['3'] AS missing FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT s_suppkey, 1, 20 + s_suppkey % 3, [] FROM supplier WHERE s_suppkey % 4 <> 0 UNION ALL SELECT s_suppkey, 40, 50, [] FROM supplier WHERE s_suppkey % 4 <> 0
""")
def sections_or_the_whole(t):
    s, n = t.supplier, F.col("s_suppkey")
    span = lambda name, start, end: F.struct(F.lit(name).alias("section"), start.alias("start"), end.alias("end")).cast("struct<section:string,start:int,end:int>")
    spans = s.select("s_suppkey", F.explode(F.array_compact(F.array(span("1", F.lit(1), F.lit(10)), span("2", F.lit(8), (20 + n % 3).cast("int")), F.when(n % 4 != 0, span("3", F.lit(40), F.lit(50)))))).alias("x")).select("s_suppkey", "x.*")
    wanted = s.select("s_suppkey", F.explode(F.array(*(F.lit(x) for x in "123"))).alias("section"))
    return D.sections_or_whole(spans, wanted, ["s_suppkey"], s.select("s_suppkey", F.lit(99).alias("lines"))).select("s_suppkey", F.col("start").cast("int"), F.col("end").cast("int"), "missing")


@query(r"""
WITH q AS (SELECT item_id, text FROM benchmark), v AS (SELECT item_id, item_id * 7 + 100 AS n FROM q)
SELECT item_id, item_id * 7 + 100 AS n, 'In all ' || (item_id * 7 + 100) || ' units of revenue were sold' AS excerpt, true AS found FROM q
""")
def excerpts_that_state_values(t):
    n = F.col("item_id") * 7 + 100
    values = t.benchmark.select("item_id", n.alias("n"), F.array(F.lit("revenue"), F.lit("units")).alias("words"))
    lines = F.array(F.concat(F.lit("There were "), n.cast("string"), F.lit(" units")), F.concat(F.lit("In all "), n.cast("string"), F.lit(" units of revenue were sold")), F.concat(F.lit("Not 1"), n.cast("string"), F.lit(" units of revenue")))
    s = t.benchmark.select(F.posexplode(lines).alias("line", "x")).withColumn("words_", V.keywords("x", []))
    return D.cut_excerpts(values, "item_id", "n", None, "words", s, ["line"], "x", "words_").join(values.select("item_id", "n"), "item_id").select("item_id", "n", "excerpt", "found")


# ---------------------------------------------------------------- edits


@query("""
SELECT s_suppkey, unnest([0, 1, 2]) AS place, unnest(['# head', chr(10) || 'new ' || s_suppkey || chr(10), 'b' || chr(10) || chr(10) || 'v2' || chr(10)]) AS body FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, unnest([0, 1, 2]), unnest(['# head', 'a', 'b']) FROM supplier WHERE s_suppkey % 2 = 1
""")
def patched_sections(t):
    docs = t.supplier.select("s_suppkey", F.lit("# head\n## 9. Risks\na\n## Version history\nb").alias("text"))
    even = t.supplier.where("s_suppkey % 2 = 0")
    changes = even.select("s_suppkey", F.lit("9").alias("section"), F.concat(F.lit("new "), F.col("s_suppkey").cast("string")).alias("body")).unionByName(even.select("s_suppkey", F.lit("version history").alias("section"), F.lit("v2").alias("body")))
    got, _ = E.patch_sections(E.sections_of(docs, ["s_suppkey"], "text"), ["s_suppkey"], changes)
    return got.select("s_suppkey", "place", "body")


@query("""
SELECT s_suppkey, '# head' || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE chr(10) || '## 9. Risks' || chr(10) || 'a' END || chr(10) || '## Other' || chr(10) || 'c' AS text FROM supplier
""")
def without_masked_sections(t):
    docs = t.supplier.select("s_suppkey", F.lit("# head\n## 9. Risks\na\n## Other\nc").alias("text"))
    left, _ = E.without_sections(E.sections_of(docs, ["s_suppkey"], "text"), ["s_suppkey"], t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("risks").alias("name")))
    return E.joined_sections(left, ["s_suppkey"])


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'sold 5 [src:A-1] units' ELSE 'sold 5 units' END AS text, CASE WHEN s_suppkey % 3 = 1 THEN 1 WHEN s_suppkey % 3 = 2 THEN 1 ELSE 0 END AS problems FROM supplier
""")
def tag_repairs(t):
    n = F.col("s_suppkey") % 3
    texts = t.supplier.select("s_suppkey", F.lit("sold 5 units").alias("text"))
    new = F.when(n == 0, "sold 5 [src:A-1]").when(n == 1, "sold 6 [src:A-1]").otherwise("s [src:A-1]")
    repairs = t.supplier.select("s_suppkey", F.lit(1).alias("n"), F.when(n == 2, "s").otherwise("sold 5").alias("find"), new.alias("replace"))
    return E.apply_tag_repairs(texts, ["s_suppkey"], "text", repairs).select("s_suppkey", "text", F.size("problems").alias("problems"))


@query("""
WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn % 3, turn) AS n FROM conversations),
m AS (SELECT a.conv_id, a.turn, a.n, b.n AS other FROM r a LEFT JOIN r b ON b.conv_id = a.conv_id AND b.turn = a.turn - 3)
SELECT conv_id, 'F' || n AS id, 'T' || turn AS old_id, 'see ' || CASE WHEN other IS NULL THEN 'T' || (turn - 3) ELSE 'F' || other END || ', not T999' AS text FROM m
""")
def findings_renumbered(t):
    c = t.conversations.select("conv_id", "turn", (F.col("turn") % 3).alias("slice"), F.concat(F.lit("T"), F.col("turn").cast("string")).alias("id"), F.concat(F.lit("see T"), (F.col("turn") - 3).cast("string"), F.lit(", not T999")).alias("text"))
    return E.merged_audits(c, ["conv_id"], "slice", "turn", "id", "F", "text").select("conv_id", "id", "old_id", "text")


@query("""
WITH a AS (SELECT c_custkey, c_nationkey::VARCHAR AS nation, c_mktsegment AS segment FROM customer), b AS (SELECT c_custkey, (c_nationkey % 20)::VARCHAR AS nation, CASE WHEN c_custkey % 4 = 0 THEN 'OTHER' ELSE c_mktsegment END AS segment FROM customer)
SELECT a.c_custkey, 'nation' AS field, a.nation AS "left", b.nation AS "right", 'left' AS takes FROM a JOIN b USING (c_custkey) WHERE a.nation <> b.nation
UNION ALL SELECT a.c_custkey, 'segment', a.segment, b.segment, CASE WHEN a.c_custkey % 8 = 0 THEN 'right' ELSE 'left' END FROM a JOIN b USING (c_custkey) WHERE a.segment <> b.segment
""")
def fields_aligned(t):
    k = F.col("c_custkey")
    a = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = t.customer.select("c_custkey", (F.col("c_nationkey") % 20).cast("string").alias("nation"), F.when(k % 4 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("segment"))
    votes = t.customer.select("c_custkey", F.explode(F.when(k % 8 == 0, F.array("c_mktsegment")).otherwise(F.array("c_mktsegment", F.lit("X")))).alias("value"))
    return E.aligned(a, b, ["c_custkey"], ["nation", "segment"], votes, "segment")


@query("""
SELECT s_suppkey, '---' || chr(10) || 'a: 1' || chr(10) || 'status: done' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || 'b: 2' ELSE '' END || chr(10) || '---' || chr(10) || 'body' AS text FROM supplier
""")
def front_matter_set(t):
    even = F.col("s_suppkey") % 2 == 0
    text = F.when(even, "---\na: 1\nstatus: new\nb: 2\n---\nbody").otherwise("---\na: 1\n---\nbody")
    return t.supplier.select("s_suppkey", E.set_front_matter(text, "status", F.concat(F.lit("done"), F.col("s_suppkey").cast("string"))).alias("text"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a=x b=' || event_type ELSE 'a=x' END AS f FROM events
""")
def fields_set_by_path(t):
    docs = t.events.select("event_id", F.create_map(F.lit("b"), F.lit("old"), F.lit("a"), F.lit("x")).alias("data"))
    changes = t.events.select("event_id", F.lit("b").alias("path"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("value"))
    got = E.set_fields(docs, ["event_id"], "data", changes)
    return got.select("event_id", F.array_join(F.transform(F.array_sort(F.map_entries("data")), lambda e: F.concat_ws("=", e["key"], e["value"])), " ").alias("f"))


@query("""
WITH x AS (SELECT o_orderkey, o_totalprice, round(o_totalprice * 0.5, 2) AS h, o_custkey % 3 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k = 0 THEN 'holds' WHEN k = 1 THEN 'loose' ELSE 'wrong' END AS status FROM x
""")
def stated_results(t):
    """Sums of two rounded numbers, stated as they are, within their rounding, and beyond it."""
    from ..functions import formula as M

    a, b = F.floor("o_totalprice") + 1000, F.floor(F.col("o_totalprice") / 2) + 1000
    k = F.col("o_custkey") % 3
    text = F.concat(a.cast("string"), F.lit(" + "), b.cast("string"))
    rows = t.orders.select("o_orderkey", text.alias("f"), (a + b + F.when(k == 0, 0.0).when(k == 1, 0.9).otherwise(2.0)).alias("r")).withColumn("b", M.bounds_of("f"))
    return rows.select("o_orderkey", M.written_status(F.col("b.value"), F.col("b.low"), F.col("b.high"), F.col("r"), F.lit(1)).alias("status"))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'holds' ELSE 'wrong' END AS status FROM orders
""")
def chains_of_formulas(t):
    from ..functions import formula as M

    price = F.format_string("%.2f", "o_totalprice")
    left = F.concat(price, F.lit(" × 2"))
    right = F.concat(F.format_string("%.1f", F.col("o_totalprice") + F.when(F.col("o_custkey") % 2 == 0, 0.0).otherwise(5.0)), F.lit(" × 2"))
    return t.orders.select("o_orderkey", M.chain_of(left, right).alias("status"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS a, l_tax AS b, l_discount AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, round(a - b + c, 2) AS total FROM x
""")
def totals_across_a_row(t):
    from ..functions import formula as M

    cells = F.array("l_extendedprice", "l_tax", "l_discount", F.lit(0.0))
    got = M.running_total(cells, F.array(*(F.lit(s) for s in ("P", "−", "+", "="))))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.get(got, F.lit(0))["total"], 2).alias("total"))


# ---------------------------------------------------------------- ownership documents

_XML_LINE = "<nonDerivativeTransaction><securityTitle><value>{0}</value></securityTitle><transactionDate><value>{1}</value></transactionDate><transactionCoding><transactionCode>S</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>{2}</value><footnoteId id=\"F{3}\"/></transactionShares></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>{4}</value></sharesOwnedFollowingTransaction></postTransactionAmounts></nonDerivativeTransaction>"


@query("""
WITH l AS (SELECT l_orderkey, l_returnflag AS security, l_quantity AS q, l_linenumber AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag) AS k FROM lineitem),
g AS (SELECT l_orderkey AS form, security, count(*) AS fills, sum(q)::DOUBLE AS shares, max_by(n * 10, k)::DOUBLE AS owned_after, list(CASE n % 3 WHEN 0 THEN 'Under a plan.' WHEN 1 THEN NULL ELSE 'By gift.' END ORDER BY k) AS f FROM l GROUP BY ALL)
SELECT form, 'transaction' AS kind, security, fills, shares, owned_after, CASE WHEN list_position(f, 'By gift.') IS NULL THEN CASE WHEN list_position(f, 'Under a plan.') IS NULL THEN '' ELSE 'Under a plan.' END WHEN list_position(f, 'Under a plan.') IS NULL THEN 'By gift.' WHEN list_position(f, 'By gift.') < list_position(f, 'Under a plan.') THEN 'By gift. Under a plan.' ELSE 'Under a plan. By gift.' END AS notes FROM g
UNION ALL SELECT o_orderkey, 'holding', 'H', 1, NULL, o_custkey::DOUBLE, '' FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def insiders_of_forms(t):
    """Every order as an ownership document in XML: its lines are sales with footnotes (one names a price), its customer a holding."""
    parts = _XML_LINE.replace("{", "\x00{").replace("}", "}\x00").split("\x00")

    def line(r):
        fields = {"{0}": r["l_returnflag"], "{1}": F.lit("2024-01-02"), "{2}": r["l_quantity"].cast("string"), "{3}": (r["l_linenumber"] % 3).cast("string"), "{4}": (r["l_linenumber"] * 10).cast("string")}
        return F.concat(*(fields[p] if p in fields else F.lit(p) for p in parts))

    # Lines are gathered as numbers and written out afterwards, so no texts are shuffled or held.
    deals = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag"))).alias("lines")).withColumn("deals", F.array_join(F.transform("lines", line), ""))
    held = F.concat(F.lit("<nonDerivativeHolding><securityTitle><value>H</value></securityTitle><postTransactionAmounts><sharesOwnedFollowingTransaction><value>"), F.col("o_custkey").cast("string"), F.lit("</value></sharesOwnedFollowingTransaction></postTransactionAmounts></nonDerivativeHolding>"))
    notes = '<footnotes><footnote id="F0">Under a plan.</footnote><footnote id="F1">Sold at $5 each.</footnote><footnote id="F2">By gift.</footnote></footnotes>'
    xml = F.concat(F.lit("<ownershipDocument><nonDerivativeTable>"), "deals", held, F.lit(f"</nonDerivativeTable>{notes}</ownershipDocument>"))
    forms = deals.join(t.orders, F.expr("o_orderkey = l_orderkey")).select(F.col("l_orderkey").alias("form"), F.from_xml(xml, H.OWNERSHIP, {"rowTag": "ownershipDocument"}).alias("d")).select("form", "d.*")
    rows = H.ownership_lines(forms, ["form"])
    return rows.select("form", "kind", "security", "fills", "shares", "owned_after", F.array_join("footnotes", " ").alias("notes"))
