"""Text functions, figures and formulas on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formula as M
from ..functions import mentions as N
from ..functions import text as T
from ..operators import checks as C
from ..operators import documents as D
from ..operators import filings as L
from .registry import query


@query(r"""SELECT doc_id, (floor((length(text) - length(regexp_replace(text, '[\x00-\x7F]', '', 'g'))) / 2.6::DOUBLE) + length(regexp_replace(text, '[\x00-\x7F]', '', 'g')))::BIGINT AS tokens FROM documents""")
def token_estimates(t):
    return t.documents.select("doc_id", T.estimate_tokens("text").alias("tokens"))


_BLOCK, _INLINE = "|".join(T.BLOCK_TAGS), "|".join(T.INLINE_TAGS)
_DECODED = "regexp_replace(t, '<[^>]*>', ' ', 'g')"
for _name, _plain in T.ENTITIES.items():  # the ampersand is the last of them
    _DECODED = f"replace({_DECODED}, '&{_name};', chr({ord(_plain)}))"
_VISIBLE = rf"""
a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script[ \t\r\n]*>', ' ', 'g'), '(?is)<style\b.*?</style[ \t\r\n]*>', ' ', 'g'), '(?is)<head\b.*?</head[ \t\r\n]*>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(t, '[ \t\n\x0B\f\r]+', ' ', 'g'), '(?i)</?(?:{_BLOCK})\b[^>]*>', chr(10), 'g'), '(?i)</?(?:{_INLINE})\b[^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, replace({_DECODED}, chr(160), ' ') AS t FROM b),
v AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\f\x0B]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM c)
"""


@query(f"WITH {_VISIBLE} SELECT page_id, text FROM v")
def visible_text(t):
    return t.pages.select("page_id", T.html_to_text("html").alias("text"))


@query(r"""
WITH m AS (SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '[ \t]+\n', chr(10), 'g'), '\n+$', ''), '[ \t]+$', '')) AS h FROM (SELECT doc_id, replace(text, chr(13), chr(10)) AS text FROM documents WHERE NOT contains(text, chr(13)) UNION ALL SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) FROM documents WHERE contains(text, chr(13))))
SELECT h, count(*) AS n, min(doc_id) AS doc_id FROM m GROUP BY h
""")
def content_hashes(t):
    return t.documents.where("text is not null").groupBy(T.content_hash("text").alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{4,}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN length(w) > 4 - 1 AND w LIKE '%s' AND length(w) >= 4 THEN substr(substr(w, 1, length(w) - 1), 1, 7) ELSE substr(w, 1, 7) END AS stem FROM (SELECT doc_id, unnest(ws) AS w FROM w) WHERE w NOT IN ('with', 'from', 'that', 'this', 'they'))
SELECT stem, count(*) AS n FROM s GROUP BY stem
""")
def stem_frequencies(t):
    stems = T.stems("text", ["with", "from", "that", "this", "they"])
    return t.documents.select("doc_id", F.explode(stems).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


# The statement a line makes about an order, and the figures read back from it.
_STATED = "concat('On ', strftime(o_orderdate, '%Y-%m-%d'), ' the FY1999Q', quarter(o_orderdate)::VARCHAR, ' total was $', printf('%.2f', o_totalprice), 'M, or (', printf('%.1f', o_custkey / 10), ')%, in 1998 after ', o_custkey::VARCHAR, ' points')"


@query(f"""
WITH s AS (SELECT o_orderkey, {_STATED} AS s, o_totalprice AS a, o_custkey / 10 AS b, o_custkey AS c FROM orders)
SELECT o_orderkey, unnest([1, 2, 3]) AS place, unnest([CAST(printf('%.2f', a) AS DOUBLE), -CAST(printf('%.1f', b) AS DOUBLE), c::DOUBLE]) AS value, unnest(['M', '%', 'pt']) AS unit, unnest([2, 1, 0]) AS decimals FROM s
""")
def figures_read_back(t):
    s = F.concat(F.lit("On "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" the FY1999Q"), F.quarter("o_orderdate").cast("string"), F.lit(" total was $"), F.format_string("%.2f", "o_totalprice"), F.lit("M, or ("), F.format_string("%.1f", F.col("o_custkey") / 10), F.lit(")%, in 1998 after "), F.col("o_custkey").cast("string"), F.lit(" points"))
    got = t.orders.select("o_orderkey", F.posexplode(T.figures(s)).alias("p", "f"))
    return got.select("o_orderkey", (F.col("p") + 1).alias("place"), "f.value", "f.unit", "f.decimals")


_Q = "[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+"
_WORD_UNITS = ", ".join(f"'{u}'" for u in T.UNITS if len(u) > 1)
_LEADS = ", ".join(f"'{w}'" for w in [*T.MONTHS, *T.REFERENCES])
_SHORT = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in T.UNITS.items()) + "}"


@query(rf"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(text, '\[src:[^\]]*\]', ' ', 'g'), '[ \t\r\n]+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
c AS (SELECT doc_id, i, w, regexp_replace(regexp_replace(w, '^[\["“‘'']+', ''), '[\],.;:!?"”’'']+$', '') AS core,
  lower(regexp_replace(regexp_replace(coalesce(ws[i + 1], ''), '^[\["“‘'']+', ''), '[\],.;:!?"”’'')]+$', '')) AS after, lower(regexp_replace(regexp_replace(regexp_replace(coalesce(ws[i - 1], ''), '^[\["“‘'']+', ''), '[\],.;:!?"”’'']+$', ''), '[.(]', '')) AS before FROM e WHERE regexp_matches(w, '[0-9]')),
p AS (SELECT *, regexp_matches(core, '^[$]?[(][$]?(?:{_Q})(?:[.][0-9]+)?[)](?:%|[xX×]|bps?|pp|pts?|bn|[MBKmbk])?$') AS neg, regexp_extract(core, '^[(]?([−-]?)[$]?((?:{_Q})(?:[.][0-9]+)?)(%|[xX×]|bps?|pp|pts?|bn|[MBKmbk])?[)]?$', ['s', 'n', 'u']) AS a, regexp_extract(core, '^[$]?[(][$]?((?:{_Q})(?:[.][0-9]+)?)[)](%|[xX×]|bps?|pp|pts?|bn|[MBKmbk])?$', ['n', 'u']) AS b FROM c),
n AS (SELECT *, CASE WHEN neg THEN b.n ELSE a.n END AS num, CASE WHEN neg THEN b.u ELSE a.u END AS own FROM p WHERE neg OR a.n <> ''),
u AS (SELECT *, CASE WHEN own <> '' THEN lower(own) WHEN regexp_matches(w, '[0-9)]$') AND after IN ({_WORD_UNITS}) THEN after ELSE '' END AS raw FROM n),
k AS (SELECT *, coalesce({_SHORT}[raw], raw) AS unit FROM u)
SELECT doc_id, core AS figure, CASE WHEN neg OR a.s <> '' THEN -1 ELSE 1 END * CAST(replace(num, ',', '') AS DOUBLE) AS value, unit, CASE WHEN contains(num, '.') THEN length(string_split(num, '.')[2]) ELSE 0 END::INT AS decimals, count(*) AS n
FROM k WHERE NOT (regexp_matches(num, '^(?:19|20)[0-9][0-9]$') AND unit = '' AND NOT contains(core, '$') AND NOT neg) AND NOT (before IN ({_LEADS}) AND unit = '' AND (before NOT IN ({", ".join(f"'{m}'" for m in T.MONTHS)}) OR regexp_matches(num, '^[0-9][0-9]?$')))
GROUP BY ALL
""")
def figures_of_documents(t):
    got = t.documents.where("text is not null").select("doc_id", F.explode(T.figures("text")).alias("f"))
    return got.select("doc_id", F.col("f.text").alias("figure"), "f.value", "f.unit", "f.decimals").groupBy("doc_id", "figure", "value", "unit", "decimals").agg(F.count("*").alias("n"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice AS e, CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS p, l_discount AS d, CASE WHEN l_tax > 0.06 THEN 1 ELSE 0 END AS off FROM lineitem),
s AS (SELECT *, round(q * p, 2) + off AS written FROM x)
SELECT l_orderkey, l_linenumber, CASE WHEN abs(q * p - CAST(printf('%.2f', written) AS DOUBLE)) <= 0.005 + 1e-9 THEN 'holds' WHEN abs(q * p - CAST(printf('%.2f', written) AS DOUBLE)) <= 0.015 THEN 'rounding' ELSE 'error' END AS status, count(*) AS n FROM s GROUP BY ALL
""")
def written_arithmetic(t):
    price = F.format_string("%.2f", "l_extendedprice")
    result = F.round(F.col("l_quantity") * price.cast("double"), 2) + F.when(F.col("l_tax") > 0.06, 1).otherwise(0)
    text = F.concat(F.lit("so "), F.format_string("%.0f", "l_quantity"), F.lit(" × $"), price, F.lit(" = $"), F.format_string("%.2f", result), F.lit(" in all"))
    said = t.lineitem.select("l_orderkey", "l_linenumber", F.explode(M.written(text)).alias("s")).select("l_orderkey", "l_linenumber", "s.*")
    judged = C.written_results(said.withColumn("computed", M.value_of(F.col("formula"))), "computed", "result", "decimals")
    return judged.groupBy("l_orderkey", "l_linenumber", "status").agg(F.count("*").alias("n"))


@query("""
SELECT c_custkey, lpad(c_custkey::VARCHAR, 10, '0') AS cik, lpad(c_custkey::VARCHAR, 10, '0') || '-' || lpad((c_nationkey % 100)::VARCHAR, 2, '0') || '-' || lpad((c_custkey % 1000000)::VARCHAR, 6, '0') AS accession, '10QA' AS form, 'FY2024Q' || (c_nationkey % 4 + 1) AS period FROM customer
""")
def identifiers(t):
    n = F.col("c_nationkey")
    raw = F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.lpad((n % 100).cast("string"), 2, "0"), F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0"))
    tag = T.parse_tag(F.concat(F.lit("ABC.B-10Q-FY2024Q"), (n % 4 + 1).cast("string")))
    return t.customer.select("c_custkey", T.normalize_cik(F.concat(F.lit("CIK"), F.col("c_custkey").cast("string"))).alias("cik"), T.normalize_accession(raw).alias("accession"), T.form_key(F.lit("10-Q/A")).alias("form"), tag["period"].alias("period"))


@query(r"""
WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
t AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}')) AS ws FROM benchmark),
w AS (SELECT item_id, unnest(ws) AS w FROM t), l AS (SELECT doc_id, i, unnest(list_distinct(regexp_extract_all(lower(line), '[a-z]{5,}'))) AS w FROM u),
h AS (SELECT item_id, doc_id, i, count(*) AS hits FROM w JOIN l USING (w) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY hits DESC, doc_id, i) AS k FROM h)
SELECT item_id, doc_id, i::INT AS line, hits FROM r WHERE k = 1
""")
def best_excerpts(t):
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{5,})"), F.lit(1)))
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "x")).select("doc_id", "line", F.explode(words(F.col("x"))).alias("w"))
    items = t.benchmark.select("item_id", F.explode(words(F.col("text"))).alias("w"))
    hits = lines.join(items, "w").groupBy("item_id", "doc_id", "line").agg(F.count("*").alias("hits"))
    return C.best_excerpt(hits, ["item_id"], [F.desc("hits"), "doc_id", "line"])


@query(r"""
WITH x AS (SELECT event_id, user_id, 'x ' || event_type || ' reports ' || CASE event_id % 4 WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'third' ELSE 'fourth' END || ' quarter 2024 results' AS s, event_type = 'error' AS notice, event_id % 4 + 1 AS q FROM events)
SELECT event_id, CASE WHEN notice THEN NULL ELSE q END::INT AS quarter, CASE WHEN notice THEN NULL ELSE 2024 END AS year FROM x
""")
def results_headlines(t):
    n = F.col("event_id") % 4
    word = F.when(n == 0, "first").when(n == 1, "second").when(n == 2, "third").otherwise("fourth")
    verb = F.when(F.col("event_type") == "error", " to report ").otherwise(" reports ")
    text = F.concat(F.lit("About us\nx "), F.col("event_type"), verb, word, F.lit(" quarter 2024 results\nmore"))
    h = L.results_headline(text)
    return t.events.select("event_id", h["quarter"].alias("quarter"), h["year"].alias("year"))


@query(r"""
SELECT doc_id, len(list_filter(string_split_regex(chr(10) || text, '\n# '), lambda x: true)) AS sections FROM documents WHERE text IS NOT NULL
""")
def markdown_sections(t):
    return t.documents.where("text is not null").select("doc_id", F.size(T.headings("text", 1)).cast("long").alias("sections"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
b AS (SELECT *, sum((trim(x) = '')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS b, CASE WHEN len(regexp_extract_all(x, '[A-Za-z]+@[a-z.]+')) > 0 THEN array_to_string(regexp_extract_all(x, '[A-Za-z]+@[a-z.]+'), ' ') END AS own FROM l)
SELECT doc_id, i::INT AS line, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id, b ORDER BY i ROWS UNBOUNDED PRECEDING), '') AS tags FROM b
""")
def tags_carried_forward(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "x"))
    tags = F.regexp_extract_all("x", F.lit("([A-Za-z]+@[a-z.]+)"), F.lit(1))
    return C.carried_tags(lines, ["doc_id"], "line", tags, F.trim("x") == "").select("doc_id", "line", F.array_join("tags", " ").alias("tags"))


@query(r"""
WITH v AS (SELECT p_size, CASE WHEN p_size % 2 = 0 THEN ['license', 'version', 'apache'] ELSE ['public', 'version', 'general'] END AS ws FROM (SELECT DISTINCT p_size FROM part)),
f AS (SELECT p_size, ws, unnest([CAST(p_size AS VARCHAR), p_size || '.0']) AS form FROM v),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, i, unnest(us) AS u, unnest(range(1, len(us) + 1)) AS j FROM (SELECT doc_id, i, string_split(regexp_replace(x, '([.;!?])[ \t\r\n]+([A-Z("“$−-])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS us FROM l)),
n AS (SELECT *, regexp_extract_all(lower(u), '[a-z]+') AS ws FROM s WHERE trim(u) <> '' AND regexp_matches(u, '[0-9]')),
m AS (SELECT p_size, f.ws AS asked, form, doc_id, i, j, u, len(list_intersect(f.ws, n.ws)) AS score, len(n.ws) AS words FROM f JOIN n ON regexp_matches(u, '(^|[^0-9.,])' || replace(form, '.', '[.]') || '($|[^0-9.,]|[.,]($|[^0-9]))')),
b AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY score < len(asked), -score, -words, doc_id, i, j, u, form) AS k FROM m WHERE score >= 1),
e AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY doc_id, i, j, u, form) AS k FROM m WHERE contains(form, '.') AND length(regexp_replace(form, '^0+|[.]', '', 'g')) >= 2)
SELECT v.p_size, coalesce(b.doc_id, e.doc_id) AS doc_id, coalesce(b.i, e.i)::INT AS line, coalesce(b.j, e.j)::INT AS place, sha256(CASE WHEN length(coalesce(b.u, e.u)) <= 400 THEN coalesce(b.u, e.u) END) AS short_excerpt, b.score::INT AS score,
  CASE WHEN b.p_size IS NOT NULL THEN 'ranked' WHEN e.p_size IS NOT NULL THEN 'first' ELSE 'none' END AS how
FROM v LEFT JOIN b ON b.p_size = v.p_size AND b.k = 1 LEFT JOIN e ON e.p_size = v.p_size AND e.k = 1
""")
def ranked_excerpts_of_documents(t):
    """Sizes of parts and the sentences of documents that state them best."""
    values = t.part.select("p_size").distinct().withColumn("words", F.when(F.col("p_size") % 2 == 0, F.array(*map(F.lit, ["license", "version", "apache"]))).otherwise(F.array(*map(F.lit, ["public", "version", "general"]))))
    lines = t.documents.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "x"))
    units = lines.select("doc_id", (F.col("i") + 1).alias("line"), F.posexplode(T.sentences("x")).alias("j", "unit")).where(F.col("unit").rlike("[0-9]"))
    units = units.select("doc_id", "line", (F.col("j") + 1).alias("place"), "unit", F.filter(F.split(F.lower("unit"), "[^a-z]+"), lambda w: w != "").alias("ws"))
    got = D.ranked_excerpts(values, "p_size", "p_size", None, "words", units, ["doc_id", "line", "place"], "unit", "ws")
    short = F.sha2(F.when(~F.col("excerpt").contains("…"), F.col("excerpt")), 256)
    return got.select("p_size", "doc_id", "line", "place", short.alias("short_excerpt"), "score", "how")


def _mentions_sql() -> str:
    listed = lambda ws: ", ".join("'" + w.replace("'", "''") + "'" for w in ws)
    return rf"""
WITH x AS (SELECT doc_id, string_split_regex(text || ' Items 2, 3 and ' || (doc_id % 40) || ' of May ' || (doc_id % 28 + 1) || ', ' || (1990 + doc_id % 30) || ': ' || doc_id || ' million (' || (doc_id % 9) || ')', '[ \t\r\n]+') AS ws FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, unnest(list_filter(ws, lambda x: x <> '')) AS w, unnest(range(len(list_filter(ws, lambda x: x <> '')))) AS i FROM x),
c AS (SELECT *, regexp_replace(regexp_replace(w, '^[\["“‘''(]+', ''), '[\]).,;:!?"”’'']+$', '') AS core FROM e),
t AS (SELECT *, CASE WHEN regexp_matches(core, '^[−+-]?[$]?(?:[0-9]{{1,3}}(?:,[0-9]{{3}})+|[0-9]+)(?:[.][0-9]+)?%?$') THEN CASE WHEN regexp_matches(w, '^[(\[][0-9]{{1,2}}[)\]]') THEN 'note' ELSE 'number' END WHEN lower(core) IN ({listed(T.MONTHS)}) THEN 'month'
  WHEN lower(core) IN ({listed(T.REFERENCES)}) THEN 'reference' WHEN lower(core) IN ({listed(N.CONNECTORS)}) OR core = '' THEN 'connector' WHEN lower(core) IN ({listed(u for u in T.UNITS if len(u) > 1)}) THEN 'unit' ELSE 'word' END AS k FROM c),
r AS (SELECT *, lag(k) OVER w AS pk, lead(k) OVER w AS nk, lead(lower(core)) OVER w AS nw, sum((k IN ('word', 'unit', 'month'))::INT) OVER w AS run FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT *, coalesce(bool_or(k = 'reference') OVER (PARTITION BY doc_id, run ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS referred FROM r),
m AS (SELECT doc_id, i, core, nk, nw, CASE WHEN k = 'note' THEN 'note' WHEN referred AND regexp_matches(core, '^[0-9]{{1,3}}$') THEN 'reference' WHEN pk = 'month' AND regexp_matches(core, '^[0-9]{{1,2}}$') THEN 'day' WHEN regexp_matches(core, '^(?:19|20)[0-9]{{2}}$') THEN 'year' ELSE 'value' END AS kind FROM s WHERE k IN ('number', 'note')),
n AS (SELECT doc_id, core AS form, CASE WHEN kind = 'value' AND nk = 'month' AND regexp_matches(core, '^[0-9]{{1,2}}$') THEN 'day' ELSE kind END AS kind, CASE WHEN kind = 'value' AND nk = 'unit' THEN nw END AS unit FROM m)
SELECT doc_id, form, kind, unit, count(*) AS n FROM n GROUP BY ALL
"""


@query(_mentions_sql())
def numbers_and_what_they_are(t):
    """The numbers of documents, behind which a line with references, a day, a year, an amount and a footnote mark is set."""
    n = F.col("doc_id")
    more = F.concat(F.lit(" Items 2, 3 and "), (n % 40).cast("string"), F.lit(" of May "), (n % 28 + 1).cast("string"), F.lit(", "), (n % 30 + 1990).cast("string"), F.lit(": "), n.cast("string"), F.lit(" million ("), (n % 9).cast("string"), F.lit(")"))
    found = t.documents.where("text is not null").select("doc_id", F.explode(N.mentions(F.concat("text", more))).alias("m"))
    return found.groupBy("doc_id", "m.form", "m.kind", "m.unit").agg(F.count("*").alias("n"))
