"""Document fingerprints by I-Match over randomised lexica, in DataFrame and SQL functions only.

Terms are lower-cased words (A-Z only, between white space). The lexicon is a band of inverse document frequency: terms that
at least N**low and at most N**high of N documents hold, which leaves out what tells nothing and what is a slip. SUBSETS
random lexica are nested by level: a term is in lexicon i at level j if the i-th 16 bits of its md5 lie below 2**(16 - j).
A text of m distinct terms uses the levels L, L + 1 and L + 2 with m / 2**L between 1 and 2, so every subset keeps a term or
two of texts of any length; L is 13 at most, so texts of more than 16,384 distinct terms keep more. A signature is the hash of the kept terms, distinct and sorted; a fingerprint has those that aren't
empty, as level.subset.signature. A text without terms in any subset has one signature of all its distinct sorted terms.
Likeness is the share of equal signatures among the subsets of the levels that two fingerprints have in common, where either
has one; equal fingerprints have 1.

The next document (descending id) stands in the same block of a range of ids, or is the block's guest: the largest id of
the block before it is sent to both, the largest of all to the first. So texts are shuffled once. Only terms that may be in a
subset of their text leave it, some 8 to 16; what the band leaves of them meets by row.

Defined results: null texts are empty; a text without words has an empty fingerprint; rows with one id have the same next
document, of whose texts the one with the least hash counts; a row without an id has no next document (nothing replaces
what goes, near_next is null), and is nobody's; one document alone is its own next; an empty table gives no rows. Other
columns may have any names. Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SUBSETS, LEVELS, LOW, HIGH = 8, 3, 0.1, 0.9
BROADCAST = 1 << 18  # terms of a lexicon that is sent to all tasks; larger ones are joined by shuffling
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCKS = 16  # for each shuffle partition, so that the partitions' shares are alike
DEEPEST = 13
ANY = " or ".join(f"substr(x.s, {4 * i + 1}, 4) < %s" for i in range(SUBSETS))


def terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.translate(text, CAPITALS, CAPITALS.lower()), r"[\x20\x09-\x0D]+")), "")


def level(words: str) -> str:
    """The first of the levels of a text with these distinct terms."""
    return f"least(length(bin(size({words}))) - 1, {DEEPEST})"


def below(level: str) -> str:
    """What the 4 hex digits of a term in a lexicon of that level lie below, as text."""
    return f"if({level} = 0, 'g', lpad(hex(shiftleft(1L, 16 - {level})), 4, '0'))"


def picked(words: str, least: str) -> str:
    """The terms that are in any lexicon of a level."""
    return f"transform(filter(transform({words}, w -> struct(w, md5(w) as s)), x -> {ANY.replace('%s', least)}), x -> x.w)"


def subsets(hashed: str, bounds: str) -> str:
    """For each random lexicon the kept terms, with their hashes, that it holds at the text's first level."""
    return f"transform(sequence(0, {SUBSETS - 1}), i -> filter({hashed}, x -> substr(x.s, 4 * i + 1, 4) < {bounds}[0]))"


def signatures(subsets: str, first: str, bounds: str) -> str:
    """The signatures of a text by its subsets, its first level, and what hashes lie below at its levels. Deeper levels are nested."""
    own = f"transform(filter(t, x -> substr(x.s, 4 * i + 1, 4) < {bounds}[j]), x -> x.w)"
    each = f"flatten(transform(sequence(0, {LEVELS - 1}), j -> transform({subsets}, (t, i) -> struct({first} + j as l, i as i, {own} as t))))"
    return f"transform(filter({each}, y -> size(y.t) > 0), y -> concat(y.l, '.', y.i, '.', substr(md5(array_join(sort_array(y.t), ' ')), 1, 8)))"


def likeness(a: str, b: str, la: str, lb: str) -> str:
    """Of two arrays of signatures with their texts' first levels."""
    common = lambda x: f"filter({x}, s -> try_cast(substring_index(s, '.', 1) as int) between greatest({la}, {lb}) and least({la}, {lb}) + {LEVELS - 1})"
    places = lambda x: f"transform({common(x)}, s -> substring_index(s, '.', 2))"
    either = f"size(array_union({places(a)}, {places(b)}))"
    return f"if({a} = {b}, 1D, coalesce(size(array_intersect({common(a)}, {common(b)})) / nullif({either}, 0), 0D))"


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id and text with the next document's id and text, and whether the row is what stands for its id."""
    spark = docs.sparkSession
    parts = BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.where("doc_id is not null").select("doc_id").repartitionByRange(parts, "doc_id")
    ends = sorted(r["end"] for r in ranges.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("end")).collect())  # one a partition
    bounds = F.array(*map(F.lit, ends)) if ends else F.array(F.lit(0))
    jumps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, len(ends).bit_length())))))
    n = len(ends)
    # The number of bounds below the id, by binary search.
    block = F.aggregate(jumps, F.lit(0), lambda at, jump: F.when((at + jump <= n) & (F.get(bounds, F.least(at + jump, F.lit(max(n, 1))) - 1) < F.col("doc_id")), at + jump).otherwise(at))
    alone = F.col("doc_id").isNull()
    block = F.when(alone, -1 - F.pmod(F.monotonically_increasing_id(), F.lit(max(parts, 1)))).otherwise(block.cast("long"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("block", block)
    guest = (~alone) & (F.get(bounds, F.greatest("block", F.lit(0)).cast("int")) == F.col("doc_id"))
    roles = F.when(guest, F.array(F.struct(F.col("block"), F.lit(False).alias("guest")), F.struct(F.pmod(F.col("block") + 1, F.lit(max(n, 1))).alias("block"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct(F.col("block"), F.lit(False).alias("guest"))))
    dealt = rows.select("doc_id", "text", F.explode(roles).alias("role")).select("doc_id", "text", "role.*", F.xxhash64("text").alias("h"))
    order = "partition by block order by guest desc, doc_id, h desc"
    marked = dealt.withColumn("stands", F.expr(f"doc_id is not null and not coalesce(lead(struct(guest, doc_id)) over ({order}) = struct(guest, doc_id), false)"))
    before = f"over ({order} rows between unbounded preceding and 1 preceding)"
    told = marked.withColumn("next", F.expr(f"last_value(if(stands, struct(doc_id as id, text as text), null)) ignore nulls {before}"))
    return told.where("not guest").select("doc_id", "text", "stands", F.expr("if(doc_id is null, null, next.id)").alias("next_id"), F.expr("if(doc_id is null, '', next.text)").alias("next_text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """A row for each of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of its code points replaced by the first as many of the next document.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = docs.count()
    lexicon = stored(counts.where(f"df between {int(total**low)} and {int(total**high)}").select("term"), "lexicon")
    if lexicon.count() <= BROADCAST:
        lexicon = F.broadcast(lexicon)
    texts = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    texts = texts.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    texts = texts.select("doc_id", "next_id", "stands", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"), terms(F.col("text")).alias("wa"), terms(F.col("edited")).alias("wb"))
    whole = lambda w: F.unhex(F.md5(F.array_join(F.sort_array(w), " ")))
    texts = texts.withColumns({"la": F.expr(level("wa")), "lb": F.expr(level("wb"))}).withColumn("least", F.expr(below("least(la, lb)")))
    # Terms that one of both texts may keep, each hashed once; signatures take what lies below their own levels.
    texts = texts.withColumn("u", F.expr(picked("array_union(wa, wb)", "least"))).withColumns({"a": F.array_intersect("u", "wa"), "b": F.array_intersect("u", "wb"), "all_a": F.when(F.size("wa") > 0, whole("wa")), "all_b": F.when(F.size("wb") > 0, whole("wb"))})
    texts = stored(texts.drop("wa", "wb", "u", "least").withColumn("r", F.monotonically_increasing_id()), "texts", "zstd")
    pairs = F.expr("concat(transform(array_intersect(a, b), t -> struct(t as term, 3 as of)), transform(array_except(a, b), t -> struct(t as term, 1 as of)), transform(array_except(b, a), t -> struct(t as term, 2 as of)))")
    kept = texts.select("r", F.explode(pairs).alias("p")).select("r", "p.*").join(lexicon, "term", "left_semi")
    kept = kept.groupBy("r").agg(F.expr("collect_list(if(of & 1 > 0, term, null))").alias("ka"), F.expr("collect_list(if(of & 2 > 0, term, null))").alias("kb"))
    rows = texts.drop("a", "b").join(kept, "r", "left")
    bounds = lambda first: F.expr(f"array({', '.join(below(f'({first} + {j})') for j in range(LEVELS))})")
    hashed = lambda kept: F.expr(f"coalesce(transform({kept}, w -> struct(w, md5(w) as s)), array())")
    rows = rows.withColumns({"ha": hashed("ka"), "hb": hashed("kb"), "ba": bounds("la"), "bb": bounds("lb")})
    rows = rows.withColumns({"pa": F.expr(subsets("ha", "ba")), "pb": F.expr(subsets("hb", "bb"))})
    rows = rows.withColumns({"sa": F.expr(signatures("pa", "la", "ba")), "sb": F.expr(signatures("pb", "lb", "bb"))})
    some = lambda found, all_: F.expr(f"if(size({found}) > 0 or {all_} is null, {found}, array(concat('=', lower(hex({all_})))))")
    rows = stored(rows.select("doc_id", "next_id", "stands", "n_chars", "edited_sha256", "la", "lb", some("sa", "all_a").alias("fa"), some("sb", "all_b").alias("fb")), "prints", "zstd")
    others = rows.where("stands").select(F.col("doc_id").alias("other"), F.col("fa").alias("fn"), F.col("la").alias("ln"))
    rows = rows.join(others, F.col("next_id") == F.col("other"), "left")
    near_next = F.expr(f"if(next_id is null, null, {likeness('fa', 'fn', 'la', 'ln')})")
    return rows.select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.array_join("fa", " ").alias("fingerprint"), F.array_join("fb", " ").alias("edited_fingerprint"), F.expr(likeness("fa", "fb", "la", "lb")).alias("near_edited"), near_next.alias("near_next"))


def op13_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    words = lambda t: rf"list_distinct([w FOR w IN string_split_regex(translate({t}, '{CAPITALS}', '{CAPITALS.lower()}'), '[\x20\x09-\x0D]+') IF w <> ''])"
    first = lambda w: f"least(length(bin(len({w}))) - 1, {DEEPEST})"
    under = lambda j: f"CASE WHEN {j} = 0 THEN 'g' ELSE lpad(hex(CAST(1 AS BIGINT) << (16 - {j})), 4, '0') END"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
  coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM documents),
e AS (SELECT d.doc_id, d.text, d.n_chars, d.next_id, left(d.text, d.n_chars - d.n_chars // 2) || left(o.text, d.n_chars // 2) AS edited FROM d JOIN d o ON o.doc_id = d.next_id),
w AS (SELECT doc_id, 'a' AS k, {words("text")} AS ws FROM e UNION ALL SELECT doc_id, 'b', {words("edited")} FROM e),
lexicon AS (SELECT term FROM (SELECT unnest(ws) AS term FROM w WHERE k = 'a') GROUP BY term HAVING count(*) BETWEEN floor(pow((SELECT count(*) FROM d), {LOW})) AND floor(pow((SELECT count(*) FROM d), {HIGH}))),
t AS (SELECT doc_id, k, {first("ws")} AS lv, unnest(ws) AS term FROM w),
s AS (SELECT doc_id, k, lv + j AS l, i, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 8) AS sig FROM (SELECT * FROM t SEMI JOIN lexicon USING (term)), range({LEVELS}) a(j), range({SUBSETS}) b(i)
  WHERE substr(md5(term), 4 * i + 1, 4) < {under("(lv + j)")} GROUP BY doc_id, k, lv + j, i),
f AS (SELECT doc_id, k, list(l || '.' || i || '.' || sig ORDER BY l, i) AS f, list({{'l': l, 'i': i, 's': sig}} ORDER BY l, i) AS p FROM s GROUP BY ALL),
g AS (SELECT w.doc_id, w.k, {first("ws")} AS lv, CASE WHEN f.f IS NOT NULL THEN f.f WHEN len(ws) = 0 THEN [] ELSE ['=' || md5(array_to_string(list_sort(ws), ' '))] END AS f, coalesce(p, []) AS p FROM w LEFT JOIN f USING (doc_id, k)),
x AS (SELECT e.doc_id, 'e' AS of, a.f AS fa, b.f AS fb, a.p AS pa, b.p AS pb, greatest(a.lv, b.lv) AS lo, least(a.lv, b.lv) + {LEVELS - 1} AS hi FROM e JOIN g a ON a.doc_id = e.doc_id AND a.k = 'a' JOIN g b ON b.doc_id = e.doc_id AND b.k = 'b'
  UNION ALL SELECT e.doc_id, 'n', a.f, b.f, a.p, b.p, greatest(a.lv, b.lv), least(a.lv, b.lv) + {LEVELS - 1} FROM e JOIN g a ON a.doc_id = e.doc_id AND a.k = 'a' JOIN g b ON b.doc_id = e.next_id AND b.k = 'a'),
y AS (SELECT doc_id, of, fa, fb, [q FOR q IN pa IF q.l BETWEEN lo AND hi] AS qa, [q FOR q IN pb IF q.l BETWEEN lo AND hi] AS qb FROM x),
z AS (SELECT doc_id, of, CASE WHEN fa = fb THEN 1.0 ELSE coalesce(len(list_intersect(qa, qb)) / nullif(len(list_distinct([q.l || '.' || q.i FOR q IN list_concat(qa, qb)])), 0), 0.0) END AS near FROM y)
SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(a.f, ' ') AS fingerprint, array_to_string(b.f, ' ') AS edited_fingerprint, CAST(ze.near AS DOUBLE) AS near_edited, CAST(zn.near AS DOUBLE) AS near_next
FROM e JOIN g a ON a.doc_id = e.doc_id AND a.k = 'a' JOIN g b ON b.doc_id = e.doc_id AND b.k = 'b' JOIN z ze ON ze.doc_id = e.doc_id AND ze.of = 'e' JOIN z zn ON zn.doc_id = e.doc_id AND zn.of = 'n'
"""


ORACLE = _oracle()
