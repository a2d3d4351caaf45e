"""Merkle manifest of a dataset: digests of rows, of groups and of all, with a proof for every row.

Rows of a group ascend by id and get consecutive places: they are dealt by ranges of (group, id), so a group that holds a third
of all rows spreads over many tasks, and a place is the row's number within its range plus the rows of the group in the
ranges before. Aligned buckets of 8**3 places meet in one task as Arrow tables, and DuckDB computes there, in one statement
of ordered string_agg and sha256 by level, the bucket's root, each leaf's siblings, and what a leaf that may have been
altered folds up to. Spark then combines bucket roots by runs of 8 until one is left in every group, combines those of the
groups likewise, and joins the outer part of each proof to its bucket's rows. Text never moves: a row is a few digests, and
no task holds more than one bucket.

Defined results: null values and null ids are digested as "-"; null ids come first, equal ids go by their leaves, and rows that
are equal stay as many; a null group comes first, an empty one next; a lone leaf is its group's root and a lone group's root
is the root; an empty table gives no rows. Columns not named in the digest may have any names. Texts are digested whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

FAN, INNER = 8, 3  # children of a node; levels inside a bucket
BUCKET = FAN**INNER
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_duck = None  # one connection for each Python worker


def counted(value: Column) -> Column:
    """A value as digested: its UTF-8 byte count, a colon and the value, or - for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(counted, values)), 256)


def connection():
    global _duck
    if _duck is None:
        import duckdb

        _duck = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
    return _duck


def block_sql(levels: int) -> str:
    """Over table block (place, leaf, altered): proof, folded and the bucket's root after so many levels."""
    tables, joins = ["n0 AS (SELECT place AS i, leaf AS h FROM block)"], []
    proof, folded = ["''"], "coalesce(altered, leaf)"
    for k in range(levels):
        run = f"OVER (PARTITION BY i // {FAN} ORDER BY i ROWS BETWEEN"
        tables.append(f"s{k} AS (SELECT i, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM n{k})")
        tables.append(f"n{k + 1} AS (SELECT i // {FAN} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM n{k} GROUP BY i // {FAN})")
        joins.append(f"JOIN s{k} ON s{k}.i = place // {FAN**k}")
        proof += [f"s{k}.l", f"s{k}.r"]
        folded = f"sha256(s{k}.l || {folded} || s{k}.r)"
    return f"WITH {', '.join(tables)} SELECT block.*, {' || '.join(proof)} AS proof, {folded} AS folded, (SELECT h FROM n{levels}) AS node FROM block {' '.join(joins)}"


def height(n: int, fan: int = FAN) -> int:
    """Levels above n leaves: the least h with fan**h >= n."""
    h = 0
    while fan**h < n:
        h += 1
    return h


def _bucket(schema: pa.Schema):
    def run(block: pa.Table) -> pa.Table:
        con = connection()
        con.register("block", block)
        out = con.sql(block_sql(min(INNER, height(block.column("n")[0].as_py())))).to_arrow_table()
        con.unregister("block")
        return out.select(schema.names).cast(schema)

    return run


def placed(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows with `place` (from 0, within column k, in the order of by) and `n`, the number of rows of that k. rows is stored."""
    order = ["k", *by]
    numbered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranges")
    numbered = numbered.withColumn("range", F.shiftright("at", 33))
    starts = numbered.groupBy("range", "k").agg(F.min("at").alias("start"), F.count("*").alias("own"))
    before = "partition by k order by range rows between unbounded preceding and 1 preceding"
    starts = starts.selectExpr("range as r", "k as kk", f"coalesce(sum(own) over ({before}), 0) - start as shift", "sum(own) over (partition by k) as n")
    return numbered.join(starts, F.expr("range = r and k = kk")).select(*rows.columns, F.expr("at + shift").alias("place"), "n")


def combined(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes k, i, h (places from 0 in every k): k and root; and k, i and steps, the siblings on both sides at each level up to the
    root. A run of 8 meets in one row; there is a pass for each level, all groups together."""
    links, left = [], nodes
    while (left.agg(F.max("i")).first()[0] or 0) > 0:
        runs = left.groupBy("k", F.expr(f"i div {FAN}").alias("up")).agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("run"))
        runs = stored(runs.withColumn("done", F.expr("up = 0 and size(run) = 1")), "runs")
        members = runs.select("k", "up", "done", "run", F.posexplode("run").alias("at", "own"))
        joined = lambda part: f"array_join(transform({part}, x -> x.h), '')"
        steps = f"if(done, array(), array(struct({joined('slice(run, 1, at)')} as l, {joined('slice(run, at + 2, 8)')} as r)))"
        links.append(members.select("k", F.col("own.i").alias("i"), "up", F.expr(f"cast({steps} as array<struct<l:string,r:string>>)").alias("own")))
        left = runs.select("k", F.col("up").alias("i"), F.expr("if(done, run[0].h, sha2(array_join(transform(run, x -> x.h), ''), 256))").alias("h"))
    roots = stored(left.select("k", F.col("h").alias("root")), "roots")
    proofs = roots.select("k", F.lit(0).cast("long").alias("i"), F.expr("cast(array() as array<struct<l:string,r:string>>)").alias("steps"))
    for link in reversed(links):
        above = proofs.select(F.col("k").alias("kk"), F.col("i").alias("ii"), F.col("steps").alias("above"))
        proofs = stored(link.join(above, F.expr("k = kk and up = ii")).select("k", "i", F.concat("own", "above").alias("steps")), "proofs")
    return roots, proofs


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "lang", altered: dict[str, Column] | None = None, when: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (by default the id) with leaf, subroot, root, proof_sha256, folded_root and verified.

    columns are digested in their order. altered: what stands in place of columns in rows where `when` holds; proofs of all rows
    are those of the unaltered table, and folded_root is what an altered leaf gives with them.
    """
    carry = [id_col] if carry is None else carry
    col = {c: F.col(f"`{c}`") for c in {*columns, *carry, id_col, group_col}}
    leaf = leaf_of([col[c] for c in columns])
    other = F.when(when, leaf_of([(altered or {}).get(c, col[c]) for c in columns])) if when is not None else F.lit(None).cast("string")
    key = F.when(col[group_col].isNull(), "").otherwise(F.concat(F.lit("="), col[group_col].cast("string")))
    leaves = docs.select(*(col[c].alias(f"c{i}") for i, c in enumerate(carry)), key.alias("k"), col[id_col].alias("id"), leaf.alias("leaf"), other.alias("altered"))
    leaves = stored(leaves.withColumn("m", F.monotonically_increasing_id()), "leaves")  # equal rows are told apart, and dealt
    rows = placed(leaves, ["id", "leaf", "m"]).withColumn("b", F.expr(f"place div {BUCKET}"))
    kept = T.StructType([f for f in leaves.schema.fields if f.name.startswith("c")] + [T.StructField(c, T.StringType()) for c in ("k", "leaf", "proof", "folded", "node")] + [T.StructField(c, T.LongType()) for c in ("b", "place")])
    blocks = stored(rows.drop("m", "id").groupBy("k", "b").applyInArrow(_bucket(to_arrow_schema(kept)), kept), "blocks", "zstd")
    nodes = blocks.where(f"place % {BUCKET} = 0").select("k", F.col("b").alias("i"), F.col("node").alias("h"))
    subroots, proofs = combined(nodes)
    groups = placed(stored(subroots.select(F.lit("").alias("k"), F.col("k").alias("name"), F.col("root").alias("h")), "groups"), ["name"])
    groups = stored(groups.select("k", F.col("place").alias("i"), "h", "name"), "groups")
    roots, above = combined(groups.select("k", "i", "h"))
    root = roots.first()
    groups = groups.join(above.select("i", F.col("steps").alias("above")), "i").select(F.col("name").alias("k"), F.col("h").alias("subroot"), "above")
    outer = proofs.join(groups, "k").select(F.col("k").alias("kk"), F.col("i").alias("bb"), "subroot", F.concat("steps", "above").alias("steps"))
    found = blocks.join(outer, F.expr("k = kk and b = bb"))
    root = F.lit(root["root"] if root else None).cast("string")
    outside = F.expr("array_join(transform(steps, s -> concat(s.l, s.r)), '')")
    folded = F.expr("aggregate(steps, folded, (a, s) -> sha2(concat(s.l, a, s.r), 256))")
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "leaf", "subroot", root.alias("root"), F.sha2(F.concat("proof", outside), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.expr("folded_root = root"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lower = F.translate("text", CAPITALS, CAPITALS.lower())
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], altered={"text": lower}, when=F.expr("crc32(cast(doc_id as string)) % 3 = 0"))


def _oracle(levels: int = 6, above: int = 3) -> str:
    """Six levels hold 262,144 rows a language, three hold 512 languages."""
    digest = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    lower = f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')"
    bytes_ = "[CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]"
    tables = [
        "crc AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b)))",
        f"d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, {digest('text')} AS leaf, {digest(lower)} AS other, xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295) % 3 = 0 AS bad FROM documents, crc)",
        "a0 AS (SELECT g, i, leaf AS h FROM d)",
    ]

    def tree(node: str, side: str, n: int) -> None:
        run = "OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
        for k in range(n):
            tables.append(f"{side}{k} AS (SELECT g, i, i // 8 = 0 AND count(*) OVER (PARTITION BY g, i // 8) = 1 AS done, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {node}{k})")
            tables.append(f"{node}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN i // 8 = 0 AND count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {node}{k} GROUP BY g, i // 8)")

    tree("a", "s", levels)
    tables.append(f"o AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS j FROM a{levels})")
    tables.append("z0 AS (SELECT '' AS g, j AS i, subroot AS h FROM o)")
    tree("z", "u", above)
    tables.append("f AS (SELECT doc_id, leaf, g, i, subroot, j, CASE WHEN bad THEN other ELSE leaf END AS cur, '' AS proof FROM d JOIN o USING (g))")
    last = "f"
    for s, on in [(f"s{k}", f"s{k}.g = f.g AND s{k}.i = f.i // {8**k}") for k in range(levels)] + [(f"u{k}", f"u{k}.i = f.j // {8**k}") for k in range(above)]:
        tables.append(f"f{s} AS (SELECT doc_id, leaf, f.g, f.i, subroot, j, CASE WHEN done THEN cur ELSE sha256(l || cur || r) END AS cur, proof || l || r AS proof FROM {last} f JOIN {s} ON {on})")
        last = f"f{s}"
    return "WITH " + ",\n".join(tables) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified FROM {last}, (SELECT h FROM z{above})"


ORACLE = _oracle()
