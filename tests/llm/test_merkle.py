"""Manifests against a plain version, proofs that are folded by hand, and tampering."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

KINDS = "doc_id long, text string, lang string, k string, place long, node string"  # the last three clash with names used inside


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def counted(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Root, and for each node the siblings to its left and right at each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place // 8 * 8
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return nodes[0], paths


def plain(rows):
    leaf = lambda d, t: h(counted(d), counted(t))
    groups = {}
    for d, t, g in rows:
        groups.setdefault(g, []).append((d is not None, d or 0, leaf(d, t), leaf(d, t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {g: (sorted(groups[g]), *climb([x[2] for x in sorted(groups[g])])) for g in names}
    root, above = climb([inner[g][1] for g in names])
    out = []
    for g, path in zip(names, above):
        for (has, d, a, b), own in zip(inner[g][0], inner[g][2]):
            folded = b if has and zlib.crc32(str(d).encode()) % 3 == 0 else a
            for left, right in own + path:
                folded = h(left, folded, right)
            out.append((d if has else None, a, inner[g][1], root, h(*(x + y for x, y in own + path)), folded, folded == root))
    return out


def built(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, None) for r in rows], KINDS).repartition(6)
    out = merkle.manifest(df, ["doc_id", "text"], altered={"text": F.translate("text", merkle.CAPITALS, merkle.CAPITALS.lower())}, when=F.expr("crc32(cast(doc_id as string)) % 3 = 0"))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


def test_manifest_equals_plain_version(spark):
    """Groups of 1, 8, 9, 512, 513 and 1,300 rows: a bucket, buckets with one leaf, and levels above them; odd rows in between."""
    rows = [(i, f"Text {i}" if i % 5 else f"lower {i}", g) for g, n in (("a", 1), ("b", 8), ("B", 9), ("é", 512), ("zz", 513), ("", 1300), (None, 65)) for i in range(n)]
    rows += [(9000, None, "b"), (9001, "", "b"), (None, "no id", "b"), (None, None, "b"), (3, "Text 3", "b"), (3, "Text 3", "b"), (3, "Other", "b"), (9002, "Long " * 50_000, "a")]
    got, want = built(spark, rows), sorted(plain(rows), key=str)
    assert got == want
    assert {r[-1] for r in got} == {True, False} and len({r[3] for r in got}) == 1


@pytest.mark.parametrize("rows", [[(1, "One", "x")], [(0, "same", None)] * 700, [(i, "t", f"g{i}") for i in range(70)], []])
def test_small_and_repeated_tables(spark, rows):
    assert built(spark, rows) == sorted(plain(rows) if rows else [], key=str)


def test_block_levels():
    assert [merkle.height(n) for n in (1, 2, 8, 9, 64, 65, 512, 513)] == [0, 1, 1, 2, 2, 3, 3, 4]
