"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from tidemark.plans import catalog

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def value(x):
    if isinstance(x, float):
        return "nan" if x != x else repr(round(x, 6) + 0.0)
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(value, x)) + "]"
    return str(x).split("+00:00")[0]


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, DATA)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == normal(result.fetchall(), columns)


def test_packing_by_hand(spark):
    from tidemark.operators.packing import pack_by_documents

    facts = spark.createDataFrame([("k", i, d) for i, d in enumerate([["a"], ["b"], ["a"], ["c", "b"], [], ["d"], ["a"], ["big"]], 1)], "k string, i int, docs array<string>")
    sizes = spark.createDataFrame([("a", 40.0), ("b", 30.0), ("c", 30.0), ("d", 70.0), ("big", 500.0)], "doc string, size double")
    got = {r.i: (r.slice, r.full, r.cut) for r in pack_by_documents(facts, ["k"], "i", "docs", sizes, "doc", "size", 3, 100, 450).collect()}
    # big, d, {b, c} and the three facts of a open slices; b joins {b, c} for nothing, and a fact without documents the first slice
    assert got[8] == got[5] == (3, ["big"], [])
    assert got[2][0] == got[4][0] and got[4][1:] == (["b", "c"], [])
    assert got[1] == got[3] == got[7] == (1, ["a"], [])
    assert got[6] == (4, ["d"], []) and len({n for n, *_ in got.values()}) == 4


def test_packing_keeps_its_promises(spark):
    rows = catalog.QUERIES["packed_by_documents"](spark, DATA).collect()
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_partkey").distinct().collect()
    price = {r.p_partkey: r.p_retailprice for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    assert {(r.l_suppkey, r.l_orderkey) for r in rows} == {(r.l_suppkey, r.l_orderkey) for r in lines} and len(rows) == len({(r.l_suppkey, r.l_orderkey) for r in rows})
    parts: dict = {}
    for r in lines:
        parts.setdefault((r.l_suppkey, r.l_orderkey), set()).add(r.l_partkey)
    slices: dict = {}
    for r in rows:
        slices.setdefault((r.l_suppkey, r.slice), []).append(r)
    for (supplier, n), members in slices.items():
        cited = set().union(*(parts[supplier, r.l_orderkey] for r in members))
        assert len(members) <= 60 and all(r.n_full + r.n_cut == len(cited) for r in members)
        assert len({frozenset(parts[supplier, r.l_orderkey]) for r in members}) == 1 or sum(price[p] for p in cited) <= 160_000
        if n > 1:  # numbered by their first facts
            assert min(r.l_orderkey for r in slices[supplier, n - 1]) < min(r.l_orderkey for r in members)


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["event_id", "user_id", "view_id", "view_value"]
