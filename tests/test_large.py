"""What must not grow with the table, seen in plans and in small cases."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_requests_are_dealt_over_all_cores_and_look_at_a_clause_once(spark):
    from tidemark.functions.requests import requests
    from tidemark.plans import catalog

    assert "REPARTITION_BY_NUM" in plan(catalog.QUERIES["requests_in_words"](spark, DATA))
    row = spark.range(1).select(requests(F.col("id").cast("string"), F.lit(False), F.array(F.lit("Acme"))).alias("r"))
    assert row._jdf.queryExecution().analyzed().toString().lower().count("regexp_replace") < 40


def named(column, word: str, spark) -> int:
    return spark.range(1).select(column(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString().lower().count(word)


def test_texts_are_folded_once_to_be_cut(spark):
    from tidemark.operators.packing import cut_long

    assert named(lambda x: cut_long(x, 300, lambda line: line.rlike("^A")), "aggregate(", spark) <= 2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_forms_are_written_after_their_lines_are_gathered(spark):
    from tidemark.plans import catalog

    gathered = [line for line in plan(catalog.QUERIES["insiders_of_forms"](spark, DATA)).split("\n") if "partial_collect_list" in line]
    assert gathered and not any("nonDerivativeTransaction" in line for line in gathered)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_documents_of_events_meet_once_for_releases(spark):
    from tidemark.plans import catalog

    assert plan(catalog.QUERIES["documents_of_events"](spark, DATA)).count("FileScan parquet") == 4  # events and documents, for releases and for closings


def test_words_are_bared_once(spark):
    from tidemark.functions.mentions import mentions

    assert named(mentions, "regexp_replace", spark) <= 4


def test_a_figure_is_in_two_bins_at_most(spark):
    from tidemark.operators.checks import _bin, _bins

    cells = spark.range(-40, 40).select(F.col("id").cast("double").alias("c"))
    rows = cells.select("c", _bins(F.col("c")).alias("b"), *(_bin(F.col("c") + k).alias(f"n{k + 2}") for k in range(-2, 3))).collect()
    assert all(len(r.b) <= 2 and {r[f"n{k}"] for k in range(5)} == set(r.b) for r in rows)


@pytest.mark.parametrize("light", [0, 3, 1 << 30])
def test_tiers_are_the_same_whatever_the_size_of_sources(spark, monkeypatch, light):
    from tidemark.operators import checks

    monkeypatch.setattr(checks, "LIGHT", light)
    tiers = [("own", "part", False), ("far", "rate", True)]
    figures = [("a", 12.0, 0, "p"), ("b", 1.5, 1, "p"), ("c", 7.0, 0, "q"), ("d", 400.0, 0, "q"), ("e", 33.0, 0, "none"), ("f", 5.0, 99, "p")]
    frame = spark.createDataFrame([(k, v, d, [("part", r), ("rate", "all")], ["x"]) for k, v, d, r in figures], "k string, v double, d int, cites array<struct<kind:string,ref:string>>, label array<string>")
    numbers = [("part", "p", 12.2, []), ("part", "p", 12.2, []), ("part", "p", 1499.0, []), ("part", "q", 0.0071, []), ("rate", "all", 400.1, ["x"]), ("rate", "all", 33.0, ["x"]), ("rate", "all", 34.0, ["x"]), ("rate", "all", 8.0, ["y"])]
    got = checks.checked(frame, spark.createDataFrame(numbers, "kind string, ref string, number double, around array<string>").selectExpr("*", "string(null) as unit"), "k", "v", "d", "cites", tiers, label="label")
    want = [("a", "own", 12.2, 0), ("b", "own", 1499.0, 3), ("c", "own", 0.0071, -3), ("d", "far", 400.1, 0), ("e", "weak", None, None), ("f", "unverified", None, None)]
    assert sorted(tuple(r) for r in got.select("k", "class", "number", "scale").collect()) == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_a_slice_travels_once_with_its_documents(spark):
    """Not once for each of its facts, and facts are dealt once for both groupings."""
    from tidemark.plans import catalog

    steps = plan(catalog.QUERIES["packed_by_documents"](spark, DATA)).split("\n")
    assert any("Generate explode(__members" in x for x in steps) and any("FlatMapGroupsInArrow" in x for x in steps)
    above = steps[: next(i for i, x in enumerate(steps) if "Join" in x)]
    assert sum("Exchange hashpartitioning" in x for x in above) == 1


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_units_are_read_once_for_few_quotes(spark):
    """Once for both directions, and once for the keys of what is found."""
    from tidemark.plans import catalog

    scans = [line for line in plan(catalog.QUERIES["containment_first_unit"](spark, DATA)).split("\n") if "FileScan parquet" in line and "documents.parquet" in line]
    assert sum("text" in line.split("]")[0] for line in scans) == 1 and len(scans) == 2


def test_pairs_of_texts_and_quotes_are_those_of_a_plain_search(monkeypatch):
    import random

    import pyarrow as pa

    from tidemark.operators import joins as J

    monkeypatch.setattr(J, "BLOCK", 16)
    rng = random.Random(7)
    say = lambda n: "".join(rng.choice(["ab", "ba ", "é", "漢", "aaaa"]) for _ in range(n))
    quotes = sorted({say(rng.randint(8, 60)) for _ in range(80)} | {"a" * 12, "a" * 90, "ab" * 12})
    texts = [say(rng.randint(0, 120)) for _ in range(150)] + [q[2:-2] for q in quotes] + ["x" + q for q in quotes] + ["a" * 40, "", None, "a" * 400]
    quotes = [q for q in quotes if len(q) >= 12]
    want = {(i, k) for i, t in enumerate(texts) if t for k, q in enumerate(quotes) if q in t or (len(t) > 36 and t in q)}
    batch = pa.RecordBatch.from_arrays([pa.array(range(-1, len(texts))), pa.array(["before", *texts])], ["u", "x"]).slice(1)
    got = [(u, k) for b in J._pairs_with([q.encode() for q in quotes], 36)(iter([batch, batch.slice(0, 0)])) for u, k in zip(*(c.to_pylist() for c in b.columns))]
    assert set(got) == want and len(want) > 150


@pytest.mark.parametrize("few", [0, 20_000])
def test_containment_is_the_same_for_few_and_many_quotes(spark, monkeypatch, few):
    from tidemark.operators import joins as J

    monkeypatch.setattr(J, "FEW", few)
    quotes = spark.createDataFrame([(1, "one two  three four five"), (2, "one two three four five"), (3, "tail of\ta text"), (4, "nowhere to be found"), (5, "a  quote that holds a unit of well over thirty six characters"), (6, None), (7, "too short")], "q int, quote string")
    units = spark.createDataFrame([(4, 2, "zero one two three four\nfive six"), (4, 1, "one two three four five"), (9, 0, "the tail of a text"), (3, 7, "a unit of well over thirty six characters"), (1, 1, None), (1, 2, " \n"), (2, 2, "too short")], "u int, v int, text string")
    got = {r.q: (r.u, r.v) for r in J.containment_join(quotes, units, "quote", "text", ["u", "v"], "q").collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (9, 0), 5: (3, 7)}


@pytest.mark.parametrize("few", [0, 20_000])
def test_containment_equals_its_sql_on_odd_keys_and_blanks(spark, monkeypatch, tmp_path, few):
    """Keys that are missing or stand twice, quotes cut at a blank, and blanks that aren't ASCII."""
    import duckdb

    from tidemark.operators import joins as J
    from tidemark.plans import catalog

    monkeypatch.setattr(J, "FEW", few)
    no_break = "\u00a0"
    items = [(1, "twelve chars and more of this item"), (1, "second reading of the first item"), (2, f"{no_break}wide blanks\u3000 stand at the ends{no_break}"), (3, f"a b {no_break} cccc dddd eeee ffff"), (None, "an item that has no key at all"), (4, "only a document without a key has this"), (5, None), (6, "a quote that holds one unit of well over thirty six characters")]
    docs = [
        (1, "twelve charsets"), (5, "twelve chars and so on"), (5, "twelve chars twice under one key"), (4, "the second reading of the first item here"), (None, "twelve chars and more of this item"), (7, "so wide blanks\u3000 stand at the ends"), (8, f"x a b {no_break} cccc dddd eeee ffff y"), (2, "cccc dddd eeee"),
        (9, "an item that has no key at all"), (6, "an item that has no"), (None, "only a document without a key has this"), (11, None), (12, f"\t{no_break} one unit of well over thirty six characters\u3000\n"),
    ]
    for name, rows, kinds in (("benchmark", items, "item_id long, text string"), ("documents", docs, "doc_id long, text string")):
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = {tuple(r) for r in catalog.QUERIES["containment_first_unit"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(catalog.ORACLES["containment_first_unit"]).fetchall())
    assert {("1start", 4), ("1whole", 4), ("2start", 7), ("2whole", 7), ("3words", 8), ("4whole", None), ("6whole", 12), (None, 6)} <= got


def test_events_take_a_keys_records_as_rows_and_hold_little_of_them():
    """No data frame for each key; state is read and written once. Ids are kept to the last digit beside a missing one."""
    from unittest.mock import MagicMock

    from pyspark.sql import Row

    from tidemark.streaming.events import Events

    big, record = 2**60, Row("key", "at", "at_us", "id", "kind")
    rows = [(9, 5, "close"), (1, big + 2, "open"), (1, big + 1, "open"), (1, None, "open"), (40, big + 3, "open"), (41, 7, "open"), (200, 8, "close"), (300, 9, "open"), (301, 6, "open")]
    handle = MagicMock()
    machine = Events("open", "close", 100)
    machine.init(handle)
    machine.event.get.return_value = (-50, 3)
    machine.attached.get.side_effect = lambda: iter([(4,)])
    got = list(machine.handleInputRows((1,), (record(1, None, *x) for x in rows), None))
    micros = lambda t: t.second * 1_000_000 + t.microsecond
    assert [(r.key, r.opened_id, micros(r.closed_at), r.closed_by, r.attached) for r in got] == [(1, 3, 9, "close", [4, big + 1, big + 2, None]), (1, big + 3, 140, "timer", [7])]
    assert machine.event.get.call_count == machine.attached.get.call_count == 1
    assert machine.event.update.call_args_list == [(((300, 9),),)] and machine.attached.appendList.call_args_list == [(([(6,)],),)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_lines_are_read_and_dealt_once_for_all_tiers(spark):
    """Figures, pools and numbers come from one table of orders; sources are counted once, without their names."""
    from tidemark.plans import catalog

    steps = plan(catalog.QUERIES["figures_through_all_tiers"](spark, DATA)).split("\n")
    assert not any("lineitem.parquet" in x for x in steps) and sum("Exchange hashpartitioning" in x for x in steps) <= 10


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_tiers_equal_their_sql_where_every_row_stands_twice(spark, tmp_path):
    import duckdb

    from tidemark.plans import catalog

    con = duckdb.connect()
    for name in ("orders", "lineitem", "part"):
        df = spark.read.parquet(f"{DATA}/{name}.parquet")
        df.unionAll(df).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    df = catalog.QUERIES["figures_through_all_tiers"](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES['figures_through_all_tiers']})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("light", [0, 3, 256])
def test_tiers_are_the_same_for_large_and_small_sources(spark, monkeypatch, light):
    """Numbers one by one or together in arrays, in one row of a source or several; slips and scales at the edges of bins."""
    import random

    from tidemark.operators import checks as C

    monkeypatch.setattr(C, "LIGHT", light)
    rng = random.Random(5)
    figures = [(str(i), round(rng.uniform(0, 99), i % 3), i % 3, [{"kind": k, "ref": r} for k, r in (("own", str(i % 7)), ("far", "f"))], [rng.choice("ab")]) for i in range(120)]
    numbers = [(k, str(r), round(f[1] * 10 ** rng.choice([0, 3, 6, 9, -3, -6]) + rng.choice([0, 0, 0.4, 1]) * 10 ** -f[2], 9), [rng.choice("abc")]) for i, f in enumerate(figures) for k, r in (("own", i % 7), ("far", "f")) if rng.random() < 0.25]
    asked = spark.createDataFrame(figures, "id string, v double, d int, c array<struct<kind:string,ref:string>>, l array<string>")
    plain = spark.createDataFrame([(*x, None) for x in numbers] + [("own", "1", None, None, None)], "kind string, ref string, number double, around array<string>, unit string")
    together = plain.groupBy("kind", "ref", "around", "unit").agg(F.collect_list("number").alias("number"))
    half = lambda u: 0.5 * u * (1 + 1e-12) + 1e-9 * min(1.0, u)

    def first(f, kind, ref, singled):
        best, slips, some = None, False, False
        for rank, s in enumerate(C.SCALE_POWERS):
            u, x = 10.0 ** (s - f[2]), f[1] * 10.0**s
            for _, _, n, around in (y for y in numbers if y[:2] == (kind, ref)):
                hit, beside = abs(x - n) <= half(u), not singled or f[4][0] in around
                some |= hit
                slips |= singled and f[4][0] in around and min(abs(x + u - n), abs(x - u - n)) <= half(u)
                best = min(filter(None, [best, (rank, n, s) if hit and beside else None]), default=None)
        return None if slips else best, some

    want = {}
    for f in figures:
        (own, some), (far, more) = first(f, "own", f[3][0]["ref"], False), first(f, "far", "f", True)
        want[f[0]] = ("own", *own[1:]) if own else ("far", *far[1:]) if far else ("weak" if some or more else "no fact" if f[1] == int(f[1]) and f[1] < 10 and f[2] == 0 else "unverified", None, None)
    tiers = [("own", "own", False), ("far", "far", True)]
    for given in (plain, together):
        got = {r.id: (r["class"], r.number, r.scale) for r in C.checked(asked, given, "id", "v", "d", "c", tiers, label="l").collect()}
        assert got == want
    for part in (1.0, 0.5):  # all numbers stand in the figure's row, or some of each kind
        at_hand = [x for x in numbers if rng.random() < part]
        rows = [(*f, [{"kind": k, "number": -n, "around": a, "unit": None} for k, r, n, a in at_hand if r in ("f", f[3][0]["ref"])], [1.0]) for f in figures]
        asked = spark.createDataFrame(rows, "id string, v double, d int, c array<struct<kind:string,ref:string>>, l array<string>, h array<struct<kind:string,number:double,around:array<string>,unit:string>>, p array<double>")
        rest = plain.join(spark.createDataFrame(at_hand, "kind string, ref string, number double, around array<string>"), ["kind", "ref", "number", "around"], "left_anti")
        got = C.checked(asked, rest, "id", "v", "d", "c", tiers, label="l", own="h", pool="p").collect()
        assert {r.id: (r["class"], r.number, r.scale) for r in got} == want and all(r.p == [1.0] for r in got)
    assert {c for c, *_ in want.values()} >= {"own", "far", "weak", "unverified"}
