"""Operators that no query covers whole, on small tables by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import checks, facts, islands, joins, rules, selection

day = dt.date.fromisoformat


def test_neighbours_are_the_rows_before(spark):
    rows = spark.createDataFrame([(1, i, float(i)) for i in range(5)], "k int, i int, v double")
    got = {r.i: r.pool for r in checks.neighbours(rows, ["k"], ["i"], "v", 2).collect()}
    assert got == {0: [], 1: [0.0], 2: [0.0, 1.0], 3: [1.0, 2.0], 4: [2.0, 3.0]}


def test_recompute_takes_all_own_figures_and_caps_only_wider_ones(spark):
    many, far = [1000.0] * 80, [1000.0 + i for i in range(80)]
    rows = [
        (1, 30.0, [*many, 12.0, 18.0], [], []),
        (2, 30.0, [12.0], [*far, 18.0], []),
        (3, 30.0, [12.0], far, [18.0]),
        (4, 30.0, [5000.0], [12.0], [18.0]),
        (5, 30.0, [12.0], [12.0] * 90 + [18.0], []),
    ]
    frame = spark.createDataFrame(rows, "id int, v double, pool array<double>, wider array<double>, key array<double>").selectExpr("*", "0 as d")
    got = {r.id: r.r and (r.r.op, r.r.a, r.r.b) for r in frame.select("id", checks.recompute(frame, "v", "d", "pool", wider="wider", key_figures="key").alias("r")).collect()}
    assert got == {1: ("+", 12.0, 18.0), 2: None, 3: ("+", 12.0, 18.0), 4: None, 5: ("+", 12.0, 18.0)}
    whole = frame.where("id = 1").select(checks.recompute(frame, "v", "d", "pool").alias("r")).first().r
    assert (whole.op, whole.a, whole.b) == ("+", 12.0, 18.0)


def test_recompute_leaves_copies_and_single_digits(spark):
    rows = [(1, 30.0, 0, [10.0, 20.0]), (2, 5.0, 0, [2.0, 3.0]), (3, 12.5, 1, [112.5, 100.0]), (4, 30.0, 0, [30.0, 1.0]), (5, 30.0, 0, []), (6, 50.0, 0, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "id int, v double, d int, pool array<double>")
    got = {r.id: r.r and r.r.op for r in frame.select("id", checks.recompute(frame, "v", "d", "pool").alias("r")).collect()}
    assert got == {1: "+", 2: None, 3: "-", 4: None, 5: None, 6: "/ %"}


def test_context_facts_come_from_other_slices(spark):
    table = spark.createDataFrame([("a", []), ("b", ["a", "c"]), ("c", ["a"]), ("d", ["zz"])], "id string, inputs array<string>")
    slices = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 1)], "id string, n int")
    assert {tuple(r) for r in facts.context_of(slices, table, "id", "n", "inputs").collect()} == {(2, "a")}


def test_page_numbers_are_the_longest_run(spark):
    text = "1\nx\n7\ny\n2\nz\n3\n9\n4\n"
    frame = spark.createDataFrame([(1, text), (2, "1\n2\n3"), (3, None)], "id long, text string")
    assert [(r.id, r.line, r.page) for r in islands.page_numbers(frame, "id", "text").orderBy("line").collect()] == [(1, 0, 1), (1, 4, 2), (1, 6, 3), (1, 8, 4)]


def test_walk_of_nested_documents(spark):
    frame = spark.createDataFrame([(1, '{"a": [1, {"b": "x"}], "c": null, "d": true}'), (2, "[]"), (3, None)], "key int, j string")
    got = selection.walk(frame.select("key", F.parse_json("j").alias("v")), "key", "v").where("value is not null").collect()
    assert {(r.key, r.path, r.value) for r in got} == {(1, "$.a[0]", "1"), (1, "$.a[1].b", "x"), (1, "$.d", "true")}


def test_upcoming_releases(spark):
    issuers = spark.createDataFrame([("A",), ("B",)], "k string")
    quarters = spark.createDataFrame([("A", "Q1", day("2026-05-01")), ("A", "Q2", day("2026-06-01")), ("B", "Q1", day("2026-05-20")), ("C", "Q1", day("2026-05-02"))], "k string, period string, day date")
    released = spark.createDataFrame([("B", "Q1")], "k string, period string")
    got = selection.upcoming(issuers, quarters, released, "k", "day", F.lit("2026-05-01").cast("date"), F.lit("2026-05-31").cast("date"))
    assert [(r.k, r.period) for r in got.collect()] == [("A", "Q1")]


def test_three_valued_combinations(spark):
    one = spark.range(1)
    t, f, u = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    row = one.select(rules.any_of([f, u, t]).alias("a"), rules.any_of([f, u]).alias("b"), rules.all_of([t, u]).alias("c"), rules.all_of([u, f]).alias("d")).first()
    assert tuple(row) == (True, None, None, False)


def test_slips_of_halves(spark):
    figures = spark.createDataFrame([(1, "s", 12.5, 1), (2, "s", 99.0, 0), (3, "t", 12.5, 1), (4, "s", 98.0, 0)], "id int, s string, v double, d int")
    numbers = spark.createDataFrame([("s", 12.5), ("s", -99.0), ("s", None)], "s string, n double")
    got = {r.id: (r.found, r.slips) for r in checks.singled_out(figures, numbers, ["s"], "id", "v", "d", "n").collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, False), 4: (False, True)}


def test_asof_with_nulls_ties_and_strictness(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, 5), (4, "a", 1), (5, "b", 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 5, 2.0), ("a", 2, 0.5), ("a", None, 7.0)], "k string, r int, v double")
    got = {r.id: r.v for r in joins.asof_join(left, right, ["k"], "t", "r", ["v"]).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None, 5: None}
    strict = {r.id: r.v for r in joins.asof_join(left, right, ["k"], "t", "r", ["v"], bucket=lambda c: F.floor(c / 3), strict=True).collect()}
    assert strict == {1: 0.5, 2: None, 3: None, 4: None, 5: None}
