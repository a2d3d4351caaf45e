"""The joined checker, metrics by formulas, versions over time and the keyed-state machine on cases worked out by hand."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import pairs
from tidemark.functions import text as T
from tidemark.operators import checks as C
from tidemark.operators import history as H
from tidemark.operators import metrics as M
from tidemark.streaming import events as W


def test_tiers_in_order(spark):
    cite = lambda *x: [{"kind": k, "ref": r} for k, r in x]
    own, far = ("part", "p"), ("text", "t")
    rows = [
        ("own", 12.5, 1, cite(own, far), ["sales"], "money", [], None), ("scaled", 3.2, 1, cite(own), ["sales"], None, [], None), ("clash", 77.0, 0, cite(own), ["sales"], "percent", [], None),
        ("singled", 500.0, 0, cite(far), ["sales"], None, [], None), ("slip", 611.0, 0, cite(far), ["sales"], None, [], None), ("unlabelled", 500.0, 0, cite(far), ["costs"], None, [], None),
        ("sum", 30.0, 0, cite(own), [], None, [12.0, 18.0], None), ("written", 41.0, 0, cite(own), [], None, [], "rounding"), ("small", 7.0, 0, [], [], None, [3.0, 4.0], None), ("none", 99.0, 0, [], [], None, [], "error"), ("huge", 1e18, 9, cite(own), [], None, [], None),
    ]
    figures = spark.createDataFrame(rows, "id string, v double, d int, c array<struct<kind:string,ref:string>>, l array<string>, u string, p array<double>, w string")
    numbers = spark.createDataFrame([("part", "p", 12.5, None, "money"), ("part", "p", -3_210_000.0, None, None), ("part", "p", 77.0, None, "money"), ("text", "t", 500.0, ["sales"], None), ("text", "t", 611.0, ["sales"], None), ("text", "t", 612.0, ["sales"], None), ("text", "t", None, None, None)], "kind string, ref string, number double, around array<string>, unit string")
    got = {r.id: (r["class"], r.number, r.scale) for r in C.checked(figures, numbers, "id", "v", "d", "c", [("own", "part", False), ("context", "text", True)], label="l", unit="u", pool="p", written="w").collect()}
    none = lambda c: (c, None, None)
    assert got == {
        "own": ("own", 12.5, 0), "scaled": ("own", 3_210_000.0, 6), "clash": none("unverified"), "singled": ("context", 500.0, 0), "slip": none("weak"), "unlabelled": none("weak"),
        "sum": none("recomputed"), "written": none("formula"), "small": none("no fact"), "none": none("unverified"), "huge": none("unverified"),
    }


def test_pairs_equal_a_search_of_all(spark):
    rng = np.random.default_rng(1)
    rows, want = [], []
    for _ in range(300):
        xs = np.round(rng.normal(0, 60, rng.integers(0, 14)), 1)
        xs = xs[xs != 0]
        d, v = int(rng.integers(0, 2)), float(np.round(rng.normal(0, 80), 1))
        local = rng.random(len(xs)) < 0.6
        first = None
        for i, a in enumerate(xs):
            for j, b in enumerate(xs):
                if first is None and i != j and (local[i] or local[j]):
                    small = min(abs(a), abs(b)) < 10 * 10.0**-d
                    for k, r in enumerate((a + b, a - b, a * b, a / b, 100 * a / b, 100 * (a - b) / abs(b), a * b / 100)):
                        if abs(abs(v) - abs(r)) <= 0.5 * 10.0**-d + 1e-9 and not (k < 2 and small):
                            first = (k, i, j)
                            break
        rows.append((v, d, xs, local))
        want.append(first or (-1, 0, 0))
    bounds = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])])
    got = pairs.first_pairs(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows]), bounds)
    assert list(zip(*(x.tolist() for x in got))) == want and sum(w[0] >= 0 for w in want) > 50


def test_formulas(spark):
    names = {"a": [1.0, 2.0, 3.0, 4.0, None, 6.0], "b": [0.0, 5.0, 5.0, 5.0, 5.0, 5.0]}
    readings = spark.createDataFrame([("e", p, n, v) for n, vs in names.items() for p, v in enumerate(vs) if v is not None] + [("f", 3, "a", 9.0), ("f", 5, "a", 3.0)], "e string, p int, n string, v double")
    formulas = [("ratio", "a / b"), ("two", "sum_2q(a + b)"), ("back", "(a + b)_{t-1q} - a_{t - 2q}"), ("nested", "max_2q(sum(a, 2q))"), ("year", "yoy(a)"), ("bad", "a +"), ("call", "__import__('os')"), ("attr", "a.b"), ("number", "2 × 3 − 1"), ("long", "a+" * 2000 + "a"), ("deep", "(" * 900 + "a" + ")" * 900)]
    got = {(r.e, r.p, r.metric): (r.value, r.reason) for r in M.by_formulas(readings, formulas, ["e"], "p", "n", "v").collect()}
    at = lambda m, e="e": [got[e, p, m][0] for p in range(6) if (e, p, m) in got]
    assert at("ratio") == [None, 0.4, 0.6, 0.8, None, 1.2] and at("two") == [None, 8.0, 15.0, 17.0, None, None]
    assert at("back") == [None, None, 6.0, 6.0, 6.0, None] and at("nested") == [None, None, 5.0, 7.0, None, None]
    assert at("year") == [None, None, None, None, None, 2.0] and at("number") == [5.0] * 6 and at("two", "f") == [None, None]
    assert {m for (_, _, m), (_, why) in got.items() if why == "unreadable"} >= {"bad", "call", "attr", "long"} and got["e", 0, "ratio"][1] == "missing"
    assert M.by_formulas(readings, [], ["e"], "p", "n", "v").count() == 0 and M.by_formulas(readings.limit(0), formulas, ["e"], "p", "n", "v").count() == 0


def test_versions(spark):
    t = [datetime.datetime(2024, 1, d) for d in range(1, 8)]
    log = spark.createDataFrame([("x", t[0], 1, "one"), ("x", t[1], 2, "one"), ("x", t[2], 3, None), ("x", t[3], 4, "two"), ("x", t[3], 5, "three"), ("y", t[1], 6, None), ("y", t[4], 7, "why")], "path string, at timestamp, sha int, body string")
    spans = sorted((r.path, r.since.day, r.until and r.until.day, r.sha, r.body) for r in H.versions(log, ["path"], "at", ["sha"], "body").collect())
    assert spans == [("x", 1, 3, 1, "one"), ("x", 4, None, 5, "three"), ("y", 5, None, 7, "why")]
    assert {r.path: r.first_added.day for r in H.first_added(log, ["path"], "at", "body").collect()} == {"x": 1, "y": 5}
    asked = spark.createDataFrame([("x", t[0]), ("x", t[1]), ("x", t[3]), ("x", t[5]), ("z", t[5])], "path string, moment timestamp")
    for bucket in (None, lambda c: F.date_trunc("day", c)):
        got = sorted((r.path, r.moment.day, r.body or "") for r in H.before(asked, log, ["path"], "moment", "at", ["sha"], "body", bucket).collect())
        assert got == [("x", 1, ""), ("x", 2, "one"), ("x", 4, ""), ("x", 6, "three"), ("z", 6, "")]
    assert [tuple(r)[2] for r in H.first_where(log, ["path"], "at", ["sha"], F.col("body").like("t%")).collect()] == [4]


def test_canonical_json(spark):
    rows = [('{"b": 1, "a": {"z": [1, 2], "y": null}}', '{"a":{"y":null,"z":[1,2]},"b":1}'), ("[2, 1]", "[2,1]"), ('{"a": 1,', None), (None, None), ('{"a": 1, "a": 2}', None)]
    got = [r.c for r in spark.createDataFrame([(a,) for a, _ in rows], "t string").select(T.canonical_json("t").alias("c")).collect()]
    assert got == [b for _, b in rows]


@pytest.mark.parametrize("cuts", [[], [3], [1, 5]])
def test_events_go_on_after_a_restart(spark, tmp_path, cuts):
    """One run, or several from the same checkpoint: the same events with the same attachments."""
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = [(1, at(0), 1, "open"), (1, at(2), 2, "open"), (2, at(3), 3, "open"), (1, at(5), 4, "close"), (1, at(6), 5, "close"), (2, at(20), 6, "open"), (3, at(50), 7, "other"), (3, at(59), 8, "open")]
    kinds, here = "key long, at timestamp, id long, kind string", str(tmp_path / "in")
    out = None
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], kinds).coalesce(1).write.mode("append").parquet(here)
        stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(here).withWatermark("at", "0 seconds")
        out = W.run_to_end(W.event_states(stream, "open", "close", 10 * 60 * 1_000_000), spark, str(tmp_path / "out"), str(tmp_path / "marks"))
    got = sorted((r.key, r.opened_id, r.closed_at.minute, r.closed_by, r.attached) for r in out.collect())
    assert got == [(1, 1, 5, "close", [2]), (2, 3, 13, "timer", []), (2, 6, 30, "timer", [])]


def test_what_numbers_are(spark):
    from tidemark.functions.mentions import mentions

    text = "Sales rose 4.5% on 12 March 2024 (see Notes 3, 4 and 5; page 7) to $1,250 million (1), about 9 times July 4 figures, and May 2024. Items to 8"
    got = [tuple(r) for r in spark.createDataFrame([(text,)], "t string").select(mentions("t").alias("m")).first().m]
    assert got == [
        ("4.5%", "value", None), ("12", "day", None), ("2024", "year", None), ("3", "reference", None), ("4", "reference", None), ("5", "reference", None), ("7", "reference", None),
        ("$1,250", "value", "million"), ("1", "note", None), ("9", "value", None), ("4", "day", None), ("2024", "year", None), ("8", "reference", None),
    ]
    assert spark.createDataFrame([("",), (None,)], "t string").select(mentions("t").alias("m")).collect() == [([],), (None,)]


@pytest.mark.parametrize("few", [0, 3, 6, pairs.FEW])
def test_pairs_are_the_same_by_lookup_and_one_by_one(monkeypatch, few):
    """Rows of many and of few numbers in one batch; those of few need no lookups."""
    rng = np.random.default_rng(2)
    lens = rng.integers(0, 12, 200)
    bounds = np.concatenate([[0], np.cumsum(lens)])
    numbers, local = np.round(rng.uniform(1, 60, bounds[-1]), 1), rng.random(bounds[-1]) < 0.5
    rows = np.round(rng.uniform(10, 90, 200), 1), rng.integers(0, 2, 200), numbers, local, bounds
    want = [x.tolist() for x in pairs.first_pairs(*rows)]
    looked_up = []
    monkeypatch.setattr(pairs, "_place", lambda values, *more, run=pairs._place: looked_up.append(len(more[0])) or run(values, *more))
    monkeypatch.setattr(pairs, "FEW", few)
    assert [x.tolist() for x in pairs.first_pairs(*rows)] == want and sum(x >= 0 for x in want[0]) > 40
    assert set(looked_up) == ({int(lens[lens > few].sum())} if few < 12 else set())
