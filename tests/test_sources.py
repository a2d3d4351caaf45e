"""Landed files to tables and back, issuers' events, and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.operators import facts, filings, holdings
from tidemark.sources import landed, sinks
from tidemark.streaming import machines

day = dt.date.fromisoformat


def put(folder, name, body):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body if isinstance(body, str) else json.dumps(body, indent=1))
    return str(path)


FILINGS = [  # accession, filed, report date, accepted, form, items
    ("0000000009-25-000009", "2025-10-30", "2025-10-30", "20251030160000", "8-K", "2.02,9.01"),
    ("0000000009-25-000008", "2025-08-10", "2025-06-30", "20250810120000", "10-Q", ""),
    ("0000000009-25-000007", "2025-07-31", "2025-07-29", "20250731160000", "8-K", "2.02, 9.01"),
    ("0000000009-25-000006", "2025-08-02", "2025-08-01", "20250802160000", "8-K/A", "2.02"),
    ("0000000009-25-000005", "2025-08-01", "2025-08-01", "20250801160000", "8-K", "2.02,5.02"),
    ("0000000009-25-000002", "2025-05-01", "2025-03-31", "20250501120000", "10-Q", ""),
    ("0000000009-25-000001", "2025-02-20", "2024-12-31", "20250220120000", "10-K", ""),
]


def block(rows):
    names = ("accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "form", "items")
    return {n: [r[i] for r in rows] for i, n in enumerate(names)} | {"primaryDocument": ["d.htm"] * len(rows)}


def test_submissions_and_events(spark, tmp_path):
    put(tmp_path, "s/CIK0000000009.json", {"cik": "9", "name": "Nine", "fiscalYearEnd": "1231", "filings": {"recent": block(FILINGS[:5])}})
    put(tmp_path, "p/CIK0000000009-submissions-001.json", block(FILINGS[4:]))
    heads = landed.submissions(spark, str(tmp_path / "s"))
    pages = landed.submission_pages(spark, str(tmp_path / "p"))
    table = filings.from_blocks(heads.select("cik", "part", "block").unionByName(pages), "cik", "block").cache()
    assert table.count() == 7 and {r.cik for r in table.collect()} == {"0000000009"}
    assert filings.filer_type(table).first().filer_type == "domestic"
    events = filings.domestic_events(table.withColumn("m", F.lit(12)), "m", D.business_calendar(spark, 2024, 2026)).orderBy("period").collect()
    assert [(e.period, e.release_date, e.release_basis, e.closed_by, e.closes_on) for e in events] == [
        ("FY2025Q2", day("2025-07-29"), "report_date", "T+5", day("2025-08-07")),
        ("FY2025Q3", day("2025-10-30"), "acceptance", "T+5", day("2025-11-06")),
    ]
    assert events[0].related == ["0000000009-25-000005"] and events[0].amendments == ["0000000009-25-000006"] and events[0].closing == "0000000009-25-000008"


def test_learned_quarter_ends(spark):
    rows = [("9", "10-K", "2023-09-03"), ("9", "10-K", "2024-09-01"), ("9", "10-Q", "2023-11-26"), ("9", "10-Q", "2024-02-18"), ("9", "10-Q", "2024-05-12"), ("9", "10-Q", "2024-11-24")]
    table = spark.createDataFrame(rows, "cik string, form string, report_date string").withColumn("report_date", F.to_date("report_date")).withColumn("m", F.lit(8))
    known = filings.learned_quarter_ends(table, "m")
    assert sorted((r.fiscal_year, r.quarter, str(r.quarter_end)) for r in known.collect()) == [(2023, 4, "2023-09-03"), (2024, 1, "2023-11-26"), (2024, 2, "2024-02-18"), (2024, 3, "2024-05-12"), (2024, 4, "2024-09-01")]
    ahead = filings.project_quarter_ends(known, 1).where("projected and quarter = 1").first()
    assert (ahead.fiscal_year, ahead.quarter_end) == (2025, day("2024-11-24"))


def test_foreign_events(spark):
    rows = [("9", "A1", "6-K", "2026-05-20"), ("9", "A2", "6-K", "2026-05-22"), ("9", "A3", "6-K/A", "2026-06-01"), ("9", "A4", "6-K", "2026-05-01")]
    table = spark.createDataFrame(rows, "cik string, accession string, form string, f string").select("cik", "accession", "form", F.to_date("f").alias("filing_date"), F.lit(None).cast("timestamp").alias("accepted"), F.lit(12).alias("m"))
    texts = spark.createDataFrame([("A1", "Nine Reports First Quarter 2026 Results\nMay 20"), ("A2", "Nine Announces First Quarter 2026 Results"), ("A3", "Nine Reports First Quarter 2026 Results"), ("A4", "Nine to Report First Quarter 2026 Results")], "accession string, text string")
    got = filings.foreign_events(table, texts, "m").collect()
    assert [(e.period, e.accession, e.amendments) for e in got] == [("FY2026Q1", "A1", ["A3"])]


def test_facts(spark, tmp_path):
    row = lambda v, s, e, f: {"val": v, "start": s, "end": e, "filed": f, "accn": "a", "form": "10-K", "fp": "FY"}
    put(tmp_path, "f.json", {"cik": "9", "facts": {"us-gaap": {"Revenues": {"units": {"USD": [row(5, "2024-01-01", "2024-12-31", "2025-02-01"), row(1, "2024-10-01", "2024-12-31", "2025-02-01")]}}}, "other": {"Revenues": {"units": {"USD": [row(9, "2023-01-01", "2023-12-31", "2024-02-01")]}}, "Cash": {"units": {"USD": [row(3, None, "2024-12-31", "2025-02-01")]}}}}})
    flat = facts.flatten(landed.company_facts(spark, str(tmp_path)), "cik", "facts")
    assert flat.count() == 4
    assert sorted((r.taxonomy, r.concept, r.val) for r in facts.annual(flat, "cik").collect()) == [("other", "Cash", 3.0), ("us-gaap", "Revenues", 5.0)]
    rows = spark.createDataFrame([("a", []), ("b", ["a"]), ("c", ["a", "b"]), ("d", ["e"]), ("e", ["d"]), ("f", ["gone"])], "id string, inputs array<string>")
    assert {r.id: r.depth for r in facts.depth(rows, "id", "inputs").collect()} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": 0}


def test_prices_yields_and_holdings(spark, tmp_path):
    put(tmp_path, "prices/AB.json", {"data": {"tradesTable": {"rows": [{"date": "01/05/2026", "close": "$1,304.00"}, {"date": "01/02/2026", "close": "$2.50"}, {"date": "bad", "close": "$1"}]}}})
    assert sorted((r.symbol, str(r.date), r.close) for r in landed.price_history(spark, str(tmp_path / "prices")).collect()) == [("AB", "2026-01-02", 2.5), ("AB", "2026-01-05", 1304.0)]
    path = put(tmp_path, "y.csv", 'Date,"1 Mo","10 Yr"\n01/02/2026,4.1,4.5\n01/05/2026,4.1,\n')
    assert [(str(r.date), r.value) for r in landed.treasury_yields(spark, path).collect()] == [("2026-01-02", 4.5)]
    one = lambda n, v, s, extra="": f"<infoTable><nameOfIssuer>{n}</nameOfIssuer><titleOfClass>COM</titleOfClass><cusip>00a</cusip><value>{v}</value><shrsOrPrnAmt><sshPrnamt>{s}</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt>{extra}</infoTable>"
    path = put(tmp_path, "h/t.xml", "<informationTable>" + one("A", 10, 3) + one("A", 5, 1) + one("A", 99, 1, "<putCall>Put</putCall>") + "</informationTable>")
    rows = landed.information_table(spark, path).withColumn("filed", F.lit("2022-05-01").cast("date"))
    held = holdings.positions(rows, ["file"])
    assert [(r.cusip, r.shares, r.value) for r in held.collect()] == [("00A", 4, 15000)]
    listed = spark.createDataFrame([("00A", "CINS", "AB/C")], "code string, id_type string, ticker string")
    assert holdings.tickers(held, listed).first().ticker == "AB.C"


def test_documents_logs_and_runs(spark, tmp_path):
    path = put(tmp_path, "d.txt", "intro\n===== one =====\nbody\n===== two =====\nmore\n")
    assert [(r.name, r.body.strip()) for r in landed.delimited_documents(spark, path).collect()] == [("one", "body"), ("two", "more")]
    path = put(tmp_path, "log.jsonl", '{"timestamp": "2026-01-02T00:00:00Z", "cost_usd": 1.5, "usage": {"in": 3}}\nnot json\n{"cost_usd": 1}\n')
    assert [(r.cost_usd, r.usage) for r in landed.call_log(spark, path).collect()] == [(1.5, {"in": 3})]
    put(tmp_path, "w/runs/AB/2026-01-02-04A/out/x.yml", "a: 1\n")
    put(tmp_path, "w/runs/AB/2026-01-02-04A/manifest.json", "{}")
    got = landed.run_directories(spark, str(tmp_path / "w")).collect()
    assert [(r.scope, r.run_date, r.part, r.files) for r in got] == [("AB", "2026-01-02", "04A", ["manifest.json", "out/x.yml"])]
    pytest.importorskip("yaml")
    put(tmp_path, "y/a.yml", "a: 1\nd: 2026-01-02\n")
    put(tmp_path, "y/b.yml", "a: [\n")
    got = landed.yaml_documents(spark, str(tmp_path / "y")).select("file", F.col("data").cast("string").alias("d")).orderBy("file").collect()
    assert [json.loads(r.d) if r.d else None for r in got] == [{"a": 1, "d": "2026-01-02"}, None]
    path = put(tmp_path, "t.json", {"0": {"cik_str": 1, "ticker": "BRK-A", "title": "B"}, "1": {"cik_str": 1, "ticker": "brk-b", "title": "B"}, "2": {"cik_str": 2, "ticker": "X", "title": "X"}})
    assert {(r.ticker, r.cik, r.n_ciks) for r in landed.issuers_by_ticker(spark, path).collect()} == {("BRK-A", "0000000001", 1), ("BRK-B", "0000000001", 1), ("BRK", "0000000001", 1), ("X", "0000000002", 1)}


def test_sinks(spark, tmp_path):
    a, b = (spark.createDataFrame(r, "k long, v string") for r in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (1, "a")]))
    path = str(tmp_path / "register")
    assert sinks.register(a, path, "k").count() == 0
    assert [tuple(r) for r in sinks.register(b, path, "k").collect()] == [(2, "c")]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    sinks.replace(spark.read.parquet(path).where("k > 1"), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(2, "b"), (3, "d")]
    sinks.append_log(a, str(tmp_path / "log"))
    sinks.append_log(a, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    sinks.routed(a, str(tmp_path / "out"), "v")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if "=" in p.name) == ["v=a", "v=b"]


def test_event_machine_over_two_batches(spark, tmp_path):
    path = tmp_path / "events"
    kind = "key long, at timestamp, id long, kind string"
    t = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    spark.createDataFrame([(1, t(0), 1, "open"), (1, t(2), 2, "open"), (2, t(1), 3, "open"), (1, t(3), 4, "close"), (3, t(5), 5, "close")], kind).coalesce(1).write.parquet(str(path))
    spark.createDataFrame([(2, t(40), 6, "open"), (4, t(50), 7, "open")], kind).coalesce(1).write.mode("append").parquet(str(path))
    stream = machines.files(spark, str(path), 1).withWatermark("at", "0 seconds")
    got = machines.drained(machines.event_machine(stream, "open", "close", 10_000_000), spark, "test").collect()
    assert sorted((r.key, r.opened_id, r.closed_by, r.related) for r in got) == [(1, 1, "close", 1), (2, 3, "timer", 0)]


def test_event_machine_takes_a_keys_records_in_order_whatever_the_batches(spark, tmp_path):
    """One key's records in many Arrow batches, out of order, with ties of time; and records of other kinds move the watermark."""
    from tidemark.streaming import events, machines

    rows = [(1, 10, 7, "open"), (1, 10, 8, "open"), (1, 10, 6, "close"), (1, 14, 9, "open"), (1, 14, 10, "close"), (1, 20, 11, "open"), (1, 45, 12, "open"), (1, 44, 13, "other"), (2, 5, 14, "open"), (3, 99, 15, "other")]
    rows = [*rows[::-1], *((4, 2 * i, 100 + i, "open" if i % 3 else "close") for i in range(40, 0, -1))]
    frame = spark.createDataFrame(rows, "key long, s long, id long, kind string").selectExpr("key", "timestamp_seconds(s) as at", "id", "kind")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "3")
    try:
        stream = lambda: machines.files(spark, str(tmp_path / "in")).withWatermark("at", "0 seconds")
        counted = machines.drained(machines.event_machine(stream(), "open", "close", 10_000_000), spark, "order").collect()
        kept = events.run_to_end(events.event_states(stream(), "open", "close", 10_000_000), spark, str(tmp_path / "out"), str(tmp_path / "marks")).collect()
    finally:
        spark.conf.set(batch, before)
    want = [(1, 7, 14, "close", [8, 9]), (1, 11, 30, "timer", []), (1, 12, 55, "timer", []), (2, 14, 15, "timer", [])]
    want += [*((4, 100 + i, 2 * i + 4, "close", [101 + i]) for i in range(1, 40, 3)), (4, 140, 90, "timer", [])]
    assert sorted((r.key, r.opened_id, int(r.closed_at.timestamp()), r.closed_by, r.related) for r in counted) == [(*w[:4], len(w[4])) for w in want]
    assert sorted((r.key, r.opened_id, int(r.closed_at.timestamp()), r.closed_by, r.attached) for r in kept) == want
