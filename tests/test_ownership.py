"""Ownership documents whole: both tables, holdings, footnotes by id; and pieces of long texts."""

from pyspark.sql import functions as F

from tidemark.operators import edits as E
from tidemark.operators import packing as P
from tidemark.operators import units as U
from tidemark.functions import values as V
from tidemark.sources import landed as S

FORM = """<ownershipDocument><documentType>4</documentType><issuer><issuerCik>1</issuerCik><issuerTradingSymbol>ACME</issuerTradingSymbol></issuer>
<reportingOwner><reportingOwnerId><rptOwnerName>Doe Jo</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>true</isOfficer></reportingOwnerRelationship></reportingOwner>
<nonDerivativeTable>
<nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2024-01-02</value></transactionDate><transactionCoding><transactionCode>S</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>10</value><footnoteId id="F1"/></transactionShares><transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>90</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>
<nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2024-01-02</value></transactionDate><transactionCoding><transactionCode>S</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>5</value><footnoteId id="F2"/></transactionShares><transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>85</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>
<nonDerivativeHolding><securityTitle><value>Common</value></securityTitle><postTransactionAmounts><sharesOwnedFollowingTransaction><value>7</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership><natureOfOwnership><value>By trust</value><footnoteId id="F3"/></natureOfOwnership></ownershipNature></nonDerivativeHolding>
<nonDerivativeHolding><securityTitle><value>Common</value></securityTitle><postTransactionAmounts><sharesOwnedFollowingTransaction><value>7</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership></ownershipNature></nonDerivativeHolding>
</nonDerivativeTable>
<derivativeTable><derivativeTransaction><securityTitle><value>Option</value></securityTitle><conversionOrExercisePrice><value>3.5</value><footnoteId id="F9"/></conversionOrExercisePrice><transactionDate><value>2024-01-03</value></transactionDate><transactionCoding><transactionCode>A</transactionCode><footnoteId id="F1"/></transactionCoding><transactionAmounts><transactionShares></transactionShares></transactionAmounts><underlyingSecurity><underlyingSecurityTitle><value>Common</value></underlyingSecurityTitle></underlyingSecurity></derivativeTransaction></derivativeTable>
<footnotes><footnote id="F1">Under a plan.</footnote><footnote id="F2">Sold at $12.10 to $12.50.</footnote><footnote id="F3">Held by a trust.</footnote></footnotes></ownershipDocument>"""


def test_ownership_documents(spark, tmp_path):
    (tmp_path / "form.xml").write_text(FORM)
    (tmp_path / "empty.xml").write_text("<ownershipDocument><documentType>3</documentType><issuer><issuerCik>2</issuerCik></issuer></ownershipDocument>")
    rows = S.ownership(spark, str(tmp_path)).collect()
    assert {(r.owners, r.roles, r.ticker) for r in rows} == {("Doe Jo", "director, officer", "ACME")}
    got = sorted((r.derivative, r.kind, r.security, r.day or "", r.nature or "", r.fills, r.shares, r.owned_after, r.exercise_price, r.underlying, r.footnotes) for r in rows)
    assert got == [
        (False, "holding", "Common", "", "I", 1, None, 7.0, None, None, []), (False, "holding", "Common", "", "I", 1, None, 7.0, None, None, ["Held by a trust."]),
        (False, "transaction", "Common", "2024-01-02", "D", 2, 15.0, 85.0, None, None, ["Under a plan."]), (True, "transaction", "Option", "2024-01-03", "", 1, None, None, 3.5, "Common", ["Under a plan."]),
    ]
    trades = S.ownership_trades(spark, str(tmp_path)).collect()
    assert [(r.security, r.fills, r.shares, r.owned_after) for r in trades] == [("Common", 2, 15.0, 85.0)]


def test_landed_pages_and_history(spark, tmp_path):
    (tmp_path / "p.html").write_text("<html><head><title>t</title></head><body><p>One</p><p>two</p></body></html>")
    (tmp_path / "log.json").write_text('{"commit": "c1", "at": "2024-01-02T03:04:05Z", "files": ["a", "b"]}\n{"commit": "c2", "at": "soon", "files": ["a"]}\n')
    assert [tuple(r) for r in S.html_documents(spark, str(tmp_path / "p.html")).collect()] == [("p.html", "One\ntwo")]
    log = sorted((r.commit, r.at and r.at.day, r.path) for r in S.version_log(spark, str(tmp_path / "log.json")).collect())
    assert log == [("c1", 2, "a"), ("c1", 2, "b"), ("c2", None, "a")]


def test_long_texts_are_cut(spark):
    texts = ["", "short", "a\nB two\nc\nD four\nlong e", "x" * 95, "\n".join("Line %d" % i for i in range(30)), "no\nbreaks\nat all\nhere\n" * 4, None, "B\n" + "y" * 45 + "\nB end"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("c", P.cut_long("t", 20, lambda x: x.rlike("^[A-Z]"))).orderBy("k").collect()
    for r in rows:
        if r.t is None:
            assert r.c is None
            continue
        assert all(x["size"] <= 20 and x["size"] == len(x["piece"]) + 1 for x in r.c)
        assert "".join(x["piece"] for x in r.c).replace("\n", "") == r.t.replace("\n", "")
    assert [x["piece"] for x in rows[2].c] == ["a\nB two\nc", "D four\nlong e"]
    assert [len(x["piece"]) for x in rows[3].c] == [19] * 5


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, "mine", "kept")], "k int, status string, other string")
    assert tuple(E.overlay_fields(df, {"status": F.lit("final")}).first()) == (1, "final", "kept")
    agents = ["Acme Research jo@acme.org", "Acme", "", None, "@x.org"]
    assert [r.a for r in spark.createDataFrame([(a,) for a in agents], "a string").select(V.contact_agent("a").alias("a")).collect()] == [True, False, False, False, False]
    units = spark.createDataFrame([(["A"], ["B"]), (["A", "C"], [])], "own array<string>, context array<string>")
    docs = spark.createDataFrame([("A", None, "too large"), ("B", "text", None)], "tag string, text string, why string")
    assert sorted(tuple(r) for r in U.unreadable(units, docs, "tag", "text", "why").collect()) == [("A", "too large"), ("C", "not registered")]
