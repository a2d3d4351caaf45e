"""Operators that select their columns first, on tables whose other columns have names used inside, with repeated rows and none."""

import pytest

from tidemark.llm import language, token_counts, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
KINDS = "doc_id long, text string, lang string, n_bytes string, n_tokens string, over_limit string, score string, lang_pred string, seg int"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, g, "x", "y", "z", "s", "p", 7) for d, t, g in rows], KINDS)


@pytest.mark.parametrize("rows", [[(1, "ka to ri", "aa"), (1, "ka to ri", "aa"), (2, None, "bb"), (None, "der die das", "bb"), (None, None, None)], []])
def test_token_counts_and_languages(spark, rows):
    df = docs(spark, rows)
    counted = token_counts.token_counts(df, public_tokenizers.path("word_bpe_49k.json"))
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(str, (r.n_bytes for r in counted.collect()))) == sorted(str(len(t or "")) for _, t, _ in rows)
    model = language.learn(df.where("lang is not null")) if rows else language.learn(docs(spark, [(1, "ka to ri", "aa")]))
    assert language.identify(df, model, carry=["doc_id"]).count() == len(rows)


@pytest.mark.parametrize("n", [3, 0])
def test_archives(spark, tmp_path, n):
    pages = [(i, f"http://h/{i}", "<p>same</p>", "x", 1, b"b") for i in range(n)] + [(9, None, None, "x", 1, b"b")] * bool(n)
    df = spark.createDataFrame(pages, "page_id long, url string, html string, origin string, segment int, payload binary")
    path = str(tmp_path / "warc")
    warc.write_archives(df, path)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_records(spark, path).collect()) if n else []
    assert got == ([(0, "response", None), (1, "revisit", 0), (2, "revisit", 0), (9, "response", None)] if n else [])


def test_a_carried_text_stands_once_in_the_batches_that_are_scored(spark):
    from tidemark.llm import toxicity

    rows = [(i, f"word{i % 3} bad idea" if i % 2 else f"word{i % 3} good idea", "en") for i in range(60)] + [(90, None, None), (91, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    index = toxicity.learn(df, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    carried = toxicity.score(df, index, carry=["doc_id", "text", "lang"])
    assert carried._jdf.queryExecution().analyzed().toString().count(" AS text#") == 1  # the result, no second copy before it
    got, want = carried.orderBy("doc_id").collect(), toxicity.score(df, index).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.lang) for r in got] == rows
    assert [(r.score, r.predicted, r.neighbours) for r in got] == [(r.score, r.predicted, r.neighbours) for r in want]
