"""The registered queries themselves, over tables with odd rows: against their SQL, their library or a plain version; and every
operator and stage on rows without values, repeated rows, very long texts, no rows, and columns with names used inside."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_queries import normal
from tidemark.llm import byte_bpe, language, near_dup, positional, queries, substring, suffixes, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
duckdb = pytest.importorskip("duckdb")

PLAIN = ["ka to ri mu", "schung eit ver", "ção lho nha", "der die das und"]
LANGS = ["aa", "bb", "cc", "dd"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """documents, labels, benchmark, pages and embeddings with copies, near copies, shared passages, nulls, empties and a long text."""
    rng, root = random.Random(31), tmp_path_factory.mktemp("tables")
    rows, labels = [], []
    passage = " ".join(f"shared{i}" for i in range(40))
    for i in range(240):
        lang = i % 4
        words = [rng.choice(PLAIN[lang].split()) + rng.choice("abcdefgh") for _ in range(rng.randint(6, 60))]
        bad = i % 6 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["vilescum", "nastyrot"]))
        if i % 9 == 0:
            words += passage.split()
        rows.append((i, " ".join(words), LANGS[lang], "s", 0))
        labels.append((i, i % 2, int(bad)))
    near = rows[3][1].split() + [f"n{i}" for i in range(60)]
    rows += [(300, None, None, None, 0), (301, "", "aa", "s", 0), (302, rows[4][1], "aa", "s", 0), (303, rows[4][1], "aa", "s", 0), (304, " ".join(near), "aa", "s", 0), (305, " ".join(["x", *near[1:]]), "aa", "s", 0)]
    rows += [(306, "long text of words " * 3000, "bb", "s", 0), (307, "漢字の文章" * 3000, "cc", "s", 0), (308, "!!! 123", "dd", "s", 0)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    items = [(1, " ".join(f"shared{i}" for i in range(5, 30))), (2, rows[7][1]), (3, None), (4, ""), (10, "SHARED1 shared2")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    pages = [(i, f"http://h/{i % 5}", rng.choice(["<p>a</p>", "<p>b\r\né</p>", "", None, "<b>" + "long" * 40000])) for i in range(40)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    v = np.random.default_rng(3).standard_normal((120, 8)).astype(np.float32)
    v[60:70] = v[3]
    vectors = [(i, x.tolist(), i % 5 or None) for i, x in enumerate(v)] + [(200, None, 1), (220, [0.0] * 8, 9)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return str(root), rows, labels, v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables[0]}/{t}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, tables[0])
    result = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(result.fetchall(), columns)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_queries_without_sql(spark, tables):
    root, rows, labels, v = tables
    text = {r[0]: r[1] or "" for r in rows}
    tk = token_counts.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in queries.QUERIES["op1_token_counts"](spark, root).collect()}
    for d, t in text.items():
        n = len(tk.encode(t, add_special_tokens=False).ids)
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len(t.encode()), n, n > 2048)

    lang = {r.doc_id: r for r in queries.QUERIES["op2_language_id"](spark, root).collect()}
    assert set(lang) == set(text) and all(lang[d].held_out == held(d) for d in text)
    right = sum(lang[r[0]].lang_pred == r[2] for r in rows if r[0] < 240)
    assert right >= 228, right  # shared passages and bad words are in every language
    assert all(lang[d].lang_pred == "und" for d in (300, 301, 308))

    toxic = {r.doc_id: r for r in queries.QUERIES["op4_toxicity"](spark, root).collect()}
    assert set(toxic) == set(text) and all(toxic[d].held_out == held(d) and 0 <= toxic[d].score <= 1 for d in text)
    assert sum(toxic[d].predicted == y for d, _, y in labels) > 0.97 * len(labels)
    assert toxic[302].score == toxic[303].score == toxic[4].score

    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.QUERIES["op7_byte_bpe"](spark, root).collect():
        ids = library.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()

    near: dict = {}
    for r in queries.QUERIES["op6_nearest_neighbours"](spark, root).orderBy("query_id", "rank").collect():
        near.setdefault(r.query_id, []).append(r.vec_id)
    d = v.astype(float)
    for q in range(0, 120, 20):
        order = [i for i in np.lexsort([np.arange(120), -(d @ d[q]).round(12)]) if i != q][:20]
        assert near[q] == order
    assert sorted(near) == list(range(0, 120, 20))


def count_false_positives(languages, grams):
    table = np.zeros(language.SLOTS, np.uint64)
    for bit in range(languages):
        for at in language.slots(grams[bit]):
            table[at] |= np.uint64(1 << bit)
    return language.Model([f"l{i}" for i in range(languages)], table)


def test_language_counts_are_corrected(monkeypatch):
    """Counts of a full filter, corrected, come near those of exact sets."""
    monkeypatch.setattr(language, "SLOTS", 1 << 12)
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnop", np.uint8)
    texts = [bytes(rng.choice(letters[i * 5 : i * 5 + 9], 4000)) for i in range(2)]
    own = [np.unique(np.concatenate([language.grams(np.frombuffer(t, np.uint8), n) for n in language.SIZES])) for t in texts]
    model = count_false_positives(2, own)
    asked = b" " + bytes(rng.choice(letters, 3000)) + b" "
    total, found = model.counts(np.frombuffer(asked, np.uint8), np.array([0, len(asked)]))
    grams = np.concatenate([language.grams(np.frombuffer(asked, np.uint8), n) for n in language.SIZES])
    assert total[0] == len(grams) and (model.false > 0.02).any()
    for i in range(2):
        exact = np.isin(grams, own[i]).sum()
        corrected = (found[0, i] - total[0] * model.false[i]) / (1 - model.false[i])
        assert found[0, i] >= exact and abs(corrected - exact) < abs(found[0, i] - exact) + 1 and abs(corrected - exact) < 0.05 * total[0]


def test_ties_of_languages_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "kato rimu", "b", 1), (2, "kato rimu", "a", 1), (None, None, "a", 1), (None, "kato", None, 1)], "doc_id long, text string, lang string, score int")
    model = language.learn(docs)
    got = language.identify(docs.drop("score"), model, carry=["doc_id", "lang"]).collect()
    assert [r.lang_pred for r in got] == ["a", "a", "und", "a"]  # of equal counts the first name
    long = spark.createDataFrame([(1, "kato rimu " * 100_000)] * 2, "doc_id long, text string")
    assert [r.lang_pred for r in language.identify(long, model).collect()] == ["a", "a"]
    assert language.identify(docs.where("false"), model, carry=["doc_id"]).count() == 0


CLASH = "doc_id long, text string, seg long, id long, segment long, ids string, terms string, h string, label int, bucket long"


def clashing(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, 3, "i", "t", "h", 0, 4) for d, t in rows], CLASH)


def test_clashing_columns_repeated_rows_and_no_rows(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (None, "one two three four five six"), (None, None)]
    for rows_ in (rows, []):
        docs = clashing(spark, rows_)
        assert near_dup.near_duplicates(docs).count() == len(rows_) and near_dup.deduplicate(docs).columns == docs.columns
        assert substring.dedup_substrings(docs, carry=docs.columns).count() == len(rows_)
        assert suffixes.dedup_bytes(docs, carry=docs.columns).count() == len(rows_)
        assert byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).count() == len(rows_)
        got = positional.decontaminate(docs, spark.createDataFrame([(1, "two three"), (None, "five six")], "item_id long, text string")).collect()
        assert len(got) == len(rows_) and all(r.n_hit == (4 if r.n_words else 0) and r["items"] == ([1] if r.n_words else []) for r in got)
        index = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", F.lit(1).alias("toxic")))
        assert toxicity.score(docs, index, carry=docs.columns).count() == len(rows_)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, tables, stage):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    name, fn = corpus_pipeline.STAGES[stage]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, seg string, id long"
    rows = [(1, "ka to ri mu " * 12, "aa", "s", 1, "x", 9), (1, "ka to ri mu " * 12, "aa", "s", 1, "x", 9), (2, None, None, None, None, None, None), (None, "der die das", "dd", "s", 1, "x", 9), (None, None, None, None, None, None, None), (5, "", "aa", "s", 0, "x", 9), (6, "wörter und worte " * 20_000, "dd", "s", 1, "x", 9)]
    got = fn(spark, spark.createDataFrame(rows, kinds), tables[0])
    assert got.count() == len(rows), name
    if name != "byte_bpe":
        assert got.columns == [c.split()[0] for c in kinds.split(", ")]
    none = fn(spark, spark.createDataFrame([], kinds), tables[0])
    assert none.count() == 0 and none.columns == got.columns


def test_contaminated_rows_without_an_id_go(spark, tables):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    passage = " ".join(f"shared{i}" for i in range(5, 30))
    rows = [(None, passage, "aa", "s", 1), (7, passage, "aa", "s", 1), (7, "clean words of a row with the same id", "aa", "s", 1), (None, "clean", "aa", "s", 1)]
    got = dict(corpus_pipeline.STAGES)["decontamination"](spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), tables[0])
    assert sorted(r.text for r in got.collect()) == ["clean", "clean words of a row with the same id"]
