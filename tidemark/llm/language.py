"""Language identification by bit-sliced Bloom filters of n-grams.

One table of masks serves all languages, in as many 64-bit words a slot as they need: bit l of a slot says that some
n-gram of language l hashes there. The conjunction of an n-gram's slots is the mask of all languages that contain it, in one lookup. A text's score
for a language is the count of its n-grams with that bit, corrected for the filter's false positives, which are known
from the fill of the bit slice. N-grams are 2 to 4 bytes of the lower-cased text, everything but letters one space.

An n-gram is in a language if it makes up at least RATE of the language's n-grams and SHARE of its rate in the language
that uses it most. Learned from a bounded sample: the `sample` training rows (default 20,000) of smallest hash of the id,
an equal part for each language. Ids only choose the sample; prediction reads text alone.
Defined results: null text or text without a letter: `und` with score 0; rows without lang aren't learned from; no
training rows: every text is `und`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (2, 3, 4)
SLOTS = 1 << 19
HASHES = 3
RATE, SHARE = 2e-5, 0.25
GRAMS = 30_000  # n-grams of a language in the filter, the most frequent
GAP = re.compile(r"[\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
STEP = 1 << 19


def normal(text: str) -> bytes:
    return f" {GAP.sub(' ', text).lower().strip()} ".encode() if LETTER.search(text) else b""


def grams(buf: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that begins at each byte, as a number that also holds its length."""
    key = np.full(max(0, len(buf) - n + 1), n, np.uint64)
    for i in range(n):
        key = key << np.uint64(8) | buf[i : len(buf) - n + 1 + i]
    return key


def slots(keys: np.ndarray):
    h = keys * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    bits = SLOTS.bit_length() - 1
    for i in range(HASHES):
        yield (h >> np.uint64(64 - bits * (i + 1))) & np.uint64(SLOTS - 1)


class Model:
    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table.reshape(SLOTS, -1)
        fill = np.array([((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        self.false = fill**HASHES

    def counts(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each text, and for each language those whose mask has its bit. Texts begin and end with a space."""
        n_docs, n_langs = len(bounds) - 1, len(self.languages)
        total, found = np.zeros(n_docs), np.zeros((n_docs, n_langs))
        for n in SIZES:
            keys = grams(buf, n)
            mask = None
            for at in slots(keys):
                got = self.table[at]
                mask = got if mask is None else mask & got
            lens = np.maximum(np.diff(bounds) - n + 1, 0)  # n-grams across texts don't count
            total += lens
            low = np.minimum(bounds[:-1], len(keys))
            for i in range(n_langs):
                sums = np.concatenate([[0], np.cumsum((mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)])
                found[:, i] += sums[low + np.minimum(lens, len(keys) - low)] - sums[low]
        return total, found

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        total, found = self.counts(np.frombuffer(b"".join(texts), np.uint8), bounds)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        true = np.maximum(found - total[:, None] * self.false, 0) / (1 - self.false)
        best, whole = true.argmax(axis=1), true.sum(axis=1)
        score = np.where(whole > 0, true.max(axis=1) / np.maximum(whole, 1e-9), 0.0)
        named = [self.languages[b] if t else "und" for b, t in zip(best.tolist(), texts)]
        return named, np.where([bool(t) for t in texts], np.clip(score, 0, 1), 0.0)


def _count(batches):
    for batch in batches:
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, []).append(normal(text or ""))
        for lang, texts in by.items():
            buf = np.frombuffer(b" ".join(texts), np.uint8)
            for n in SIZES:
                keys, counts = np.unique(grams(buf, n), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 20_000) -> Model:
    """A model from rows with a language. Counting runs in Spark; the model's size is bounded by languages and GRAMS."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((SLOTS, 1), np.uint64))
    each = max(1, sample // len(languages))
    # Only hashes low enough for half as many again are ranked: the ranking's input doesn't grow with the table.
    shares = spark.createDataFrame([(lang, (1.5 * each + 200) / n) for lang, n in sizes.items()], "lang string, share double")
    ranked = rows.select("lang", F.xxhash64("id").alias("h")).join(F.broadcast(shares), "lang").where(F.col("h") / F.lit(2.0**64) + 0.5 < F.col("share"))
    cut = ranked.selectExpr("lang", "h", "row_number() over (partition by lang order by h) as k").where(f"k <= {each}").groupBy("lang").agg(F.max("h").alias("most"))
    most = spark.createDataFrame([(r["lang"], r["most"]) for r in cut.collect()], "lang string, most long")
    chosen = rows.join(F.broadcast(most), "lang").where(F.xxhash64("id") <= F.col("most")).select("lang", "text")
    counted = chosen.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    per_lang = "sum(n) over (partition by lang)"
    rated = counted.selectExpr("lang", "gram", f"n / {per_lang} as rate").where(f"rate >= {RATE}")
    rated = rated.selectExpr("lang", "gram", "rate", "max(rate) over (partition by gram) as top").where(f"rate >= {SHARE} * top")
    kept = rated.selectExpr("lang", "gram", "row_number() over (partition by lang order by rate desc, gram) as k").where(f"k <= {GRAMS}").select("lang", "gram").toPandas()
    table = np.zeros((SLOTS, -(-len(languages) // 64)), np.uint64)
    number = {lang: i for i, lang in enumerate(languages)}
    for lang, part in kept.groupby("lang"):
        word, bit = divmod(number[lang], 64)
        for at in slots(part["gram"].to_numpy(np.int64).view(np.uint64)):
            table[at, word] |= np.uint64(1 << bit)
    return Model(languages, table)


def identify(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Carried columns, lang_pred and score of every row of docs."""
    carry = ["doc_id"] if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    chosen = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = T.StructType([*chosen.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(kind)

    def run(batches):
        model_ = shared.value
        for batch in batches:
            texts, at = batch.column(batch.num_columns - 1), 0
            names: list[str] = []
            scores: list[np.ndarray] = []
            while at < batch.num_rows:
                part, size = [], 0
                while at < batch.num_rows and (not part or size < STEP):
                    part.append(normal(texts[at].as_py() or ""))
                    size += len(part[-1])
                    at += 1
                a, b = model_.predict(part)
                names += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], schema=schema)

    return chosen.mapInArrow(run, kind).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "lang_pred", "score")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = learn(docs.where("not held_out"))
    return identify(docs, model, carry=["doc_id", "held_out"])
