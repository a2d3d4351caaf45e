"""From raw documents to token ids: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of documents, others that docs may have included; the last returns a row of digests for each document left.
Null and empty texts are clean and stay, as do rows without an id (near duplicates are told by ids, so those link with
nothing); rows that are there twice are judged alike and stay twice; no rows give no rows; texts of any length are whole.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, common, near_dup, positional, substring, toxicity
from tidemark.llm.common import scratch, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_left: list[str] = []  # scratch tables that the stage before needed


def _stage(fn):
    """A stage begins when the rows of the one before are written: that one's scratch tables go."""

    @wraps(fn)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.discard(spark, _left)
        start = len(common.made)
        out = fn(spark, docs, sf_dir)
        _left[:] = common.made[start:]
        return out

    return begin


@_stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Learned from the training rows of docs and the labels, as op4 does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    index = toxicity.learn(docs.where(~toxicity.held_out()), labels)
    return toxicity.score(docs, index, carry=docs.columns).where("predicted = 0").select(*docs.columns)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return near_dup.deduplicate(docs)


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside passages of 20 words or more that also begin earlier go; the text of a document that loses some is the
    rest, joined by single spaces, and n_chars its length. Other documents stay as they are, and none is dropped."""
    cut = substring.dedup_substrings(docs, carry=docs.columns)
    changed = F.col("n_removed") > 0
    return cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text"))).withColumn("n_chars", F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words at least a twentieth belong to windows of benchmark items go. Rows are told apart by a hash of
    id and text, so those without an id, or with another's, are judged by their own text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = F.xxhash64("doc_id", "text")
    found = positional.decontaminate(docs.select(own.alias("id"), "text"), items, id_col="id")
    marked = stored(found.where("contaminated").select("id"), "contaminated").distinct()
    return docs.join(marked, own == marked["id"], "left_anti").select(*docs.columns)


@_stage
def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document left."""
    import public_tokenizers

    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_bytes),
]

#: Toxicity is learned and the ids come from a vocabulary: no SQL gives run()'s rows. tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
