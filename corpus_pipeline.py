"""A training corpus from raw documents: five stages, each an operator of ``demandcast.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. ``run``
writes each result as Parquet to the shared folder and reads it again for the next stage.
Stages with Python workers exchange small batches with them, so that an executor's memory holds through all five.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.llm import bpe, decontam, langid, linededup, neardup
from demandcast.llm.common import drop_keys, small_batches, table
from demandcast.session import materialise

#: Bits per byte above which even the best language does not explain a text (random bytes take 8).
FOREIGN_BITS = 6.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters or that no learned language explains."""
    small_batches(spark)
    model = langid.train(docs)
    seen = langid.identify(docs, model, lang_pred="_lang", score="_score", bits="_bits")
    return seen.where((F.col("_lang") != langid.UNDETERMINED) & (F.col("_bits") <= FOREIGN_BITS)).select(*[seen[f"`{c}`"] for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that repeat an earlier one; documents made of such lines only are dropped."""
    small_batches(spark)
    kept = linededup.dedup_documents(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8)."""
    small_batches(spark)
    groups = neardup.near_duplicates(docs, percent=80)
    return drop_keys(docs, "doc_id", groups.where("NOT kept").select("doc_id"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a test item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document instead of its text, with the digest of the bytes they decode to."""
    small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN,
                      keep=[c for c in docs.columns if c != "text"], ids="ids", decoded_sha="decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", remove_benchmark),
    ("byte_bpe", tokenize),
]

#: Language models, sketches and tokens have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
