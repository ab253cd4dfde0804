"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read back as the next stage's documents; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from carestar.llm import bpe, jaccard, langid, mixing, substring
from carestar.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters, no text) go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles stays."""
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id also has are cut out;
    documents of which nothing is left go."""
    return substring.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, whole epochs and a last cut."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and the way back."""
    return bpe.encode_documents(docs)


STAGES = [("language_id", identify_language),
          ("ngram_jaccard", near_duplicates),
          ("substring_dedup", repeated_passages),
          ("mix_sources", mix_sources),
          ("byte_bpe", encode)]

# Language identification has no SQL form; tests/llm compares the stages
# with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path = f"{root}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
