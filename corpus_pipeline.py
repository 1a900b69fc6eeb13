"""The corpus pipeline: documents to tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
works on all rows that the stage before kept. Every stage but the last returns the
columns of ``documents``; each result is written as Parquet to the shared folder and
read again. ``ORACLE_SQL`` is None: language models, boosted trees and piece
vocabularies have no SQL form; ``tests/llm/test_pipeline.py`` compares with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, pieces, pii, simhash
from tidemark.llm.common import stage, table, unstage

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a language that is likely enough go."""
    records = langid.records_of_documents(docs)
    return langid.identify(records, langid.fit(records)).where("kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return pii.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, ids, n_tokens, round_trip."""
    return pieces.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        unstage(last)
        last = docs
    return docs
