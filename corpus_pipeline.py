"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

Every stage is ``fn(spark, docs, sf_dir) -> DataFrame`` and works on all that the
one before it kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import contamination, mixing, simhash, tokens, toxicity
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.shared import arrow_rows, crc_mod, materialise, read

BATCH_ROWS = 2500  # whole texts that travel to a Python worker at once


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below 0.5; learnt from labelled rows outside the held-out fifth."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    return docs.where(toxicity.scorer(spark, model)("text") < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at two fingerprint bits or fewer the one with the least id."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per row."""
    found = tokens.encode_documents(docs, tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies),
          ("benchmark_decontamination", drop_benchmark), ("source_mix", mix_sources),
          ("token_files", write_tokens)]

# Fingerprints, the trained classifier and the tokenizer have no SQL form: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with arrow_rows(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
