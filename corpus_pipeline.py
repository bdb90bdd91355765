"""A corpus prepared for training: toxicity, near duplicates, benchmark passages, the mix of sources, token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pelagia.llm import contamination, mixing, neardup, tokens, toxicity
from pelagia.llm.common import read, small_batches
from pelagia.llm.registry import query
from pelagia.runtime import scratch_path, stage

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, learned from the labelled ones of them, doesn't reject."""
    small_batches(spark)
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near duplicates."""
    small_batches(spark)
    return neardup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not made of benchmark passages."""
    small_batches(spark)
    return contamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each pass over a document."""
    small_batches(spark)
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number and checksum of the ids of every row, read back from the files."""
    small_batches(spark)
    path = scratch_path(spark, "tokens")
    files = tokens.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    return tokens.read_tokens(files, path).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_token_files),
]

# The trained model, the signatures and the tokenizer have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
