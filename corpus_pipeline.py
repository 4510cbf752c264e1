"""From raw documents to packed training sequences.

Stages, each over all rows the one before it kept, written as Parquet and read again:

1. language_id   documents without an identified language go (no letters, or no language that holds a fair share)
2. toxicity      documents scored 0.5 or more go
3. ngram_join    one document of each group of near duplicates (word shingles, Jaccard 0.8 or more) stays
4. personal_data personal data and secrets are replaced by their kind in brackets
5. packing       token pieces placed in sequences of 1024

All but the last return the columns of ``documents``. ``ORACLE_SQL`` is None: learned models and tokenisation are not SQL;
tests hold the stages against brute-force versions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitlab.llm import language_id, ngram_join, packing, personal_data, toxicity
from transitlab.llm.common import table, written
from transitlab.llm.registry import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.redact(docs, personal_data.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
