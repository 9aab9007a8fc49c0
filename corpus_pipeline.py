"""A training corpus from raw documents: toxicity, near duplicates, benchmark decontamination, mixing, token records.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, and what one stage returns
is written as Parquet and read again as the next one's documents. All stages but the last return the documents' columns.

Defined results: null and empty texts, and rows without an id, are documents like others (all texts without words are one
class of near duplicates, of which one stays); texts of any length are read whole; rows that repeat are copies; of equally
good ones in a class the least id and row stays; further columns go through all stages but the last, whatever their names;
empty tables give no rows, and without labels, or without benchmark items, their stage keeps every document as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, neardup, records, toxicity
from tidemark.llm.common import saved, table, text_batches


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    text_batches(spark)
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    text_batches(spark)
    return neardup.drop_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go; documents that are hardly anything else go whole."""
    text_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by target weights; a document taken twice is there twice."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in binary shards, and a row for each record."""
    return records.token_records(docs, records.default_tokenizer())


STAGES = [
    ("toxicity", keep_clean),
    ("near_duplicates", keep_distinct),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: SQL can express neither the learned stage nor the sampled one; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
