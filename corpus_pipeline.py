"""A corpus pipeline: language, near copies, benchmark passages, source mix, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.llm.decontaminate import decontaminate
from logloom.llm.langid import documents_with_language
from logloom.llm.mixing import repeated_documents
from logloom.llm.queries import LLM_ORACLES
from logloom.llm.queries import QUERIES as OPERATOR_QUERIES
from logloom.llm.simhash import one_of_each_group
from logloom.llm.tokens import token_index, write_tokens
from logloom.plans.scratch import new_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without letters, or with most letters in other languages than their own, go."""
    return documents_with_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id, null last."""
    return one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go; documents that are mostly such passages go as a whole."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (none, once or twice)."""
    return repeated_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files; where each document lies in them and the checksum of its ids."""
    folder = new_folder(spark, "tokens")
    write_tokens(docs, folder)
    return token_index(spark, folder)


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
LLM_ORACLES = dict(LLM_ORACLES)
