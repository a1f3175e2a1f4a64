"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.llm.chat import conversation_digests, format_conversations
from logloom.llm.collocations import mine_collocations
from logloom.llm.common import table
from logloom.llm.decontaminate import benchmark_hits, hit_digests
from logloom.llm.extract import extract_text
from logloom.llm.fim import fill_in_middle, fim_digests
from logloom.llm.langid import identify_languages
from logloom.llm.licenses import scan_licenses
from logloom.llm.mixing import mix_sources
from logloom.llm.oracles import ORACLES as LLM_ORACLES  # noqa: F401
from logloom.llm.phrases import remove_repeats
from logloom.llm.quality import quality_rules
from logloom.llm.simhash import simhash_groups
from logloom.llm.tokens import token_index, write_tokens
from logloom.llm.toxicity import toxicity
from logloom.plans.scratch import new_folder

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_simhash_dedup(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_chat_format(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return conversation_digests(format_conversations(conversations.unionByName(control)))


def op5_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))


def op6_remove_repeats(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark, sf_dir):
    return hit_digests(benchmark_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), nameless=True))


def op8_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_token_ids(spark, sf_dir):
    folder = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_index(spark, folder)


def op11_collocations(spark, sf_dir):
    return mine_collocations(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    return fim_digests(fill_in_middle(table(spark, sf_dir, "documents")))


def op13_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


QUERIES = {name: function for name, function in globals().items() if name.startswith("op")}
