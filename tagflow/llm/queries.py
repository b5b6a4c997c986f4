"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.llm import oracle
from tagflow.llm.alignment import aligned
from tagflow.llm.byte_cnn import quality_scores
from tagflow.llm.collocations import collocations
from tagflow.llm.decontamination import contained_items
from tagflow.llm.deleted_interpolation import interpolated_scores
from tagflow.llm.host_rules import judge
from tagflow.llm.language_id import predict
from tagflow.llm.pii_crf import fit, labelled_table, private_spans
from tagflow.llm.prefix_join import jaccard_components
from tagflow.llm.shared import table
from tagflow.llm.slots import MAP_CONF, sharded
from tagflow.llm.source_mix import mixed
from tagflow.llm.tool_calls import CHAT_TOOLS, chat_calls, linked_calls
from tagflow.llm.url_globs import filter_urls

TOKENIZERS_CONF = "spark.tagflow.tokenizers"  # the folder of the public tokenizers, on the driver


def remainder(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_scores(table(spark, sf_dir, "documents"), remainder(10) == 0, remainder(10) == 1)


def op3_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(5) == 0)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=5, percent=80)


def op5_url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op6_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("source").withColumn("target", F.round("target", 6))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_calls(*chat_calls(table(spark, sf_dir, "conversations")), CHAT_TOOLS)


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), map_path=spark.conf.get(MAP_CONF, None))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"), remainder(4) != 2)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = spark.conf.get(TOKENIZERS_CONF, "/opt/tokenizers")
    return aligned(table(spark, sf_dir, "documents"), f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")


def op13_pii_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return private_spans(docs, fit(labelled_table(docs)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_quality_rules": op1_host_quality_rules,
    "op2_deleted_interpolation": op2_deleted_interpolation,
    "op3_byte_cnn_quality": op3_byte_cnn_quality,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_url_globs": op5_url_globs,
    "op6_benchmark_containment": op6_benchmark_containment,
    "op7_source_mix": op7_source_mix,
    "op8_tool_calls": op8_tool_calls,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_language_id": op10_language_id,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_token_alignment": op12_token_alignment,
    "op13_pii_field": op13_pii_field,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
