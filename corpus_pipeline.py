"""The corpus pipeline: quality, near copies, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on every row the stage before kept and returns a
DataFrame; all but the last return the columns of documents. Null and empty texts pass
the first three stages by the rules of their operators and leave in the mix, which is
made of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.llm.byte_cnn import keep_good
from tagflow.llm.decontamination import without_items
from tagflow.llm.prefix_join import keep_one
from tagflow.llm.shared import discard, table, written
from tagflow.llm.slots import MAP_CONF, sharded
from tagflow.llm.source_mix import mix


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labels of documents whose crc32 modulo 5 is not 0."""
    return keep_good(docs, table(spark, sf_dir, "labels"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes: shard, place in it, virtual slot and the version of the slot map."""
    return sharded(docs, map_path=spark.conf.get(MAP_CONF, None))


STAGES = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
    ("sharding", shard),
]

#: Learned filters and hashes have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        discard(*before)  # the table that only this stage has read
        before = [docs]
    return docs
