"""Tables kept between the steps of an operator, and label propagation on links."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.sources.scratch import discard, shared_dir, written

__all__ = ["components", "copies", "discard", "shared_dir", "shuffles_removed", "table", "text_batches", "written"]

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(docs: DataFrame) -> DataFrame:
    """docs, whose session from now on makes Arrow batches of a few MB: rows of texts differ by orders of magnitude in size.

    A smaller limit that the session has already stays.
    """
    spark = docs.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_BYTES)) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    return docs


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each query go when it ends, instead of when the driver's JVM finds them unreachable: for queries whose results are written."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def copies(df: DataFrame, number: str, block: int = 4096) -> DataFrame:
    """Each row of df as often as its column number says, with the column copy from 0; numbers of any size, in blocks."""
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(number) - 1) / block)))
    inside = F.explode(F.sequence(F.col("__block") * block, F.least((F.col("__block") + 1) * block, F.col(number)) - 1))
    # the blocks of a row of very many copies are dealt to all tasks; a number keeps them from being put together by their bytes
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.where(F.col(number) > 0).withColumn("__block", blocks).repartition(tasks).withColumn("copy", inside).drop("__block")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links(a, b) as (node, component), component = least node.

    Alternating large-star and small-star steps until the edges stop changing; the
    number of steps grows with the logarithm of the longest chain. Each step is written
    to the shared folder, as is the result. Nothing but two counts comes to the driver. Nodes
    without a link do not appear. Nulls are left out.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = written(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        two_way = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least neighbours are written, so that what joins them is dealt by the join alone and a hub's edges can be split
        least = written(two_way.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(two_way.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        after = written(small, "edges")
        discard(edges, least, large, low)
        edges = after
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    out = written(
        edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
        .union(edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))), "components")
    discard(edges)
    return out
