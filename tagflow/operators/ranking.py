"""Places and running sums in an order, with no task that gets a whole group or table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.operators.joins import join_same
from tagflow.sources.scratch import written

EARLIER = (W.unboundedPreceding, -1)


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df sorted in ranges of order, with the columns __range and __at, which counts up in a range."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return written(sorted_.withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "ranged")


def place_in(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """df with each row's place, from 0, among those of its group (null is a group too) by order, nulls first.

    The place is that in the row's range and the rows of the group in the ranges before.
    """
    ranged = _ranged(df, [*group, *order])
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(*EARLIER)
    starts = ranged.groupBy(*group, "__range").agg(F.count("*").alias("__n"), F.min("__at").alias("__low"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    placed = join_same(ranged, starts, [*group, "__range"]).withColumn(name, F.col("__start") + F.col("__at") - F.col("__low"))
    return placed.drop("__range", "__at", "__start", "__low")


def earlier_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """df with columns of sums over all rows before, by order; 0 for the first."""
    ranged = _ranged(df.withColumns({f"__of_{k}": v for k, v in sums.items()}), order)
    before = W.orderBy("__range").rowsBetween(*EARLIER)  # a row for each range
    totals = ranged.groupBy("__range").agg(*[F.sum(f"__of_{k}").alias(f"__all_{k}") for k in sums])
    starts = totals.select("__range", *[F.coalesce(F.sum(f"__all_{k}").over(before), F.lit(0)).alias(f"__start_{k}") for k in sums])
    inside = W.partitionBy("__range").orderBy("__at").rowsBetween(*EARLIER)
    found = ranged.withColumns({k: F.coalesce(F.sum(f"__of_{k}").over(inside), F.lit(0)) for k in sums}).join(starts, "__range")
    return found.withColumns({k: F.col(k) + F.col(f"__start_{k}") for k in sums}).drop("__range", "__at", *[f"__{w}_{k}" for k in sums for w in ("of", "start")])
