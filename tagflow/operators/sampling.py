"""Caps, splits and weights. Order comes from md5, so every engine draws the same rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.functions.names import md5_order, tokens
from tagflow.operators.joins import join_same
from tagflow.sources.scratch import written

CELL_ROWS = 10_000  # a cut is looked for among the hashes themselves once so few are left


def cap_rows(df: DataFrame, n: int, seed: int = 42, key: str = "name") -> DataFrame:
    """A uniform sample of n rows: the least by md5, a top-k without a full sort."""
    return df.orderBy(md5_order(seed, F.col(key)), key).limit(n)


def _cuts(keyed: DataFrame, group: list[str], key: str, quota: DataFrame) -> DataFrame:
    """The n_val-th row by (__h, key) of each group of quota(group, n_val): __cut_h, __cut_key; rows equal to it (__equal) and how many of them are wanted (__room).

    Rows are counted by the first digits of their hashes, which tells the digits of the cut; then by more digits among those that
    share them, until few are left. Rows are only counted: none is sorted or shuffled.
    """
    need = quota.where("n_val > 0").select(*group, F.col("n_val").cast("long").alias("__need"), F.lit("").alias("__prefix"))
    most = quota.agg(F.max("n")).first()[0] or 0
    step = width = max(1, min(4, -(-max(0, most // CELL_ROWS).bit_length() // 4)))
    before = lambda *order: F.coalesce(F.sum("__n").over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = lambda: join_same(keyed, need, group).where(F.startswith("__h", "__prefix"))
    hit = "__before < __need AND __need <= __before + __n"
    while True:
        cells = inside().groupBy(*group, "__need", F.substring("__h", 1, width).alias("__cell")).agg(F.count("*").alias("__n"))
        found = cells.withColumn("__before", before("__cell")).where(hit)
        need = written(found.select(*group, (F.col("__need") - F.col("__before")).alias("__need"), F.col("__cell").alias("__prefix"), "__n"), "cut_cells")
        # a cell shorter than asked is that of the null key: all its rows are equal
        large = need.where(F.length("__prefix") == width).agg(F.max("__n")).first()[0] or 0
        need = need.drop("__n")
        if large <= CELL_ROWS or width >= 32:
            break
        width += step
    equal = inside().groupBy(*group, "__need", "__h", key).agg(F.count("*").alias("__n"))
    found = equal.withColumn("__before", before("__h", key)).where(hit)
    return written(found.select(*group, F.col("__h").alias("__cut_h"), F.col(key).alias("__cut_key"), (F.col("__need") - F.col("__before")).alias("__room"), F.col("__n").alias("__equal")), "cuts")


def _split(df: DataFrame, group: list[str], quota: DataFrame, seed: int, key: str) -> DataFrame:
    """df with the column split: val for the first n_val rows by md5 of each group of quota(group, n, n_val), train for the others.

    Null keys come first. Of equal keys at the cut any rows are val, as many as are wanted.
    """
    keyed = df.withColumn("__h", F.coalesce(md5_order(seed, F.col(key)), F.lit("")))
    cuts = _cuts(keyed.select(*group, key, "__h"), group, key, quota)
    marked = join_same(keyed, cuts, group, how="left")
    same = (F.col("__h") == F.col("__cut_h")) & F.col(key).eqNullSafe(F.col("__cut_key"))
    first = (F.col("__h") < F.col("__cut_h")) | ((F.col("__h") == F.col("__cut_h")) & (F.col(key) <= F.col("__cut_key"))) | same
    flag = lambda val: F.when(F.coalesce(val, F.lit(False)), "val").otherwise("train")
    if cuts.where("__room < __equal").isEmpty():
        return marked.select(*df.columns, flag(first).alias("split"))
    # equal keys on both sides of a cut: counted by part of the table, so that no task has them all
    tied = F.coalesce(same & (F.col("__room") < F.col("__equal")), F.lit(False))
    ties = written(marked.where(tied).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "ties")
    parts = ties.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    starts = parts.withColumn("__start", F.coalesce(F.sum("__n").over(W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    place = F.row_number().over(W.partitionBy(*group, "__part").orderBy("__at"))
    chosen = join_same(ties.withColumn("__place", place), starts, [*group, "__part"]).select(*df.columns, flag(F.col("__start") + F.col("__place") <= F.col("__room")).alias("split"))
    return marked.where(~tied).select(*df.columns, flag(first).alias("split")).unionByName(chosen)


def random_split(df: DataFrame, frac: float = 0.2, seed: int = 42, key: str = "name") -> DataFrame:
    """Column split: val for ceil(frac * N) rows, train for the rest. Rows are not shuffled."""
    n = df.count()
    quota = df.sparkSession.createDataFrame([(0, n, math.ceil(Decimal(str(frac)) * n))], "__all int, n long, n_val long")
    return _split(df.withColumn("__all", F.lit(0)), ["__all"], quota, seed, key).drop("__all")


def stratified_quota(counts: DataFrame, frac: float) -> DataFrame:
    """label, n, n_val: shares of ceil(frac * N) by largest remainder, ties by label. counts: label, n, a row a class."""
    total = F.sum("n").over(W.partitionBy())
    want = F.ceil(F.lit(str(frac)).cast("decimal(10,6)") * total)
    exact = want * F.col("n") / total
    low = counts.withColumn("want", want).withColumn("exact", exact.cast("double")).withColumn("low", F.floor("exact"))
    short = F.col("want") - F.sum("low").over(W.partitionBy())
    extra = F.row_number().over(W.orderBy(F.desc(F.round(F.col("exact") - F.col("low"), 9)), "label"))
    return low.withColumn("short", short).withColumn("extra", extra).select("label", "n", (F.col("low") + F.when(F.col("extra") <= F.col("short"), 1).otherwise(0)).alias("n_val"))


def stratified_split(df: DataFrame, label: str, frac: float = 0.2, seed: int = 42, key: str = "name") -> DataFrame:
    """Column split keeping class shares: val is ceil(frac * N) rows in all. Every row stays: null labels are a class of their own. Rows are not
    shuffled while the cuts, a row a class, are small enough for a broadcast."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    quota = written(stratified_quota(counts, frac), "quota").withColumnRenamed("label", label)
    return _split(df, [label], quota, seed, key)


def select_split(df: DataFrame, split: str) -> DataFrame:
    return df if split == "all" else df.where(F.col("split") == split)


def head_rows(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    return df.orderBy(pos).limit(n)


def class_distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """column, n by falling count, ties by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), column).limit(top)


def class_weights(df: DataFrame, label: str, classes: Sequence[str]) -> DataFrame:
    """label, n, weight = (1 / max(n, 1)) / sum of these."""
    every = df.sparkSession.createDataFrame([(c,) for c in classes], f"{label} string")
    inverse = every.join(df.groupBy(label).agg(F.count("*").alias("n")), label, "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("inv", 1 / F.greatest("n", F.lit(1)))
    return inverse.withColumn("weight", F.col("inv") / F.sum("inv").over(W.partitionBy())).drop("inv")


def pos_weights(df: DataFrame, label: str, classes: Sequence[str], exact: bool = False, sep: str = "_") -> DataFrame:
    """label, weight = (n - f) / f, f rows (1 at least) whose label text contains the class, or with exact holds it as a token."""
    own = tokens(F.col(label), sep)
    hit = lambda c: F.array_contains(own, c) if exact else F.coalesce(F.col(label).contains(c), F.lit(False))
    counts = df.agg(F.count("*").alias("n"), *[F.greatest(F.count_if(hit(c)), F.lit(1)).alias(f"f{i}") for i, c in enumerate(classes)])
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"f{i}").alias("f")) for i, c in enumerate(classes)])
    return counts.select("n", F.explode(rows).alias("r")).select("r.label", ((F.col("n") - F.col("r.f")) / F.col("r.f")).alias("weight"))
