"""Metrics. Categorical ones all derive from one count by (gt, pred); multi-label ones from one count by attr.

A null label is a label like others: null is right where the truth is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.operators.joins import normalize_terms

THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where den is 0."""
    return F.coalesce(num / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def same() -> Column:
    return F.col("gt").eqNullSafe(F.col("pred"))


def pair_counts(df: DataFrame, gt: str = "gt", pred: str = "pred") -> DataFrame:
    """gt, pred, n: the one large aggregation of this module."""
    return df.groupBy(F.col(gt).alias("gt"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def label_universe(counts: DataFrame) -> DataFrame:
    return counts.select(F.col("gt").alias("label")).union(counts.select("pred")).distinct()


def accuracy(counts: DataFrame) -> DataFrame:
    return counts.agg(ratio(F.sum(F.when(same(), F.col("n")).otherwise(0)), F.sum("n")).alias("accuracy"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def confusion_matrix(counts: DataFrame, classes: Sequence[str]) -> DataFrame:
    """gt, pred, n and share of the gt row, on the full grid of classes."""
    spark, k = counts.sparkSession, len(classes)
    names = spark.createDataFrame(list(enumerate(classes)), "i long, c string")
    # a row for each cell, made in the tasks
    cells = spark.range(k * k).select(F.floor(F.col("id") / max(1, k)).alias("i"), (F.col("id") % max(1, k)).alias("j"))
    grid = cells.join(names.withColumnRenamed("c", "gt"), "i").join(names.select(F.col("i").alias("j"), F.col("c").alias("pred")), "j").select("gt", "pred")
    full = grid.join(counts, ["gt", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = full.groupBy("gt").agg(F.sum("n").alias("row_n"))
    return full.join(rows, "gt").select("gt", "pred", "n", (F.col("n") / F.greatest("row_n", F.lit(1))).alias("share"))


def per_label(counts: DataFrame) -> DataFrame:
    """label, tp, support, predicted, precision, recall, f1 of every label on either side."""
    truth = counts.select(F.col("gt").alias("label"), F.col("n").alias("support"), F.when(same(), F.col("n")).otherwise(0).alias("tp"), F.lit(0).alias("predicted"))
    given = counts.select(F.col("pred").alias("label"), F.lit(0).alias("support"), F.lit(0).alias("tp"), F.col("n").alias("predicted"))
    both = truth.unionByName(given).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "tp", "predicted")])
    scored = both.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    return scored.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def classification_report(counts: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support; also the rows accuracy, macro avg and weighted avg."""
    labels = per_label(counts).select("label", "precision", "recall", "f1", "support")
    means = labels.agg(
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}") for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    summary = means.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("label"), F.col("m_precision").alias("precision"), F.col("m_recall").alias("recall"), F.col("m_f1").alias("f1"), "support"),
        F.struct(F.lit("weighted avg").alias("label"), F.col("w_precision").alias("precision"), F.col("w_recall").alias("recall"), F.col("w_f1").alias("f1"), "support"),
        # the weighted recall is the accuracy
        F.struct(F.lit("accuracy").alias("label"), F.col("w_recall").alias("precision"), F.col("w_recall").alias("recall"), F.col("w_recall").alias("f1"), "support"))).alias("r")).select("r.*")
    return labels.unionByName(summary)


def per_class_accuracy(counts: DataFrame) -> DataFrame:
    """label, n_samples, accuracy of each gt class, and the row OVERALL, both without the rows whose truth is null."""
    right = F.sum(F.when(same(), F.col("n")).otherwise(0))
    rolled = counts.where("gt IS NOT NULL").rollup("gt").agg(F.sum("n").alias("n_samples"), ratio(right, F.sum("n")).alias("accuracy"))
    return rolled.select(F.coalesce("gt", F.lit("OVERALL")).alias("label"), "n_samples", "accuracy")


def top_confusions(counts: DataFrame, k: int = 10) -> DataFrame:
    return counts.where(~same()).orderBy(F.desc("n"), "gt", "pred").limit(k)


def misclassified(df: DataFrame) -> DataFrame:
    return df.where(~same()).select("name", F.col("gt").alias("true_label"), F.col("pred").alias("pred_label"))


def attr_counts(long: DataFrame) -> DataFrame:
    """attr, tp, fp, fn, tn, n from (attr, gt, pred) with 0/1."""
    g, p = F.col("gt") == 1, F.col("pred") == 1
    return long.groupBy("attr").agg(
        F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn"), F.count("*").alias("n"))


def error_breakdown(long: DataFrame) -> DataFrame:
    return attr_counts(long).drop("n")


def signal_tier(value: Column) -> Column:
    return F.when(value >= 0.80, "ships").when(value >= 0.65, "fine-tune").otherwise("needs work")


def multilabel_metrics(long: DataFrame, threshold: float | None = None) -> DataFrame:
    """attr, precision, recall, f1 (3 places), support, pred_positives, rates, signal. With threshold, pred comes from score."""
    if threshold is not None:
        long = long.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    c = attr_counts(long)
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    s = c.withColumns({"p": p, "r": r}).withColumn("f", f1(F.col("p"), F.col("r")))
    return s.select(
        "attr", F.round("p", 3).alias("precision"), F.round("r", 3).alias("recall"), F.round("f", 3).alias("f1"), (F.col("tp") + F.col("fn")).alias("support"),
        (F.col("tp") + F.col("fp")).alias("pred_positives"), F.round(ratio(F.col("tp") + F.col("fn"), F.col("n")), 4).alias("gt_rate"),
        F.round(ratio(F.col("tp") + F.col("fp"), F.col("n")), 4).alias("pred_rate"), signal_tier(F.round("f", 3)).alias("signal"))


def macro_f1(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.round(F.avg("f1"), 4).alias("macro_f1"), F.count("*").alias("n_attrs"))


def binary_report(long: DataFrame) -> DataFrame:
    """attr, class (absent or present), precision, recall, f1, support."""
    c = attr_counts(long)
    one = lambda name, tp, fp, fn: F.struct(F.lit(name).alias("class"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), (tp + fn).alias("support"))
    rows = F.array(one("present", F.col("tp"), F.col("fp"), F.col("fn")), one("absent", F.col("tn"), F.col("fn"), F.col("fp")))
    return c.select("attr", F.explode(rows).alias("r")).select("attr", "r.class", "r.precision", "r.recall", f1(F.col("r.precision"), F.col("r.recall")).alias("f1"), "r.support")


def threshold_sweep(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """attr, threshold, f1: the F1-maximising threshold, the lowest of equals; (0.5, 0) if no F1 is above 0.

    Scores fall into buckets between thresholds; counts at or above each threshold are sums over buckets. One
    pass over the rows, whatever the number of thresholds. scores: attr, gt, score.
    """
    # a sum of comparisons: unlike a lambda over the thresholds it is compiled
    bucket = sum(((F.col("score") >= t).cast("int") for t in thresholds), F.lit(0))
    hist = scores.groupBy("attr", F.coalesce(bucket, F.lit(0)).alias("b")).agg(F.count_if(F.col("gt") == 1).alias("pos"), F.count_if(F.col("gt") != 1).alias("neg"))
    # a bucket b counts at the first b thresholds; the few buckets of an attribute are summed once more, without a join
    above = lambda c, i: F.sum(F.when(F.col("b") > i, F.col(c)).otherwise(0))
    sums = hist.groupBy("attr").agg(F.sum("pos").alias("all_pos"), *[above(c, i).alias(f"{c}_{i}") for i in range(len(thresholds)) for c in ("pos", "neg")])
    value = lambda i: ratio(2.0 * F.col(f"pos_{i}"), F.col(f"pos_{i}") + F.col(f"neg_{i}") + F.col("all_pos"))
    best = sums.select("attr", F.array_max(F.array(*[F.struct(value(i).alias("f"), F.lit(-t).alias("t")) for i, t in enumerate(thresholds)])).alias("m"))
    return best.select("attr", F.when(F.col("m.f") > 0, -F.col("m.t")).otherwise(0.5).alias("threshold"), F.col("m.f").alias("f1"))


def taxonomy_pairs(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """df(gt, pred) with canonical terms gt_norm and pred_norm."""
    return normalize_terms(normalize_terms(df, "gt", aliases, "gt_norm"), "pred", aliases, "pred_norm")


def taxonomy_accuracy(pairs: DataFrame) -> DataFrame:
    """raw_rate (unknown equals unknown), clean_rate (neither unknown), n, n_clean, n_excluded."""
    same, clean = F.col("gt_norm") == F.col("pred_norm"), (F.col("gt_norm") != "_unknown") & (F.col("pred_norm") != "_unknown")
    return pairs.agg(
        ratio(F.count_if(same), F.count("*")).alias("raw_rate"), ratio(F.count_if(same & clean), F.count_if(clean)).alias("clean_rate"),
        F.count("*").alias("n"), F.count_if(clean).alias("n_clean"), F.count_if(~clean).alias("n_excluded"))


def taxonomy_per_class(pairs: DataFrame) -> DataFrame:
    known = pairs.where("gt_norm <> '_unknown'")
    return known.groupBy("gt_norm").agg(F.avg((F.col("gt_norm") == F.col("pred_norm")).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def unknown_terms(pairs: DataFrame) -> DataFrame:
    """side, term, n of raw terms without a canonical one."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("term"), F.col(f"{s}_norm").alias("norm")) for s in ("gt", "pred")])
    return pairs.select(F.explode(sides).alias("s")).where("s.norm = '_unknown'").groupBy("s.side", "s.term").agg(F.count("*").alias("n"))


def term_frequency(df: DataFrame, names: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """kind, term, n of single names and of names in lists."""
    one = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("term")) for c in names])

    def listed(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.struct(F.lit(c).alias("kind"), x.alias("term")))

    return df.select(F.explode(F.concat(one, *map(listed, lists))).alias("t")).where("t.term IS NOT NULL AND t.term <> ''").groupBy("t.kind", "t.term").agg(F.count("*").alias("n"))


def attribute_prevalence(long: DataFrame) -> DataFrame:
    """attr, n, percent of true values; attributes without one are not listed. long: attr, value (boolean, null: no answer)."""
    hits = F.count_if("value")
    return long.groupBy("attr").agg(hits.alias("n"), F.round(100.0 * hits / F.count("*"), 2).alias("percent")).where("n > 0")


def zero_positive_attrs(long: DataFrame, attrs: Sequence[str]) -> DataFrame:
    every = long.sparkSession.createDataFrame([(a,) for a in attrs], "attr string")
    return every.join(long.where("gt = 1").select("attr").distinct(), "attr", "left_anti")


def audit_signal(mean: Column, std: Column) -> Column:
    """STRONG (mean far from one half), FLAT, WEAK (little spread) or OK, tested in this order."""
    return F.when((mean > 0.65) | (mean < 0.35), "STRONG").when(std < 0.04, "FLAT").when(std < 0.07, "WEAK").otherwise("OK")


def audit_summary(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """attr, n_positive, pct_positive, mean_score, std_score (sample), signal."""
    hit = F.count_if(F.col("score") >= threshold)
    s = scores.groupBy("attr").agg(hit.alias("n_positive"), (100.0 * hit / F.count("*")).alias("share"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"))
    return s.select("attr", "n_positive", F.round("share", 2).alias("pct_positive"), F.round("mean", 4).alias("mean_score"), F.round("std", 4).alias("std_score"), audit_signal(F.col("mean"), F.col("std")).alias("signal"))
