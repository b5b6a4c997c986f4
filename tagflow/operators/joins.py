"""Equi-joins on names and terms. Spark picks the side to broadcast by its measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.names import clean_raw_labels, path_order
from tagflow.sources.catalog import EXTENSIONS


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join that takes a null key for equal to a null key; the columns of left, then the other ones of right."""
    other = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(other, on, how).drop(*[f"__right_{k}" for k in keys])


def join_gt_pred(gt: DataFrame, pred: DataFrame) -> DataFrame:
    return gt.join(pred, "name")


def match_counts(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """matched, gt_rows, pred_rows in one pass over both sides."""
    sides = gt.groupBy("name").agg(F.count("*").alias("g")).join(pred.groupBy("name").agg(F.count("*").alias("p")), "name", "full")
    g, p = F.coalesce("g", F.lit(0)), F.coalesce("p", F.lit(0))
    return sides.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(n) for x, n in ((g * p, "matched"), (g, "gt_rows"), (p, "pred_rows"))])


def pending(catalog: DataFrame, done: DataFrame, retry_failed: bool = False, failed: Column | None = None) -> DataFrame:
    """Images not done yet, one a name: the first path; without paths the row that is least as JSON. With retry_failed, done rows where failed holds do not count."""
    if retry_failed and failed is not None:
        done = done.where(~F.coalesce(failed, F.lit(False)))
    first = catalog.groupBy("name").agg(F.min_by(F.struct("*"), path_order(F.col("path"))).alias("r")).select("r.*") if "path" in catalog.columns else catalog.groupBy("name").agg(F.min_by(F.struct("*"), F.to_json(F.struct("*"))).alias("r")).select("r.*")
    return first.join(done.select("name"), "name", "left_anti")


def exclude_drawings(items: DataFrame, photo_pred: DataFrame, key: str = "name") -> DataFrame:
    return items.join(photo_pred.where("prediction = 'drawing'").select(F.col("name").alias(key)), key, "left_anti")


def restrict_to_present(labels: DataFrame, catalog: DataFrame, must_exist: bool = True) -> DataFrame:
    """Label rows that have an image; an error if none has."""
    kept = labels.join(catalog.select("name"), "name", "left_semi")
    if must_exist and kept.isEmpty():
        raise ValueError("no label has an image")
    return kept


def best_paths(catalog: DataFrame) -> DataFrame:
    """name, path: a file at the root by the order of extensions, else the first nested one."""
    rank = F.array_position(F.array(*[F.lit(e) for e in EXTENSIONS]), F.col("ext"))
    nested = F.col("category").isNotNull()
    order = F.struct(nested, F.when(nested, F.lit(0)).otherwise(rank), path_order(F.col("path")))
    return catalog.groupBy("name").agg(F.min_by("path", order).alias("path"))


def resolve_images(labels: DataFrame, catalog: DataFrame) -> DataFrame:
    """Labels with the path of their image; null if there is none."""
    return labels.join(best_paths(catalog), "name", "left")


def labels_marked(labels: DataFrame, catalog: DataFrame, outputs: DataFrame) -> DataFrame:
    """name, have (there is an image), done (there is an output) of each label row."""
    names = lambda df, flag: df.select("name").distinct().withColumn(flag, F.lit(True))
    found = labels.select("name").join(names(catalog, "have"), "name", "left").join(names(outputs, "done"), "name", "left")
    return found.select("name", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("have", "done")])


def coverage(labels: DataFrame, catalog: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row: n_labels, already_done, to_process, missing (no image), images."""
    counts = labels_marked(labels, catalog, outputs).agg(
        F.count("*").alias("n_labels"), F.count_if("done").alias("already_done"), F.count_if(F.col("have") & ~F.col("done")).alias("to_process"),
        F.count_if(~F.col("have") & ~F.col("done")).alias("missing"))
    images = catalog.select("name").distinct().agg(F.count("*").alias("images"))
    return counts.withColumn("k", F.lit(1)).join(images.withColumn("k", F.lit(1)), "k").drop("k")


def last_by_name(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Of rows of one name the last by position."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "name"])  # the name stays the key, so that a layout by name lasts
    return df.groupBy("name").agg(F.max_by(own, F.col(pos)).alias("r")).select("name", "r.*").select(*[F.col(f"`{c}`") for c in df.columns])


def attach_tags(images: DataFrame, tags: DataFrame, pos: str = "pos") -> DataFrame:
    """Images with their verified tags; grounded says whether there are some."""
    return images.join(last_by_name(tags, pos).drop(pos).withColumn("__hit", F.lit(True)), "name", "left").withColumn("grounded", F.col("__hit").isNotNull()).drop("__hit")


def attach_descriptions(tags: DataFrame | None, descriptions: DataFrame, pos: str = "pos") -> DataFrame:
    """Tags with description ("" if none) and grounded; without tags the described names."""
    last = last_by_name(descriptions, pos).select("name", "description", "grounded")
    base = last.select("name") if tags is None else tags
    return base.join(last, "name", "left").withColumn("description", F.coalesce("description", F.lit("")))


def assemble_cascade(names: DataFrame, stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """name, category, category_conf, subcategory, subcategory_conf; unknown and 0.0 where a stage has no answer."""
    one = stage1.select("name", F.col("prediction").alias("category"), F.col("confidence").alias("category_conf"))
    two = stage2.select("name", F.col("prediction").alias("subcategory"), F.col("confidence").alias("subcategory_conf"))
    both = names.select("name").join(one, "name", "left").join(two, "name", "left")
    return both.fillna({"category": "unknown", "subcategory": "unknown", "category_conf": 0.0, "subcategory_conf": 0.0})


def normalize_terms(df: DataFrame, column: str, aliases: DataFrame, out: str, fallback: str = "_unknown") -> DataFrame:
    """The canonical term of a column, trimmed and in lower case; fallback where there is none."""
    pairs = aliases.select(F.col("alias").alias("__alias"), F.col("canonical").alias(out))
    return df.join(pairs, F.lower(F.trim(F.col(column))) == F.col("__alias"), "left").drop("__alias").withColumn(out, F.coalesce(out, F.lit(fallback)))


def label_catalog(catalog: DataFrame, raw: DataFrame) -> DataFrame:
    """Every image with its cleaned label; "" where it has none."""
    return catalog.select("name").join(raw.select("name", clean_raw_labels(F.col("label")).alias("label")), "name", "left").withColumn("label", F.coalesce("label", F.lit("")))


def labels_not_found(catalog: DataFrame, raw: DataFrame) -> DataFrame:
    return raw.join(catalog.select("name"), "name", "left_anti").select("name")


def select_candidates(raw: DataFrame, pool: DataFrame, have: DataFrame, targets: Sequence[str], n: int, labels: str = "labels", pos: str = "pos") -> DataFrame:
    """The first n items with a target label that are in the pool and not there already."""
    hit = raw.where(F.arrays_overlap(F.col(labels), F.array(*[F.lit(t) for t in targets])))
    return hit.join(pool.select("name"), "name", "left_semi").join(have.select("name"), "name", "left_anti").orderBy(pos, "name").limit(n)


def error_cases(gt: DataFrame, pred: DataFrame, attr: str, kind: str) -> DataFrame:
    """name, badge, gt_labels of cases of one kind: fp, fn, tp, tn, pred, both (fp and fn), all.

    gt and pred: name, labels (arrays).
    """
    return badged(gt.select("name", F.col("labels").alias("g")).join(pred.select("name", F.col("labels").alias("p")), "name"), attr, kind)


def badged(pairs: DataFrame, attr: str, kind: str) -> DataFrame:
    """error_cases of rows that hold both lists: name, g (true labels), p (predicted ones)."""
    g, p = F.array_contains("g", attr), F.array_contains("p", attr)
    badge = F.when(g & p, "TP").when(p, "FP").when(g, "FN").otherwise("TN")
    wanted = {"fp": ["FP"], "fn": ["FN"], "tp": ["TP"], "tn": ["TN"], "pred": ["TP", "FP"], "both": ["FP", "FN"], "all": ["TP", "FP", "FN", "TN"]}[kind]
    return pairs.select("name", badge.alias("badge"), F.array_join("g", "|").alias("gt_labels")).where(F.col("badge").isin(*wanted))
