"""Small summaries of label, prediction and description tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.names import is_true


def prediction_summary(df: DataFrame, below: float = 0.80) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.count_if(F.round("confidence", 4) < below).alias("n_low"))


def cascade_summary(df: DataFrame, below: float = 0.70) -> DataFrame:
    """A row for each category and one for all (category null): n, mean confidences, n_low."""
    return df.groupingSets([["category"], []], "category").agg(
        F.count("*").alias("n"), F.avg("category_conf").alias("mean_category_conf"), F.avg("subcategory_conf").alias("mean_subcategory_conf"),
        F.count_if(F.round("category_conf", 4) < below).alias("n_low"))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """value, n of the most frequent value, the first of equals; null and empty values do not count."""
    counts = df.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(1)


def tag_summary(df: DataFrame) -> DataFrame:
    """kind, value, n: all rows, the most common toe and the most common heel."""
    rows = df.agg(F.count("*").alias("n")).select(F.lit("rows").alias("kind"), F.lit("").alias("value"), "n")
    for kind, c in (("toe", "toe_shape"), ("heel", "heel_type")):
        rows = rows.unionByName(most_common(df, c).select(F.lit(kind).alias("kind"), "value", "n"))
    return rows


def annotation_summary(tasks: DataFrame, annotated: Column, rejected: Column) -> DataFrame:
    return tasks.agg(F.count_if(annotated & ~rejected).alias("n_annotated"), F.count_if(~annotated).alias("n_without"), F.count_if(annotated & rejected).alias("n_rejected"))


def description_summary(df: DataFrame) -> DataFrame:
    text = F.coalesce("description", F.lit("")) != ""
    return df.agg(
        F.count_if(text & is_true(F.col("grounded"))).alias("n_grounded"), F.count_if(text & ~is_true(F.col("grounded"))).alias("n_ungrounded"), F.count_if(~text).alias("n_failed"))


def review_cards(tags: DataFrame, descriptions: DataFrame, catalog: DataFrame, construction: list[str], embellishment: list[str]) -> DataFrame:
    """One row an image: badges of toe and heel, whether a value is invalid, attribute badges, description, grounded, image_found."""
    badge = lambda attrs: F.filter(F.array(*[F.when(is_true(F.col(f"`{a}`")), F.lit(a)) for a in attrs]), lambda x: x.isNotNull())
    invalid = F.coalesce(F.col("toe_shape").startswith("_invalid"), F.lit(False)) | F.coalesce(F.col("heel_type").startswith("_invalid"), F.lit(False))
    cards = tags.select("name", "toe_shape", "heel_type", invalid.alias("invalid"), badge(construction).alias("construction"), badge(embellishment).alias("embellishment"))
    found = catalog.select("name").distinct().withColumn("image_found", F.lit(True))
    return cards.join(descriptions.select("name", "description", "grounded"), "name", "left").join(found, "name", "left").withColumns(
        {"description": F.coalesce("description", F.lit("")), "image_found": F.coalesce("image_found", F.lit(False))})
