"""Label tables, annotation exports, taxonomies, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions.annotations import TASK_SCHEMA
from tagflow.functions.names import is_true, tokens

# The texts that data-frame readers take for a missing value.
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def na_to_null(value: Column) -> Column:
    return F.when(~value.isin(*NA_TEXTS), value)


def read_label_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A manifest; texts that stand for a missing value become null."""
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')
    return df.select([na_to_null(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK_SCHEMA).json(path, multiLine=True)


def alias_pairs(taxonomy: dict[str, Sequence[str] | None]) -> dict[str, str]:
    """alias -> canonical in lower case; a name is its own alias, names with a leading _ are notes, the later entry wins."""
    out: dict[str, str] = {}
    for canonical, aliases in taxonomy.items():
        if not canonical.startswith("_"):
            out |= {x.lower(): canonical for x in (canonical, *(aliases or ()))}
    return out


def alias_table(spark: SparkSession, yaml_path: str) -> DataFrame:
    """alias, canonical of a taxonomy in YAML, at any path that Spark reads."""
    text = "\n".join(r.value for r in spark.read.text(yaml_path, wholetext=True).collect())
    pairs = alias_pairs(yaml.safe_load(text))
    return spark.createDataFrame(sorted(pairs.items()), "alias string, canonical string")


def pivot_wide(long: DataFrame, attrs: Sequence[str], values: dict[str, str], key: str = "name") -> DataFrame:
    """One row a name, with <prefix><attr> for each attr and value column; values: column -> prefix."""
    cells = [F.max(F.when(F.col("attr") == a, F.col(c))).alias(f"{p}{a}") for a in attrs for c, p in values.items()]
    return long.groupBy(key).agg(*cells)


def write_wide_csv(long: DataFrame, attrs: Sequence[str], values: dict[str, str], path: str, key: str = "name") -> None:
    pivot_wide(long, attrs, values, key).write.mode("overwrite").csv(path, header=True)


def long_form(wide: DataFrame, attrs: Sequence[str], prefix: str = "", value: str = "value", key: str = "name") -> DataFrame:
    """name, attr, value from wide columns."""
    cells = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(f"`{prefix}{a}`").alias(value)) for a in attrs])
    return wide.select(key, F.explode(cells).alias("c")).select(key, "c.attr", f"c.{value}")


def tags_to_nested(df: DataFrame, choices: Sequence[str], details: Sequence[str], embellishments: Sequence[str]) -> DataFrame:
    """name, model_details (values of choices first, then true details), embellishments."""
    flag = lambda a: F.when(is_true(F.col(f"`{a}`")), F.lit(a))
    kept = lambda parts: F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != ""))
    return df.select("name", kept([*[F.col(c) for c in choices], *[flag(a) for a in details]]).alias("model_details"), kept([flag(a) for a in embellishments]).alias("embellishments"))


def annotation_tasks(catalog: DataFrame, url_prefix: str) -> DataFrame:
    """One labelling task an image: data{image, name}, by file name."""
    file = F.concat("name", F.lit("."), "ext")
    return catalog.select(file.alias("file"), F.struct(F.concat(F.lit(url_prefix), file).alias("image"), F.col("name")).alias("data")).orderBy("file", "data.name")


def preannotation_tasks(predicted: DataFrame, attrs: Sequence[str], url_prefix: str, widget: str) -> DataFrame:
    """Tasks with the predicted attributes filled in, in the order of attrs; no annotation where none is positive.

    predicted: name, file, attr, pred.
    """
    place = F.array_position(F.array(*[F.lit(a) for a in attrs]), F.col("attr"))
    grouped = predicted.groupBy("name", "file").agg(F.array_sort(F.collect_list(F.when((F.col("pred") == 1) & (place > 0), F.struct(place.alias("p"), "attr")))).alias("hits"))
    chosen = F.transform("hits", lambda x: x["attr"])
    result = F.array(F.struct(F.lit(widget).alias("from_name"), F.struct(chosen.alias("choices")).alias("value")))
    none = F.lit(None).cast("array<struct<result:array<struct<from_name:string,value:struct<choices:array<string>>>>>>")
    return grouped.select(
        F.struct(F.concat(F.lit(url_prefix), "file").alias("image"), "name").alias("data"),
        F.coalesce(F.when(F.size("hits") > 0, F.array(F.struct(result.alias("result")))), none, F.array().cast("array<struct<result:array<struct<from_name:string,value:struct<choices:array<string>>>>>>")).alias("annotations"))


def label_vocabulary(df: DataFrame, column: str, sep: str = "|") -> DataFrame:
    """Distinct labels without no-spec."""
    return df.select(F.explode(tokens(F.col(column), sep)).alias("label")).where("label <> 'no-spec'").distinct()
