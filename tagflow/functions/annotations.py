"""Exported annotation tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagflow.functions.names import stem

TASK_SCHEMA = (
    "data struct<image:string,name:string>, "
    "annotations array<struct<result:array<struct<from_name:string,value:struct<choices:array<string>>>>>>")


def annotation_name(task: Column, name: Column, local: str = "local-files") -> Column:
    """The name field; if that is empty or the local store's, the stem of the ?d= value or else of the URL's path."""
    return F.when(name.isNotNull() & (name != "") & ~name.contains(local), name).otherwise(annotation_name_v2(task))


def annotation_name_v2(url: Column) -> Column:
    r"""Stem of the ?d= value, or of the URL's path; escapes are resolved and \ counts as /."""
    value = F.regexp_extract(url, r"[?&]d=([^&#]*)", 1)
    place = F.when(value != "", value).otherwise(F.regexp_replace(url, r"[?#].*$", ""))
    return stem(F.replace(F.url_decode(place), F.lit("\\"), F.lit("/")))


def first_result(annotations: Column) -> Column:
    """Result of the first annotation; null if there is none."""
    return F.get(annotations, F.lit(0))["result"]


def choices_of(result: Column, widget: str) -> Column:
    """Choices of a widget; the last result of the widget counts. [] if none."""
    own = F.filter(result, lambda r: r["from_name"] == widget)
    return F.coalesce(F.try_element_at(own, F.lit(-1))["value"]["choices"], F.array().cast("array<string>"))


def annotation_single(annotations: Column) -> Column:
    """toe_shape and heel_type (first choice or ""), construction joined by | in the given order."""
    result = first_result(annotations)
    one = lambda w: F.coalesce(F.get(choices_of(result, w), F.lit(0)), F.lit(""))
    return F.struct(one("toe_shape").alias("toe_shape"), one("heel_type").alias("heel_type"), F.array_join(choices_of(result, "construction"), "|").alias("construction"))


def annotation_multi(annotations: Column, widget: str = "embellishment") -> Column:
    """Choices joined by |; "" where nothing was annotated."""
    return F.coalesce(F.array_join(choices_of(first_result(annotations), widget), "|"), F.lit(""))


def merge_choices(result: Column, widgets: list[str]) -> Column:
    """Sorted union of the choices of some widgets."""
    own = F.filter(result, lambda r: r["from_name"].isin(*widgets))
    lists = F.transform(own, lambda r: F.coalesce(r["value"]["choices"], F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.flatten(F.coalesce(lists, F.array().cast("array<array<string>>")))))


def annotation_attributes(annotations: Column, widgets: list[str], quality_widget: str = "quality") -> Column:
    """attributes and quality; null where nothing was annotated or the image was rejected."""
    result = first_result(annotations)
    quality = F.coalesce(F.get(choices_of(result, quality_widget), F.lit(0)), F.lit(""))
    usable = result.isNotNull() & (quality != "reject")
    return F.when(usable, F.struct(merge_choices(result, widgets).alias("attributes"), quality.alias("quality")))
