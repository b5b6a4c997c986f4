"""Filters and rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.names import is_true


def filter_valid_single(df: DataFrame, label: str, classes: Sequence[str]) -> DataFrame:
    return df.where(F.col(label).isin(*classes))


def filter_valid_multi(df: DataFrame, label: str) -> DataFrame:
    """Rows with a name; a missing label is a clean negative, ""."""
    return df.dropna(subset=["name"]).fillna({label: ""})


def filter_tags(df: DataFrame, attr_true: str | None = None, toe: str | None = None, heel: str | None = None, limit: int | None = None, order: str = "name") -> DataFrame:
    for on, keep in ((attr_true, lambda: is_true(F.col(f"`{attr_true}`"))), (toe, lambda: F.col("toe_shape") == toe), (heel, lambda: F.col("heel_type") == heel)):
        if on is not None:
            df = df.where(keep())
    return df if limit is None else df.orderBy(order).limit(limit)


def filter_cascade(df: DataFrame, category: str | None = None, subcategory: str | None = None, min_conf: float | None = None, max_conf: float | None = None, limit: int | None = None, order: str = "name") -> DataFrame:
    """Both bounds of category_conf belong to the range."""
    if category is not None:
        df = df.where(F.col("category") == category)
    if subcategory is not None:
        df = df.where(F.col("subcategory") == subcategory)
    if min_conf is not None:
        df = df.where(F.col("category_conf") >= min_conf)
    if max_conf is not None:
        df = df.where(F.col("category_conf") <= max_conf)
    return df if limit is None else df.orderBy(order).limit(limit)


def low_confidence(df: DataFrame, column: str = "confidence", below: float = 0.80) -> DataFrame:
    """Strictly below, of the confidence as stored (rounded to 4 places)."""
    return df.where(F.round(F.col(column), 4) < below)


def positives(pred_long: DataFrame, attr: str) -> DataFrame:
    return pred_long.where((F.col("attr") == attr) & (F.col("pred") == 1)).select("name")


def quality_reason(width: Column, height: Column, min_side: int = 300, max_ar: float = 2.5, min_ar: float = 0.25) -> Column:
    """Why an image is refused, "" if it is not: decode_error, too_small(WxH), bad_aspect, in this order."""
    ratio = width / F.when(height > 0, height)
    return (
        F.when(width.isNull() | height.isNull() | (height <= 0) | (width <= 0), "decode_error")
        .when((width < min_side) | (height < min_side), F.format_string("too_small(%dx%d)", width.cast("int"), height.cast("int")))
        .when((ratio > max_ar) | (ratio < min_ar), "bad_aspect").otherwise(""))


def quality_gate(df: DataFrame, **limits) -> DataFrame:
    """Columns ok and reason."""
    reason = quality_reason(F.col("width"), F.col("height"), **limits)
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason") == "")


@dataclass(frozen=True)
class Rule:
    """A label for names with all of require and none of exclude."""

    label: str
    require: tuple[str, ...]
    exclude: tuple[str, ...] = ()


def classify_by_rules(df: DataFrame, column: str, refuse: Sequence[str], refuse_exact: Sequence[str], rules: Sequence[Rule], out: str = "label") -> DataFrame:
    """The label of the first rule that fits; null if none does, or the name holds a refused part or is refused whole.

    Names and refused names compare in lower case with - and blanks as _.
    """
    plain = F.translate(F.lower(F.col(column)), "- ", "__")
    exact = sorted({x.lower().replace("-", "_").replace(" ", "_") for x in refuse_exact})
    label = F.coalesce(*[
        F.when(_all([plain.contains(x) for x in r.require] + [~plain.contains(x) for x in r.exclude]), F.lit(r.label)) for r in rules])
    stop = F.lit(False)
    for x in refuse:
        stop = stop | plain.contains(x)
    if exact:
        stop = stop | plain.isin(*exact)
    return df.withColumn(out, F.when(~stop, label))


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out
