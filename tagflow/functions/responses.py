"""Answers of models: text to JSON, choices and flags; scores to probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"


def response_text(raw: Column) -> Column:
    """The JSON in an answer: what is between code fences if it begins with one, without a leading word json."""
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    text = strip(raw)
    fenced = F.regexp_replace(F.get(F.split(text, FENCE), F.lit(1)), r"^json", "")
    return strip(F.when(text.startswith(FENCE), fenced).otherwise(text))


def parse_model_json(raw: Column, schema: str = "map<string,string>") -> Column:
    """The answer parsed; null if it is no JSON object."""
    text = response_text(raw)
    return F.when(text.startswith("{"), F.from_json(text, schema))


def parse_status(raw: Column, parsed: Column | None = None) -> Column:
    """ok, empty (an object without keys), failed, or missing. parsed: the answer parsed, where it is a column already."""
    parsed = parse_model_json(raw) if parsed is None else parsed
    return F.when(raw.isNull(), "missing").when(parsed.isNull(), "failed").when(F.size(F.map_keys(parsed)) == 0, "empty").otherwise("ok")


def validate_choice(value: Column, allowed: Sequence[str], fallback: str | None = None) -> Column:
    """An allowed value as it is, any other as _invalid:<value>, or as fallback. Null stays."""
    other = F.lit(fallback) if fallback is not None else F.concat(F.lit("_invalid:"), value)
    return F.when(value.isNull(), F.lit(None).cast("string")).when(value.isin(*allowed), value).otherwise(other)


def coerce_flag(parsed: Column, attr: str) -> Column:
    """Truth of one key: false if missing or one of false, 0, no, "", null; null if nothing was parsed or the object is empty."""
    value = F.lower(F.trim(F.try_element_at(parsed, F.lit(attr))))
    usable = parsed.isNotNull() & (F.size(F.map_keys(parsed)) > 0)
    return F.when(usable, F.coalesce(~value.isin("false", "0", "0.0", "no", "", "null", "[]", "{}"), F.lit(False)))


def softmax(logits: Column) -> Column:
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def softmax_predict(logits: Column, classes: Sequence[str]) -> Column:
    """prediction (the first of the largest), confidence and probs, rounded to 4 places."""
    probs = softmax(logits)
    return F.struct(
        F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(logits, F.array_max(logits)).cast("int")).alias("prediction"),
        F.round(F.array_max(probs), 4).alias("confidence"), F.transform(probs, lambda p: F.round(p, 4)).alias("probs"))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def sigmoid_predict(logit: Column, threshold: float = 0.5) -> Column:
    """score rounded to 4 places; pred from the score before rounding."""
    p = sigmoid(logit)
    return F.struct(F.round(p, 4).alias("score"), (p >= threshold).cast("int").alias("pred"))


def contrastive_prob(positive: Column, negative: Column) -> Column:
    """Softmax over a pair of logits, the first entry."""
    return 1 / (1 + F.exp(negative - positive))
