"""Tagging and describing images through an injected client: client_factory() -> client(row, prompt) -> text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.responses import coerce_flag, parse_model_json, parse_status, validate_choice
from tagflow.operators.calls import Client, call_batch


def parse_tags(answers: DataFrame, toes: Sequence[str], heels: Sequence[str], attrs: Sequence[str], raw: str = "raw", heel_fallback: str | None = None) -> DataFrame:
    """name, toe_shape, heel_type, a nullable flag for each attribute, parse_status. No row is lost."""
    parsed = answers.select("name", raw, parse_model_json(F.col(raw)).alias("j")).withColumn("parse_status", parse_status(F.col(raw), F.col("j")))
    key = lambda k: F.try_element_at("j", F.lit(k))
    return parsed.select(
        "name", validate_choice(key("toe_shape"), toes).alias("toe_shape"), validate_choice(key("heel_type"), heels, heel_fallback).alias("heel_type"),
        *[coerce_flag(F.col("j"), a).alias(a) for a in attrs], "parse_status")


def tag_batch(pending: DataFrame, client_factory: Callable[[], Client], prompt: str, **calls) -> DataFrame:
    return call_batch(pending, client_factory, F.lit(prompt), **calls)


def describe_batch(rows: DataFrame, client_factory: Callable[[], Client], grounded: Column, ungrounded: Column, version: str = "v1", **calls) -> DataFrame:
    """name, description ("" if the call or its JSON failed), grounded, prompt_version. rows: name, grounded and what the prompts use."""
    answers = call_batch(rows, client_factory, F.when(F.col("grounded"), grounded).otherwise(ungrounded), **calls)
    text = F.try_element_at(parse_model_json(F.col("raw")), F.lit("description"))
    return answers.select("name", F.coalesce(text, F.lit("")).alias("description"), "grounded", F.lit(version).alias("prompt_version"))


def probe_batch(catalog: DataFrame, client_factory: Callable[[], Client], focus: str = "both", **calls) -> DataFrame:
    """Free words for what is seen: heel_name, heel_alternative_names, toe_name, toe_alternative_names; null outside the focus."""
    schema = "heel_name string, heel_alternative_names array<string>, toe_name string, toe_alternative_names array<string>"
    asked = {"heel": ["heel"], "toe": ["toe"], "both": ["heel", "toe"]}[focus]
    answers = call_batch(catalog, client_factory, F.lit(f"Name the {' and '.join(asked)} in your own words, as JSON."), **calls)
    parsed = answers.select("name", parse_model_json(F.col("raw"), schema).alias("j"))
    return parsed.select("name", *[F.when(F.lit(c.split("_")[0] in asked), F.col(f"j.{c}")).alias(c) for c in ("heel_name", "heel_alternative_names", "toe_name", "toe_alternative_names")])


def append_results(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True)
