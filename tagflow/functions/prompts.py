"""Prompts for tagging and describing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagflow.functions.names import is_true


def true_names(attrs: Sequence[str], columns: Mapping[str, Column]) -> Column:
    """Names of the attributes that are true, in the order of attrs."""
    return F.filter(F.array(*[F.when(is_true(columns[a]), F.lit(a)) for a in attrs]), lambda x: x.isNotNull())


def tag_block(toe: Column, heel: Column, construction: Column, embellishment: Column) -> Column:
    """Lines for toe, heel and the true attributes; a sentence if there is nothing."""
    line = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{name}: "), value))
    lines = F.concat_ws(
        "\n", line("Toe shape", toe), line("Heel type", heel), line("Construction", F.array_join(construction, ", ")), line("Embellishments", F.array_join(embellishment, ", ")))
    return F.when(lines == "", "(no tags available)").otherwise(lines)


def grounded_prompt(block: Column) -> Column:
    return F.concat(F.lit("Describe the product in the picture in at most 60 words. These tags are checked; agree with them:\n"), block, F.lit('\nAnswer as JSON with the key "description".'))


def ungrounded_prompt() -> Column:
    return F.lit('Describe only what the picture shows of the product, in at most 60 words.\nAnswer as JSON with the key "description".')


def choice_prompt(lists: Mapping[str, Sequence[str]]) -> str:
    """One prompt for all images: a value out of each list."""
    return "\n".join(["Choose one value for each key and answer as JSON."] + [f"{k}: {', '.join(v)}" for k, v in lists.items()])


def flags_prompt(lists: Mapping[str, Sequence[str]]) -> str:
    return "\n".join(["Answer as JSON with true or false for each name."] + [f"{k}: {', '.join(v)}" for k, v in lists.items()])
