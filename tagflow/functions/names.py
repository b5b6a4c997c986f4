"""Paths, names and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_path(path: Column) -> Column:
    """Without a slash at either end and without doubled ones."""
    return F.btrim(F.replace(path, F.lit("//"), F.lit("/")), F.lit("/"))


def path_parts(path: Column) -> Column:
    """Parts of a path; comparing the arrays orders as file listings do (a/b before a-b)."""
    return F.split(clean_path(path), "/")


def path_order(path: Column) -> Column:
    """A text that orders paths as their parts do: the slash comes before every character of a name."""
    return F.translate(clean_path(path), "/", "\1")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a name that begins with its only dot keeps it."""
    file, last = file_name(path), F.substring_index(path, ".", -1)
    return F.when(_has_suffix(file, last), F.left(file, F.length(file) - F.length(last) - 1)).otherwise(file)


def ext(path: Column) -> Column:
    """Lower-case suffix without the dot, "" if there is none."""
    file, last = file_name(path), F.substring_index(path, ".", -1)
    return F.when(_has_suffix(file, last), F.lower(last)).otherwise(F.when(file.isNotNull(), ""))


def _has_suffix(file: Column, last: Column) -> Column:
    """Whether last, what follows a path's last dot, is a suffix of its file name: not empty, and not all of the name."""
    return (last != "") & (F.length(file) > F.length(last) + 1)


def is_true(value: Column) -> Column:
    """True for true, the word true (any case, trimmed) and numbers other than 0; null is false."""
    text = F.lower(F.trim(value.cast("string")))
    return F.coalesce((text == "true") | (text.try_cast("double") != 0), F.lit(False))


def map_label(value: Column, overrides: Mapping[str, str]) -> Column:
    """The override of a label, or the label itself."""
    if not overrides:
        return value
    pairs = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, value), value)


def clean_raw_labels(value: Column) -> Column:
    """Lower case, blanks to -, no-spec and null to "", _ to |."""
    text = F.replace(F.lower(value), F.lit(" "), F.lit("-"))
    return F.when(text.isNull() | (text == "no-spec"), "").otherwise(F.replace(text, F.lit("_"), F.lit("|")))


def tokens(value: Column, sep: str = "|") -> Column:
    """Trimmed, non-empty tokens; a null or empty value has none."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), f"[{sep}]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def pred_tokens(value: Column) -> Column:
    """Tokens of a model's answer, parted by , or |."""
    return tokens(F.translate(value, ",", "|"))


def multi_hot(value: Column, classes: Sequence[str], sep: str = "|") -> Column:
    """0/1 for each class in order; whole tokens count."""
    own = tokens(value, sep)
    return F.array(*[F.array_contains(own, c).cast("int") for c in classes])


def class_index(value: Column, classes: Sequence[str]) -> Column:
    """Place in the class list, from 0; a value outside it fails the query."""
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), value)
    return F.when(place > 0, (place - 1).cast("int")).otherwise(F.raise_error(F.concat(F.lit("not a class: "), F.coalesce(value, F.lit("null")))).cast("int"))


def safe_name(name: Column) -> Column:
    return F.replace(name, F.lit("+"), F.lit("plus"))


def route_photo(prediction: Column) -> Column:
    """Folder by the photo classifier's answer; null for any other answer."""
    return F.when(prediction == "photo", "photo").when(prediction == "drawing", "sketch")


def routed_name(name: Column) -> Column:
    return F.replace(name, F.lit("+"), F.lit("-plus"))


def asset_name(category: Column, number: Column, kind: str) -> Column:
    return F.format_string(f"%s_{kind}_%04d", category, number.cast("int"))


def strip_query(url: Column) -> Column:
    return F.regexp_replace(url, r"\?.*$", "")


def base_url(url: Column) -> Column:
    """Without query and without the size token before .jpg: the same for all sizes of a shot."""
    return F.regexp_replace(strip_query(url), r"_\d+\.jpg$", "")


def normalise_url(url: Column, width: int = 1000) -> Column:
    """The size token set to width, the query removed."""
    return strip_query(F.regexp_replace(url, r"_\d+\.jpg$", f"_{width}.jpg"))


def sized_url(url: Column, width: int) -> Column:
    """The query replaced by a width."""
    return F.concat(strip_query(url), F.lit(f"?imwidth={width}"))


def extract_urls(html: Column, pattern: str) -> Column:
    """All matches in a page, in order."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))


def content_hash(content: Column) -> Column:
    return F.md5(content)


def resize_dims(width: Column, height: Column, longest: int) -> Column:
    """Size after shrinking the longer side to longest; smaller images keep theirs."""
    scale = F.lit(float(longest)) / F.greatest(width, height)
    larger = F.greatest(width, height) > longest
    side = lambda x: F.when(larger, F.floor(x * scale).cast("int")).otherwise(x.cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def md5_order(seed: int, key: Column) -> Column:
    """An order that looks random and is the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
