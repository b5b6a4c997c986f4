"""Image catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagflow.functions.names import ext, path_parts, stem
from tagflow.sources.listing import list_files

EXTENSIONS = ("jpg", "jpeg", "png", "webp", "bmp")  # in order of preference


def filter_extensions(df: DataFrame, exts: Sequence[str] = EXTENSIONS, column: str = "ext") -> DataFrame:
    return df.where(F.lower(F.col(column)).isin(*exts))


def catalog_from_paths(df: DataFrame, path_col: str = "path", root: str = "", exts: Sequence[str] = EXTENSIONS, skip_dirs: Sequence[str] = ("infer",)) -> DataFrame:
    """name, ext, path, rel_path, parts, category, subcategory of the images among paths.

    category is the first folder below root, subcategory the second; null where a file lies
    higher. Paths with a folder named in skip_dirs are left out.
    """
    path = F.col(path_col)
    rel = _below(path, root.strip("/")) if root.strip("/") else path
    made = {"rel_path": rel, "parts": path_parts(rel), "name": stem(path), "ext": ext(path)}
    # made by a generator of one row: else the optimiser repeats these expressions wherever a filter or a key uses them
    row = F.inline(F.array(F.struct(*[e.alias(c) for c, e in made.items()])))
    found = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], row)
    level = lambda k: F.when(F.size("parts") > k, F.get("parts", F.lit(k - 1)))
    found = found.withColumns({"category": level(1), "subcategory": level(2)})
    for x in skip_dirs:
        found = found.where(~F.contains(F.concat(F.lit("/"), "rel_path"), F.lit(f"/{x}/")))
    return filter_extensions(found, exts)


def _below(path: Column, root: str) -> Column:
    """path without its scheme file: and root; a path that is not below root stays as it is."""
    bare = F.ltrim(F.when(F.startswith(path, F.lit("file:")), F.substr(path, F.lit(6))).otherwise(path), F.lit("/"))
    return F.when(F.startswith(bare, F.lit(f"{root}/")), F.ltrim(F.substr(bare, F.lit(len(root) + 1)), F.lit("/"))).otherwise(path)


def image_catalog(spark: SparkSession, root: str, exts: Sequence[str] = EXTENSIONS, recursive: bool = True, skip_dirs: Sequence[str] = ("infer",)) -> DataFrame:
    """The images under root. Folders are listed in tasks; contents are not read."""
    place = root.split("://")[-1].removeprefix("file:")
    return catalog_from_paths(list_files(spark, root, recursive), "path", place, exts, skip_dirs)


def filter_category(df: DataFrame, category: str) -> DataFrame:
    """One category; an error if it has no image."""
    own = df.where(F.col("category") == category)
    if own.isEmpty():
        raise ValueError(f"no such category: {category}")
    return own


#: What an Observation of read_images() holds.
IMAGE_COUNTS = ("decoded", "failed", "unsupported")


def read_images(spark: SparkSession, root: str, drop_invalid: bool = True, counts: Observation | None = None) -> DataFrame:
    """path, name, height, width, channels, data (BGR bytes) of the images under root.

    Images that cannot be decoded are left out; with drop_invalid=False they have height -1. counts gets IMAGE_COUNTS from the query that
    reads the images, without a pass of its own: files that were decoded, that were not, and WebP files, which Spark's reader does not know. A file
    of no bytes has no row and is not counted.
    """
    image = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace("image.origin", "^file:/+", "file:/")
    found = image.select(path.alias("path"), stem(path).alias("name"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")
    bad, webp = F.col("height") < 0, F.lower(ext(F.col("path"))) == "webp"
    if counts is not None:
        found = found.observe(counts, *[F.count_if(x).alias(c) for c, x in zip(IMAGE_COUNTS, (~bad, bad & ~webp, bad & webp), strict=True)])
    return found.where(~bad) if drop_invalid else found
