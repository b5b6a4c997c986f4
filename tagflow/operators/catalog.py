"""Duplicates, manifests, numbering, quotas: first-wins work without global sorts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.functions.names import content_hash, map_label, path_order
from tagflow.operators.filters import quality_gate
from tagflow.operators.joins import join_same
from tagflow.operators.ranking import place_in
from tagflow.sources.scratch import written


def first_path() -> Column:
    """The first path of a group, by parts, as file listings are."""
    return F.min_by("path", path_order(F.col("path")))


CHUNK = 1000  # occurrences in a row


def _below_subcategories(catalog: DataFrame, category: str | None) -> DataFrame:
    own = catalog.where("subcategory IS NOT NULL")
    return own if category is None else own.where(F.col("category") == category)


def duplicate_counts(catalog: DataFrame, category: str | None = None) -> DataFrame:
    """category, name, occurrences, distinct_subcats of the stems with several images below subcategory folders; nothing is listed.

    Two copies in one subcategory count; files that lie directly under a category do not.
    """
    each = _below_subcategories(catalog, category).groupBy("category", "name", "subcategory").agg(F.count("*").alias("n"))
    return each.groupBy("category", "name").agg(F.sum("n").alias("occurrences"), F.count("*").alias("distinct_subcats")).where("occurrences > 1")


def duplicate_rows(catalog: DataFrame, category: str | None = None) -> DataFrame:
    """The images of duplicate_counts(), with its columns."""
    return _below_subcategories(catalog, category).join(duplicate_counts(catalog, category), ["category", "name"])


def duplicate_stems(catalog: DataFrame, category: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """duplicate_counts() with occ, the stem's (subcat, path) in path order, and chunk: a row, from 0, for so many of them.

    Stems are counted before anything is listed: those with one image never are. A stem of at most CHUNK images (or chunk, if that is
    more) is listed at once and cut; one of more is placed in ranges of its paths, so that no task gets all of them.
    """
    counts = written(duplicate_counts(catalog, category), "duplicate_counts")
    found = _below_subcategories(catalog, category).join(counts, ["category", "name"]).select(*counts.columns, F.col("subcategory").alias("subcat"), "path", path_order(F.col("path")).alias("k"))
    most = max(chunk, CHUNK)
    occ = F.transform(F.array_sort(F.collect_list(F.struct("k", F.struct("subcat", "path").alias("x")))), lambda y: y["x"])
    whole = found.where(F.col("occurrences") <= most).groupBy(*counts.columns).agg(occ.alias("all"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / chunk).cast("int")), lambda i: F.slice("all", i * chunk + 1, F.lit(chunk)))
    listed = whole.select(*counts.columns, F.posexplode(parts).alias("chunk", "occ")).select(*counts.columns, "occ", F.col("chunk").cast("long").alias("chunk"))
    if not counts.where(F.col("occurrences") > most).isEmpty():
        many = place_in(found.where(F.col("occurrences") > most), ["category", "name"], ["k"], "place").withColumn("chunk", F.floor(F.col("place") / chunk))
        listed = listed.unionByName(many.groupBy(*counts.columns, "chunk").agg(occ.alias("occ")))
    return listed


def duplicate_summary(dups: DataFrame) -> DataFrame:
    """category, duplicate_stems, copies. dups: duplicate_counts() or duplicate_stems()."""
    first = dups.where("chunk = 0") if "chunk" in dups.columns else dups
    return first.groupBy("category").agg(F.count("*").alias("duplicate_stems"), F.sum("occurrences").alias("copies"))


def widen_duplicates(dups: DataFrame, most: int) -> DataFrame:
    """The report's wide form: subcat_1..most, path_1..most; most is at most a chunk."""
    cells = [F.get("occ", F.lit(i))[f].alias(f"{p}_{i + 1}") for p, f in (("subcat", "subcat"), ("path", "path")) for i in range(most)]
    return dups.where("chunk = 0").select(F.col("name").alias("stem"), "category", "occurrences", *cells)


def quarantine_plan(dups: DataFrame, root: str) -> DataFrame:
    """One row a copy: where it goes under a name with its subcategory, an empty action, and whether names clash.

    dups: duplicate_rows(), which lists nothing, or duplicate_stems().
    """
    one = dups.select("category", F.col("name").alias("stem"), F.explode("occ").alias("o")).select("category", "stem", F.col("o.subcat").alias("subcat"), F.col("o.path").alias("path")) if "occ" in dups.columns else dups.select(
        "category", F.col("name").alias("stem"), F.col("subcategory").alias("subcat"), "path")
    suffix = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    target = F.concat(F.lit(root.rstrip("/") + "/"), "stem", F.lit("__"), "subcat", suffix)
    rows = one.select("stem", "category", "subcat", target.alias("quarantine_path"), F.col("path").alias("original_path"), F.lit("").alias("action"))
    # counted and joined: a window would gather all copies that want one name in one task
    wanted = rows.groupBy("quarantine_path").agg((F.count("*") > 1).alias("clash"))
    return join_same(rows, wanted, ["quarantine_path"])


def first_by_stem(catalog: DataFrame, label: str = "unknown") -> DataFrame:
    """name, path of the first image, Class (a placeholder) and n_paths."""
    return catalog.groupBy("name").agg(first_path().alias("path"), F.count("*").alias("n_paths")).withColumn("Class", F.lit(label))


def manifest_from_folders(catalog: DataFrame, overrides: Mapping[str, str] | None = None, allow: Sequence[str] | None = None) -> DataFrame:
    """name, Class (the top folder, mapped), path of the first image of each (Class, name)."""
    own = catalog.where(F.col("category").isNotNull())
    if allow is not None:
        own = own.where(F.col("category").isin(*allow))
    return own.withColumn("Class", map_label(F.col("category"), overrides or {})).groupBy("Class", "name").agg(first_path().alias("path"))


def manifest_duplicates(catalog: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """name, Class, kept_path, skipped_path of the images that a manifest passes over."""
    own = catalog.where(F.col("category").isNotNull()).withColumn("Class", map_label(F.col("category"), overrides or {}))
    kept = own.groupBy("Class", "name").agg(first_path().alias("kept_path"), F.count("*").alias("n")).where("n > 1").drop("n")
    return own.join(kept, ["Class", "name"]).where("path <> kept_path").select("name", "Class", "kept_path", F.col("path").alias("skipped_path"))


def number_per_label(df: DataFrame, pad: int = 5) -> DataFrame:
    """new_name <label>_<number>: numbered in (folder, file) order within the label; null folders and files come first.

    Every row stays: a null folder is one of the folders, rows with a null label get a null name. Neither a
    large label nor a large folder is one task's work.
    """
    number = F.format_string(f"%0{pad}d", (F.col("__place") + 1).cast("int"))
    name = F.concat(F.replace("label", F.lit(" "), F.lit("_")), F.lit("_"), number)
    return place_in(df, ["label"], ["folder", "file"], "__place").withColumn("new_name", name).drop("__place")


def min_class_size(df: DataFrame, n: int, label: str = "label") -> DataFrame:
    return df.join(df.groupBy(label).count().where(F.col("count") >= n).select(label), label, "left_semi")


def quota_per_group(df: DataFrame, group: str, key: str, n: int, order: str, allow: Sequence[str] | None = None) -> DataFrame:
    """The first n keys of each group in input order; a key counts where it first occurs."""
    if allow is not None:
        df = df.where(F.col(group).isin(*allow))
    first = df.groupBy(key).agg(F.min_by(F.struct("*"), F.col(order)).alias("r")).select("r.*")
    return first.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(order))).where(F.col("rank") <= n)


def dedup_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row by order of each combination of keys."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.col(order)).alias("r")).select(*keys, "r.*")


def dedup_by_content(df: DataFrame, scope: str = "category", order: str = "pos") -> DataFrame:
    """The first asset of each content within its scope; only hashes are shuffled, if content is dropped before."""
    hashed = df if "md5" in df.columns else df.withColumn("md5", content_hash(F.col("content"))).drop("content")
    return dedup_by(hashed, [scope, "md5"], order)


def dedup_by_base_url(df: DataFrame, scope: str = "category", order: str = "pos") -> DataFrame:
    return dedup_by(df, [scope, "base_url"], order)


def curate_assets(df: DataFrame, most: int, kind: str = "ff", order: str = "pos", **limits) -> DataFrame:
    """First of each content, then the quality gate, then the first most of each category, numbered from 1."""
    passed = quality_gate(dedup_by_content(df, order=order), **limits).where("ok").drop("ok", "reason")
    number = F.row_number().over(W.partitionBy("category").orderBy(order))
    return passed.withColumn("number", number).where(F.col("number") <= most).withColumn("name", F.format_string(f"%s_{kind}_%04d", "category", "number"))
