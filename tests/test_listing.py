"""Files listed in tasks, and decodes that fail."""

import os
import struct
import zlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tagflow.sources.catalog import image_catalog, read_images
from tagflow.sources.listing import FilesReader, PrunedFilesReader, list_files, visible


@pytest.fixture()
def tree(tmp_path):
    names = [
        "a.jpg", "x/b.png", "x/y/c d.JPG", "x/y/z/e.webp", "infer/f.jpg", "_hidden/g.jpg", ".dot/h.jpg", "k=1/i.jpg", "_k=1/j.jpg", "x/_success", "x/.k.jpg", "x/l.jpg._COPYING_", "é ü/m%20.bmp", "empty/", "y/n.txt"]
    for n in names:
        path = tmp_path / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.mkdir(exist_ok=True) if n.endswith("/") else path.write_bytes(b"x" * len(n))
    return str(tmp_path)


def spark_lists(spark, root, recursive=True):
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root).select("path", "length", "modificationTime")


@pytest.mark.parametrize("partitions", [1, 2, 64])
def test_tasks_list_what_spark_lists(spark, tree, partitions):
    rows = lambda df: sorted((r.path, r.length, int(r.modificationTime.timestamp())) for r in df.collect())
    for root in (tree, "file://" + tree, "file:" + tree):
        assert rows(list_files(spark, root, partitions=partitions)) == rows(spark_lists(spark, tree))
    assert rows(list_files(spark, tree, False, partitions)) == [r for r in rows(spark_lists(spark, tree)) if r[0].endswith("/a.jpg")]


def test_no_file_list_in_the_plan(spark, tree):
    found = image_catalog(spark, tree)
    assert "InMemoryFileIndex" not in found._jdf.queryExecution().toString()
    assert {r.rel_path for r in found.collect()} == {"a.jpg", "x/b.png", "x/y/c d.JPG", "x/y/z/e.webp", "k=1/i.jpg", "_k=1/j.jpg", "é ü/m%20.bmp"}


def test_folders_that_a_filter_rules_out_are_not_listed(spark, tree):
    from pyspark.sql.datasource import StringStartsWith

    reader = PrunedFilesReader(tree, True, 64)
    assert len(list(reader.pushFilters([StringStartsWith(("path",), f"file:{tree}/x/y/")]))) == 1
    listed = {p for part in reader.partitions() for p in part.paths}
    assert listed == {tree, f"{tree}/x", f"{tree}/x/y", f"{tree}/x/y/z"}
    plain = {p for part in FilesReader(tree, True, 64).partitions() for p in part.paths}
    assert f"{tree}/empty" in plain and f"{tree}/_hidden" not in plain
    conf = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "true")
    try:
        got = list_files(spark, tree).where(F.startswith("path", F.lit(f"file:{tree}/x/y/"))).collect()
    finally:
        spark.conf.set(conf, before)
    assert {os.path.basename(r.path) for r in got} == {"c d.JPG", "e.webp"}


def test_an_empty_folder_has_no_files(spark, tmp_path):
    assert list_files(spark, str(tmp_path)).collect() == []
    assert [visible(x) for x in ("a", "_a", "_a=1", ".a", "a._COPYING_")] == [True, False, True, False, False]


def png(width=2, height=2):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + b"\x10\x20\x30" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_failed_decodes_are_counted_by_the_query_that_reads(spark, tmp_path):
    files = {"a.png": png(), "b.png": png(3, 1), "junk.png": b"junk", "empty.jpg": b"", "w.webp": b"RIFF\x1a\0\0\0WEBPVP8 ", "W2.WEBP": b"RIFF"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    counts = Observation()
    found = read_images(spark, str(tmp_path), counts=counts).collect()
    assert sorted((r.name, r.width, r.height) for r in found) == [("a", 2, 2), ("b", 3, 1)]
    assert counts.get == {"decoded": 2, "failed": 1, "unsupported": 2}  # Spark reads no row of an empty file
    assert read_images(spark, str(tmp_path), drop_invalid=False).where("height < 0").count() == 3


def test_image_files_are_written_by_tasks_in_few_folders(spark, tmp_path):
    from tagflow.plans.source_queries import write_images

    images = spark.range(2500).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("x"), "id").alias("value"))
    write_images(images, f"file://{tmp_path}/images")
    assert sorted(os.listdir(tmp_path / "images")) == ["0", "1", "2"]  # not a folder for each image
    found = {p.relative_to(tmp_path / "images").as_posix(): p.read_text() for p in (tmp_path / "images").rglob("*.*")}
    assert found == {f"{i // 1000}/{i}.bmp": f"x{i}" for i in range(2500)}
