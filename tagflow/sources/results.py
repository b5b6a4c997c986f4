"""Results that several runs add to one folder: each commit is whole or not there, and can be repeated.

A commit has a name and writes a folder of its own below it; Spark's marker of a finished job, which is written last, makes it count.
So writers need no lock: two of different names both count, of two of one name the one that finished first, and one that was
killed does not.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each commit that is whole, by its (quoted) name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, tuple] = {}
    for marker in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commit=*/attempt=*/_SUCCESS")) or []:
        folder = marker.getPath().getParent()
        name = folder.getParent().getName().removeprefix("commit=")
        found[name] = min(found.get(name, (1 << 63, "")), (marker.getModificationTime(), folder.toString()))
    return {name: folder for name, (_, folder) in sorted(found.items())}


def commit_results(new: DataFrame, path: str, name: str) -> bool:
    """Adds new to the results at path under name; False, and nothing is computed, if that name is there already."""
    spark, quoted = new.sparkSession, quote(name, safe="")
    if quoted in committed(spark, path):
        return False
    new.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/commit={quoted}/attempt={uuid.uuid4().hex}")
    return True


def read_results(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all commits; columns that some lack are null. None if there are no commits."""
    folders = list(committed(spark, path).values())
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None
