"""Tables kept between the steps of an operator."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Where it is unset, a temporary folder, but only if the driver is the only executor: on a cluster
    each executor would write to a disk of its own, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = _temporary()
    return found


@functools.cache
def _temporary() -> str:
    """The driver's own folder: one for its lifetime."""
    return "file://" + tempfile.mkdtemp(prefix="tagflow-")


#: For rows of some MB: Parquet's writer looks at its size only after 100 rows, and Spark's reader takes up to 4,096 rows of a row group at a time.
WIDE = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}  # the latter is for row groups too


def written(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors.

    Compressed by zstd, whose buffers are in the heap; the buffers of the default codec are outside of it and linger.
    wide: rows are blocks of some MB; row groups are then of a few rows, so that neither writer nor reader holds many.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tagflow/{uuid.uuid4().hex}/{name}"
    df.write.options(compression="zstd", **(WIDE if wide else {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes what written() has written. Nothing that was made of it may be computed any more."""
    for df in tables:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(df._written_path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place.getParent(), True)
