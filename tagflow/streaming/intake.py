"""Incremental intake: each new name is worked on once, whatever restarts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RUN, BATCH = "intake_run", "intake_batch"  # folders of done_path, and so columns of what is read there


def incremental_intake(stream: DataFrame, work: Callable[[DataFrame], DataFrame], done_path: str, checkpoint: str, key: str = "name") -> StreamingQuery:
    """Runs work on the rows of stream whose names are new and adds what it returns to done_path (see read_results).

    The names seen so far are the stream's state, a row a name, in the state store of the session (use RocksDB for many names). A new checkpoint
    is seeded with the names that done_path holds; after that no batch reads it. Of equal names in a batch one is worked on, the
    least as JSON. A batch that is repeated after a failure finds the state as it was and writes its rows in the place of those it may have written.
    Stops when all files there are were read.
    """
    spark = stream.sparkSession
    kind = stream.select(key).schema
    run, seeds = _seeded(spark, done_path, f"{checkpoint}/seed", kind, key)
    now = F.current_timestamp().alias("__now")  # one for all rows of a batch, and the same when it is repeated
    seeded = spark.readStream.schema(kind).parquet(seeds).select(key, F.lit(True).alias("__seed"), F.lit(None).cast(stream.schema).alias("__row"), now)
    rows = stream.select(key, F.lit(False).alias("__seed"), F.struct(*[F.col(f"`{c}`") for c in stream.columns]).alias("__row"), now)
    first = F.min_by("__row", F.struct("__now", F.to_json("__row"))).alias("__row")
    names = seeded.union(rows).groupBy(key).agg(F.max("__seed").alias("__seed"), F.min("__now").alias("__first"), F.max("__now").alias("__last"), first)

    def batch(df: DataFrame, n: int) -> None:
        fresh = df.where("NOT __seed AND __first = __last").select("__row.*")
        work(fresh).write.mode("overwrite").parquet(f"{done_path}/{RUN}={run}/{BATCH}={n}")

    return names.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _seeded(spark: SparkSession, done_path: str, path: str, kind, key: str) -> tuple[str, str]:
    """(a name for this checkpoint's run, the folder of its seeds), made when the checkpoint is new."""
    try:
        run = spark.read.schema("run string").json(f"{path}/run").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        run = None
    if run is None:  # the run's name is written last: without it the seeds may not be whole
        done = read_done(spark, done_path, key)
        (spark.createDataFrame([], kind) if done is None else done.select(F.col(key).cast(kind[0].dataType))).write.mode("overwrite").parquet(f"{path}/names")
        run = (uuid.uuid4().hex,)
        spark.createDataFrame([run], "run string").coalesce(1).write.mode("overwrite").json(f"{path}/run")
    return run[0], f"{path}/names"


def read_results(spark: SparkSession, done_path: str) -> DataFrame:
    """What the intake's work has returned."""
    return spark.read.parquet(done_path).drop(RUN, BATCH)


def read_done(spark: SparkSession, path: str, key: str = "name") -> DataFrame | None:
    """Names done so far; None if nothing was written yet."""
    try:
        return spark.read.parquet(path).select(F.col(key)).distinct()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
