"""Commits of results, and joins of bucketed tables."""

import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tagflow.operators import joins as J
from tagflow.sources.layout import bucketed
from tagflow.sources.results import commit_results, committed, read_results


def rows(spark, low, high, extra=None):
    df = spark.range(low, high).select(F.col("id").cast("string").alias("name"))
    return df if extra is None else df.withColumn(extra, F.lit(1))


def test_commits_are_whole_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "out")
    assert read_results(spark, path) is None
    with ThreadPoolExecutor(4) as pool:  # two writers of their own names, two of one name
        done = list(pool.map(lambda x: commit_results(rows(spark, *x[:2]), path, x[2]), [(0, 50, "a/b c"), (50, 90, "d"), (90, 95, "twice"), (90, 95, "twice")]))
    assert done[:2] == [True, True] and any(done[2:])
    assert commit_results(rows(spark, 0, 50), path, "a/b c") is False
    # a writer that was killed leaves files without a mark, some of them not whole
    os.makedirs(f"{path}/commit=killed/attempt=1/_temporary")
    rows(spark, 500, 510).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/commit=killed/attempt=2")
    with open(f"{path}/commit=killed/attempt=1/part-0.parquet", "wb") as f:
        f.write(b"half")
    assert set(committed(spark, path)) == {"a%2Fb%20c", "d", "twice"}
    assert sorted(int(r.name) for r in read_results(spark, path).collect()) == list(range(95))
    assert commit_results(rows(spark, 500, 502, "more"), path, "killed") is True
    out = read_results(spark, path)
    assert out.count() == 97 and out.where("more = 1").count() == 2


def fails(spark):
    return rows(spark, 0, 10).withColumn("x", F.when(F.col("name") == "7", F.raise_error("lost")).otherwise("ok"))


def test_a_failed_commit_does_not_count(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        commit_results(fails(spark), path, "one")
    assert committed(spark, path) == {}
    assert commit_results(rows(spark, 0, 3), path, "one") and read_results(spark, path).count() == 3


@pytest.fixture()
def no_broadcast(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    yield
    spark.conf.set(conf, before)


def below_joins(df):
    """The plan below its topmost join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[re.search("SortMergeJoin|ShuffledHashJoin", plan).start() :]


def test_joins_of_bucketed_tables_need_no_shuffle(spark, no_broadcast):
    names = spark.range(400).select(F.col("id").cast("string").alias("name"))
    catalog = names.select("name", F.concat(F.lit("r/"), "name", F.lit(".jpg")).alias("path"), F.lit("jpg").alias("ext"), F.lit(None).cast("string").alias("category"))
    tables = {
        "labels": names.where("name < '7'").withColumn("gt", F.lit("a")), "preds": names.where("name > '2'").withColumn("pred", F.lit("b")), "images": catalog,
        "outputs": names.where("name < '3'"), "tags": names.where("name < '5'").withColumns({"toe": F.lit("round"), "pos": F.col("name").cast("int")})}
    made = {k: bucketed(df, f"layout_{k}", 8) for k, df in tables.items()}
    pairs = {
        "join_gt_pred": lambda t: J.join_gt_pred(t["labels"], t["preds"]), "resolve_images": lambda t: J.resolve_images(t["labels"], t["images"]),
        "attach_tags": lambda t: J.attach_tags(t["images"].select("name"), t["tags"]), "coverage": lambda t: J.coverage(t["labels"], t["images"], t["outputs"])}
    for name, join in pairs.items():
        got = join(made)
        own = got if name != "coverage" else J.labels_marked(made["labels"], made["images"], made["outputs"])
        assert "Exchange" not in below_joins(own), name
        assert sorted(map(repr, got.collect())) == sorted(map(repr, join(tables).collect())), name
    for k in tables:
        spark.sql(f"DROP TABLE layout_{k}")


def test_blocks_of_some_mb_are_written_in_small_row_groups(spark):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tagflow.sources.scratch import written

    def blocks(batches):
        for batch in batches:
            for x in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([x]), pa.array([os.urandom(2 << 20)], pa.binary())], ["id", "data"])

    made = written(spark.range(0, 40, 1, 1).mapInArrow(blocks, "id long, data binary"), "blocks", wide=True)
    (file,) = [f.removeprefix("file://") for f in made.inputFiles()]
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 24 << 20  # without wide: one of 80 MB
    assert made.selectExpr("count(distinct id)", "sum(length(data))").first()[:] == (40, 40 << 21)
