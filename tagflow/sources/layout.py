"""One layout for the tables that are joined on name: buckets by name, so that their joins and groups need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, table: str, buckets: int, key: str = "name") -> DataFrame:
    """df as a table of so many buckets by key, sorted in each. Tables that are joined have the same number: about their bytes by 128 MB.

    df is dealt to one task a bucket, which writes one file.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)
