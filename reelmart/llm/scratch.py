"""Tables that are written once and read several times, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelmart.session import scratch_path


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (``spark.checkpoint.dir``); removed when the driver ends."""
    return scratch_path(spark, f"llm-{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table: cuts the lineage and survives lost executors, in columns.

    The table stays until the driver ends, since the result that reads it is lazy.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same, bucketed by a key: reads by that key need no exchange of these rows."""
    spark = df.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", folder(spark, name)).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files stay, and the rows know where
    return rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
