"""The latest day of a fact from the statistics in its files' footers."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.session import settings

#: Parquet folders through the reader that answers a MAX from footers.
FOOTERS_ANSWER = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def greatest(facts: DataFrame, key: str) -> DataFrame:
    return facts.agg(F.max(key).cast("int").alias(key))


def greatest_of_footers(spark: SparkSession, folder: str, key: str, kind: str = "int") -> int | None:
    """The greatest value of an integer column of a Parquet folder: the tasks read footers and no column.

    Raises what Spark raises where a footer can't tell, as that of a file whose keys are all null.
    """
    with settings(spark, FOOTERS_ANSWER):
        return greatest(spark.read.schema(f"{key} {kind}").parquet(folder), key).first()[0]


def lies_in(facts: DataFrame, folder: str) -> DataFrame:
    """Note where a fact lies as Parquet files that hold its day key. What is derived from it lies nowhere."""
    _FOLDERS[facts] = folder
    return facts


def latest_key(facts: DataFrame, key: str) -> int | None:
    """The latest day key of a fact; None if it has none.

    From footers if its folder was noted. The key column is scanned where the files are elsewhere or of
    another kind, and where a footer can't tell.
    """
    folder = _FOLDERS.get(facts)
    if folder is not None:
        try:
            return greatest_of_footers(facts.sparkSession, folder, key, facts.schema[key].dataType.simpleString())
        except (PySparkException, Py4JJavaError):
            pass
    return greatest(facts, key).first()[0]


def plain_folder(spark: SparkSession, table: str) -> str | None:
    """Where an unpartitioned Parquet table of the catalog lies; None for any other table or view.

    A partitioned one is left out: its folder may hold partitions that the catalog doesn't list.
    """
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    if (described.get("Provider") or "").lower() != "parquet" or "# Partition Information" in described:
        return None
    return described.get("Location")


def partitioned(spark: SparkSession, folder: str) -> bool:
    """Whether a folder has partitions by name; their keys are no column of the files."""
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*=*")
    return bool(found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found))
