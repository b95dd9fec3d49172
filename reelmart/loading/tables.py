"""Output tables: typed, partitioned by period, written by column name."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmart.plans.registry import Output
from reelmart.schemas import OUTPUT_DDL, output_schema
from reelmart.session import remove, settings


#: How a catalog names the partition of a null period.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Written:
    """What a write has counted: all rows, and those of the periods asked for that have any."""

    rows: int
    by_period: dict[date, int]


def create_output(spark: SparkSession, output: Output, table: str, location: str | None = None) -> None:
    """Create the table if it is absent."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({OUTPUT_DDL[output.name]}) "
        f"USING parquet PARTITIONED BY ({output.period}) {where}"
    )


def require_output(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"output table {table} does not exist")


def conformed(df: DataFrame, output: Output) -> DataFrame:
    """The output's columns by name, in its types. Fractions of a count are rounded, not cut."""

    def typed(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.LongType) and isinstance(df.schema[field.name].dataType, T.DecimalType):
            column = F.round(column)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*map(typed, output_schema(output.name)))


def _in_table_order(spark: SparkSession, df: DataFrame, output: Output, table: str) -> DataFrame:
    """Rows in the table's column order, gathered by period.

    A rebalance instead of a repartition by period: it makes few files per period, but still splits a
    period that holds most of the rows.
    """
    return conformed(df, output).hint("rebalance", output.period).select(*spark.table(table).columns)


def _write_settings(spark: SparkSession, overwrite: str):
    """Settings of one write.

    Small shuffle partitions stay apart up to one per core: each period is a file of its own whatever
    its size, and one task should not have to write them all.
    """
    values = {
        "spark.sql.sources.partitionOverwriteMode": overwrite,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    return settings(spark, values)


def append(df: DataFrame, output: Output, table: str) -> None:
    spark = df.sparkSession
    require_output(spark, table)
    with _write_settings(spark, "static"):
        _in_table_order(spark, df, output, table).write.insertInto(table)


def replace_periods(df: DataFrame, output: Output, table: str, periods: Iterable[date] = ()) -> Written:
    """Write whole periods; the ones present in ``df`` replace what the table had for them.

    Running the same load twice leaves the same rows. The write itself counts its rows, all of them and those of each of
    ``periods``; nothing that the table already holds is read, listed or compared.
    """
    spark = df.sparkSession
    require_output(spark, table)
    days = sorted(set(periods))
    counts = [F.count_if(F.col(output.period) == F.lit(day)).alias(f"p{i}") for i, day in enumerate(days)]
    # behind the exchange, in the tasks that write: there a task that runs again is counted once
    observed = Observation()
    rows = _in_table_order(spark, df, output, table).observe(observed, F.count(F.lit(1)).alias("all"), *counts)
    with _write_settings(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=True)
    found = observed.get
    return Written(found["all"], {day: n for i, day in enumerate(days) if (n := found[f"p{i}"])})


def periods_of(spark: SparkSession, output: Output, table: str) -> list[date]:
    """The periods that the table has, from the catalog: no file is opened."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()  # a row for each period
    days = (unquote(row.partition).removeprefix(f"{output.period}=") for row in listed)
    return sorted(date.fromisoformat(day) for day in days if day != NO_PERIOD)


def drop_periods(spark: SparkSession, output: Output, table: str, days: list[date]) -> None:
    """Remove periods: their folders, then their entries, without a job.

    In this order a reader sees a period without files as empty, and a later append finds none of the old ones.
    """
    if not days:
        return
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    for day in days:
        remove(spark, f"{described.data_type}/{output.period}={day}")
    dropped = ", ".join(f"PARTITION ({output.period} = DATE'{day}')" for day in days)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {dropped}")
    spark.catalog.refreshTable(table)


def clear_periods(spark: SparkSession, output: Output, table: str, day: str, onwards: bool = False) -> list[str]:
    """Remove one period, or it and everything after it. Returns the removed periods."""
    require_output(spark, table)
    limit = date.fromisoformat(day)
    days = [d for d in periods_of(spark, output, table) if (d >= limit if onwards else d == limit)]
    drop_periods(spark, output, table, days)
    return list(map(str, days))
