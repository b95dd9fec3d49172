"""What is left to load: bounds, the calendar of complete months, pending months.

Everything here is a DataFrame of one row, or of one row per month.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions.dates import day_of_key
from reelmart.functions.fixed_values import INITIAL_DATE


def _bounds(source: DataFrame, source_key: str, loaded: DataFrame, loaded_date: str) -> DataFrame:
    """The last loaded day and the last available day, in one row.

    Two one-row maxima, stacked and reduced to one row.
    """
    none = F.lit(None)
    latest = source.agg(F.max(source_key).cast("int").alias("key")).select(
        none.cast("date").alias("LOADED"), day_of_key("key").alias("LATEST")
    )
    last = loaded.agg(F.max(loaded_date).alias("LOADED")).select("LOADED", none.cast("date").alias("LATEST"))
    return latest.unionByName(last).agg(F.max("LOADED").alias("LOADED"), F.max("LATEST").alias("LATEST"))


def _initial(initial: str) -> Column:
    return F.lit(initial).cast("date")


def month_bounds(
    source: DataFrame, source_key: str, loaded: DataFrame, loaded_date: str = "MONTH", initial: str = INITIAL_DATE
) -> DataFrame:
    """START_DATE: first day after the last loaded month (or after the initial month); LATEST_DATE."""
    last = F.last_day(F.coalesce("LOADED", _initial(initial)))
    return _bounds(source, source_key, loaded, loaded_date).select(
        F.add_months(F.trunc(last, "MM"), 1).alias("START_DATE"), F.col("LATEST").alias("LATEST_DATE")
    )


def day_bounds(
    source: DataFrame, source_key: str, loaded: DataFrame, loaded_date: str = "DATE", initial: str = INITIAL_DATE
) -> DataFrame:
    """START_DATE: the day after the last loaded day, or the initial day; LATEST_DATE."""
    return _bounds(source, source_key, loaded, loaded_date).select(
        F.coalesce(F.date_add("LOADED", 1), _initial(initial)).alias("START_DATE"),
        F.col("LATEST").alias("LATEST_DATE"),
    )


def month_calendar(bounds: DataFrame) -> DataFrame:
    """The months that lie wholly between START_DATE and LATEST_DATE, with their last days."""
    first = F.when(F.trunc("START_DATE", "MM") == F.col("START_DATE"), F.col("START_DATE")).otherwise(
        F.add_months(F.trunc("START_DATE", "MM"), 1)
    )
    month = F.expr("INTERVAL 1 MONTH")
    return (
        bounds.withColumn("START_DATE", first)
        .where(F.col("START_DATE") <= F.col("LATEST_DATE"))
        .select(F.explode(F.sequence("START_DATE", "LATEST_DATE", month)).alias("PERIOD_START"), "LATEST_DATE")
        .withColumn("PERIOD_END", F.last_day("PERIOD_START"))
        .where(F.col("PERIOD_END") <= F.col("LATEST_DATE"))
        .select("PERIOD_START", "PERIOD_END")
    )


def pending_months(
    source: DataFrame,
    source_key: str,
    loaded: DataFrame,
    loaded_date: str = "MONTH",
    initial: str = INITIAL_DATE,
    strict_max: bool = False,
) -> DataFrame:
    """Complete months of the source that the output lacks.

    Also finds a month that failed while a later one succeeded. ``strict_max`` looks only behind the
    last loaded month.
    """
    if strict_max:
        return month_calendar(month_bounds(source, source_key, loaded, loaded_date, initial))
    everything = month_calendar(month_bounds(source, source_key, loaded.limit(0), loaded_date, initial))
    present = loaded.select(F.col(loaded_date).alias("PERIOD_END")).distinct()
    return everything.join(present, "PERIOD_END", "left_anti").select("PERIOD_START", "PERIOD_END")


def as_periods(calendar: Iterable[tuple[date, date]]) -> list[tuple[int, int]]:
    """First and last days as day-key pairs for the scan filter; neighbouring periods become one pair."""
    merged: list[tuple[date, date]] = []
    for first, last in sorted((c[0], c[1]) for c in calendar):
        if merged and first <= merged[-1][1] + timedelta(days=1):
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return [(int(f"{a:%Y%m%d}"), int(f"{b:%Y%m%d}")) for a, b in merged]
