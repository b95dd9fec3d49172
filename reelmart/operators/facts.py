"""Scans of the fact tables: a date window, the needed columns, and one aggregation.

A scan by month, or by US/Non-US, sums on the map side first, so a video, channel or country that holds a
large part of the rows leaves each task as a handful of rows before anything is shuffled. A scan by day key
has next to nothing to sum there (see :func:`brought_together`).
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmart.functions import fixed_values as V
from reelmart.functions.buckets import age_midpoint, geo_bucket
from reelmart.functions.dates import Period, in_periods
from reelmart.operators.lookups import Lookup, join_lookup

VIEW_SUMS = [
    "VIEWS",
    "COMMENTS",
    "SHARES",
    "LIKES",
    "DISLIKES",
    "WATCH_TIME_MINUTES",
    "SUBSCRIBERS_GAINED",
    "SUBSCRIBERS_LOST",
    "ANNOTATION_IMPRESSIONS",
    "ANNOTATION_CLICKABLE_IMPRESSIONS",
    "ANNOTATION_CLOSABLE_IMPRESSIONS",
    "CARD_TEASER_IMPRESSIONS",
    "CARD_IMPRESSIONS",
]
REVENUE_SUMS = [
    "AD_IMPRESSIONS",
    "ESTIMATED_PARTNER_REVENUE",
    "ESTIMATED_YOUTUBE_AD_REVENUE",
    "ESTIMATED_MONETIZED_PLAYBACKS",
]
DAY_KEYS = ["DATE", "CHANNEL_ID", "VIDEO_ID", "UPLOADER_TYPE", "COUNTRY_CODE"]
COUNT_SUMS = ["VIEWS", "WATCH_TIME_MINUTES"]

Periods = Iterable[Period] | None


def sums(names: Iterable[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def mean(name: str) -> Column:
    """Average kept to sixteen decimals; that of a short decimal would be cut to a few digits."""
    return F.avg(F.col(name).cast("decimal(30,12)")).alias(name)


def view_rows(basic: DataFrame, periods: Periods = None) -> DataFrame:
    """The views fact of a date window, with its day key under the common name."""
    return basic.where(in_periods("REPORTING_DATE", periods)).withColumnRenamed("REPORTING_DATE", "DATE")


def brought_together(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows of a day key in one task, as they are, for sums that need no further shuffle.

    Facts are kept by day, so a day key has few rows and a task that scans them finds little to sum: its table of
    sums would have nearly a row for each row it reads, outgrow the task's memory and be spilled. The rows are narrower
    than their sums, too (a decimal grows by ten digits, an average is a sum and a count). A video, channel or country
    that holds many rows has many day keys, which are spread over all tasks.
    """
    return rows.select(*keys, *measures).repartition(*keys)


def views_daily(basic: DataFrame, periods: Periods = None) -> DataFrame:
    rate = "ANNOTATION_CLICK_THROUGH_RATE"
    rows = brought_together(view_rows(basic, periods), DAY_KEYS, [*VIEW_SUMS, rate])
    return rows.groupBy(*DAY_KEYS).agg(*sums(VIEW_SUMS), mean(rate))


def revenue_daily(revenue: DataFrame, periods: Periods = None) -> DataFrame:
    paid = revenue.where(in_periods("DATE", periods))
    rows = brought_together(paid, DAY_KEYS, [*REVENUE_SUMS, "ESTIMATED_CPM"])
    return rows.groupBy(*DAY_KEYS).agg(*sums(REVENUE_SUMS), mean("ESTIMATED_CPM"))


def region_views(basic: DataFrame, periods: Periods = None) -> DataFrame:
    rows = brought_together(view_rows(basic, periods), DAY_KEYS, COUNT_SUMS)
    day = rows.groupBy(*DAY_KEYS).agg(*sums(COUNT_SUMS))
    return day.select(F.lit(V.PLATFORM).alias("PLATFORM"), "*")


def region_revenue(revenue: DataFrame, periods: Periods = None) -> DataFrame:
    """Partner revenue by video, uploader, day and country; the channel is not part of the key."""
    keys = [k for k in DAY_KEYS if k != "CHANNEL_ID"]
    paid = ["ESTIMATED_PARTNER_REVENUE"]
    rows = brought_together(revenue.where(in_periods("DATE", periods)), keys, paid)
    return rows.groupBy(*keys).agg(*sums(paid))


def own_views(basic: DataFrame, periods: Periods = None) -> DataFrame:
    return basic.where(in_periods("REPORTING_DATE", periods) & (F.col("UPLOADER_TYPE") == V.OWN_UPLOADER))


def demo_views(basic: DataFrame, periods: Periods = None) -> DataFrame:
    """Views of own uploads by day, video, channel and US/Non-US."""
    keys = ["VIDEO_ID", "REPORTING_DATE", "CHANNEL_ID", "UPLOADER_TYPE", geo_bucket("COUNTRY_CODE").alias("GEO")]
    return own_views(basic, periods).groupBy(*keys).agg(*sums(COUNT_SUMS))


def percentage_share(demographics: DataFrame) -> Column:
    """VIEW_PERCENTAGE as an exact fraction of 1: two decimals more than the input has.

    A decimal keeps all its decimals. A floating-point percentage has none of its own and is read to
    ten decimals, part of what is asked of that input.
    """
    kind = demographics.schema["VIEW_PERCENTAGE"].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0 if isinstance(kind, T.IntegralType) else 10
    wide = F.col("VIEW_PERCENTAGE").cast(f"decimal({min(38, scale + 5)},{scale})")
    return (wide * Decimal("0.01")).alias("VIEW_SHARE")


def demo_rows(demographics: DataFrame, periods: Periods = None) -> DataFrame:
    """Demographics of own uploads: the exact share (a fraction of 1) and the age midpoint."""
    own = demographics.where(in_periods("REPORTING_DATE", periods) & (F.col("UPLOADER_CODE") == V.OWN_UPLOADER))
    return own.select(
        "REPORTING_DATE",
        "VIDEO_ID",
        "CHANNEL_ID",
        "UPLOADER_CODE",
        geo_bucket("COUNTRY_CODE").alias("GEO"),
        "GENDER",
        age_midpoint("AGE_GROUP").alias("MID_AGE"),
        percentage_share(demographics),
    )


def demo_share(demographics: DataFrame, periods: Periods = None) -> DataFrame:
    keys = ["REPORTING_DATE", "VIDEO_ID", "CHANNEL_ID", "UPLOADER_CODE", "GEO", "GENDER", "MID_AGE"]
    return demo_rows(demographics, periods).groupBy(*keys).agg(F.sum("VIEW_SHARE").alias("VIEW_PERCENTAGE_SUM"))


def _own_combined(combined: DataFrame, periods: Periods, code: str, day: Column) -> DataFrame:
    own = combined.where(in_periods("DATE", periods) & (F.col("UPLOADER_TYPE") == V.OWN_UPLOADER))
    geo = geo_bucket("COUNTRY_CODE").alias("US_NON_US")
    return own.groupBy(day, "VIDEO_ID", "UPLOADER_TYPE", "CHANNEL_ID", geo, code).agg(*sums(COUNT_SUMS))


def combined_by_code(combined: DataFrame, code: str, periods: Periods = None, day: Column | None = None) -> DataFrame:
    """Own views by day (or another date column), video, channel, US/Non-US and a type code."""
    return _own_combined(combined, periods, code, F.col("DATE") if day is None else day)


def _by_type_name(coded: DataFrame, name: str) -> DataFrame:
    keys = ["DATE", "VIDEO_ID", "UPLOADER_TYPE", "CHANNEL_ID", "US_NON_US", name]
    return coded.groupBy(*keys).agg(*sums(COUNT_SUMS)).select(F.lit(V.PLATFORM).alias("PLATFORM"), "*")


def traffic_views(combined: DataFrame, traffic_dim: Lookup, periods: Periods = None) -> DataFrame:
    """Own views by day and traffic source name; unknown codes stay, without a name.

    Summed by code before the join, so the join sees one row per code and not the raw facts.
    """
    coded = combined_by_code(combined, "TRAFFIC_SOURCE_TYPE", periods)
    return _by_type_name(join_lookup(coded, traffic_dim, "TRAFFIC_SOURCE_TYPE"), "TRAFFIC_SOURCE_TYPE_NAME")


def device_views(combined: DataFrame, device_dim: Lookup, periods: Periods = None) -> DataFrame:
    """Own views by day and device name; unknown codes are dropped."""
    coded = combined_by_code(combined, "DEVICE_TYPE", periods)
    return _by_type_name(join_lookup(coded, device_dim, "DEVICE_TYPE", how="inner"), "DEVICE_TYPE_NAME")
