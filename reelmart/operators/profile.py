"""Audience profiles: age and gender of a group's views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V
from reelmart.functions.dates import month_of_key
from reelmart.functions.measures import percentage, ratio
from reelmart.operators.lookups import join_lookup, lookup

PROFILE_SUMS = ["VIEWS", "WATCH_TIME_MINUTES", "AGE_VIEWS", "MALE_VIEWS", "FEMALE_VIEWS", "UNSPECIFIED_VIEWS"]


def in_two_parts(totals: DataFrame) -> DataFrame:
    """The sums cut at the reported eight decimals, and what is beyond them as ``<name>_REST``.

    Both parts can be multiplied by copies and summed further within 38 digits, and together lose
    nothing. :func:`as_one` puts them together, which rounds once.
    """

    def parts(name: str) -> list[Column]:
        scale = totals.schema[name].dataType.scale
        if scale <= 8:
            return [F.col(name).cast("decimal(38,8)").alias(name), F.lit(0).cast("decimal(18,8)").alias(f"{name}_REST")]
        wide = f"decimal(37,{scale})"
        whole = F.call_function("floor", F.col(name), F.lit(8)).cast("decimal(38,8)")
        rest = F.col(name).cast(wide) - whole.cast(wide)
        return [whole.alias(name), rest.cast(f"decimal({scale},{scale})").alias(f"{name}_REST")]

    others = [c for c in totals.columns if c not in PROFILE_SUMS]
    return totals.select(*others, *[part for name in PROFILE_SUMS for part in parts(name)])


def as_one(sums: DataFrame) -> DataFrame:
    whole = {n: F.col(n) + F.col(f"{n}_REST").cast("decimal(38,8)") for n in PROFILE_SUMS}
    return sums.withColumns(whole).drop(*[f"{n}_REST" for n in PROFILE_SUMS])


def profile_columns() -> list[Column]:
    """Ratios over the sums named in ``PROFILE_SUMS``.

    MEDIAN_AGE keeps its reported name; it is the mean of the age midpoints weighted by views. Views
    of an unknown age count in the total only. A group without views has no ratios (NULL).
    """
    total = F.col("VIEWS")
    return [
        F.col("VIEWS"),
        F.col("WATCH_TIME_MINUTES"),
        ratio(F.col("AGE_VIEWS"), total).alias("MEDIAN_AGE"),
        percentage(F.col("MALE_VIEWS"), total).alias("PERCENTAGE_MALE"),
        percentage(F.col("FEMALE_VIEWS"), total).alias("PERCENTAGE_FEMALE"),
        percentage(F.col("UNSPECIFIED_VIEWS"), total).alias("PERCENTAGE_OTHER"),
    ]


def demo_profile(detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Profile of each group of a :func:`~reelmart.operators.combine.demo_join` result.

    The total of a group and its shares by age and gender come from one grouping, without a window.
    """
    views, gender = F.col("DEMO_VIEWS"), F.col("GENDER")
    scale = detail.schema["DEMO_VIEWS"].dataType.scale

    def of(name: str) -> Column:
        return F.sum(F.when(gender == name, views).otherwise(0))

    measures = [
        F.sum(views),
        F.sum("DEMO_WATCH_TIME_MINUTES"),
        F.sum(views.cast(f"decimal(35,{scale})") * F.col("MID_AGE").cast("decimal(2,0)")),
        of(V.GENDER_MALE),
        of(V.GENDER_FEMALE),
        of(V.GENDER_UNSPECIFIED),
    ]
    sums = [m.alias(name) for m, name in zip(measures, PROFILE_SUMS)]
    return detail.groupBy(*keys).agg(*sums).select(*keys, *profile_columns())


def demo_geo_sum(detail: DataFrame) -> DataFrame:
    """Views and minutes of a demographic detail by month, channel and US/Non-US."""
    return detail.groupBy(month_of_key("REPORTING_DATE").alias("MONTH"), "CHANNEL_ID", "GEO").agg(
        F.sum("DEMO_VIEWS").alias("TOTAL_VIEWS"),
        F.sum("DEMO_WATCH_TIME_MINUTES").alias("TOTAL_WATCH_TIME_MINUTES"),
    )


def with_group_total(detail: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over each group to every row of the group.

    What ``SUM(...) OVER (PARTITION BY ...)`` gives, but a window would sort a whole group in one
    task. Here the totals are a grouping, joined back as a lookup. Give a detail that is written or
    cheap to read: both sides use it.
    """
    totals = detail.groupBy(*keys).agg(F.sum(value).alias(name))
    return join_lookup(detail, lookup(totals, *keys), *keys, null_safe=True)
