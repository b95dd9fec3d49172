"""Combining two facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V
from reelmart.functions.buckets import geo_bucket
from reelmart.functions.dates import day_of_key, month_of_key
from reelmart.functions.measures import cost_per_mille
from reelmart.operators.dimensions import PLACE, VIDEO_KEY, with_place, with_video_key
from reelmart.operators.facts import (
    COUNT_SUMS,
    DAY_KEYS,
    REVENUE_SUMS,
    VIEW_SUMS,
    Periods,
    brought_together,
    demo_rows,
    in_periods,
    mean,
    own_views,
    region_revenue,
    region_views,
    sums,
    view_rows,
)

#: What a sum of shares, or of shares times ages, has before the point; counts and minutes of one key.
#: Products with counts are exact for shares of up to 13 decimals, with minutes for up to 10.
SHARE_DIGITS = 6
AGE_SHARE_DIGITS = 8
COUNT = "decimal(16,0)"
MINUTES = "decimal(21,8)"


def views_revenue_full(basic: DataFrame, revenue: DataFrame, periods: Periods = None) -> DataFrame:
    """Views and revenue side by side for every day key that either of them has.

    A full outer join on the key followed by a grouping on the same key is a union followed by one
    grouping: each side has one row per key, and the grouping treats NULL parts of a key as equal.
    The union needs one shuffle, of rows as they are (see :func:`~reelmart.operators.facts.brought_together`),
    and no join that a hot video could unbalance.
    """
    both = view_rows(basic, periods).unionByName(
        revenue.where(in_periods("DATE", periods)), allowMissingColumns=True
    )
    averaged = ["ANNOTATION_CLICK_THROUGH_RATE", "ESTIMATED_CPM"]
    rows = brought_together(both, DAY_KEYS, [*VIEW_SUMS, *REVENUE_SUMS, *averaged])
    out = rows.groupBy(*DAY_KEYS).agg(*sums(VIEW_SUMS), *sums(REVENUE_SUMS), *map(mean, averaged))
    return out.select(F.lit(V.PLATFORM).alias("PLATFORM"), "*")


def video_measures(
    basic: DataFrame, revenue: DataFrame, grain: str, periods: Periods = None, by_video: bool = False
) -> DataFrame:
    """Views and revenue by month or day, channel, video, uploader and US/Non-US.

    ESTIMATED_CPM is an average of averages by day and country, so revenue is summed by day key
    first. Its rows go as they are to where the final key places them, as those of a day key lie under one
    final key; the views are summed to the final key and placed by it. So both meet without a further shuffle.

    With ``by_video`` both go as they are to a place of their video and channel
    (:func:`~reelmart.operators.dimensions.with_place`), which a final key lies in, too, and the result has the place
    instead of their ids: what is known of them can then be joined by place without a shuffle of the sums.
    """
    if grain not in ("monthly", "daily"):
        raise ValueError(f"granularity must be 'monthly' or 'daily', not {grain!r}")
    period = month_of_key("DATE").alias("MONTH") if grain == "monthly" else day_of_key("DATE").alias("DATE")
    keys = [period, "CHANNEL_ID", "VIDEO_ID", "UPLOADER_TYPE", geo_bucket("COUNTRY_CODE").alias("GEO")]

    views = view_rows(basic, periods).select(*keys, *VIEW_SUMS)
    names = views.columns[:5]
    paid = revenue.where(in_periods("DATE", periods)).select(
        *keys, F.col("DATE").alias("_day"), "COUNTRY_CODE", *REVENUE_SUMS, "ESTIMATED_CPM"
    )
    if by_video:
        spread = [names[0], "UPLOADER_TYPE", "GEO"]
        views, paid = (with_place(rows, spread).repartition(*PLACE) for rows in (views, paid))
        names = [*PLACE, *spread]
    else:
        paid = paid.repartition(*names)
    by_day = paid.groupBy(*names, "_day", "COUNTRY_CODE").agg(*sums(REVENUE_SUMS), mean("ESTIMATED_CPM"))
    seen = views.groupBy(*names).agg(*sums(VIEW_SUMS))
    once = [F.max(name).alias(name) for name in VIEW_SUMS]  # one row of views a key
    out = (
        seen.unionByName(by_day.drop("_day", "COUNTRY_CODE"), allowMissingColumns=True)
        .groupBy(*names)
        .agg(*once, *sums(REVENUE_SUMS), F.avg("ESTIMATED_CPM").alias("ESTIMATED_CPM"))
    )
    cpm = cost_per_mille(F.col("ESTIMATED_YOUTUBE_AD_REVENUE"), F.col("AD_IMPRESSIONS"))
    return out.select(F.lit(V.PLATFORM).alias("PLATFORM"), "*", cpm.alias("CALCULATED_CPM"))


def videos_and_channels(basic: DataFrame, revenue: DataFrame, periods: Periods = None) -> DataFrame:
    """Each video with each channel it has views or revenue under, once; NULL is an id like any other."""
    ids = ["CHANNEL_ID", "VIDEO_ID"]
    seen = view_rows(basic, periods).select(*ids)
    return seen.union(revenue.where(in_periods("DATE", periods)).select(*ids)).distinct()


def region_views_revenue(basic: DataFrame, revenue: DataFrame, periods: Periods = None) -> DataFrame:
    """Daily views with the partner revenue of their video, uploader, day and country.

    Revenue has no channel, so a video under two channels shows its revenue under both. Revenue
    without views has no place in the regional report, hence the left join.
    """
    keys = [k for k in DAY_KEYS if k != "CHANNEL_ID"]
    return region_views(basic, periods).join(region_revenue(revenue, periods), keys, "left")


def region_monthly(basic: DataFrame, revenue: DataFrame, periods: Periods = None, as_rows: bool = False) -> DataFrame:
    """:func:`region_views_revenue` summed by month, channel, video, uploader and country.

    Which days a channel had views is all that the daily match needs of the views, and the days of a
    month fit the bits of a number. So views are summed to the month in the tasks that scan them and
    no day of theirs is ever shuffled; revenue, by day, meets the bits. The join is on four of the five
    keys of the last grouping, which therefore needs no shuffle of its own.

    With ``as_rows`` both go as they are to where the match by month places them, and are summed there: one shuffle of
    each instead of two, and no table of sums in the tasks that scan, which nearly as many keys as rows would outgrow.
    """
    month, day = month_of_key("DATE").alias("MONTH"), (F.col("DATE") % 100 - 1).alias("_day")
    match = ["MONTH", "VIDEO_ID", "UPLOADER_TYPE", "COUNTRY_CODE"]
    keys, amount = ["CHANNEL_ID", *match], "ESTIMATED_PARTNER_REVENUE"
    views = view_rows(basic, periods).select(month, "CHANNEL_ID", *match[1:], *COUNT_SUMS, day)
    if as_rows:
        views = views.repartition(*match)
        rows = revenue.where(in_periods("DATE", periods)).select(month, *match[1:], day, amount)
        paid = rows.repartition(*match).groupBy(*match, "_day").agg(*sums([amount]))
    else:
        paid = region_revenue(revenue, periods).select(month, *match[1:], day, amount)
    days = F.bit_or(F.expr("shiftleft(1, _day)")).alias("_days")
    v, r = views.groupBy(*keys).agg(*sums(COUNT_SUMS), days).alias("v"), paid.alias("r")
    same = [F.col(f"v.{k}") == F.col(f"r.{k}") for k in match]
    on_the_day = F.expr("getbit(_days, _day) = 1")
    joined = v.join(r, [*same, on_the_day], "left").select("v.*", amount)
    # the views stand in every row of their key, once for each day with revenue
    once = [F.first(name).alias(name) for name in COUNT_SUMS]
    return joined.groupBy(*keys).agg(*once, *sums([amount]))


def _views_by(basic: DataFrame, keys: Iterable[str], periods: Periods) -> DataFrame:
    own = own_views(basic, periods).select("*", geo_bucket("COUNTRY_CODE").alias("GEO"))
    return own.withColumnRenamed("UPLOADER_TYPE", "UPLOADER_CODE").groupBy(*keys).agg(*sums(COUNT_SUMS))


def _products(joined: DataFrame, share: str, digits: int = SHARE_DIGITS) -> tuple[Column, Column]:
    """The share times views and minutes, with all decimals of the share."""
    scale = joined.schema[share].dataType.scale
    weight = F.col(share).cast(f"decimal({digits + scale},{scale})")
    return weight * F.col("VIEWS").cast(COUNT), weight * F.col("WATCH_TIME_MINUTES").cast(MINUTES)


DEMO_KEYS = ["REPORTING_DATE", "VIDEO_ID", "CHANNEL_ID", "UPLOADER_CODE"]


def demo_join(
    basic: DataFrame,
    demographics: DataFrame,
    match_geo: bool = False,
    keep_geo: bool = False,
    periods: Periods = None,
) -> DataFrame:
    """Views and minutes by day, video, channel, uploader, gender and age midpoint.

    As reported, US/Non-US is no part of the match: every share of a key meets the views of every
    geography of that key. The sum over all those pairs equals the product of the two sums, so both
    sides are summed over geography first and no pair is ever formed. ``match_geo`` pairs equal
    geographies only; ``keep_geo`` leaves the geography of the share in the result.
    """
    keys = DEMO_KEYS + (["GEO"] if match_geo else [])
    kept = DEMO_KEYS + (["GEO"] if match_geo or keep_geo else [])
    shares = (
        demo_rows(demographics, periods)
        .groupBy(*kept, "GENDER", "MID_AGE")
        .agg(F.sum("VIEW_SHARE").alias("VIEW_SHARE"))
    )
    final = DEMO_KEYS + (["GEO"] if keep_geo else []) + ["GENDER", "MID_AGE"]
    joined = shares.join(_views_by(basic, keys, periods), keys, "left")
    views, minutes = _products(joined, "VIEW_SHARE")
    joined = joined.select(
        *final, minutes.alias("DEMO_WATCH_TIME_MINUTES"), views.alias("DEMO_VIEWS")
    )
    if match_geo and not keep_geo:
        joined = joined.groupBy(*final).agg(*sums(["DEMO_WATCH_TIME_MINUTES", "DEMO_VIEWS"]))
    renamed = joined.withColumnRenamed("UPLOADER_CODE", "UPLOADER_TYPE")
    return renamed.select(
        F.lit(V.PLATFORM).alias("PLATFORM"), month_of_key("REPORTING_DATE").alias("MONTH"), *renamed.columns
    )


def demo_totals(basic: DataFrame, demographics: DataFrame, periods: Periods = None) -> DataFrame:
    """What a profile needs of :func:`demo_join`, by month, video, channel and uploader.

    All of it is linear in the shares, so the genders and ages of a key become a few columns before
    the join and the join is one row to one row. A day of a video is one row then, so the days go to the
    task of their video, and the months that are summed there stay for what joins by video.
    """

    def part(test: Column) -> Column:
        return F.sum(F.when(test, F.col("VIEW_SHARE")).otherwise(0))

    gender = F.col("GENDER")
    shares = (
        demo_rows(demographics, periods)
        .groupBy(*DEMO_KEYS)
        .agg(
            F.sum("VIEW_SHARE").alias("ALL_SHARE"),
            F.sum(F.col("VIEW_SHARE") * F.col("MID_AGE").cast("decimal(2,0)")).alias("AGE_SHARE"),
            part(gender == V.GENDER_MALE).alias("MALE_SHARE"),
            part(gender == V.GENDER_FEMALE).alias("FEMALE_SHARE"),
            part(gender == V.GENDER_UNSPECIFIED).alias("UNSPECIFIED_SHARE"),
        )
    )
    joined = shares.join(_views_by(basic, DEMO_KEYS, periods), DEMO_KEYS, "left")
    views, minutes = _products(joined, "ALL_SHARE")
    measures = {
        "VIEWS": views,
        "WATCH_TIME_MINUTES": minutes,
        "AGE_VIEWS": _products(joined, "AGE_SHARE", AGE_SHARE_DIGITS)[0],
        "MALE_VIEWS": _products(joined, "MALE_SHARE")[0],
        "FEMALE_VIEWS": _products(joined, "FEMALE_SHARE")[0],
        "UNSPECIFIED_VIEWS": _products(joined, "UNSPECIFIED_SHARE")[0],
    }
    keys = ["MONTH", "VIDEO_ID", "CHANNEL_ID", "UPLOADER_TYPE"]
    month, uploader = month_of_key("REPORTING_DATE").alias("MONTH"), F.col("UPLOADER_CODE").alias("UPLOADER_TYPE")
    days = joined.select(month, *keys[1:3], uploader, *[m.alias(name) for name, m in measures.items()])
    return with_video_key(days).repartition(VIDEO_KEY).groupBy(*keys, VIDEO_KEY).agg(*sums(measures))
