"""The six output marts.

All of them follow one order: sum the facts to the finest key the report can see, join the large
video dimension once on the video id, sum to the report's key, and only then look up the small
dimensions. Sums are linear, so joining later gives the same report, and what is joined no longer
grows with the views of a video, channel or country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V
from reelmart.functions.buckets import device_bucket, geo_bucket, region_flags, traffic_category
from reelmart.functions.dates import month_of_key
from reelmart.functions.titles import video_form
from reelmart.operators.combine import demo_totals, region_monthly, video_measures, videos_and_channels
from reelmart.operators.dimensions import (
    PARENT_COLUMNS,
    VIDEO_KEY,
    join_by_place,
    join_by_video,
    map_channel,
    map_series,
    repeated,
    times,
    titles_and_forms,
    with_video_key,
)
from reelmart.operators.facts import COUNT_SUMS, Periods, combined_by_code, sums
from reelmart.operators.lookups import join_lookup
from reelmart.operators.profile import PROFILE_SUMS, as_one, in_two_parts, profile_columns
from reelmart.plans.dimensions import Dimensions

#: The columns of the video reports after the platform and the period, in report order.
VIDEO_COLUMNS = [
    "PUBLISHED_DATE",
    "VIDEO_ID",
    "VIDEO_TITLE",
    "SERIES_ID",
    "PARENT_SERIES_ID",
    "SERIES_NAME",
    "PARENT_SERIES_NAME",
    "CHANNEL_ID",
    "CHANNEL_NAME",
    "EXTRACTED_PPL_ID",
    "GEO",
    "UPLOADER_TYPE",
    "BRAND_ROLL_UP",
    "VIDEO_FORM",
    "DURATION",
    "VIEWS",
    "LIKES",
    "DISLIKES",
    "COMMENTS",
    "SHARES",
    "WATCH_TIME_MINUTES",
    "SUBSCRIBERS_GAINED",
    "SUBSCRIBERS_LOST",
    "AD_IMPRESSIONS",
    "ESTIMATED_PARTNER_REVENUE",
    "ESTIMATED_YOUTUBE_AD_REVENUE",
    "ESTIMATED_CPM",
    "ESTIMATED_MONETIZED_PLAYBACKS",
    "ANNOTATION_CLICKABLE_IMPRESSIONS",
    "ANNOTATION_CLOSABLE_IMPRESSIONS",
    "ANNOTATION_IMPRESSIONS",
    "CARD_IMPRESSIONS",
    "CARD_TEASER_IMPRESSIONS",
    "CALCULATED_CPM",
]


def video_mart(dims: Dimensions, grain: str, periods: Periods = None) -> DataFrame:
    """One row per month or day, channel, video, uploader and US/Non-US, with everything known of the video.

    What is known is found for each video and channel that the facts have, titles and series by video and names by
    channel, and meets the facts in one join, where these are summed: they are shuffled once, as they are.
    """
    inputs = dims.inputs
    measures = video_measures(inputs.basic, inputs.revenue, grain, periods, by_video=True)
    ids = with_video_key(videos_and_channels(inputs.basic, inputs.revenue, periods))
    titled = join_by_video(ids, titles_and_forms(inputs.metadata))
    # copies are made behind the last join
    series = dims.series_and_parents.withColumnRenamed("COPIES", "SERIES_COPIES")
    known = map_channel(map_series(titled, series, dims.parents), dims.channels).drop(VIDEO_KEY)
    joined = join_by_place(measures, known)
    copies = F.coalesce("SERIES_COPIES", F.lit(1).cast("long"))
    formed = joined.withColumns({"VIDEO_FORM": video_form("UPLOADER_TYPE", "TITLE_FORM"), "COPIES": copies})
    return repeated(formed).select("PLATFORM", "MONTH" if grain == "monthly" else "DATE", *VIDEO_COLUMNS)


def _with_forms(facts: DataFrame, dims: Dimensions, measures: list[str]) -> DataFrame:
    """Add VIDEO_FORM by video and count the measures once per matching metadata row."""
    joined = join_by_video(facts, dims.forms)
    copies = F.coalesce("FORM_COPIES", F.lit(1).cast("long"))
    return joined.withColumns(
        {"VIDEO_FORM": video_form("UPLOADER_TYPE", "TITLE_FORM"), **{m: times(facts, m, copies) for m in measures}}
    ).drop("TITLE_FORM", "FORM_COPIES")


def demographics_mart(dims: Dimensions, periods: Periods = None) -> DataFrame:
    """Audience profile by month, channel and form, with a subtotal over the forms named ALL."""
    inputs = dims.inputs
    measures = [*PROFILE_SUMS, *(f"{n}_REST" for n in PROFILE_SUMS)]
    totals = _with_forms(in_two_parts(demo_totals(inputs.basic, inputs.demographics, periods)), dims, measures)
    keys = ["MONTH", "CHANNEL_ID", "UPLOADER_TYPE"]
    levels = totals.groupingSets([[*keys, "VIDEO_FORM"], keys], *keys, "VIDEO_FORM").agg(
        *sums(measures), F.grouping("VIDEO_FORM").alias("_all")
    )
    levels = as_one(levels)
    form = F.when(F.col("_all") == 1, V.ALL_FORMS).otherwise(F.col("VIDEO_FORM"))
    return map_channel(levels.withColumn("VIDEO_FORM", form), dims.channels).select(
        F.lit(V.PLATFORM).alias("PLATFORM"),
        "MONTH",
        "CHANNEL_ID",
        "CHANNEL_NAME",
        "VIDEO_FORM",
        "UPLOADER_TYPE",
        *profile_columns(),
    )


def traffic_mart(dims: Dimensions, periods: Periods = None) -> DataFrame:
    """Own views by month, series, channel, form, traffic category and US/Non-US."""
    month = month_of_key("DATE").alias("MONTH")
    coded = combined_by_code(dims.inputs.combined, "TRAFFIC_SOURCE_TYPE", periods, month)
    formed = _with_forms(with_video_key(coded), dims, COUNT_SUMS)
    serial = map_series(formed, dims.series_copies, dims.parents)
    copies = F.coalesce("SERIES_COPIES", F.lit(1).cast("long"))
    series = ["SERIES_ID", "SERIES_NAME", *PARENT_COLUMNS]
    keys = ["MONTH", *series, "CHANNEL_ID", "VIDEO_FORM", "UPLOADER_TYPE", "US_NON_US"]
    counted = serial.withColumns({m: times(formed, m, copies) for m in COUNT_SUMS})
    category = traffic_category("TRAFFIC_SOURCE_TYPE_NAME").alias("TRAFFIC_SOURCE_TYPE_CATEGORY")
    sourced = join_lookup(counted, dims.traffic_sources, "TRAFFIC_SOURCE_TYPE")
    report = sourced.groupBy(*keys, category).agg(*sums(COUNT_SUMS))
    return map_channel(report, dims.channels).select(
        F.lit(V.PLATFORM).alias("PLATFORM"),
        "MONTH",
        "SERIES_ID",
        "SERIES_NAME",
        "PARENT_SERIES_ID",
        "PARENT_SERIES_NAME",
        "CHANNEL_ID",
        "CHANNEL_NAME",
        "BRAND_ROLL_UP",
        "VIDEO_FORM",
        "TRAFFIC_SOURCE_TYPE_CATEGORY",
        "UPLOADER_TYPE",
        "US_NON_US",
        *COUNT_SUMS,
    )


def device_mart(dims: Dimensions, periods: Periods = None) -> DataFrame:
    """Own views by month, channel, device bucket, US/Non-US and form."""
    month = month_of_key("DATE").alias("MONTH")
    coded = combined_by_code(dims.inputs.combined, "DEVICE_TYPE", periods, month)
    keys = ["MONTH", "CHANNEL_ID", "UPLOADER_TYPE", "US_NON_US", "VIDEO_FORM"]
    named = join_lookup(_with_forms(coded, dims, COUNT_SUMS), dims.devices, "DEVICE_TYPE", how="inner")
    report = named.groupBy(*keys, device_bucket("DEVICE_TYPE_NAME").alias("DEVICE_TYPE_NAME")).agg(*sums(COUNT_SUMS))
    return map_channel(report, dims.channels).select(
        F.lit(V.PLATFORM).alias("PLATFORM"),
        "MONTH",
        "CHANNEL_ID",
        "CHANNEL_NAME",
        "DEVICE_TYPE_NAME",
        "UPLOADER_TYPE",
        "US_NON_US",
        *COUNT_SUMS,
        "VIDEO_FORM",
        "BRAND_ROLL_UP",
    )


def region_mart(dims: Dimensions, periods: Periods = None) -> DataFrame:
    """Views and partner revenue by month, channel, form, uploader and part of the world."""
    inputs = dims.inputs
    measures = [*COUNT_SUMS, "ESTIMATED_PARTNER_REVENUE"]
    monthly = region_monthly(inputs.basic, inputs.revenue, periods, as_rows=True)
    keys = ["MONTH", "CHANNEL_ID", "VIDEO_FORM", "UPLOADER_TYPE"]
    placed = join_lookup(_with_forms(monthly, dims, measures), dims.countries, "COUNTRY_CODE", how="inner")
    report = placed.groupBy(
        *keys, "SUB_CONTINENT", "CONTINENT", geo_bucket("COUNTRY_CODE").alias("US_NON_US")
    ).agg(*sums(measures))
    return map_channel(report, dims.channels).select(
        F.lit(V.PLATFORM).alias("PLATFORM"),
        "MONTH",
        "CHANNEL_ID",
        "CHANNEL_NAME",
        "VIDEO_FORM",
        "UPLOADER_TYPE",
        "SUB_CONTINENT",
        "CONTINENT",
        *region_flags(),
        "US_NON_US",
        *measures,
    )
