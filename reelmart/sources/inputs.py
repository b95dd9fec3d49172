"""The input tables of the marts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reelmart.sources.latest import latest_key, lies_in, partitioned, plain_folder

#: Columns every input must offer; further columns are ignored.
INPUT_COLUMNS = {
    "basic": [
        "REPORTING_DATE",
        "CHANNEL_ID",
        "VIDEO_ID",
        "UPLOADER_TYPE",
        "COUNTRY_CODE",
        "VIEWS",
        "COMMENTS",
        "SHARES",
        "LIKES",
        "DISLIKES",
        "WATCH_TIME_MINUTES",
        "SUBSCRIBERS_GAINED",
        "SUBSCRIBERS_LOST",
        "ANNOTATION_CLICK_THROUGH_RATE",
        "ANNOTATION_IMPRESSIONS",
        "ANNOTATION_CLICKABLE_IMPRESSIONS",
        "ANNOTATION_CLOSABLE_IMPRESSIONS",
        "CARD_TEASER_IMPRESSIONS",
        "CARD_IMPRESSIONS",
    ],
    "revenue": [
        "DATE",
        "CHANNEL_ID",
        "VIDEO_ID",
        "UPLOADER_TYPE",
        "COUNTRY_CODE",
        "AD_IMPRESSIONS",
        "ESTIMATED_PARTNER_REVENUE",
        "ESTIMATED_YOUTUBE_AD_REVENUE",
        "ESTIMATED_CPM",
        "ESTIMATED_MONETIZED_PLAYBACKS",
    ],
    "demographics": [
        "REPORTING_DATE",
        "VIDEO_ID",
        "CHANNEL_ID",
        "UPLOADER_CODE",
        "COUNTRY_CODE",
        "GENDER",
        "AGE_GROUP",
        "VIEW_PERCENTAGE",
    ],
    "combined": [
        "DATE",
        "VIDEO_ID",
        "CHANNEL_ID",
        "UPLOADER_TYPE",
        "COUNTRY_CODE",
        "TRAFFIC_SOURCE_TYPE",
        "DEVICE_TYPE",
        "VIEWS",
        "WATCH_TIME_MINUTES",
    ],
    "metadata": [
        "VIDEO_ID",
        "VIDEO_TITLE",
        "VIDEO_LENGTH",
        "TIME_UPLOADED",
        "CHANNEL_ID",
        "CHANNEL_DISPLAY_NAME",
        "CUSTOM_ID",
        "THIRD_PARTY_VIDEO_ID",
    ],
    "program": ["PROGRAM_ID", "SERIES_ID", "PARENT_SERIES_ID", "SERIES_NAME"],
    "series": ["PARENT_SERIES_ID", "PARENT_SERIES_NAME"],
    "corrected_series": ["DOMO_SERIES_NAME", "CORRECTED_SERIES_ID", "CORRECTED_PPL_SERIES_NAME"],
    "brand_map": ["CHANNEL_NAME", "BRAND_ROLL_UP"],
    "country_info": ["COUNTRY_CODE", "SUB_CONTINENT", "CONTINENT"],
    "traffic_dim": ["TRAFFIC_SOURCE_TYPE_ID", "TRAFFIC_SOURCE_TYPE_NAME"],
    "device_dim": ["DEVICE_TYPE", "DEVICE_TYPE_NAME"],
}

FACTS = ["basic", "revenue", "demographics", "combined"]


@dataclass(frozen=True)
class Inputs:
    basic: DataFrame
    revenue: DataFrame
    demographics: DataFrame
    combined: DataFrame
    metadata: DataFrame
    program: DataFrame
    series: DataFrame
    corrected_series: DataFrame
    brand_map: DataFrame
    country_info: DataFrame
    traffic_dim: DataFrame
    device_dim: DataFrame

    def __post_init__(self):
        for name, columns in INPUT_COLUMNS.items():
            have = {c.upper() for c in getattr(self, name).columns}
            missing = [c for c in columns if c not in have]
            if missing:
                raise ValueError(f"input {name} lacks {', '.join(missing)}")

    def latest(self, name: str, key: str) -> int | None:
        """The latest day key of a fact, from footers if its folder is known; None if it has none."""
        return latest_key(getattr(self, name), key)

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame], folders: Mapping[str, str] | None = None) -> Inputs:
        """Inputs by name. ``folders`` tells where the table of an input lies as unpartitioned Parquet files."""
        chosen = {name: tables[name].select(*columns) for name, columns in INPUT_COLUMNS.items()}
        for name, folder in (folders or {}).items():
            lies_in(chosen[name], folder)
        return cls(**chosen)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Inputs:
        """Catalog tables by name, e.g. ``{"basic": "lake.reports.basic", ...}``."""
        places = {name: plain_folder(spark, names[name]) for name in FACTS}
        folders = {name: folder for name, folder in places.items() if folder}
        return cls.of({name: spark.table(names[name]) for name in INPUT_COLUMNS}, folders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Inputs:
        """One Parquet folder or file per input, named after it."""
        tables = {name: spark.read.parquet(f"{folder}/{name}") for name in INPUT_COLUMNS}
        flat = {name: f"{folder}/{name}" for name in FACTS if not partitioned(spark, f"{folder}/{name}")}
        return cls.of(tables, flat)
