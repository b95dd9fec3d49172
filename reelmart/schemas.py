"""Column names and types of the six outputs and of the audit table."""

from __future__ import annotations

from pyspark.sql import types as T

_VIDEO = """
    CHANNEL_ID STRING,
    VIDEO_ID STRING,
    UPLOADER_TYPE STRING,
    GEO STRING,
    VIEWS BIGINT,
    COMMENTS BIGINT,
    SHARES BIGINT,
    LIKES BIGINT,
    DISLIKES BIGINT,
    WATCH_TIME_MINUTES DECIMAL(38,4),
    SUBSCRIBERS_GAINED BIGINT,
    SUBSCRIBERS_LOST BIGINT,
    AD_IMPRESSIONS BIGINT,
    ESTIMATED_PARTNER_REVENUE DECIMAL(38,12),
    ESTIMATED_YOUTUBE_AD_REVENUE DECIMAL(38,12),
    ANNOTATION_IMPRESSIONS BIGINT,
    ANNOTATION_CLICKABLE_IMPRESSIONS BIGINT,
    ANNOTATION_CLOSABLE_IMPRESSIONS BIGINT,
    CARD_TEASER_IMPRESSIONS BIGINT,
    CARD_IMPRESSIONS BIGINT,
    ESTIMATED_CPM DECIMAL(38,12),
    CALCULATED_CPM DECIMAL(38,3),
    ESTIMATED_MONETIZED_PLAYBACKS BIGINT,
    PUBLISHED_DATE TIMESTAMP,
    VIDEO_TITLE STRING,
    DURATION BIGINT,
    CHANNEL_NAME STRING,
    EXTRACTED_PPL_ID DECIMAL(38,0),
    SERIES_ID DECIMAL(38,5),
    SERIES_NAME STRING,
    PARENT_SERIES_ID STRING,
    PARENT_SERIES_NAME STRING,
    BRAND_ROLL_UP STRING,
    VIDEO_FORM STRING"""

OUTPUT_DDL = {
    "monthly_video": f"PLATFORM STRING, MONTH DATE, {_VIDEO}",
    "daily_video": f"PLATFORM STRING, DATE DATE, {_VIDEO}",
    "demographics": """
        PLATFORM STRING, MONTH DATE, CHANNEL_ID STRING, CHANNEL_NAME STRING, VIDEO_FORM STRING,
        UPLOADER_TYPE STRING, VIEWS BIGINT, WATCH_TIME_MINUTES DECIMAL(38,8), MEDIAN_AGE DECIMAL(38,8),
        PERCENTAGE_MALE DECIMAL(38,8), PERCENTAGE_FEMALE DECIMAL(38,8), PERCENTAGE_OTHER DECIMAL(38,8)""",
    "traffic": """
        PLATFORM STRING, MONTH DATE, SERIES_ID DECIMAL(38,0), SERIES_NAME STRING,
        PARENT_SERIES_ID DECIMAL(38,0), PARENT_SERIES_NAME STRING, CHANNEL_ID STRING, CHANNEL_NAME STRING,
        BRAND_ROLL_UP STRING, VIDEO_FORM STRING, TRAFFIC_SOURCE_TYPE_CATEGORY STRING, UPLOADER_TYPE STRING,
        US_NON_US STRING, VIEWS BIGINT, WATCH_TIME_MINUTES DECIMAL(38,8)""",
    "device": """
        PLATFORM STRING, MONTH DATE, CHANNEL_ID STRING, CHANNEL_NAME STRING, DEVICE_TYPE_NAME STRING,
        UPLOADER_TYPE STRING, US_NON_US STRING, VIEWS BIGINT, WATCH_TIME_MINUTES DECIMAL(38,8),
        VIDEO_FORM STRING, BRAND_ROLL_UP STRING""",
    "region": """
        PLATFORM STRING, MONTH DATE, CHANNEL_ID STRING, CHANNEL_NAME STRING, VIDEO_FORM STRING,
        UPLOADER_TYPE STRING, SUB_CONTINENT STRING, CONTINENT STRING, AMER INT, LATAM INT, EMEA INT, AMEA INT,
        US_NON_US STRING, VIEWS BIGINT, WATCH_TIME_MINUTES DECIMAL(38,8),
        ESTIMATED_PARTNER_REVENUE DECIMAL(38,8)""",
}

AUDIT_DDL = """
    RUN_ID STRING, OUTPUT STRING, PERIOD_START DATE, PERIOD_END DATE, STATUS STRING, ROWS BIGINT,
    MESSAGE STRING, LOGGED_AT TIMESTAMP"""


def output_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(OUTPUT_DDL[name])
