import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reelmart.functions.titles import sample_title_rules  # noqa: E402
from reelmart.plans.dimensions import Dimensions  # noqa: E402
from reelmart.session import local_session  # noqa: E402
from reelmart.sources.inputs import Inputs  # noqa: E402

SMALL = "/root/testdata/sf0.001"

SCHEMAS = {
    "basic": "REPORTING_DATE int, CHANNEL_ID string, VIDEO_ID string, UPLOADER_TYPE string, COUNTRY_CODE string, "
    "VIEWS long, COMMENTS long, SHARES long, LIKES long, DISLIKES long, WATCH_TIME_MINUTES decimal(38,8), "
    "SUBSCRIBERS_GAINED long, SUBSCRIBERS_LOST long, ANNOTATION_CLICK_THROUGH_RATE double, "
    "ANNOTATION_IMPRESSIONS long, ANNOTATION_CLICKABLE_IMPRESSIONS long, ANNOTATION_CLOSABLE_IMPRESSIONS long, "
    "CARD_TEASER_IMPRESSIONS long, CARD_IMPRESSIONS long",
    "revenue": "DATE int, CHANNEL_ID string, VIDEO_ID string, UPLOADER_TYPE string, COUNTRY_CODE string, "
    "AD_IMPRESSIONS long, ESTIMATED_PARTNER_REVENUE decimal(38,12), ESTIMATED_YOUTUBE_AD_REVENUE decimal(38,12), "
    "ESTIMATED_CPM decimal(38,12), ESTIMATED_MONETIZED_PLAYBACKS long",
    "demographics": "REPORTING_DATE int, VIDEO_ID string, CHANNEL_ID string, UPLOADER_CODE string, "
    "COUNTRY_CODE string, GENDER string, AGE_GROUP string, VIEW_PERCENTAGE double",
    "combined": "DATE int, VIDEO_ID string, CHANNEL_ID string, UPLOADER_TYPE string, COUNTRY_CODE string, "
    "TRAFFIC_SOURCE_TYPE int, DEVICE_TYPE int, VIEWS long, WATCH_TIME_MINUTES decimal(38,8)",
    "metadata": "VIDEO_ID string, VIDEO_TITLE string, VIDEO_LENGTH long, TIME_UPLOADED string, CHANNEL_ID string, "
    "CHANNEL_DISPLAY_NAME string, CUSTOM_ID string, THIRD_PARTY_VIDEO_ID string",
    "program": "PROGRAM_ID long, SERIES_ID string, PARENT_SERIES_ID long, SERIES_NAME string",
    "series": "PARENT_SERIES_ID long, PARENT_SERIES_NAME string",
    "corrected_series": "DOMO_SERIES_NAME string, CORRECTED_SERIES_ID string, CORRECTED_PPL_SERIES_NAME string",
    "brand_map": "CHANNEL_NAME string, BRAND_ROLL_UP string",
    "country_info": "COUNTRY_CODE string, SUB_CONTINENT string, CONTINENT string",
    "traffic_dim": "TRAFFIC_SOURCE_TYPE_ID int, TRAFFIC_SOURCE_TYPE_NAME string",
    "device_dim": "DEVICE_TYPE int, DEVICE_TYPE_NAME string",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def table(spark):
    """table(name, {column: value}, ...): rows of one input; columns left out are NULL."""

    def make(name, *rows):
        columns = [c.split()[0] for c in SCHEMAS[name].replace("decimal(38,", "decimal(38.").split(",")]
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], SCHEMAS[name])

    return make


@pytest.fixture(scope="session")
def inputs(table):
    """inputs(basic=[rows], ...): all inputs, empty unless given."""

    def make(**rows):
        return Inputs.of({name: table(name, *rows.get(name, [])) for name in SCHEMAS})

    return make


@pytest.fixture(scope="session")
def dims(inputs):
    def make(**rows):
        return Dimensions(inputs(**rows), sample_title_rules())

    return make


def rows(df, *columns):
    """Sorted rows as plain tuples; decimals as floats, dates as text."""

    def plain(v):
        if isinstance(v, date):
            return str(v)
        return float(v) if type(v).__name__ == "Decimal" else v

    return sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=str)
