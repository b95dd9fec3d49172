"""The mart's inputs over a TPC-H-like star schema.

Each input is one SELECT in the SQL that Spark and DuckDB share, with the star's tables as
``{lineitem}``, ``{part}``, ... Every row of the star becomes a row of an input; the odd cases the
reports must cope with (NULL keys, unknown countries, repeated metadata, unmatched codes) are made
by rewriting values, not by leaving rows out.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from reelmart.sources.inputs import Inputs

_DAY = "CAST((year(l_shipdate) + 28) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT)"
_VIDEO = """CASE WHEN l_partkey % 97 = 3 THEN NULL
            WHEN l_tax > 0.075 THEN 'x' || CAST(l_partkey AS STRING)
            ELSE 'v' || CAST(l_partkey AS STRING) END"""
_CHANNEL = """'c' || CAST(CAST(floor(l_partkey / 50) AS BIGINT)
            + CASE WHEN l_linestatus = 'F' AND l_partkey % 10 = 0 THEN 1 ELSE 0 END AS STRING)"""
_UPLOADER = """CASE WHEN l_returnflag = 'R' THEN 'thirdParty'
            WHEN l_quantity = 50 THEN 'SELF'
            WHEN l_quantity = 49 THEN NULL
            ELSE 'self' END"""
_COUNTRY = """CASE WHEN l_suppkey % 25 = 0 THEN 'US'
            WHEN l_suppkey % 25 = 23 THEN 'ZZ'
            WHEN l_suppkey % 25 = 24 THEN NULL
            ELSE 'NATION_' || CAST(l_suppkey % 25 AS STRING) END"""

BASIC = f"""
    SELECT {_DAY} AS REPORTING_DATE,
           {_CHANNEL} AS CHANNEL_ID,
           {_VIDEO} AS VIDEO_ID,
           {_UPLOADER} AS UPLOADER_TYPE,
           {_COUNTRY} AS COUNTRY_CODE,
           CAST(l_quantity AS BIGINT) AS VIEWS,
           CAST(l_linenumber AS BIGINT) AS COMMENTS,
           CAST(l_orderkey % 5 AS BIGINT) AS SHARES,
           CAST(l_partkey % 7 AS BIGINT) AS LIKES,
           CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_suppkey % 3 AS BIGINT) END AS DISLIKES,
           CAST(l_extendedprice AS DECIMAL(12, 2)) AS WATCH_TIME_MINUTES,
           CAST(l_orderkey % 4 AS BIGINT) AS SUBSCRIBERS_GAINED,
           CAST(l_suppkey % 2 AS BIGINT) AS SUBSCRIBERS_LOST,
           CAST(l_discount AS DECIMAL(4, 2)) AS ANNOTATION_CLICK_THROUGH_RATE,
           CAST(l_linenumber * 3 AS BIGINT) AS ANNOTATION_IMPRESSIONS,
           CAST(l_linenumber * 2 AS BIGINT) AS ANNOTATION_CLICKABLE_IMPRESSIONS,
           CAST(l_linenumber + 1 AS BIGINT) AS ANNOTATION_CLOSABLE_IMPRESSIONS,
           CAST(l_orderkey % 11 AS BIGINT) AS CARD_TEASER_IMPRESSIONS,
           CAST(l_orderkey % 13 AS BIGINT) AS CARD_IMPRESSIONS
    FROM {{lineitem}}"""

# Rows of the first two line numbers report another country, so that views and revenue both have
# keys the other one lacks.
REVENUE = f"""
    SELECT {_DAY} AS DATE,
           {_CHANNEL} AS CHANNEL_ID,
           {_VIDEO} AS VIDEO_ID,
           {_UPLOADER} AS UPLOADER_TYPE,
           CASE WHEN l_linenumber <= 2 THEN 'NATION_5' ELSE {_COUNTRY} END AS COUNTRY_CODE,
           CAST(round(l_tax * 100) AS BIGINT) * l_linenumber AS AD_IMPRESSIONS,
           CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(4, 2)) AS ESTIMATED_PARTNER_REVENUE,
           CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(4, 2)) AS ESTIMATED_YOUTUBE_AD_REVENUE,
           CAST(l_extendedprice AS DECIMAL(12, 2)) AS ESTIMATED_CPM,
           CAST(l_quantity AS BIGINT) AS ESTIMATED_MONETIZED_PLAYBACKS
    FROM {{lineitem}}"""

DEMOGRAPHICS = f"""
    SELECT {_DAY} AS REPORTING_DATE,
           CASE WHEN l_linenumber = 7 THEN 'd' || CAST(l_partkey AS STRING) ELSE {_VIDEO} END AS VIDEO_ID,
           {_CHANNEL} AS CHANNEL_ID,
           {_UPLOADER} AS UPLOADER_CODE,
           CASE WHEN l_linenumber = 1 THEN 'US' ELSE {_COUNTRY} END AS COUNTRY_CODE,
           CASE l_linenumber % 4 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'USER_SPECIFIED'
                ELSE 'UNKNOWN' END AS GENDER,
           CASE l_suppkey % 8 WHEN 0 THEN 'AGE_13_17' WHEN 1 THEN 'AGE_18_24' WHEN 2 THEN 'AGE_25_34'
                WHEN 3 THEN 'AGE_35_44' WHEN 4 THEN 'AGE_45_54' WHEN 5 THEN 'AGE_55_64' WHEN 6 THEN 'AGE_65_'
                ELSE 'AGE_UNKNOWN' END AS AGE_GROUP,
           CAST(l_quantity AS DECIMAL(4, 1)) * CAST(1.75 AS DECIMAL(3, 2)) AS VIEW_PERCENTAGE
    FROM {{lineitem}}"""

COMBINED = f"""
    SELECT {_DAY} AS DATE,
           {_VIDEO} AS VIDEO_ID,
           {_CHANNEL} AS CHANNEL_ID,
           {_UPLOADER} AS UPLOADER_TYPE,
           {_COUNTRY} AS COUNTRY_CODE,
           CAST(l_suppkey % 28 AS INT) AS TRAFFIC_SOURCE_TYPE,
           CAST(l_linenumber * 4 AS INT) AS DEVICE_TYPE,
           CAST(l_quantity AS BIGINT) AS VIEWS,
           CAST(l_extendedprice AS DECIMAL(12, 2)) AS WATCH_TIME_MINUTES
    FROM {{lineitem}}"""

_TITLE = """CASE p_size % 14
                WHEN 0 THEN p_name || ' Mega Marathon #Shorts'
                WHEN 1 THEN p_name || ' marathon #shorts'
                WHEN 2 THEN p_name || ' Marathon Night'
                WHEN 3 THEN p_name || ' Full Episode part 2'
                WHEN 4 THEN p_name || ' teen cheerleader is abducted by family friend'
                WHEN 5 THEN p_name || ' Teen Cheerleader is Abducted by Family Friend, Part 1'
                WHEN 6 THEN p_name || ' Angry Sellers Lose Their Cool'
                WHEN 7 THEN p_name || ': Best of ' || p_brand
                WHEN 8 THEN p_name || ' #Shorts'
                WHEN 9 THEN p_name
                WHEN 10 THEN NULL
                WHEN 11 THEN p_name || ' angry sellers lose their cool #shorts'
                WHEN 12 THEN upper(p_name) || ' COMPILATION'
                ELSE p_name || ' clip' END"""
# Every phrase that decides a form, one after another.
_PHRASE = """CASE CAST(floor(p_partkey / 3) AS BIGINT) % 64
                WHEN 0 THEN ' mega marathon'
                WHEN 1 THEN ' Marathon'
                WHEN 2 THEN ' full episode'
                WHEN 3 THEN ' Full Episodes'
                WHEN 4 THEN ' full movie'
                WHEN 5 THEN ' Full Documentary'
                WHEN 6 THEN ' ultimate guide'
                WHEN 7 THEN ' Full Ep'
                WHEN 8 THEN ' full length'
                WHEN 9 THEN ' Husband Vanished After 37 Years'
                WHEN 10 THEN ' buried: knights templar and the holy grail'
                WHEN 11 THEN ' Wanda Durant Story'
                WHEN 12 THEN ' college admissions scandal'
                WHEN 13 THEN ' James Van Der Beek'
                WHEN 14 THEN ' 14-year-old girl goes missing while walking dog'
                WHEN 15 THEN ' He Buried Teen Girl Five Feet Under After Night Out'
                WHEN 16 THEN ' real estate mom disappears during showing'
                WHEN 17 THEN ' Teen Cheerleader Is Abducted By Family Friend'
                WHEN 18 THEN ' compilation'
                WHEN 19 THEN ' Compilations'
                WHEN 20 THEN ' top '
                WHEN 21 THEN ' Most Viewed Moments'
                WHEN 22 THEN ' best moments of all time'
                WHEN 23 THEN ' Moments Of All Time'
                WHEN 24 THEN ' blow your mind'
                WHEN 25 THEN ' Jaw-Dropping'
                WHEN 26 THEN ' mind-boggling'
                WHEN 27 THEN ' Deadliest'
                WHEN 28 THEN ' more super rare'
                WHEN 29 THEN ' Horrifying Strange Creatures'
                WHEN 30 THEN ' rapid fire negotiations'
                WHEN 31 THEN ' Most Iconic Moments'
                WHEN 32 THEN ' greatest hits'
                WHEN 33 THEN ' Best Of'
                WHEN 34 THEN ' of all time'
                WHEN 35 THEN ' Insanely High Appraisals'
                WHEN 36 THEN ' rare & patriotic us military items'
                WHEN 37 THEN ' High Value Appraisals'
                WHEN 38 THEN ' super rare high value items'
                WHEN 39 THEN ' Angry Sellers Lose Their Cool'
                WHEN 40 THEN ' shorts'
                WHEN 41 THEN ' #Shorts'
                ELSE '' END"""
_METADATA = f"""
    SELECT 'v' || CAST(p_partkey AS STRING) AS VIDEO_ID,
           {_TITLE} || CASE WHEN p_size % 14 IN (9, 13) THEN {_PHRASE} ELSE '' END AS VIDEO_TITLE,
           CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_size * 60 END AS VIDEO_LENGTH,
           CASE WHEN p_partkey % 101 = 0 THEN NULL
                ELSE '20' || CAST(10 + p_partkey % 15 AS STRING) || '/0' || CAST(1 + p_partkey % 9 AS STRING)
                     || '/' || CAST(10 + p_partkey % 19 AS STRING) || ' 0' || CAST(p_partkey % 10 AS STRING)
                     || ':30:00' END AS TIME_UPLOADED,
           'c' || CAST(CAST(floor(p_partkey / 50) AS BIGINT) AS STRING) AS CHANNEL_ID,
           CASE CAST(floor(p_partkey / 50) AS BIGINT) % 9
                WHEN 0 THEN 'Vikings' WHEN 1 THEN 'Biography' WHEN 2 THEN 'Pawn Stars' WHEN 3 THEN 'Lifetime Movies'
                WHEN 4 THEN 'vikings' WHEN 5 THEN 'Dance Moms' WHEN 6 THEN 'Parking Wars' WHEN 7 THEN NULL
                ELSE 'Channel of ' || p_brand END
                || CASE WHEN p_partkey % 4 = 1 THEN ' (old)' ELSE '' END AS CHANNEL_DISPLAY_NAME,
           CASE p_partkey % 8
                WHEN 0 THEN 'AA_PGRMID_' || CAST(10000 + p_partkey AS STRING)
                WHEN 1 THEN 'AA_PGRMID_1'
                WHEN 3 THEN CAST(10000 + p_partkey AS STRING)
                WHEN 5 THEN CAST(10000 + p_partkey AS STRING) || '_X'
                WHEN 7 THEN 'XX_PGRMID_AB'
                ELSE NULL END AS CUSTOM_ID,
           CASE p_partkey % 8
                WHEN 1 THEN CAST(10000 + p_partkey AS STRING) || '_A'
                WHEN 2 THEN '00' || CAST(10000 + p_partkey AS STRING)
                WHEN 4 THEN 'AB_' || CAST(10000 + p_partkey AS STRING) || '_X'
                WHEN 6 THEN CASE p_partkey % 16 WHEN 6 THEN '12.7' ELSE '0000' END
                ELSE NULL END AS THIRD_PARTY_VIDEO_ID,
           p_size
    FROM {{part}}"""
# The longest videos are listed twice, the second time under a title of their own.
_META_COLUMNS = """VIDEO_LENGTH, TIME_UPLOADED, CHANNEL_ID, CHANNEL_DISPLAY_NAME, CUSTOM_ID, THIRD_PARTY_VIDEO_ID"""
METADATA = f"""
    SELECT VIDEO_ID, VIDEO_TITLE, {_META_COLUMNS} FROM ({_METADATA}) m
    UNION ALL
    SELECT VIDEO_ID, VIDEO_TITLE || ' compilation', {_META_COLUMNS} FROM ({_METADATA}) m WHERE p_size = 50"""

PROGRAM = """
    SELECT 10000 + p_partkey AS PROGRAM_ID,
           CASE WHEN p_partkey % 9 = 0 THEN NULL
                ELSE CAST(1000 + CAST(floor(p_partkey / 5) AS BIGINT) AS STRING) END AS SERIES_ID,
           CASE WHEN p_partkey % 4 = 0 THEN NULL
                ELSE 500 + CAST(floor(p_partkey / 20) AS BIGINT) + p_partkey % 2 END AS PARENT_SERIES_ID,
           CASE p_partkey % 6 WHEN 0 THEN 'w_dget' WHEN 1 THEN NULL WHEN 2 THEN 'Lost' || chr(92) || 'Gear'
                WHEN 3 THEN 'Hot Everything Else' ELSE p_name || ' ' || p_brand END AS SERIES_NAME
    FROM {part}"""

SERIES = """
    SELECT 500 + s_suppkey AS PARENT_SERIES_ID,
           CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_name END AS PARENT_SERIES_NAME FROM {supplier}
    UNION ALL
    SELECT 500 + s_suppkey, 'A second name ' || CAST(s_nationkey AS STRING) FROM {supplier} WHERE s_acctbal > 5000"""

CORRECTED_SERIES = """
    SELECT CASE n_nationkey WHEN 0 THEN 'Red Widget' WHEN 1 THEN 'Cold Gear' WHEN 2 THEN 'Hot Rod'
                WHEN 3 THEN 'Large Plate or Rod' ELSE 'Label ' || CAST(n_nationkey AS STRING) END AS DOMO_SERIES_NAME,
           CASE WHEN n_nationkey = 2 THEN NULL ELSE CAST(9000 + n_nationkey AS STRING) END AS CORRECTED_SERIES_ID,
           CASE WHEN n_nationkey = 1 THEN NULL ELSE 'Corrected ' || n_name END AS CORRECTED_PPL_SERIES_NAME
    FROM {nation}"""

BRAND_MAP = """
    SELECT CASE n_nationkey WHEN 0 THEN 'Vikings' WHEN 1 THEN 'Biography' WHEN 2 THEN 'Parking Wars'
                ELSE 'Channel of Brand#' || CAST(n_nationkey AS STRING) END AS CHANNEL_NAME,
           'Brand ' || r_name AS BRAND_ROLL_UP
    FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    UNION ALL
    SELECT 'Biography', 'A second brand' FROM {nation} WHERE n_nationkey = 1"""

COUNTRY_INFO = """
    SELECT CASE WHEN n_nationkey = 0 THEN 'US' ELSE n_name END AS COUNTRY_CODE,
           CASE n_nationkey % 4 WHEN 0 THEN 'CARIBBEAN' WHEN 1 THEN 'LATIN NORTH' WHEN 2 THEN 'WEST'
                ELSE NULL END AS SUB_CONTINENT,
           CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'North America' WHEN 'ASIA' THEN 'Asia'
                WHEN 'EUROPE' THEN 'Europe' ELSE 'Oceania' END AS CONTINENT
    FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

TRAFFIC_DIM = """
    SELECT n_nationkey AS TRAFFIC_SOURCE_TYPE_ID,
           CASE n_nationkey WHEN 0 THEN 'Browse features' WHEN 1 THEN 'YouTube search' WHEN 2 THEN 'Suggested videos'
                WHEN 3 THEN 'External' WHEN 4 THEN 'YouTube advertising' WHEN 5 THEN 'Playlists'
                WHEN 6 THEN 'Playlist pages' WHEN 7 THEN NULL ELSE 'Source ' || n_name END AS TRAFFIC_SOURCE_TYPE_NAME
    FROM {nation}"""

DEVICE_DIM = """
    SELECT n_nationkey AS DEVICE_TYPE,
           CASE n_nationkey WHEN 4 THEN 'Mobile Phone' WHEN 8 THEN 'Tablet' WHEN 12 THEN 'Computer' WHEN 16 THEN 'TV'
                ELSE 'Device ' || n_name END AS DEVICE_TYPE_NAME
    FROM {nation}"""

#: The line items with few keys: several rows of every key, several days a month, several countries a video.
DENSE_LINEITEM = """
    SELECT l_orderkey, 1 + l_partkey % 9 AS l_partkey, 6 * (l_suppkey % 5) AS l_suppkey, l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           make_date(1997, month(l_shipdate), 1 + 10 * (day(l_shipdate) % 3)) AS l_shipdate
    FROM {lineitem}"""

ADAPTERS = {
    "basic": BASIC,
    "revenue": REVENUE,
    "demographics": DEMOGRAPHICS,
    "combined": COMBINED,
    "metadata": METADATA,
    "program": PROGRAM,
    "series": SERIES,
    "corrected_series": CORRECTED_SERIES,
    "brand_map": BRAND_MAP,
    "country_info": COUNTRY_INFO,
    "traffic_dim": TRAFFIC_DIM,
    "device_dim": DEVICE_DIM,
}
STAR_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text STRING",
}


class Star:
    """The star in one folder. Tables are opened once, with their schema given. ``dense``: facts of few keys."""

    def __init__(self, spark: SparkSession, folder: str, dense: bool = False):
        self.spark = spark
        self.folder = folder
        self.dense = dense

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cache
    def input(self, name: str) -> DataFrame:
        """One input of the marts."""
        text = ADAPTERS[name]
        used = {t: self.table(t) for t in STAR_SCHEMAS if "{" + t + "}" in text}
        if self.dense and "lineitem" in used:
            used["lineitem"] = self.spark.sql(DENSE_LINEITEM, lineitem=used["lineitem"])
        return self.spark.sql(text, **used)

    def inputs(self) -> Inputs:
        return Inputs.of({name: self.input(name) for name in ADAPTERS})
