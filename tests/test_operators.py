from itertools import product

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelmart.functions.dates import month_of_key
from reelmart.operators import combine as C
from reelmart.operators import dimensions as D
from reelmart.operators.lookups import join_lookup, lookup
from reelmart.operators.profile import demo_profile, with_group_total

KEY = dict(CHANNEL_ID="c", VIDEO_ID="v", UPLOADER_TYPE="self", COUNTRY_CODE="US")


def view(day=20250101, views=1, **more):
    return {**KEY, "REPORTING_DATE": day, "VIEWS": views, "WATCH_TIME_MINUTES": None, **more}


def money(day=20250101, cpm=None, **more):
    return {**KEY, "DATE": day, "ESTIMATED_CPM": cpm, **more}


def dec(x):
    from decimal import Decimal

    return Decimal(str(x))


def test_union_equals_full_outer_join_with_null_keys(spark, table):
    days, videos, countries = [20250101, 20250131], ["v", None], ["US", None]
    basic = [
        view(d, n + 1, VIDEO_ID=v, COUNTRY_CODE=c, ANNOTATION_CLICK_THROUGH_RATE=float(n))
        for n, (d, v, c) in enumerate(product(days, videos, countries))
    ] + [view(20250101, 7)]
    revenue = [
        money(d, dec(n), VIDEO_ID=v, COUNTRY_CODE=c, AD_IMPRESSIONS=n)
        for n, (d, v, c) in enumerate(product([20250131, 20250201], videos, countries))
    ] + [money(20250131, None, AD_IMPRESSIONS=5)]
    b, r = table("basic", *basic), table("revenue", *revenue)
    # The join as reported, literally: a full outer join, then a grouping on the coalesced keys.
    b.createOrReplaceTempView("b_raw")
    r.createOrReplaceTempView("r_raw")
    expected = spark.sql("""
        WITH a AS (SELECT REPORTING_DATE AS DATE, CHANNEL_ID, VIDEO_ID, UPLOADER_TYPE, COUNTRY_CODE, SUM(VIEWS) AS VIEWS,
                          AVG(ANNOTATION_CLICK_THROUGH_RATE) AS RATE FROM b_raw GROUP BY ALL),
             t AS (SELECT DATE, CHANNEL_ID, VIDEO_ID, UPLOADER_TYPE, COUNTRY_CODE, SUM(AD_IMPRESSIONS) AS ADS,
                          AVG(ESTIMATED_CPM) AS CPM FROM r_raw GROUP BY ALL)
        SELECT coalesce(a.DATE, t.DATE), coalesce(a.VIDEO_ID, t.VIDEO_ID), coalesce(a.COUNTRY_CODE, t.COUNTRY_CODE),
               SUM(VIEWS), SUM(ADS), AVG(RATE), AVG(CPM)
        FROM a FULL OUTER JOIN t ON a.DATE = t.DATE AND a.CHANNEL_ID = t.CHANNEL_ID AND a.VIDEO_ID = t.VIDEO_ID
             AND a.UPLOADER_TYPE = t.UPLOADER_TYPE AND a.COUNTRY_CODE = t.COUNTRY_CODE GROUP BY 1, 2, 3""")
    got = C.views_revenue_full(b, r)
    columns = ["DATE", "VIDEO_ID", "COUNTRY_CODE", "VIEWS", "AD_IMPRESSIONS", "ANNOTATION_CLICK_THROUGH_RATE"]
    assert rows(got, *columns, "ESTIMATED_CPM") == rows(expected, "*")
    assert got.count() == 12


def test_cpm_is_an_average_of_averages(table):
    basic = [view(20250101, 1)]
    revenue = [money(20250101, dec(1)), money(20250101, dec(3)), money(20250102, dec(8)), money(20250103, None)]
    got = C.video_measures(table("basic", *basic), table("revenue", *revenue), "monthly")
    assert rows(got, "MONTH", "VIEWS", "ESTIMATED_CPM", "CALCULATED_CPM") == [("2025-01-31", 1, 5.0, 0.0)]
    with pytest.raises(ValueError):
        C.video_measures(table("basic"), table("revenue"), "weekly")


def test_averages_of_short_decimals_are_not_cut(table):
    short = table("revenue", *[money(20250101, dec(n)) for n in (1, 1, 2)]).withColumn(
        "ESTIMATED_CPM", F.col("ESTIMATED_CPM").cast("decimal(4,2)")
    )
    [(cpm,)] = rows(C.video_measures(table("basic"), short, "daily"), "ESTIMATED_CPM")
    assert abs(cpm - 4 / 3) < 1e-12


def test_periods_limit_both_facts(table):
    basic = [view(d, 1) for d in (20241231, 20250101, 20250131, 20250201)]
    revenue = [money(d, dec(1), AD_IMPRESSIONS=1) for d in (20241231, 20250115)]
    got = C.video_measures(table("basic", *basic), table("revenue", *revenue), "daily", [(20250101, 20250131)])
    assert rows(got, "DATE", "VIEWS", "AD_IMPRESSIONS") == [
        ("2025-01-01", 1, None),
        ("2025-01-15", None, 1),
        ("2025-01-31", 1, None),
    ]


def test_region_counts_revenue_under_each_channel(table):
    basic = [view(VIDEO_ID="v", CHANNEL_ID=c) for c in ("c1", "c2")] + [view(VIDEO_ID="w", COUNTRY_CODE=None)]
    revenue = [
        money(CHANNEL_ID="c1", ESTIMATED_PARTNER_REVENUE=dec(2)),
        money(CHANNEL_ID="c9", ESTIMATED_PARTNER_REVENUE=dec(3)),
        money(VIDEO_ID="only revenue", ESTIMATED_PARTNER_REVENUE=dec(9)),
        money(VIDEO_ID="w", COUNTRY_CODE=None, ESTIMATED_PARTNER_REVENUE=dec(9)),
    ]
    got = C.region_views_revenue(table("basic", *basic), table("revenue", *revenue))
    assert rows(got, "VIDEO_ID", "CHANNEL_ID", "ESTIMATED_PARTNER_REVENUE") == [
        ("v", "c1", 5.0),
        ("v", "c2", 5.0),
        ("w", "c", None),
    ]


def test_regional_months_equal_the_sum_of_their_days(spark, table):
    """Every day of a month has its bit; channels, missing keys and days with one side only are as in the daily match."""
    keys = list(product(["v", None], ["US", "FR", None], ["self", None]))
    basic = [
        view(day, i + n, VIDEO_ID=v, COUNTRY_CODE=c, UPLOADER_TYPE=u, CHANNEL_ID=channel, WATCH_TIME_MINUTES=dec(n))
        for i, (v, c, u) in enumerate(keys)
        for n, day in enumerate([20250101, 20250131, 20250131, 20250228, 20250312, None])
        for channel in ("c1", "c2", None)
        if (i + n + len(channel or "")) % 3
    ]
    revenue = [
        money(day, VIDEO_ID=v, COUNTRY_CODE=c, UPLOADER_TYPE=u, ESTIMATED_PARTNER_REVENUE=amount)
        for v, c, u in keys
        for day, amount in [(20250101, dec(1)), (20250130, dec(2)), (20250131, dec(4)), (20250131, dec(8)), (20250312, None), (None, dec(16))]
    ]
    basic, revenue = table("basic", *basic), table("revenue", *revenue)
    names = ["MONTH", "CHANNEL_ID", "VIDEO_ID", "UPLOADER_TYPE", "COUNTRY_CODE"]
    measures = ["VIEWS", "WATCH_TIME_MINUTES", "ESTIMATED_PARTNER_REVENUE"]
    daily = C.region_views_revenue(basic, revenue).withColumn("MONTH", month_of_key("DATE"))
    want = daily.groupBy(*names).agg(*[F.sum(m).alias(m) for m in measures])
    got = C.region_monthly(basic, revenue)
    assert rows(got, *names, *measures) == rows(want, *names, *measures)
    paid = rows(got.where("VIDEO_ID = 'v' AND ESTIMATED_PARTNER_REVENUE IS NOT NULL"), "ESTIMATED_PARTNER_REVENUE")
    assert {(1.0,), (12.0,), (13.0,)} >= set(paid) >= {(13.0,)}
    january = C.region_monthly(basic, revenue, [(20250101, 20250131)])
    assert rows(january, *names, *measures) == rows(want.where("MONTH = DATE'2025-01-31'"), *names, *measures)


def demo(gender="MALE", age="AGE_18_24", pct=50.0, day=20250101, **more):
    key = {k: v for k, v in KEY.items() if k != "UPLOADER_TYPE"}
    row = {**key, "UPLOADER_CODE": "self", "REPORTING_DATE": day, "GENDER": gender, "AGE_GROUP": age}
    return {**row, "VIEW_PERCENTAGE": pct, **more}


DEMO_BASIC = [
    view(views=10, WATCH_TIME_MINUTES=dec(1)),
    view(views=20, WATCH_TIME_MINUTES=dec(2), COUNTRY_CODE="DE"),
    view(views=30, WATCH_TIME_MINUTES=dec(3), COUNTRY_CODE=None),
    view(views=1000, UPLOADER_TYPE="SELF"),
    view(views=7, VIDEO_ID=None),
]
DEMOGRAPHICS = [
    demo("MALE", "AGE_18_24", 50.0),
    demo("MALE", "AGE_18_24", 20.0, COUNTRY_CODE="DE"),
    demo("FEMALE", "AGE_65_", 10.0),
    demo("FEMALE", "AGE_65_", 10.0, COUNTRY_CODE="US"),
    demo("USER_SPECIFIED", "AGE_?", 20.0),
    demo("MALE", "AGE_13_17", 20.0, VIDEO_ID="no views"),
    demo("MALE", "AGE_13_17", 20.0, VIDEO_ID=None),
    demo("MALE", "AGE_13_17", 20.0, UPLOADER_CODE="other"),
]


def test_demo_join_fans_out_over_geography(table):
    b, d = table("basic", *DEMO_BASIC), table("demographics", *DEMOGRAPHICS)
    columns = ["VIDEO_ID", "GENDER", "MID_AGE", "DEMO_VIEWS", "DEMO_WATCH_TIME_MINUTES"]
    # US 10 views, elsewhere 50; every share meets both.
    assert rows(C.demo_join(b, d), *columns) == sorted(
        [
            ("v", "MALE", 21, 42.0, 4.2),
            ("v", "FEMALE", 70, 12.0, 1.2),
            ("v", "USER_SPECIFIED", None, 12.0, 1.2),
            ("no views", "MALE", 15, None, None),
            (None, "MALE", 15, None, None),
        ],
        key=str,
    )
    assert rows(C.demo_join(b, d, match_geo=True), *columns) == sorted(
        [
            ("v", "MALE", 21, 15.0, 1.5),
            ("v", "FEMALE", 70, 2.0, 0.2),
            ("v", "USER_SPECIFIED", None, 2.0, 0.2),
            ("no views", "MALE", 15, None, None),
            (None, "MALE", 15, None, None),
        ],
        key=str,
    )


def test_demo_totals_agree_with_the_join(table):
    b, d = table("basic", *DEMO_BASIC), table("demographics", *DEMOGRAPHICS)
    totals = C.demo_totals(b, d).where("VIDEO_ID = 'v'")
    names = ["VIEWS", "WATCH_TIME_MINUTES", "AGE_VIEWS", "MALE_VIEWS", "FEMALE_VIEWS", "UNSPECIFIED_VIEWS"]
    assert rows(totals, *names) == [(66.0, 6.6, 42.0 * 21 + 12.0 * 70, 42.0, 12.0, 12.0)]


def test_profile(spark):
    schema = "g string, GENDER string, MID_AGE int, DEMO_VIEWS decimal(35,10), DEMO_WATCH_TIME_MINUTES decimal(38,18)"
    detail = [
        ("a", "MALE", 15, dec(1), dec(1)),
        ("a", "FEMALE", 70, dec(2), dec(1)),
        ("a", "OTHER", None, dec(1), dec(1)),  # unknown age: in the total only
        ("zero", "MALE", 15, dec(0), dec(0)),
        ("none", "MALE", 15, None, None),
        (None, "MALE", 40, dec(3), dec(1)),
    ]
    got = demo_profile(spark.createDataFrame(detail, schema), ["g"])
    assert rows(got, "g", "VIEWS", "MEDIAN_AGE", "PERCENTAGE_MALE", "PERCENTAGE_FEMALE", "PERCENTAGE_OTHER") == sorted(
        [
            ("a", 4.0, 155 / 4, 25.0, 50.0, 0.0),
            ("zero", 0.0, None, None, None, None),
            ("none", None, None, None, None, None),
            (None, 3.0, 40.0, 100.0, 0.0, 0.0),
        ],
        key=str,
    )
    total = with_group_total(spark.createDataFrame(detail, schema), ["g"], "DEMO_VIEWS", "TOTAL")
    assert rows(total, "g", "TOTAL") == sorted(
        [("a", 4.0)] * 3 + [("zero", 0.0), ("none", None), (None, 3.0)], key=str
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_lookup_equals_the_plain_one(spark, how, null_safe):
    facts = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), ("unused", 4), (None, 5)], "key string, x int")
    small, large = lookup(dim, "key"), lookup(dim, "key", large=True)
    a = join_lookup(facts, small, "k", how=how, null_safe=null_safe)
    b = join_lookup(facts, large, "k", how=how, null_safe=null_safe)
    assert a.columns == b.columns == ["id", "k", "x"]
    assert rows(a, "*") == rows(b, "*")


def test_large_lookup_spreads_a_hot_key(spark):
    facts = spark.range(2000).select("id", F.lit("hot").alias("k"))
    dim = spark.createDataFrame([("hot", 1)], "key string, x int")
    joined = join_lookup(facts, lookup(dim, "key", large=True), "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 2000


def meta(video="v", title="clip", **more):
    return {"VIDEO_ID": video, "VIDEO_TITLE": title, "CHANNEL_ID": "c", **more}


def test_latest_channel_name(table):
    m = table(
        "metadata",
        meta(CHANNEL_ID="a", TIME_UPLOADED="2024/01/01 00:00:00", CHANNEL_DISPLAY_NAME="old"),
        meta(CHANNEL_ID="a", TIME_UPLOADED="2024/01/02 00:00:00", CHANNEL_DISPLAY_NAME="new"),
        meta(CHANNEL_ID="b", TIME_UPLOADED="2024/01/02 00:00:00", CHANNEL_DISPLAY_NAME="dated"),
        meta(CHANNEL_ID="b", TIME_UPLOADED=None, CHANNEL_DISPLAY_NAME="undated"),
        meta(CHANNEL_ID="t", TIME_UPLOADED="2024/01/02 00:00:00", CHANNEL_DISPLAY_NAME="tie 1"),
        meta(CHANNEL_ID="t", TIME_UPLOADED="2024/01/02 00:00:00", CHANNEL_DISPLAY_NAME="tie 2"),
        meta(CHANNEL_ID="n", TIME_UPLOADED="2024/01/03 00:00:00", CHANNEL_DISPLAY_NAME=None),
        meta(CHANNEL_ID="n", TIME_UPLOADED="2024/01/02 00:00:00", CHANNEL_DISPLAY_NAME="named"),
    )
    names = [("a", "new"), ("b", "undated"), ("n", None), ("t", "tie 2")]
    assert rows(D.latest_channel_names(m), "*") == sorted(names, key=str)


def test_parents_put_null_last(table):
    program = table(
        "program",
        dict(SERIES_ID="s", PARENT_SERIES_ID=None),
        dict(SERIES_ID="s", PARENT_SERIES_ID=9),
        dict(SERIES_ID="s", PARENT_SERIES_ID=7),
        dict(SERIES_ID="orphan", PARENT_SERIES_ID=None),
    )
    series = table(
        "series",
        dict(PARENT_SERIES_ID=7, PARENT_SERIES_NAME=None),
        dict(PARENT_SERIES_ID=7, PARENT_SERIES_NAME="b"),
        dict(PARENT_SERIES_ID=7, PARENT_SERIES_NAME="a"),
    )
    got = D.parent_series(D.program_table(program), series)
    assert rows(got, "SERIES_ID", "PARENT_SERIES_ID", "PARENT_SERIES_NAME") == [("orphan", None, None), ("s", 7, "a")]


def test_series_correction_order(spark):
    schema = "VIDEO_ID string, EXTRACTED_PPL_ID int, DOMO_SERIES_NAME string, SERIES_ID string, SERIES_NAME string"
    programs = [
        ("program wins", 1, "Fixed", "10", "Ten"),
        ("corrected", None, "Fixed", None, None),
        ("corrected id, own name", 1, "Fixed", None, "Ten"),
        ("nothing known", None, "Plain", None, None),
        ("name equals", 1, "Plain", None, "Plain"),
        ("name contained", 1, "Plain Sight", None, "plain"),
        ("wildcards", 1, "Plain Sight", None, "P%n_S"),
        ("backslash", 1, "Lost\\Gear", None, "\\gear"),
        ("no agreement", 1, "Plain", None, "Other"),
    ]
    corrected = spark.createDataFrame(
        [("Fixed", "90", "Ninety")],
        "DOMO_SERIES_NAME string, CORRECTED_SERIES_ID string, CORRECTED_PPL_SERIES_NAME string",
    )
    rows_ = spark.createDataFrame(programs, schema).withColumn("COPIES", F.lit(1).cast("long"))
    got = D.corrected_series(rows_, lookup(corrected, "DOMO_SERIES_NAME")).drop("COPIES")
    assert {r.VIDEO_ID: (r.SERIES_ID, r.SERIES_NAME) for r in got.collect()} == {
        "program wins": ("10", "Ten"),
        "corrected": ("90", "Ninety"),
        "corrected id, own name": ("90", "Ten"),
        "nothing known": ("-1", "other"),
        "name equals": (None, "Plain"),
        "name contained": (None, "plain"),
        "wildcards": (None, "P%n_S"),
        "backslash": (None, "\\gear"),
        "no agreement": ("-1", "Other"),
    }
    facts = spark.createDataFrame([("name equals",), ("unheard of",), (None,)], "VIDEO_ID string")
    mapped = D.map_series(facts, got)
    assert rows(mapped, "VIDEO_ID", "SERIES_ID", "SERIES_NAME") == sorted(
        [("name equals", None, "Plain"), ("unheard of", "-1", "other"), (None, "-1", "other")], key=str
    )


def test_brand_table_has_no_default(spark, table):
    facts = spark.createDataFrame([("known",), ("unknown",), (None,)], "CHANNEL_NAME string")
    brands = table("brand_map", dict(CHANNEL_NAME="known", BRAND_ROLL_UP="b"))
    assert rows(D.map_brand_from_table(facts, brands), "*") == sorted([("known", "b"), ("unknown", None), (None, None)], key=str)


def test_facts_without_a_video_id_are_spread(spark, table):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "v").alias("VIDEO_ID"))
    keyed = D.with_video_key(facts)
    assert keyed.where("VIDEO_ID IS NULL").select(D.VIDEO_KEY).distinct().count() > 300
    titled = D.map_video_title(facts, table("metadata", meta("v", "t"), meta(None, "never")))
    assert rows(titled.groupBy("VIDEO_ID", "VIDEO_TITLE").count(), "*") == [("v", "t", 500), (None, None, 500)]


def test_copies_are_counted_and_repeated(table):
    m = table("metadata", *[meta("v", "t", TIME_UPLOADED=str(n)) for n in range(3)], meta("v", None), meta("v", None), meta("w"))
    counted = D.metadata_rows(m)
    assert rows(counted, "VIDEO_ID", "VIDEO_TITLE", "COPIES") == [("v", "t", 3), ("v", None, 2), ("w", "clip", 1)]
    assert rows(D.repeated(counted), "VIDEO_ID", "VIDEO_TITLE") == rows(m, "VIDEO_ID", "VIDEO_TITLE")
    many = counted.withColumn("COPIES", F.col("COPIES") * 10_000 - 1)
    assert D.repeated(many).count() == 60_000 - 3
