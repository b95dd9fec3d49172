from decimal import Decimal

import pytest
from conftest import SCHEMAS, SMALL, rows
from pyspark.sql import functions as F

from reelmart.functions.titles import sample_title_rules
from reelmart.operators.combine import demo_join, region_monthly
from reelmart.operators.profile import demo_profile
from reelmart.plans import marts as M
from reelmart.plans.dimensions import Dimensions
from reelmart.plans.registry import OUTPUTS
from reelmart.session import scratch_path
from reelmart.sources.inputs import Inputs
from reelmart.sources.star_adapter import Star

SUMS = ["VIEWS", "LIKES", "WATCH_TIME_MINUTES", "ESTIMATED_PARTNER_REVENUE", "AD_IMPRESSIONS"]


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, SMALL).inputs()


@pytest.fixture(scope="module")
def star_dims(star):
    return Dimensions(star, sample_title_rules())


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


KEY = dict(CHANNEL_ID="c", VIDEO_ID="v", UPLOADER_TYPE="self", COUNTRY_CODE="US", VIEWS=10, WATCH_TIME_MINUTES=Decimal(5))


def meta(title, **more):
    return {"VIDEO_ID": "v", "VIDEO_TITLE": title, "VIDEO_LENGTH": 60, "CHANNEL_ID": "c", **more}


def test_repeated_metadata_multiplies(dims):
    """Twice in metadata: four rows in the video mart (two titles by two programs), views twice or four times elsewhere."""
    two = [meta("a marathon", CUSTOM_ID="12345"), meta("a clip", CUSTOM_ID="54321")]
    combined = dict(KEY, DATE=20250105, TRAFFIC_SOURCE_TYPE=1, DEVICE_TYPE=1)
    d = dims(
        basic=[dict(KEY, REPORTING_DATE=20250105)],
        combined=[combined],
        metadata=two,
        country_info=[dict(COUNTRY_CODE="US", CONTINENT="North America")],
        device_dim=[dict(DEVICE_TYPE=1, DEVICE_TYPE_NAME="TV")],
    )
    video = M.video_mart(d, "monthly")
    assert rows(video, "VIDEO_TITLE", "EXTRACTED_PPL_ID", "VIEWS") == [
        ("a clip", 12345.0, 10),
        ("a clip", 54321.0, 10),
        ("a marathon", 12345.0, 10),
        ("a marathon", 54321.0, 10),
    ]
    forms = [("Marathon", 10), ("Short Form", 10)]
    assert rows(M.device_mart(d), "VIDEO_FORM", "VIEWS") == forms
    assert rows(M.region_mart(d), "VIDEO_FORM", "VIEWS") == forms
    assert rows(M.traffic_mart(d), "VIDEO_FORM", "VIEWS", "WATCH_TIME_MINUTES") == [
        ("Marathon", 20, 10.0),
        ("Short Form", 20, 10.0),
    ]


def test_unmatched_codes(dims):
    base = dict(KEY, DATE=20250105)
    d = dims(
        combined=[
            dict(base, TRAFFIC_SOURCE_TYPE=1, DEVICE_TYPE=1),
            dict(base, TRAFFIC_SOURCE_TYPE=2, DEVICE_TYPE=2),
            dict(base, TRAFFIC_SOURCE_TYPE=9, DEVICE_TYPE=9),
            dict(base, TRAFFIC_SOURCE_TYPE=None, DEVICE_TYPE=None),
            dict(base, TRAFFIC_SOURCE_TYPE=1, DEVICE_TYPE=1, UPLOADER_TYPE="SELF"),
        ],
        traffic_dim=[
            dict(TRAFFIC_SOURCE_TYPE_ID=1, TRAFFIC_SOURCE_TYPE_NAME="Playlists"),
            dict(TRAFFIC_SOURCE_TYPE_ID=2, TRAFFIC_SOURCE_TYPE_NAME="Playlist pages"),
        ],
        device_dim=[dict(DEVICE_TYPE=1, DEVICE_TYPE_NAME="Tablet"), dict(DEVICE_TYPE=2, DEVICE_TYPE_NAME="Mobile Phone")],
    )
    assert rows(M.traffic_mart(d), "TRAFFIC_SOURCE_TYPE_CATEGORY", "VIEWS") == [("Other", 20), ("Playlists", 20)]
    assert rows(M.device_mart(d), "DEVICE_TYPE_NAME", "VIEWS") == [("Mobile Phone & Tablet", 20)]
    assert rows(M.device_mart(d), "CHANNEL_NAME", "BRAND_ROLL_UP") == [(None, "other")]


def test_region_drops_unknown_countries(dims):
    d = dims(
        basic=[dict(KEY, REPORTING_DATE=20250105, COUNTRY_CODE=c) for c in ("KE", "XX", None)],
        country_info=[dict(COUNTRY_CODE="KE", CONTINENT="Africa", SUB_CONTINENT="EAST")],
    )
    assert rows(M.region_mart(d), "CONTINENT", "EMEA", "AMEA", "AMER", "VIEWS") == [("Africa", 1, 1, 0, 10)]


def test_monthly_and_daily_agree_and_lose_nothing(star, star_dims):
    unique = Dimensions(
        Inputs(**{**star.__dict__, "metadata": star.metadata.dropDuplicates(["VIDEO_ID"])}), sample_title_rules()
    )
    totals = [F.sum(c).alias(c) for c in SUMS]
    month = F.last_day("DATE").alias("MONTH")
    by_month = M.video_mart(unique, "monthly").groupBy("MONTH").agg(*totals)
    from_days = M.video_mart(unique, "daily").groupBy(month).agg(*totals)
    assert rows(by_month, "MONTH", *SUMS) == rows(from_days, "MONTH", *SUMS)
    assert rows(by_month.agg(F.sum("VIEWS")), "*") == rows(star.basic.agg(F.sum("VIEWS")), "*")
    money = "ESTIMATED_PARTNER_REVENUE"
    assert rows(by_month.agg(F.sum(money)), "*") == rows(star.revenue.agg(F.sum(money)), "*")


def test_profile_percentages_do_not_exceed_the_whole(star_dims):
    got = M.demographics_mart(star_dims)
    over = got.where("PERCENTAGE_MALE + PERCENTAGE_FEMALE + PERCENTAGE_OTHER > 100.000001")
    assert got.count() > 0 and over.count() == 0
    form, total = (got.where(F.col("VIDEO_FORM") != "ALL"), got.where("VIDEO_FORM = 'ALL'"))
    assert rows(form.agg(F.sum("VIEWS")), "*") == rows(total.agg(F.sum("VIEWS")), "*")


def test_large_dimensions_give_the_same_marts(star, star_dims, monkeypatch):
    """Every dimension is said to be large: all lookups are salted, and the reports stay the same."""
    from reelmart.operators import dimensions, lookups
    from reelmart.plans import dimensions as prepared

    def never_small(df, *keys):
        return lookups.Lookup(df, keys, large=True)

    monkeypatch.setattr(prepared, "lookup", never_small)
    monkeypatch.setattr(dimensions, "lookup", never_small)
    salted = Dimensions(star, sample_title_rules())
    for mart in (lambda d: M.video_mart(d, "monthly"), M.traffic_mart, M.device_mart, M.region_mart):
        assert rows(mart(salted), "*") == rows(mart(star_dims), "*")


@pytest.mark.parametrize("name", list(OUTPUTS))
def test_plans_hold_no_python_and_no_cartesian(star_dims, name):
    text = plan(OUTPUTS[name].build(star_dims, None))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "Window"):
        assert node not in text, node


def test_facts_are_shuffled_once_for_both_joins_by_video(spark, star_dims):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(M.video_mart(star_dims, "monthly"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [b for b in text.split("\n\n") if "Exchange" in b and "hashpartitioning(_video" in b]
    assert len([b for b in exchanges if "hashpartitioning(_video#" in b]) == 1
    assert len([b for b in exchanges if "hashpartitioning(_video_id#" in b]) == 2


def test_date_window_and_columns_reach_the_scan(spark, inputs):
    folder = scratch_path(spark, "facts")
    empty = inputs()
    for name in SCHEMAS:
        getattr(empty, name).write.parquet(f"{folder}/{name}")
    d = Dimensions(Inputs.from_parquet(spark, folder), sample_title_rules())
    text = plan(M.device_mart(d, [(20250101, 20250331)]))
    scan = next(block for block in text.split("\n\n") if "Scan parquet" in block and "/combined" in block)
    assert "GreaterThanOrEqual(DATE,20250101)" in scan and "LessThanOrEqual(DATE,20250331)" in scan
    assert "EqualTo(UPLOADER_TYPE,self)" in scan
    read = scan.split("ReadSchema:")[1]
    assert "DEVICE_TYPE" in read and "TRAFFIC_SOURCE_TYPE" not in read
    region = plan(M.region_mart(d, [(20250101, 20250331)]))
    views = next(b for b in region.split("\n\n") if "Scan parquet" in b and "/basic" in b)
    assert "LIKES" not in views and "IsNotNull(COUNTRY_CODE)" in views


def test_region_shuffles_no_day_of_views(spark, star):
    """Before any exchange the views are sums by month; the match with revenue and the months share a partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = region_monthly(star.basic, star.revenue)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert len(exchanges) == 4
    assert len([e for e in exchanges if "hashpartitioning(DATE" in e]) == 1  # the revenue, once


def test_one_video_with_a_third_of_all_rows(spark, dims, inputs):
    """The hot video leaves the scan as partial sums; the result is the plain sum."""
    n = 3000
    basic = spark.range(n).select(
        F.lit(20250105).alias("REPORTING_DATE"),
        F.lit("c").alias("CHANNEL_ID"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("VIDEO_ID"),
        F.lit("self").alias("UPLOADER_TYPE"),
        F.lit("US").alias("COUNTRY_CODE"),
        *[F.lit(1).cast("long").alias(c) for c in ("VIEWS", "COMMENTS", "SHARES", "LIKES", "DISLIKES")],
        F.lit(1).cast("decimal(38,8)").alias("WATCH_TIME_MINUTES"),
        *[F.lit(1).cast("long").alias(c) for c in ("SUBSCRIBERS_GAINED", "SUBSCRIBERS_LOST")],
        F.lit(0.5).alias("ANNOTATION_CLICK_THROUGH_RATE"),
        *[
            F.lit(1).cast("long").alias(c)
            for c in (
                "ANNOTATION_IMPRESSIONS",
                "ANNOTATION_CLICKABLE_IMPRESSIONS",
                "ANNOTATION_CLOSABLE_IMPRESSIONS",
                "CARD_TEASER_IMPRESSIONS",
                "CARD_IMPRESSIONS",
            )
        ],
    )
    hot = Inputs(**{**inputs().__dict__, "basic": basic})
    got = M.video_mart(Dimensions(hot, sample_title_rules()), "monthly")
    assert got.count() == 2001
    assert rows(got.where("VIDEO_ID = 'hot'"), "VIEWS", "WATCH_TIME_MINUTES") == [(1000, 1000.0)]


def test_large_sums_fit(dims):
    big = dict(KEY, VIEWS=10**15, WATCH_TIME_MINUTES=Decimal(5 * 10**12))
    share = dict(KEY, REPORTING_DATE=20250105, UPLOADER_CODE="self", GENDER="MALE", AGE_GROUP="AGE_65_", VIEW_PERCENTAGE=100.0)
    money = dict(KEY, DATE=20250105, AD_IMPRESSIONS=10**12, ESTIMATED_PARTNER_REVENUE=Decimal(10**12))
    d = dims(
        basic=[dict(big, REPORTING_DATE=20250105)],
        revenue=[dict(money, ESTIMATED_YOUTUBE_AD_REVENUE=Decimal(10**12), ESTIMATED_CPM=Decimal(10**9))],
        demographics=[share] * 3,
        combined=[dict(big, DATE=20250105, TRAFFIC_SOURCE_TYPE=1, DEVICE_TYPE=1)],
        metadata=[meta("clip")] * 3,
        country_info=[dict(COUNTRY_CODE="US", CONTINENT="North America")],
        device_dim=[dict(DEVICE_TYPE=1, DEVICE_TYPE_NAME="TV")],
    )
    demographics = rows(M.demographics_mart(d), "VIDEO_FORM", "VIEWS", "WATCH_TIME_MINUTES", "MEDIAN_AGE")
    assert demographics == [("ALL", 9e15, 45e12, 70.0), ("Short Form", 9e15, 45e12, 70.0)]
    assert rows(M.device_mart(d), "VIEWS", "WATCH_TIME_MINUTES") == [(3 * 10**15, 15e12)]
    assert rows(M.traffic_mart(d), "VIEWS", "WATCH_TIME_MINUTES") == [(9 * 10**15, 45e12)]
    assert rows(M.region_mart(d), "VIEWS", "ESTIMATED_PARTNER_REVENUE") == [(3 * 10**15, 3e12)]
    assert rows(M.video_mart(d, "monthly").distinct(), "CALCULATED_CPM", "ESTIMATED_CPM") == [(1000.0, 1e9)]


def test_inputs_name_missing_columns(inputs):
    good = inputs()
    with pytest.raises(ValueError, match="basic lacks VIEWS"):
        Inputs(**{**good.__dict__, "basic": good.basic.drop("VIEWS")})


def test_small_shares_are_not_rounded_before_they_are_summed(dims):
    """A thousand videos with a view and a tiny share each: the mart agrees with the detail's profile."""
    videos = [f"v{i}" for i in range(1000)]
    share = dict(KEY, REPORTING_DATE=20250105, UPLOADER_CODE="self", GENDER="MALE", AGE_GROUP="AGE_18_24", VIEW_PERCENTAGE=0.00000033)
    d = dims(
        basic=[dict(KEY, REPORTING_DATE=20250105, VIDEO_ID=v, VIEWS=1) for v in videos],
        demographics=[dict(share, VIDEO_ID=v) for v in videos],
        metadata=[meta("clip", VIDEO_ID=v) for v in videos],
    )
    got = M.demographics_mart(d).where("VIDEO_FORM = 'ALL'")
    detail = demo_profile(demo_join(d.inputs.basic, d.inputs.demographics), ["MONTH"])
    names = ["VIEWS", "WATCH_TIME_MINUTES", "MEDIAN_AGE", "PERCENTAGE_MALE"]
    assert rows(got, *names) == rows(detail.select(*[F.col(n).cast("decimal(38,8)").alias(n) for n in names]), *names) == [(0.0000033, 0.0000165, 21.0, 100.0)]


@pytest.mark.parametrize("name", list(OUTPUTS))
def test_building_a_mart_starts_no_job(spark, star, name):
    spark.sparkContext.setJobGroup(f"build {name}", "")
    OUTPUTS[name].build(Dimensions(star, sample_title_rules()), None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    spark.sparkContext.setJobGroup("", "")
