"""Plans and rows that matter when the facts are large: hot keys and what is shuffled."""

import re
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelmart.operators import dimensions as D
from reelmart.operators import facts as S
from reelmart.operators.combine import demo_totals, region_monthly, video_measures, views_revenue_full
from reelmart.operators.lookups import join_lookup, lookup
from reelmart.plans import marts as M


@pytest.fixture
def unhelped(spark):
    """No broadcast and no adaptive plan: what the joins do by themselves."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    """Input and arguments of every shuffle."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [b for b in text.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]


FACT = dict(REPORTING_DATE=20250105, CHANNEL_ID="c", VIDEO_ID="v", UPLOADER_TYPE="self", COUNTRY_CODE="US", VIEWS=1)


def test_rows_without_a_series_are_spread(spark, unhelped):
    some = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "-1").alias("SERIES_ID"))
    parents = spark.createDataFrame([("-1", 7, "p")], "SERIES_ID string, PARENT_SERIES_ID long, PARENT_SERIES_NAME string")
    joined = D.map_parent_series(some, lookup(parents, "SERIES_ID"))
    placed = joined.withColumn("part", F.spark_partition_id())
    found = placed.groupBy("SERIES_ID", "PARENT_SERIES_ID").agg(F.count("*"), F.count_distinct("part"))
    assert rows(found, "*") == [("-1", 7, 1000, 4), (None, None, 1000, 4)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_a_hot_key_changes_no_rows(spark, unhelped, how, null_safe):
    facts = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("k"))
    dim = lookup(spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), (None, 5)], "key string, x int"), "key")
    plain, spread = (join_lookup(facts, dim, "k", how=how, null_safe=null_safe, hot=hot) for hot in (None, "hot"))
    assert plain.columns == spread.columns and rows(plain, "*") == rows(spread, "*")


@pytest.mark.parametrize("mart", [lambda d: M.video_mart(d, "daily"), lambda d: M.video_mart(d, "monthly"), M.traffic_mart])
def test_no_fact_is_shuffled_by_its_series(dims, unhelped, mart):
    by_series = [b for b in exchanges(mart(dims())) if re.search(r"hashpartitioning\(SERIES_ID#\d+, ", b)]
    assert by_series and not [b for b in by_series if "VIEWS" in b]


@pytest.mark.parametrize("id_of_none", ["-1", "77"])
def test_videos_without_metadata_get_the_parents_of_no_series(dims, id_of_none):
    """The id -1 is an id like any other: if programs have it, its parent is theirs."""
    program = [dict(PROGRAM_ID=1, SERIES_ID=id_of_none, PARENT_SERIES_ID=5), dict(PROGRAM_ID=2, SERIES_ID=id_of_none, PARENT_SERIES_ID=6)]
    d = dims(
        basic=[FACT, dict(FACT, VIDEO_ID="unlisted"), dict(FACT, VIDEO_ID=None)],
        combined=[dict(FACT, DATE=20250105, VIDEO_ID="unlisted", TRAFFIC_SOURCE_TYPE=1, WATCH_TIME_MINUTES=Decimal(1))],
        metadata=[dict(VIDEO_ID="v", VIDEO_TITLE="a clip", CHANNEL_ID="c")],
        program=program,
        series=[dict(PARENT_SERIES_ID=5, PARENT_SERIES_NAME="five")],
    )
    parent = ("-1", 5, "five") if id_of_none == "-1" else ("-1", None, None)
    columns = ["SERIES_ID", "PARENT_SERIES_ID", "PARENT_SERIES_NAME"]
    assert rows(M.video_mart(d, "monthly"), *columns) == [parent] * 3
    assert rows(M.traffic_mart(d), *columns) == [parent]


def test_measures_that_are_not_shown_are_not_shuffled(dims, unhelped):
    d = dims()
    months = video_measures(d.inputs.basic, d.inputs.revenue, "monthly")
    shown = D.map_video_title(months, d.inputs.metadata, form=True).select("MONTH", "VIDEO_ID", "VIEWS", "VIDEO_FORM")
    shuffled = exchanges(shown)
    assert len(shuffled) >= 4  # revenue by day, both facts by month, months and titles by video
    sums = [len(re.findall(r"\bsum#", b)) for b in shuffled]
    assert max(sums) == 1 and "avg" not in "".join(shuffled)


@pytest.mark.parametrize(
    "mart, code",
    [(M.traffic_mart, "TRAFFIC_SOURCE_TYPE"), (M.device_mart, "DEVICE_TYPE"), (M.region_mart, "COUNTRY_CODE")],
)
def test_reports_are_summed_once_after_the_forms(dims, unhelped, mart, code):
    """The code's name is found before the sum by form, which needs no sum by code in front of it."""
    arguments = [b[b.index("Arguments") :] for b in exchanges(mart(dims()))]
    assert [a for a in arguments if "VIDEO_FORM" in a]
    assert not [a for a in arguments if "VIDEO_FORM" in a and f"{code}#" in a]


@pytest.mark.parametrize(
    "scan, name",
    [(S.views_daily, "basic"), (S.region_views, "basic"), (S.revenue_daily, "revenue"), (S.region_revenue, "revenue")],
)
def test_day_keys_are_not_summed_in_the_tasks_that_scan(dims, unhelped, scan, name):
    """Nearly every row has a day key of its own: a table of sums would be as long as the rows, and wider."""
    shuffled = exchanges(scan(getattr(dims().inputs, name)))
    assert len(shuffled) == 1
    assert "sum#" not in shuffled[0] and "isEmpty#" not in shuffled[0]


def test_views_and_revenue_are_not_summed_before_they_meet(dims, unhelped):
    inputs = dims().inputs
    shuffled = exchanges(views_revenue_full(inputs.basic, inputs.revenue))
    assert len(shuffled) == 1
    assert "sum#" not in shuffled[0] and "isEmpty#" not in shuffled[0]


def test_rows_of_a_day_key_meet_from_all_tasks(spark, table, unhelped):
    keys = [dict(FACT, VIDEO_ID=v, COUNTRY_CODE=c) for v in ("v", None) for c in ("US", None)]
    more = dict(WATCH_TIME_MINUTES=Decimal("0.5"), ANNOTATION_CLICK_THROUGH_RATE=0.25)
    basic = table("basic", *[dict(k, VIEWS=n, **more) for k in keys for n in (1, 2, None)]).repartition(3)
    got = rows(S.views_daily(basic), "VIDEO_ID", "COUNTRY_CODE", "VIEWS", "WATCH_TIME_MINUTES", "ANNOTATION_CLICK_THROUGH_RATE", "LIKES")
    assert got == sorted([(v, c, 3, 1.5, 0.25, None) for v in ("v", None) for c in ("US", None)], key=str)


@pytest.mark.parametrize("grain, period", [("monthly", "MONTH"), ("daily", "DATE")])
def test_revenue_is_shuffled_once_for_its_days_and_its_period(dims, unhelped, grain, period):
    """One shuffle of revenue as it is and one of the sums of views, both by the final key; none behind them."""
    inputs = dims().inputs
    shuffled = exchanges(video_measures(inputs.basic, inputs.revenue, grain))
    assert len(shuffled) == 2 and sum("sum#" in b for b in shuffled) == 1
    key = rf"hashpartitioning\({period}#\d+, CHANNEL_ID#\d+, VIDEO_ID#\d+, UPLOADER_TYPE#\d+, GEO#\d+, "
    assert all(re.search(key, b) for b in shuffled)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_views_and_revenue_of_a_key_meet_from_all_tasks(spark, table, unhelped, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    keys = [dict(CHANNEL_ID=c, VIDEO_ID=v, UPLOADER_TYPE="self") for c in ("c", None) for v in ("v", "w", None)]
    places = [dict(k, COUNTRY_CODE=c) for k in keys for c in ("US", "FR", None)]
    seen = [dict(k, REPORTING_DATE=d, VIEWS=n) for k in places for d in (20250105, 20250106) for n in (1, 2, None)]
    # the day's averages are 2 (of 1, 3 and no value) and 5: their average is 3.5, that of the rows 3
    cpms = [(20250105, 1), (20250105, 3), (20250105, None), (20250107, 5)]
    paid = [dict(k, DATE=d, AD_IMPRESSIONS=2, ESTIMATED_CPM=None if x is None else Decimal(x)) for k in places[3:] for d, x in cpms]
    measures = video_measures(table("basic", *seen).repartition(3), table("revenue", *paid).repartition(5), "monthly")
    got = rows(measures, "CHANNEL_ID", "VIDEO_ID", "GEO", "VIEWS", "AD_IMPRESSIONS", "ESTIMATED_CPM", "LIKES")
    geos = {"US": 1, "Non-US": 2}
    money = {(k["CHANNEL_ID"], k["VIDEO_ID"]) for k in keys[1:]}
    assert got == sorted(
        [
            (k["CHANNEL_ID"], k["VIDEO_ID"], g, 6 * n, *((8 * n, 3.5) if (k["CHANNEL_ID"], k["VIDEO_ID"]) in money else (None, None)), None)
            for k in keys
            for g, n in geos.items()
        ],
        key=str,
    )


def test_audience_is_shuffled_once_for_its_months_and_its_forms(dims, unhelped):
    d = dims()
    titled = D.join_by_video(demo_totals(d.inputs.basic, d.inputs.demographics), d.forms)
    assert len(exchanges(titled)) == 3 + 2  # shares, views and their days by video; the forms' sum, and the forms by video


@pytest.mark.parametrize("grain", ["monthly", "daily"])
def test_facts_of_the_video_marts_are_shuffled_once(dims, unhelped, grain):
    """As they are, to a place where they are summed and joined: no sum of theirs goes to a video, series or channel."""
    shuffled = exchanges(M.video_mart(dims(), grain))
    facts = [b for b in shuffled if re.search(r"VIEWS#|AD_IMPRESSIONS#", b)]
    assert len(facts) == 2 and "sum#" not in "".join(facts)
    assert all(re.search(r"hashpartitioning\(_place_video#\d+, _place_channel#\d+, _share#\d+, ", b) for b in facts)
    assert not [b for b in shuffled if re.search(r"\b(MONTH|DATE)#", b) and b not in facts]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_everything_known_meets_the_facts_of_every_place(spark, dims, unhelped, adaptive):
    """NULL and odd ids, a video under two channels, repeated metadata, in all shares of a place."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    ids = [(v, c) for v in ("v", "w", "", "=v", "\0", None) for c in ("c", "d", "", None)]
    days = [20250105 + 100 * m for m in range(12)]
    basic = [dict(FACT, VIDEO_ID=v, CHANNEL_ID=c, REPORTING_DATE=d) for v, c in ids for d in days]
    paid = dict(UPLOADER_TYPE="self", COUNTRY_CODE="US", DATE=days[0], AD_IMPRESSIONS=3)
    revenue = [dict(paid, VIDEO_ID=v, CHANNEL_ID=c) for v, c in [*ids, ("paid", "c")]]
    title = dict(VIDEO_ID="v", VIDEO_TITLE="one", CHANNEL_ID="c", CHANNEL_DISPLAY_NAME="C")
    metadata = [title, dict(title, VIDEO_TITLE="two"), dict(VIDEO_ID="=v", CHANNEL_ID="d", CHANNEL_DISPLAY_NAME="D"), dict(CHANNEL_ID="")]
    d = dims(basic=basic, revenue=revenue, metadata=metadata)
    got = M.video_mart(d, "monthly").groupBy("VIDEO_ID", "CHANNEL_ID", "CHANNEL_NAME", "VIDEO_TITLE", "SERIES_ID").agg(
        F.count("*"), F.sum("VIEWS"), F.sum("AD_IMPRESSIONS")
    )
    name = {"c": "C", "d": "D"}
    # both titles of v meet both of its series, which are equal
    titles = {"v": [("one", 2), ("two", 2)]}
    want = [(v, c, name.get(c), t, "-1", 12 * n, 12 * n, 3 * n) for v, c in ids for t, n in titles.get(v, [(None, 1)])]
    assert rows(got, "*") == sorted([*want, ("paid", "c", "C", None, "-1", 1, None, 3)], key=str)


def test_a_video_is_dealt_to_all_its_shares(spark, table, unhelped):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        ids = [("v", "c"), (None, "c"), (None, None)]
        basic = table("basic", *[dict(FACT, VIDEO_ID=v, CHANNEL_ID=c, REPORTING_DATE=20250101 + d) for v, c in ids for d in range(28)] * 2)
        placed = video_measures(basic, table("revenue"), "daily", by_video=True).withColumn("part", F.spark_partition_id())
        got = placed.groupBy("_place_video", "_place_channel").agg(F.count("*"), F.sum("VIEWS"), F.count_distinct("_share"), F.count_distinct("part"))
        found = got.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == 3 and all(r[2] == 28 and r[3] == 56 and r[4] >= 6 and r[5] >= 4 for r in found)


def test_facts_of_the_region_are_shuffled_once_for_their_match(dims, unhelped):
    shuffled = exchanges(M.region_mart(dims()))
    match = r"hashpartitioning\(MONTH#\d+, VIDEO_ID#\d+, UPLOADER_TYPE#\d+, COUNTRY_CODE#\d+, "
    days = [b for b in shuffled if re.search(match, b)]
    assert len(days) == 2 and "sum#" not in "".join(days)
    assert "hashpartitioning(DATE" not in "".join(shuffled)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_region_rows_meet_as_their_monthly_sums_do(spark, table, unhelped, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    keys = [dict(VIDEO_ID=v, UPLOADER_TYPE=u, COUNTRY_CODE=c) for v in ("v", None) for u in ("self", None) for c in ("US", None)]
    seen = [dict(k, CHANNEL_ID=c, REPORTING_DATE=d, VIEWS=1) for k in keys for c in ("c", "d", None) for d in (20250101, 20250101, 20250131, 20250202)]
    paid = [dict(k, DATE=d, ESTIMATED_PARTNER_REVENUE=a and Decimal(a)) for k in keys for d, a in [(20250101, 1), (20250101, 2), (20250131, None), (20250201, 4), (20250202, 8), (20250203, 16)]]
    basic, revenue = table("basic", *seen).repartition(3), table("revenue", *paid).repartition(3)
    columns = ["MONTH", "CHANNEL_ID", "VIDEO_ID", "UPLOADER_TYPE", "COUNTRY_CODE", "VIEWS", "WATCH_TIME_MINUTES", "ESTIMATED_PARTNER_REVENUE"]
    got = rows(region_monthly(basic, revenue, as_rows=True), *columns)
    assert got == rows(region_monthly(basic, revenue), *columns)
    assert [r[5:] for r in got if r[:4] == ("2025-01-31", "c", "v", "self") and r[4] == "US"] == [(3, None, 3.0)]
    assert got[0][0] == "2025-01-31" and len(got) == 48
