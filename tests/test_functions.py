from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelmart.functions import buckets as B
from reelmart.functions import fixed_values as V
from reelmart.functions.dates import day_of_key, in_periods, key_of_day, month_of_key, upload_time
from reelmart.functions.measures import cost_per_mille, percentage, ratio
from reelmart.functions.program_ids import program_id
from reelmart.functions.titles import (
    TitleClause,
    sample_title_rules,
    title_form,
    title_rules_from,
    title_series,
    video_form,
)


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr("x")).first()[0]


@pytest.mark.parametrize(
    "title, seconds, form",
    [
        ("Mega Marathon #Shorts", 1, "Marathon"),
        ("A Marathon", 1, "Marathon"),
        ("marathon #shorts", 1, "Vertical Viewing"),
        ("Full Episode part 2", 1, "Long Form"),
        ("full documentary #shorts", 1, "Long Form"),
        ("Teen cheerleader is abducted by family friend", 1, "Long Form"),
        ("Teen cheerleader is abducted by family friend, part 1", 1, "Short Form"),
        ("teen cheerleader is abducted by family friend #shorts", 1, "Vertical Viewing"),
        ("angry sellers lose their cool", 600, "Short Form"),
        ("angry sellers lose their cool", 780, "Short Form"),
        ("angry sellers lose their cool", 781, "Compilations"),
        ("angry sellers lose their cool", None, "Short Form"),
        ("angry sellers lose their cool #shorts", 781, "Vertical Viewing"),
        ("Best of 2020", None, "Compilations"),
        ("Stop it", 1, "Compilations"),  # holds "top "
        ("Top 10", 1, "Compilations"),
        ("in shorts", 1, "Vertical Viewing"),
        ("", 1, "Short Form"),
        (None, 1, "Short Form"),
    ],
)
def test_title_form(spark, title, seconds, form):
    df = spark.createDataFrame([(title, seconds)], "t string, s int")
    assert df.select(title_form("t", "s")).first()[0] == form


@pytest.mark.parametrize(
    "phrases, form",
    [
        (V.LONG_PHRASES[:-1], "Long Form"),
        (V.COMPILATION_PHRASES[:-1], "Compilations"),
        (V.VERTICAL_PHRASES, "Vertical Viewing"),
    ],
)
def test_every_phrase_alone_decides_the_form(spark, phrases, form):
    df = spark.createDataFrame([(f"x {p.upper()} y", 1) for p in phrases], "t string, s int")
    assert {r[0] for r in df.select(title_form("t", "s")).collect()} == {form}


def test_video_form_needs_an_own_upload(spark):
    df = spark.createDataFrame(
        [("self", "Marathon"), ("SELF", None), ("thirdParty", "Marathon"), (None, "Marathon")], "u string, f string"
    )
    assert [r[0] for r in df.select(video_form("u", "f")).collect()] == ["Marathon", "Short Form", "", ""]


@pytest.mark.parametrize(
    "title, label",
    [
        ("RED WIDGET", "Red Widget"),
        ("blue rod", "Blue Rings & Rods"),
        ("a gear, cold", "Cold Gear"),
        ("hot plate", "Hot Everything Else"),  # an earlier rule shadows the rule named after it
        ("hot rod", "Hot Rod"),
        ("old bolt", "other"),  # required and forbidden by the same rule
        ("Small Gizmo", "Small Gizmo, Plain"),
        ("small gizmo!", "other"),
        ("large plate marathon", "Large Plate or Rod"),  # the exclusion limits the other alternative only
        ("large rod marathon", "other"),
        ("large rod", "Large Plate or Rod"),
        ("new ring", "New Ring's Year"),
        (None, "other"),
    ],
)
def test_title_series(spark, title, label):
    assert one(spark, title, lambda c: title_series(c, sample_title_rules())) == label


def test_many_rules_keep_their_order(spark):
    clauses = [TitleClause(n, f"label {n}", (f"w{n} ",)) for n in range(1, 601)]
    titles = [(f"w{a} w{b} ", min(a, b)) for a, b in [(5, 3), (101, 100), (600, 599), (250, 7)]]
    df = spark.createDataFrame([*titles, ("none", 0)], "t string, n int")
    got = {r.n: r.label for r in df.select("n", title_series("t", reversed(clauses)).alias("label")).collect()}
    assert got == {3: "label 3", 100: "label 100", 599: "label 599", 7: "label 7", 0: "other"}


def test_rule_table(spark):
    schema = "ordinal int, label string, contains array<string>, lacks array<string>, equals string"
    df = spark.createDataFrame([(2, "b", ["x"], None, None), (1, "a", ["x"], ["y"], None)], schema)
    rules = title_rules_from(df)
    assert one(spark, "xy", lambda c: title_series(c, rules)) == "b"
    with pytest.raises(ValueError):
        TitleClause(1, "tests nothing")


@pytest.mark.parametrize(
    "custom, third, expected",
    [
        ("XX_PGRMID_12345", None, 12345),
        ("XX_PGRMID_123", None, None),
        ("XX_PGRMID_1234567", None, None),
        ("XX_PGRMID_12345", "4321_A", 12345),
        ("PGRMID_12345_1", "4321_A", 4321),
        (None, "12345_A", 12345),
        (None, "0012345", 12345),
        (None, "12.7", 13),
        (None, "0000", 0),
        (None, "123456789", None),
        ("12345", None, 12345),
        ("1234", None, 1234),
        ("1234567", "abc", None),
        ("12345", "99999999", 12345),
        (None, "AB_77_X", 77),
        ("4321_X", None, 4321),
        ("4321_X", "AB_x_X", 4321),
        ("a", "b", None),
        (None, None, None),
    ],
)
def test_program_id(spark, custom, third, expected):
    df = spark.createDataFrame([(custom, third)], "CUSTOM_ID string, THIRD_PARTY_VIDEO_ID string")
    got = df.select(program_id()).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_buckets(spark):
    assert [one(spark, c, B.geo_bucket) for c in ("US", "us", "DE", None)] == ["US", "Non-US", "Non-US", "Non-US"]
    devices = ["Mobile Phone", "Tablet", "Computer", "TV", "Watch", None]
    assert [one(spark, d, B.device_bucket) for d in devices] == [
        "Mobile Phone & Tablet",
        "Mobile Phone & Tablet",
        "Computer",
        "TV",
        "Other",
        "Other",
    ]
    sources = ["External", "Playlists", "Playlist pages", "external", None]
    assert [one(spark, s, B.traffic_category) for s in sources] == ["External", "Playlists", "Playlists", "Other", "Other"]
    ages = ["AGE_13_17", "AGE_65_", "AGE_99", None]
    assert [one(spark, a, B.age_midpoint) for a in ages] == [15, 70, None, None]


def test_region_flags_overlap(spark):
    places = [("Africa", None), ("Oceania", "WEST"), ("North America", "CARIBBEAN"), ("Asia", "LATIN NORTH"), (None, None)]
    df = spark.createDataFrame(places, "CONTINENT string, SUB_CONTINENT string")
    assert [tuple(r) for r in df.select(*B.region_flags()).collect()] == [
        (0, 0, 1, 1),
        (0, 0, 0, 0),
        (1, 1, 0, 0),
        (0, 1, 0, 1),
        (0, 0, 0, 0),
    ]


def test_brands(spark):
    assert {b: len(c) for b, c in V.CHANNELS_BY_BRAND.items()} == {
        "A&E Brand": 29,
        "Emerging": 11,
        "History Brand": 33,
        "Lifetime Brand": 11,
    }
    names = [(n, b) for b, channels in V.CHANNELS_BY_BRAND.items() for n in channels]
    df = spark.createDataFrame([*names, ("vikings", "other"), (None, "other")], "n string, b string")
    assert df.where(B.brand_of_channel("n") != F.col("b")).count() == 0


@pytest.mark.parametrize(
    "revenue, impressions, expected",
    [
        ("2", 3, "666.667"),
        ("0.0005", 1000, "0.001"),
        ("0.0004999", 1000, "0.000"),
        ("0.000500", 1000, "0.001"),
        ("-0.0005", 1000, "-0.001"),
        ("5", 0, "0.000"),
        ("5", None, "0.000"),
        (None, 5, "0.000"),
        ("123456789.123456789012", 7, "17636684160.494"),
    ],
)
def test_cost_per_mille(spark, revenue, impressions, expected):
    value = None if revenue is None else Decimal(revenue)
    df = spark.createDataFrame([(value, impressions)], "r decimal(38,12), n long")
    assert df.select(cost_per_mille(F.col("r"), F.col("n"))).first()[0] == Decimal(expected)


def test_percentage_of_nothing(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "p int, w int")
    assert [r[0] for r in df.select(percentage(F.col("p"), F.col("w"))).collect()] == [None, None, 25.0]


def test_ratio_rounds_halves_up(spark):
    df = spark.createDataFrame(
        [(Decimal("4842.1275"), Decimal("134.4")), (Decimal(2), Decimal(3)), (Decimal(1), Decimal(128)), (None, Decimal(1))],
        "p decimal(38,8), w decimal(38,8)",
    )
    got = [r[0] for r in df.select(ratio(F.col("p"), F.col("w"))).collect()]
    # 4842.1275 / 134.4 is 36.027734375 exactly.
    assert got == [Decimal("36.02773438"), Decimal("0.66666667"), Decimal("0.00781250"), None]


def test_dates(spark):
    df = spark.createDataFrame([(20240229, "2024/02/29 23:59:59"), (20250131, "bad"), (None, None)], "k int, t string")
    assert rows(df, day_of_key("k"), month_of_key("k"), key_of_day(day_of_key("k"))) == [
        ("2024-02-29", "2024-02-29", 20240229),
        ("2025-01-31", "2025-01-31", 20250131),
        (None, None, None),
    ]
    assert [str(r[0]) for r in df.select(upload_time("t")).collect()] == ["2024-02-29 23:59:59", "None", "None"]
    assert df.where(in_periods("k", None)).count() == 3
    assert df.where(in_periods("k", [])).count() == 0
    assert df.where(in_periods("k", [(20240201, 20240229), (20240301, 20241231)])).count() == 1
