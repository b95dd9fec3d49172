"""Dimensions: video titles and forms, channels, programs, series, brands."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmart.functions import fixed_values as V
from reelmart.functions.buckets import brand_of_channel
from reelmart.functions.dates import upload_time
from reelmart.functions.program_ids import program_id
from reelmart.functions.titles import TitleClause, title_form, title_series, video_form
from reelmart.operators.lookups import Lookup, join_lookup, lookup
from reelmart.sources.inputs import Inputs

# Joins by video.

VIDEO_KEY = "_video"
#: Tasks' worth of keys for the facts without a video id.
NULL_SALTS = 1024
#: Types of the keys of facts; their measures are longs and decimals.
_KEY_TYPES = (T.StringType, T.DateType, T.IntegerType)


def with_video_key(facts: DataFrame) -> DataFrame:
    """Add the key for joins by video: the id, or for facts without one a value that matches nothing.

    NULL ids would all meet in one task of a shuffled join, and however many they are, none of them
    can match. The stand-ins (a NUL character and a hash of the row's other texts, days and codes) spread
    them. Measures are no part of the hash: a report that doesn't show them need not sum and shuffle them.
    Add the key once before several joins, and the facts are shuffled once for all of them.
    """
    telling = [f.name for f in facts.schema if f.name != "VIDEO_ID" and isinstance(f.dataType, _KEY_TYPES)]
    salt = F.pmod(F.xxhash64(*(telling or facts.columns)), F.lit(NULL_SALTS)).cast("string")
    return facts.withColumn(VIDEO_KEY, F.coalesce("VIDEO_ID", F.concat(F.lit("\0"), salt)))


def join_by_video(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join with a dimension by VIDEO_ID."""
    keyed = facts if VIDEO_KEY in facts.columns else with_video_key(facts)
    dim = dim.withColumnRenamed("VIDEO_ID", "_video_id")
    joined = keyed.join(dim, F.col(VIDEO_KEY) == F.col("_video_id"), "left").drop("_video_id")
    return joined if VIDEO_KEY in facts.columns else joined.drop(VIDEO_KEY)


# Places by video and channel.

#: Tasks that a video of a channel is dealt to.
SHARES = 8
_PLACE_VIDEO, _PLACE_CHANNEL, _SHARE = "_place_video", "_place_channel", "_share"
PLACE = [_PLACE_VIDEO, _PLACE_CHANNEL, _SHARE]


def _shares() -> Column:
    """How many places a video and channel have. Facts without both ids may be very many, and are one pair."""
    return F.when(F.col("VIDEO_ID").isNull() & F.col("CHANNEL_ID").isNull(), NULL_SALTS).otherwise(SHARES)


def _placed(ids: DataFrame, share: Column) -> DataFrame:
    """The ids as texts that are never NULL, in their stead, and a share."""

    def told(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))

    others = [c for c in ids.columns if c not in ("VIDEO_ID", "CHANNEL_ID")]
    return ids.select(
        told("VIDEO_ID").alias(_PLACE_VIDEO), told("CHANNEL_ID").alias(_PLACE_CHANNEL), share.alias(_SHARE), *others
    )


def with_place(facts: DataFrame, spread: list[str]) -> DataFrame:
    """Facts with a place instead of their video and channel.

    The rows of a video and channel are dealt to its shares by the columns ``spread``, so that a video with a large part
    of the rows is no single task's. Rows that agree in the ids and these columns have one place.
    """
    return _placed(facts, F.pmod(F.xxhash64(*spread), _shares()).cast("int"))


def join_by_place(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Left join of facts :func:`with_place` with rows by VIDEO_ID and CHANNEL_ID, which it gives back to the facts.

    The rows of ``known`` are the ones that are repeated, once for each share; NULL ids match.
    """

    def id_of(place: str, name: str) -> Column:
        return F.when(F.col(place) != "", F.expr(f"substring({place}, 2)")).cast(known.schema[name].dataType)

    everywhere = _placed(known, F.explode(F.sequence(F.lit(0), _shares() - 1)))
    rows = everywhere.withColumnsRenamed({name: f"{name}_r" for name in PLACE})
    same = [F.col(name) == F.col(f"{name}_r") for name in PLACE]
    ids = {name: id_of(place, name) for name, place in (("VIDEO_ID", _PLACE_VIDEO), ("CHANNEL_ID", _PLACE_CHANNEL))}
    return facts.join(rows, same, "left").withColumns(ids).drop(*PLACE, *rows.columns[:3])


# Titles and forms, by video.


def video_titles(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "VIDEO_ID",
        upload_time("TIME_UPLOADED").alias("PUBLISHED_DATE"),
        "VIDEO_TITLE",
        F.col("VIDEO_LENGTH").alias("DURATION"),
    )


def titles_and_forms(metadata: DataFrame) -> DataFrame:
    return video_titles(metadata).withColumn("TITLE_FORM", title_form("VIDEO_TITLE", "DURATION"))


def map_video_title(facts: DataFrame, metadata: DataFrame, form: bool = False) -> DataFrame:
    """Title, upload time and duration. Several metadata rows of a video multiply its facts.

    With ``form`` also VIDEO_FORM; the title is searched once per metadata row, not per fact.
    """
    if not form:
        return join_by_video(facts, video_titles(metadata))
    titled = join_by_video(facts, titles_and_forms(metadata))
    return titled.withColumn("VIDEO_FORM", video_form("UPLOADER_TYPE", "TITLE_FORM")).drop("TITLE_FORM")


def video_forms(metadata: DataFrame) -> DataFrame:
    """The title forms of each video and how many metadata rows have them.

    The reports that only need the form join this and multiply, instead of joining every copy of a
    title: a video has at most one row per form here, however often it is repeated.
    """
    forms = metadata.select("VIDEO_ID", title_form("VIDEO_TITLE", "VIDEO_LENGTH").alias("TITLE_FORM"))
    return forms.groupBy("VIDEO_ID", "TITLE_FORM").agg(F.count(F.lit(1)).alias("FORM_COPIES"))


def repeated_videos(metadata: DataFrame) -> DataFrame:
    """Data check: videos with more than one metadata row, whose facts count several times."""
    copies = metadata.groupBy("VIDEO_ID").agg(F.count(F.lit(1)).alias("COPIES"))
    return copies.where((F.col("COPIES") > 1) & F.col("VIDEO_ID").isNotNull())


#: What the other dimensions are found by.
DIMENSION_KEYS = {
    "program": "PROGRAM_ID",
    "corrected_series": "DOMO_SERIES_NAME",
    "brand_map": "CHANNEL_NAME",
    "country_info": "COUNTRY_CODE",
    "traffic_dim": "TRAFFIC_SOURCE_TYPE_ID",
    "device_dim": "DEVICE_TYPE",
}


def repeated_keys(inputs: Inputs) -> DataFrame:
    """Data check: keys that a dimension has more than once, so that the facts they match count several times."""

    def check(name: str, key: str) -> DataFrame:
        copies = getattr(inputs, name).groupBy(F.col(key).cast("string").alias("KEY")).agg(F.count(F.lit(1)).alias("COPIES"))
        return copies.where((F.col("COPIES") > 1) & F.col("KEY").isNotNull()).select(F.lit(name).alias("DIMENSION"), "KEY", "COPIES")

    return reduce(DataFrame.union, (check(name, key) for name, key in DIMENSION_KEYS.items()))


# Channels.


def latest_channel_names(metadata: DataFrame) -> DataFrame:
    """Display name of each channel on its latest upload.

    An upload without a time counts as the latest; equal times are decided by the greater name. A
    maximum instead of a sorted window: tasks combine a channel's rows before the shuffle.
    """
    latest = F.struct(F.col("TIME_UPLOADED").isNull().alias("undated"), "TIME_UPLOADED", "CHANNEL_DISPLAY_NAME")
    newest = metadata.groupBy("CHANNEL_ID").agg(F.max(latest).alias("latest"))
    return newest.select("CHANNEL_ID", F.col("latest.CHANNEL_DISPLAY_NAME").alias("CHANNEL_NAME"))


def channels(metadata: DataFrame) -> DataFrame:
    return latest_channel_names(metadata).withColumn("BRAND_ROLL_UP", brand_of_channel("CHANNEL_NAME"))


def map_channel(facts: DataFrame, channel: Lookup) -> DataFrame:
    """Channel name and brand; a channel without a name has the brand ``other``."""
    named = join_lookup(facts, channel, "CHANNEL_ID")
    return named.withColumn("BRAND_ROLL_UP", F.coalesce("BRAND_ROLL_UP", F.lit(V.NO_BRAND)))


def map_brand_from_table(facts: DataFrame, brand_map: DataFrame) -> DataFrame:
    """Brand from a maintained table instead of the fixed names; NULL where it has none."""
    brands = lookup(brand_map.select("CHANNEL_NAME", "BRAND_ROLL_UP"), "CHANNEL_NAME")
    return join_lookup(facts, brands, "CHANNEL_NAME")


# Programs and series.


def program_table(program: DataFrame) -> DataFrame:
    """Programs with the key types used in all joins: number for programs, text for series."""
    return program.select(
        F.col("PROGRAM_ID").cast("decimal(38,0)").alias("PROGRAM_ID"),
        F.col("SERIES_ID").cast("string").alias("SERIES_ID"),
        "PARENT_SERIES_ID",
        "SERIES_NAME",
    )


def metadata_rows(metadata: DataFrame) -> DataFrame:
    """What programs and series need of the metadata, with equal rows counted instead of repeated.

    However often a video is listed, its copies are one row for the rules and the joins that follow.
    """
    identifiers = ["VIDEO_ID", "CUSTOM_ID", "THIRD_PARTY_VIDEO_ID", "VIDEO_TITLE"]
    return metadata.groupBy(*identifiers).agg(F.count(F.lit(1)).alias("COPIES"))


def repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as its COPIES say, without that column; in two steps, to keep the arrays short."""
    step = 10_000
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("COPIES") - 1) / step))
    left = F.least(F.lit(step).cast("long"), F.col("COPIES") - F.col("_block") * step)
    return (
        rows.withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .drop("_block", "_copy", "COPIES")
    )


def video_programs(rows: DataFrame, program: Lookup, clauses: Iterable[TitleClause]) -> DataFrame:
    """Metadata rows with their program id, the series the title suggests, and the program's row."""
    identified = rows.select(
        "*",
        program_id().alias("EXTRACTED_PPL_ID"),
        title_series("VIDEO_TITLE", clauses).alias("DOMO_SERIES_NAME"),
    )
    return join_lookup(identified, program, "EXTRACTED_PPL_ID")


def corrected_table(corrected_series: DataFrame) -> DataFrame:
    return corrected_series.select(
        "DOMO_SERIES_NAME",
        F.col("CORRECTED_SERIES_ID").cast("string").alias("CORRECTED_SERIES_ID"),
        "CORRECTED_PPL_SERIES_NAME",
    )


def corrected_series(programs: DataFrame, corrected: Lookup) -> DataFrame:
    """Series of each row of :func:`video_programs`: the program's, else the corrected one, else none.

    Without either id, a program whose series name agrees with the title's label keeps an unknown
    id (NULL); all other videos get the id -1. The name is a LIKE pattern: percent signs and
    underscores in it are wildcards, backslashes are plain.
    """
    resolved = join_lookup(programs, corrected, "DOMO_SERIES_NAME")
    pattern = F.concat(F.lit("%"), F.replace(F.col("SERIES_NAME"), F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    label = F.col("DOMO_SERIES_NAME")
    agrees = (label == F.col("SERIES_NAME")) | F.call_function("ilike", label, pattern)
    fallback = F.when(agrees, F.lit(None).cast("string")).otherwise(V.NO_SERIES_ID)
    return resolved.select(
        "VIDEO_ID",
        "COPIES",
        "EXTRACTED_PPL_ID",
        F.coalesce("SERIES_ID", "CORRECTED_SERIES_ID", fallback).alias("SERIES_ID"),
        F.coalesce("SERIES_NAME", "CORRECTED_PPL_SERIES_NAME", F.lit(V.NO_SERIES_NAME)).alias("SERIES_NAME"),
    )


#: What :func:`map_parent_series` adds.
PARENT_COLUMNS = ["PARENT_SERIES_ID", "PARENT_SERIES_NAME"]


def map_series(facts: DataFrame, series_by_video: DataFrame, parents: Lookup | None = None) -> DataFrame:
    """Join series by video; a video without metadata gets the id -1 and the name ``other``.

    With COPIES on the series' side, a row appears once per copy. It is repeated after the join, so that
    what a join may broadcast is never larger than it was counted to be. ``parents`` is for a series' side
    that :func:`map_parent_series` has given its parents: a video without metadata then gets those of the id -1.
    """
    missing = {"SERIES_ID": F.lit(V.NO_SERIES_ID), "SERIES_NAME": F.lit(V.NO_SERIES_NAME)}
    if parents is not None:
        none = parents.rows.where(F.col("SERIES_ID") == V.NO_SERIES_ID)  # a row at most
        missing |= {name: none.select(name).scalar() for name in PARENT_COLUMNS}
    joined = join_by_video(facts, series_by_video.withColumn("_known", F.lit(True)))
    joined = joined.withColumns(
        {name: F.when(F.col("_known"), F.col(name)).otherwise(value) for name, value in missing.items()}
    ).drop("_known")
    if "COPIES" not in series_by_video.columns:
        return joined
    return repeated(joined.withColumn("COPIES", F.coalesce("COPIES", F.lit(1).cast("long"))))


def series_copies(resolved: DataFrame) -> DataFrame:
    """Distinct series of each video, with their parents if given, and how many metadata rows lead to them."""
    keys = ["VIDEO_ID", "SERIES_ID", "SERIES_NAME", *(c for c in PARENT_COLUMNS if c in resolved.columns)]
    return resolved.groupBy(*keys).agg(F.sum("COPIES").alias("SERIES_COPIES"))


def first_parent_ids(program: DataFrame) -> DataFrame:
    """Lowest parent id of each series; a series has none only if all its programs have none."""
    return program.groupBy("SERIES_ID").agg(F.min("PARENT_SERIES_ID").alias("PARENT_SERIES_ID"))


def first_parent_names(series: DataFrame) -> DataFrame:
    return series.groupBy("PARENT_SERIES_ID").agg(F.min("PARENT_SERIES_NAME").alias("PARENT_SERIES_NAME"))


def parent_series(program: DataFrame, series: DataFrame) -> DataFrame:
    """Each series with its parent's id and name."""
    names = lookup(first_parent_names(series), "PARENT_SERIES_ID")
    return join_lookup(first_parent_ids(program), names, "PARENT_SERIES_ID")


def map_parent_series(rows: DataFrame, parents: Lookup) -> DataFrame:
    """Parent id and name by SERIES_ID.

    Videos without a series share the id -1, often a large part of all. Give the series of the videos, before they
    meet the facts: the facts then need no join by series, and what is shared out here are metadata rows.
    """
    return join_lookup(rows, parents, "SERIES_ID", hot=V.NO_SERIES_ID)


# Multiplying sums by the number of matching dimension rows.


def times(facts: DataFrame, measure: str, copies: Column) -> Column:
    """``measure * copies`` in the measure's own scale."""
    kind = facts.schema[measure].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(measure).cast(f"decimal(27,{kind.scale})") * copies.cast("decimal(10,0)")
    return F.col(measure) * copies
