"""Small code tables as columns: geography, devices, traffic, markets, ages, brands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geo_bucket(country: Column | str) -> Column:
    """Home country or the rest of the world; an unknown country counts as the rest."""
    return F.when(_col(country) == V.HOME_COUNTRY, V.HOME_COUNTRY).otherwise(V.FOREIGN)


def device_bucket(name: Column | str) -> Column:
    name = _col(name)
    return (
        F.when(name.isin(V.HANDHELD_DEVICES), V.HANDHELD_BUCKET)
        .when(name.isin(V.KEPT_DEVICES), name)
        .otherwise(V.OTHER_BUCKET)
    )


def traffic_category(name: Column | str) -> Column:
    name = _col(name)
    return (
        F.when(name.isin(V.KEPT_TRAFFIC), name)
        .when(name.isin(V.PLAYLIST_TRAFFIC), V.PLAYLIST_BUCKET)
        .otherwise(V.OTHER_BUCKET)
    )


def region_flags(continent: Column | str = "CONTINENT", sub_continent: Column | str = "SUB_CONTINENT") -> list[Column]:
    """The four market flags as 0/1 columns. Africa is in both EMEA and AMEA."""

    def flag(place: Column | str, members: list[str], name: str) -> Column:
        return F.coalesce(_col(place).isin(members), F.lit(False)).cast("int").alias(name)

    return [
        flag(continent, V.AMER_CONTINENTS, "AMER"),
        flag(sub_continent, V.LATAM_SUB_CONTINENTS, "LATAM"),
        flag(continent, V.EMEA_CONTINENTS, "EMEA"),
        flag(continent, V.AMEA_CONTINENTS, "AMEA"),
    ]


def age_midpoint(age_group: Column | str) -> Column:
    """Midpoint of an age group code; NULL for codes without one."""
    pairs = [F.lit(x) for pair in V.AGE_MIDPOINTS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _col(age_group))


def brand_of_channel(channel_name: Column | str) -> Column:
    """Brand by exact channel name."""
    name = _col(channel_name)
    brand = F.lit(None).cast("string")
    for label, channels in V.CHANNELS_BY_BRAND.items():
        brand = F.coalesce(brand, F.when(name.isin(channels), label))
    return F.coalesce(brand, F.lit(V.NO_BRAND))
