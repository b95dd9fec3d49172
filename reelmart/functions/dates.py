"""Integer day keys (20250131) and the calendar columns derived from them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmart.functions.fixed_values import DATE_KEY_FORMAT, UPLOAD_TIME_FORMAT

Period = tuple[int, int]


def day_of_key(key: Column | str) -> Column:
    """Date of an integer key, by arithmetic: parsing text costs more than the whole scan."""
    key = F.col(key) if isinstance(key, str) else key
    year, month, day = F.floor(key / 10_000), F.floor(key / 100) % 100, key % 100
    return F.make_date(year.cast("int"), month.cast("int"), day)


def month_of_key(key: Column | str) -> Column:
    """Months are named by their last day."""
    return F.last_day(day_of_key(key))


def key_of_day(day: Column | str) -> Column:
    return F.date_format(day, DATE_KEY_FORMAT).cast("int")


def upload_time(text: Column | str) -> Column:
    return F.try_to_timestamp(text, F.lit(UPLOAD_TIME_FORMAT))


def in_periods(key: str, periods: Iterable[Period] | None) -> Column:
    """Whether an integer day key lies in one of the periods.

    Integer literals against the stored integer column, so the test reaches the Parquet scan (and
    the partitions, if the facts are partitioned by the key). ``None`` means all days.
    """
    if periods is None:
        return F.lit(True)
    tests = [F.col(key).between(int(start), int(end)) for start, end in periods]
    return reduce(or_, tests) if tests else F.lit(False)
