"""Program ids hidden in the two free-text identifiers of a video."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """The text as a whole number (rounded), NULL if it is not one."""
    return text.try_cast("decimal(38,0)")


def _segment(identifier: Column, part: int, lengths: tuple[int, int] | None) -> Column:
    """Number in one underscore-separated part, if that part's text has an accepted length."""
    text = F.split_part(identifier, F.lit("_"), F.lit(part))
    return number(text) if lengths is None else F.when(F.length(text).between(*lengths), number(text))


def _plain(identifier: Column, lengths: tuple[int, int]) -> Column:
    """The whole identifier as a non-zero number with an accepted count of characters."""
    value = number(identifier)
    return F.when((value != 0) & F.length(value.cast("string")).between(*lengths), value)


def program_id(custom: Column | str = "CUSTOM_ID", third_party: Column | str = "THIRD_PARTY_VIDEO_ID") -> Column:
    """First usable program id among six places, NULL if there is none.

    An underscore in the patterns stands for any one character, as in every LIKE.
    """
    custom = F.col(custom) if isinstance(custom, str) else custom
    third_party = F.col(third_party) if isinstance(third_party, str) else third_party
    return F.coalesce(
        F.when(custom.like("%_PGRMID_%"), _segment(custom, 3, (4, 6))),
        F.when(third_party.like("%_%_%"), _segment(third_party, 1, (4, 6))),
        _plain(third_party, (4, 6)),
        F.when(number(third_party).isNull(), _plain(custom, (5, 6))),
        F.when(third_party.like("%_%_%_%"), _segment(third_party, 2, None)),
        F.when(custom.like("%_%"), _segment(custom, 1, (4, 6))),
    )
