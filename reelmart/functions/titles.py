"""Classification of videos by title: the ordered series rules and the video form."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from importlib import resources
from itertools import groupby
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V

#: Clauses per CASE expression. Long rule sets become several CASEs, so that no generated method
#: outgrows what the JVM is willing to compile.
CLAUSES_PER_CASE = 100


@dataclass(frozen=True)
class TitleClause:
    """One row of a rule table: the title must meet all of its conditions.

    Rows with the same ordinal belong to one rule and are alternatives; rules apply in order of
    their ordinals and the first that holds gives the label.
    """

    ordinal: int
    label: str
    contains: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    equals: str | None = None

    def __post_init__(self):
        if not self.contains and self.equals is None:
            raise ValueError(f"title rule {self.ordinal} ({self.label!r}) has a clause that tests nothing")

    def test(self, title: Column) -> Column:
        tests = [title.contains(phrase) for phrase in self.contains]
        tests += [~title.contains(phrase) for phrase in self.lacks]
        if self.equals is not None:
            tests.append(title == self.equals)
        return reduce(and_, tests)


def _clause(row: dict) -> TitleClause:
    return TitleClause(
        int(row["ordinal"]),
        row["label"],
        tuple(row.get("contains") or ()),
        tuple(row.get("lacks") or ()),
        row.get("equals"),
    )


def sample_title_rules() -> list[TitleClause]:
    """A small rule table with one rule of every shape, for tests and examples."""
    text = resources.files("reelmart").joinpath("rules/sample_title_rules.json").read_text(encoding="utf-8")
    return [_clause(row) for row in json.loads(text)]


def title_rules_from(table: DataFrame) -> list[TitleClause]:
    """Read a rule table (ordinal, label, contains, lacks, equals) into clauses, which become part of the query text.

    For rules that are data of any size, join them instead: :mod:`reelmart.operators.title_rules`.
    """
    return [_clause(row.asDict()) for row in table.collect()]


def title_series(title: Column | str, clauses: Iterable[TitleClause], default: str = V.NO_SERIES_NAME) -> Column:
    """Label of the first rule that holds for the lower-case title, else ``default``."""
    title = F.lower(F.col(title) if isinstance(title, str) else title)
    ordered = sorted(clauses, key=lambda c: c.ordinal)
    rules = [(group[0].label, [c.test(title) for c in group]) for _, group in _by_ordinal(ordered)]
    cases = []
    for start in range(0, len(rules), CLAUSES_PER_CASE):
        case = F
        for label, tests in rules[start : start + CLAUSES_PER_CASE]:
            case = case.when(reduce(or_, tests), F.lit(label))
        cases.append(case)
    return F.coalesce(*cases, F.lit(default))


def _by_ordinal(ordered: Sequence[TitleClause]):
    return [(ordinal, list(group)) for ordinal, group in groupby(ordered, key=lambda c: c.ordinal)]


def title_form(title: Column | str, seconds: Column | str) -> Column:
    """Video form of an own upload, from its title and its length.

    In the three forms with exclusions these limit only the last phrase; every earlier phrase is
    sufficient by itself.
    """
    title = F.lower(F.col(title) if isinstance(title, str) else title)
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds

    def has(phrase: str) -> Column:
        return title.contains(phrase)

    def any_of(phrases: list[str], *last_only: Column) -> Column:
        *free, last = phrases
        return reduce(or_, map(has, free)) | reduce(and_, last_only, has(last))

    return (
        F.when(any_of(V.MARATHON_PHRASES, ~has(V.SHORTS_TAG)), V.FORM_MARATHON)
        .when(any_of(V.LONG_PHRASES, *[~has(p) for p in V.LONG_EXCLUSIONS]), V.FORM_LONG)
        .when(
            any_of(V.COMPILATION_PHRASES, seconds > V.COMPILATION_MIN_SECONDS, ~has(V.SHORTS_TAG)),
            V.FORM_COMPILATION,
        )
        .when(any_of(V.VERTICAL_PHRASES), V.FORM_VERTICAL)
        .otherwise(V.FORM_SHORT)
    )


def video_form(uploader: Column | str, form: Column | str) -> Column:
    """The title form for own uploads (whatever the case of the marker), else the empty text.

    ``form`` is :func:`title_form`, NULL where the video has no metadata.
    """
    uploader = F.col(uploader) if isinstance(uploader, str) else uploader
    form = F.col(form) if isinstance(form, str) else form
    own = F.lower(uploader) == V.OWN_UPLOADER
    return F.when(own, F.coalesce(form, F.lit(V.FORM_SHORT))).otherwise("")
