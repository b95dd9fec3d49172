"""Joins with dimension tables of unknown size."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dimension said to be large: each fact key is spread over this many join partitions.
SALTS = 32

_KEY = "_lookup_key"
_SALT = "_lookup_salt"


@dataclass(frozen=True)
class Lookup:
    """A dimension with the key to find it by.

    ``large``: its join is always a salted shuffle. Otherwise the join is left to adaptive execution,
    which broadcasts a side that turns out to be small and splits the partition of a hot key.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    large: bool = False


def lookup(rows: DataFrame, *keys: str, large: bool = False) -> Lookup:
    """Name the key of a dimension; nothing is computed."""
    return Lookup(rows, keys, large)


def join_lookup(
    facts: DataFrame, dim: Lookup, *fact_keys: str, how: str = "left", null_safe: bool = False, hot: str | None = None
) -> DataFrame:
    """Join facts with a dimension (``left`` or ``inner``); the dimension's keys are dropped.

    For a dimension said to be large, the shuffle is on (key, salt): the salt is a hash of the fact
    row, and every dimension row is present under all salts, so a key that holds a large part of the
    facts (or NULL) is shared out over many tasks. ``hot`` names a value of a single key that is known to
    hold many facts: only it and NULL are shared out, and only its rows of the dimension are repeated. All
    ways give the same rows.
    """
    aliases = [f"{_KEY}_{i}" for i in range(len(dim.keys))]
    rows = dim.rows.withColumnsRenamed(dict(zip(dim.keys, aliases)))
    salted = dim.large or hot is not None
    if salted:
        salt, salts = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1))
        if not dim.large:
            key = F.col(fact_keys[0])
            salt = F.when(key.isNull() | (key == hot), salt).otherwise(0)
            alias = F.col(aliases[0])
            salts = F.when(alias.isNull() | (alias == hot), salts).otherwise(F.array(F.lit(0)))
        facts = facts.withColumn(_SALT, salt)
        rows = rows.withColumn(f"{_SALT}_r", F.explode(salts))

    def same(fact_key: str, alias: str) -> Column:
        left, right = F.col(fact_key), F.col(alias)
        return left.eqNullSafe(right) if null_safe else left == right

    tests = [same(k, a) for k, a in zip(fact_keys, aliases)]
    if salted:
        tests.append(F.col(_SALT) == F.col(f"{_SALT}_r"))
    return facts.join(rows, reduce(and_, tests), how).drop(*aliases, _SALT, f"{_SALT}_r")
