"""Ratios with exact rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cost_per_mille(revenue: Column, impressions: Column) -> Column:
    """``revenue / impressions * 1000`` to three places, half away from zero; 0 without impressions.

    Rounded once, by integer division of exact decimals. A decimal or double quotient would be cut
    to its own scale first and could land on the wrong side of a half.
    """
    twice = F.abs(revenue) * 2_000_000 + impressions
    mills = F.call_function("div", twice, F.nullif(impressions, F.lit(0)) * 2)
    signed = F.coalesce(F.when(revenue < 0, -mills).otherwise(mills), F.lit(0))
    return (signed.cast("decimal(20,0)") * Decimal("0.001")).cast("decimal(38,3)")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` of two counts or amounts, to eight places, half up; NULL without a whole.

    By integer division like the above: the quotient of two doubles misses exact halves.
    """
    part, whole = part.cast("decimal(27,8)"), F.nullif(whole, F.lit(0)).cast("decimal(27,8)")
    units = F.call_function("div", part * Decimal(200_000_000) + whole, whole * Decimal(2))
    return (units.cast("decimal(20,0)") * Decimal("0.00000001")).cast("decimal(38,8)")


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with the precision of :func:`ratio`."""
    return ratio(part.cast("decimal(25,8)") * Decimal(100), whole)
