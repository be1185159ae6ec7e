"""Column functions on measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAMS_PER_TON = 1e6
KWH_PER_MWH = 1000

# Age limits in minutes of the freshness labels.
FRESHNESS_LIMITS = [("fresh", 60), ("recent", 240), ("stale", 1440)]
FRESHNESS_BEYOND = "very stale"


def grams_per_hour(mw: Column, gco2_per_kwh: Column) -> Column:
    """MW held for an hour -> kWh -> grams of CO2."""
    return mw * KWH_PER_MWH * gco2_per_kwh


def tons(grams: Column) -> Column:
    return grams / GRAMS_PER_TON


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL unless the whole is positive."""
    return F.when(whole > 0, F.round(100.0 * part / whole, digits))


def intensity(grams: Column, mw: Column, digits: int = 2) -> Column:
    """gCO2 per kWh, NULL unless something was generated."""
    return F.when(mw > 0, F.round(grams / (mw * KWH_PER_MWH), digits))


def age_minutes(ts: Column, as_of: Column) -> Column:
    return (F.unix_timestamp(as_of) - F.unix_timestamp(ts)) / 60.0


def freshness(age: Column) -> Column:
    """Label of an age in minutes. A NULL age (empty table) is past every limit."""
    label = F.lit(FRESHNESS_BEYOND)
    for name, limit in reversed(FRESHNESS_LIMITS):
        label = F.when(age < limit, F.lit(name)).otherwise(label)
    return label


def stable_sum(value: Column | str) -> Column:
    """SUM as a double that is the same to the last digit whatever order the rows arrive in.

    It is taken in decimals of twelve places; where a value or the sum does not fit one (NaN, or
    beyond 1e26) the plain sum of doubles stands in, so that one freak value neither fails the job
    nor drops out.
    """
    col = F.col(value) if isinstance(value, str) else value
    fixed = col.try_cast("decimal(38,12)")
    unfit = F.count_if(col.isNotNull() & fixed.isNull())
    exact = F.when(unfit == 0, F.try_sum(fixed).cast("double"))
    return F.coalesce(exact, F.sum(col.cast("double")))


def array_total(values: Column) -> Column:
    """SUM over an array, with SQL's treatment of NULL: skipped, and NULL when none is left."""
    present = F.filter(values, lambda v: v.isNotNull())
    return F.when(
        F.size(present) > 0,
        F.aggregate(present, F.lit(0.0), lambda total, v: total + v.cast("double")),
    )
