"""Elapsed-time predicates and hash bins.

Timestamps are kept as ``timestamp_ntz`` so that arithmetic does not depend
on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.functions.nulls import truthy


def hours_interval(h: float) -> Column:
    return F.make_dt_interval(hours=F.lit(int(h)), mins=F.lit(0), secs=F.lit(round((h - int(h)) * 3600, 6)))


def within_hours(event: Column, anchor: Column, hours: float, lower_hours: float | None = None,
                 inclusive: bool = False) -> Column:
    """``event - anchor < hours`` (or ``<=``). No lower bound unless given:
    events before the anchor count as within. Missing time -> False."""
    delta = event - anchor
    cond = (delta <= hours_interval(hours)) if inclusive else (delta < hours_interval(hours))
    if lower_hours is not None:
        cond = cond & (delta >= hours_interval(lower_hours))
    return truthy(cond)


def whole_days(end: Column, start: Column) -> Column:
    """Floor of (end - start) in days, as a timedelta's ``days`` field."""
    end_tod = end - F.to_date(end).cast("timestamp_ntz")
    start_tod = start - F.to_date(start).cast("timestamp_ntz")
    return F.datediff(F.to_date(end), F.to_date(start)) - F.when(end_tod < start_tod, 1).otherwise(0)


def hash_bin(key: Column, digits: int = 2) -> Column:
    """First hex digits of md5 of the key text (256 bins for two digits)."""
    return F.substring(F.md5(key.cast("string")), 1, digits)


def hash_bucket(key: Column, modulo: int, seed: str = "") -> Column:
    """Stable pseudo-random bucket in [0, modulo) from md5(seed || key)."""
    h = F.md5(F.concat(F.lit(seed), key.cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(modulo)).cast("int")


def wall_micros(t: Column) -> Column:
    """Microseconds of a timestamp_ntz's wall clock since 1970-01-01 (zone
    independent, strictly monotone in ``t``); null stays null."""
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return ((days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60) * 1_000_000
            + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))
