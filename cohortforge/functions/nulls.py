"""Two-valued logic helpers.

The feature definitions treat a comparison against a missing value as False
(never unknown), and a negation acts on that False. SQL is three-valued, so
every predicate that becomes a flag goes through ``truthy``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(cond: Column) -> Column:
    """Null predicate -> False."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """0/1 integer flag with null predicate -> 0."""
    return truthy(cond).cast("int")


def nan_to_null(c: Column) -> Column:
    """NaN -> null so that max/avg skip it the way missing values are skipped."""
    return F.when(~F.isnan(c), c)


def tolerant_double(c: Column) -> Column:
    """Text to double, unparsable text and NaN to null (ANSI-safe)."""
    return nan_to_null(c.try_cast("double"))


def tolerant_timestamp(c: Column) -> Column:
    """Text to timestamp without zone, unparsable text to null."""
    return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
