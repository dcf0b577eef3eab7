"""Column-building helpers (pure Catalyst expressions, no Python UDFs)."""

from cohortforge.functions.nulls import flag, nan_to_null, truthy, tolerant_double, tolerant_timestamp
from cohortforge.functions.text import (contains_ci, contains_any_ci, contains_cs_any, normalize_category,
                                        normalize_ethnicity, normalize_ethnicity_v1, strip_brackets)
from cohortforge.functions.time import (within_hours, whole_days, hours_interval, hash_bin,
                                       hash_bucket, wall_micros)

__all__ = [
    "flag", "nan_to_null", "truthy", "tolerant_double", "tolerant_timestamp",
    "contains_ci", "contains_any_ci", "contains_cs_any", "normalize_category", "normalize_ethnicity",
    "normalize_ethnicity_v1", "strip_brackets",
    "within_hours", "whole_days", "hours_interval", "hash_bin", "hash_bucket",
    "wall_micros",
]
