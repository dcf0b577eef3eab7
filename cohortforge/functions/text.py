"""Text predicates and the label normalisers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.functions.nulls import truthy


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive literal substring test, null text -> False."""
    return truthy(F.lower(c).contains(F.lit(needle.lower())))


def contains_any_ci(c: Column, needles: Iterable[str]) -> Column:
    low = F.lower(c)
    parts = [low.contains(F.lit(n.lower())) for n in needles]
    return truthy(reduce(lambda a, b: a | b, parts)) if parts else F.lit(False)


def contains_cs_any(c: Column, needles: Iterable[str]) -> Column:
    """Case-sensitive OR of literal substrings, null text -> False."""
    parts = [c.contains(F.lit(n)) for n in needles]
    return truthy(reduce(lambda a, b: a | b, parts)) if parts else F.lit(False)


def _replace_chain(c: Column, steps: list[tuple[str, str]]) -> Column:
    for old, new in steps:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def normalize_category(c: Column) -> Column:
    """Lower, then in order: drop '-', drop double spaces, space -> '_',
    drop "'s", '/' -> '_', drop '(' and ')'."""
    return _replace_chain(F.lower(c), [("-", ""), ("  ", ""), (" ", "_"), ("'s", ""),
                                       ("/", "_"), ("(", ""), (")", "")])


def normalize_ethnicity(c: Column) -> Column:
    """Lower, '/' -> '_', space -> '_', drop '-', '__' -> '_' (single pass)."""
    return _replace_chain(F.lower(c), [("/", "_"), (" ", "_"), ("-", ""), ("__", "_")])


def normalize_ethnicity_v1(c: Column) -> Column:
    """Older form: lower, '/' and space -> '_' only."""
    return _replace_chain(F.lower(c), [("/", "_"), (" ", "_")])


def strip_brackets(c: Column) -> Column:
    return F.translate(c, "[]", "")
