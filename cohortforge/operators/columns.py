"""Column-set operators: name-pattern selection, strict drops, renames and
row-wise combinations over the columns that exist."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_columns(df: DataFrame, cols: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop listed columns. ``strict`` fails when one is absent (Spark's own
    ``drop`` ignores unknown names)."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[c for c in cols if c in df.columns])


def columns_like(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Names containing any of ``include`` (all when empty) and none of
    ``exclude`` (e.g. features by 'ft_', floats by 'age' / 'avg' / 'los')."""
    out = []
    for c in df.columns:
        if include and not any(s in c for s in include):
            continue
        if any(s in c for s in exclude):
            continue
        out.append(c)
    return out


def select_like(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (),
                keep: Sequence[str] = ()) -> DataFrame:
    cols = columns_like(df, include, exclude)
    return df.select(*[c for c in keep if c not in cols], *cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def greatest_existing(df: DataFrame, cols: Sequence[str]) -> Column:
    """Row-wise max over those of ``cols`` that exist (nulls skipped): the
    column itself for one, null for none."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return F.lit(None)
    if len(present) == 1:
        return F.col(present[0])
    return F.greatest(*[F.col(c) for c in present])


def fold_columns(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Replace the existing ones of ``cols`` by their row-wise max ``name``."""
    out = df.withColumn(name, greatest_existing(df, cols))
    return out.drop(*[c for c in cols if c in df.columns and c != name])
