"""Model-dataset operators: subgroup exclusion, class balancing, hash split,
imputation, zero-column removal, standardisation.

Fitted constants (means, modes, standard deviations) come from two passes
(``operators/preprocess.py``) and are applied as literals, so the transform side
is a narrow projection. Random choices are hash based, hence reproducible and
recomputable after an executor loss.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import hash_bucket
from cohortforge.operators.preprocess import MEAN_HINTS, fit_constants  # noqa: F401


def exclude_subgroup(df: DataFrame, col: str = "ft_admit_type_newborn", keep_value=0) -> DataFrame:
    """Keep rows whose column equals the value; a null is dropped too. A
    missing column leaves the frame unchanged (with a warning)."""
    if col not in df.columns:
        warnings.warn(f"exclude_subgroup: no column {col}, nothing excluded")
        return df
    return df.where(F.col(col) == F.lit(keep_value))


def _hash_order(key: str, seed: str):
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def cut_hash(df: DataFrame, n: int, hash_col: str = "__h", prefix_digits: int = 4, small: int = 4096) -> tuple[str, int, int] | None:
    """Radix selection of the n-th smallest hash text: (prefix, rows below it, rows
    with it), None when there are at most ``n`` rows.

    A round counts the rows by the next ``prefix_digits`` digits inside the prefix
    found so far (at most 16^digits counts reach the driver) and lengthens it to the
    bucket that holds the n-th row, until at most ``small`` rows share the prefix or
    the hash is used up: 32 digits at the most, so 32 / digits rounds."""
    prefix, below = "", 0
    while True:
        inside = df if not prefix else df.where(F.col(hash_col).startswith(prefix))
        bucket = F.substring(hash_col, 1, len(prefix) + prefix_digits)
        for r in inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect():
            if below + r["n"] >= n:
                prefix, here = r["b"], r["n"]
                break
            below += r["n"]
        else:
            return None
        if below + here == n or here <= small or len(prefix) >= 32:
            return prefix, below, here


def hash_take(df: DataFrame, n: int, key: str = "hadm_id", seed: str = "42", prefix_digits: int = 4, small: int = 4096) -> DataFrame:
    """Exactly ``n`` rows (all when fewer), the first in md5(seed || key)
    order: a reproducible random sample without replacement.

    The cut is found by radix selection (:func:`cut_hash`): no sort, and no task
    sees more than its part of the rows. Rows are then kept or dropped by comparing
    their hash with the cut. Of the at most ``small`` rows of the last bucket the
    hash at the cut is looked up; where several rows share that hash (one key
    repeated), the wanted number of them is taken."""
    if n <= 0:
        return df.limit(0)
    h = df.withColumn("__h", _hash_order(key, seed))
    cut = cut_hash(h, n, "__h", prefix_digits, small)
    if cut is None:
        return df
    prefix, below, here = cut
    end = prefix + "g" * (32 - len(prefix))  # after every hash with the prefix
    if below + here == n:
        return h.where(F.col("__h") < F.lit(end)).drop("__h")
    of_bucket = h.where(F.col("__h").startswith(prefix))
    if len(prefix) < 32:
        hashes = sorted(r[0] for r in of_bucket.select("__h").collect())  # at most ``small``
        last = hashes[n - below - 1]
        first_of_last = below + hashes.index(last)
        tied = hashes.count(last)
    else:
        last, first_of_last, tied = prefix, below, here
    if first_of_last + tied == n:
        return h.where(F.col("__h") <= F.lit(last)).drop("__h")
    chosen = h.where(F.col("__h") < F.lit(last)).unionByName(h.where(F.col("__h") == F.lit(last)).limit(n - first_of_last))
    return chosen.drop("__h")


def undersample(df: DataFrame, label: str = "hcc_cd_135", key: str = "hadm_id", seed: str = "42",
                positive=1, negative=0, prefix_digits: int = 4) -> DataFrame:
    """Exactly as many negatives as positives, without replacement, chosen by
    the order of md5(seed || key); rows with a null label are left out.

    The n-th smallest hash is found by radix selection (:func:`hash_take`), without
    a sort; every negative is kept or dropped by its hash."""
    pos = df.where(F.col(label) == F.lit(positive))
    n_pos = pos.count()
    if n_pos == 0:
        return pos
    neg = df.where(F.col(label) == F.lit(negative))
    return pos.unionByName(hash_take(neg, n_pos, key, seed, prefix_digits))


def split_buckets(df: DataFrame, key: str = "hadm_id", seed: str = "42", modulo: int = 10,
                  train: Sequence[int] = range(0, 7), valid: Sequence[int] = (7, 8),
                  test: Sequence[int] = (9,), bucket_col: str = "bin_id", keep_bucket: bool = False) -> DataFrame:
    """Adds ``split`` (train / valid / test) from a stable hash bucket."""
    b = hash_bucket(F.col(key), modulo, str(seed))
    out = df.withColumn(bucket_col, b).withColumn(
        "split", F.when(F.col(bucket_col).isin(list(train)), "train")
                  .when(F.col(bucket_col).isin(list(valid)), "valid")
                  .when(F.col(bucket_col).isin(list(test)), "test"))
    return out if keep_bucket else out.drop(bucket_col)


def split_frames(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = split_buckets(df, **kw)
    return tuple(s.where(F.col("split") == n).drop("split") for n in ("train", "valid", "test"))


@dataclass
class Preprocessor:
    """Fitted constants of the preprocessing chain."""
    means: dict
    modes: dict
    zero_cols: list
    centers: dict
    scales: dict
    key: str
    label: str

    def transform(self, df: DataFrame, zero_std: float | None = None) -> tuple[DataFrame, DataFrame]:
        unscaled = df.fillna({k: v for k, v in self.means.items() if v is not None})
        unscaled = unscaled.fillna({k: v for k, v in self.modes.items() if v is not None})
        unscaled = unscaled.drop(*[c for c in self.zero_cols if c in unscaled.columns])
        feats = [c for c in unscaled.columns if c in self.centers]
        scaled_cols = []
        for c in feats:
            m, s = self.centers[c], self.scales[c]
            v = (F.col(c).cast("double") - F.lit(m)) / F.lit(s) if (s not in (None, 0) and m is not None) else \
                F.lit(zero_std).cast("double")
            scaled_cols.append(v.alias(c))
        scaled = unscaled.select(self.key, self.label, *scaled_cols)
        return scaled, unscaled


def feature_columns(df: DataFrame, marker: str = "ft_") -> list[str]:
    return [c for c in df.columns if marker in c]


def fit_preprocess(df: DataFrame, key: str = "hadm_id", label: str = "hcc_cd_135",
                   mean_cols: Sequence[str] | None = None, marker: str = "ft_") -> Preprocessor:
    """Mean for the float columns picked by name (age / avg / los) or given,
    mode (smallest on ties) for every other column still holding nulls,
    then the all-zero columns, then mean and sample std of the features."""
    found = fit_constants(df, key, mean_cols, marker=marker)
    value = lambda c: None if c.fill is None else float(c.fill) if c.type not in ("string", "boolean") else c.fill
    flag = lambda c: float(c.fill) != 0 if c.type == "boolean" and c.fill is not None else value(c)
    feats = [c for c in found if marker in c.name and not c.all_zero]
    return Preprocessor({c.name: value(c) for c in found if c.by_mean}, {c.name: flag(c) for c in found if not c.by_mean and c.fill is not None},
                        [c.name for c in found if c.all_zero], {c.name: c.center for c in feats}, {c.name: c.scale for c in feats}, key, label)


def preprocess(df: DataFrame, fit_on: DataFrame | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """(scaled, unscaled). ``fit_on=None`` fits on the frame itself (each split
    on its own); pass the training split to reuse its constants."""
    return fit_preprocess(fit_on if fit_on is not None else df, **kw).transform(df)
