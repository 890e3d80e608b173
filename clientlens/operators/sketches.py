"""Stored, mergeable quantile sketches (KLL).

A sketch per group and salt is a binary column: it can be written as a table,
joined by later days' sketches, and merged to any coarser grouping without
another look at the rows. The salt is the map task's number, so the sketches of
a group that holds a third of all rows meet in SALTS reducers first; only their
SALTS results meet in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
#: KLL's size parameter: the rank error is about 1.65 / K with 99 % confidence.
K = 400


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = K, salts: int = SALTS) -> DataFrame:
    """(keys, salt, sketch): sketches of the non-NULL values. A group without
    one has no row; NULL keys are a group; no rows: no rows."""
    salted = df.where(F.col(value).isNotNull()).select(
        *keys, F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), F.col(value).cast("double").alias("__value"))
    return salted.groupBy(*keys, "salt").agg(F.kll_sketch_agg_double("__value", k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, sketch): sketches of any salts, tables or finer groups as one per group."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(merged: DataFrame, probs: Sequence[float], names: Sequence[str], count_name: str = "row_count") -> DataFrame:
    """The sketches' columns but the sketch, the number of values and the
    values at the ranks ``probs`` (0 and 1: the exact least and greatest)."""
    own = [c for c in merged.columns if c != "sketch"]
    return merged.select(*own, F.kll_sketch_get_n_double("sketch").alias(count_name),
                         *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for p, n in zip(probs, names, strict=True)])
