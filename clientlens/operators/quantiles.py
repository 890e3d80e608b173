"""Exact quantiles at any scale by iterative binning.

A fine quantile sketch is not a scale-safe way to get an exact answer: when
the rank error drops below one row per partition, every partial buffer keeps
almost every value. Instead each wanted quantile keeps a range of values known
to hold its answer and its rank within that range. A pass reads only the
values inside open ranges (a filter that Parquet statistics can use), counts
them per equi-width bin with a partial aggregate that also keeps each bin's
least and greatest value, and narrows every range to the bin that holds its
rank. Bins are monotone in the value, so the new range is exactly that bin's
least to greatest; both ends are real values, so every pass splits a range
into two non-empty bins at least, and the passes end when both ends are equal.
With ``BINS`` bins a column of 10^12 spread-out values takes four passes or
five, one scan each.

Values are compared in their own type; only the bin number is worked out in
DOUBLE, which keeps the order, so BIGINT and DECIMAL answers are exact. The
rank convention is the ``ceil(p * n)``-th smallest non-null value, as
``percentile_approx`` and SQL ``quantile_disc`` define it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens.session import ensure_checkpoint_dir

BINS = 1024
#: Rows of a group in one share; a larger group is dealt into as many shares as it takes.
SHARE_ROWS = 1_000_000


def _numbers(df: DataFrame, value: str) -> Column:
    """The column as it is if numeric (FLOAT as DOUBLE), else as DOUBLE."""
    kind = df.schema[value].dataType
    keep = isinstance(kind, (T.IntegralType, T.DecimalType, T.DoubleType))
    return F.col(value) if keep else F.col(value).cast("double")


def _usable(v: Column, kind: T.DataType) -> Column:
    return v.isNotNull() & ~F.isnan(v) if isinstance(kind, T.DoubleType) else v.isNotNull()


def _bin(v: Column, lo: Column, hi: Column, kind: T.DataType) -> Column:
    """Number of the equi-width bin of [lo, hi]. Differences are exact for
    integers and decimals; doubles are halved first, so theirs cannot
    overflow."""
    if isinstance(kind, T.DoubleType):
        x, a, b = (c / 2 for c in (v, lo, hi))
    else:
        exact = kind.simpleString() if isinstance(kind, T.DecimalType) else "decimal(20,0)"
        x, a, b = (c.cast(exact) for c in (v, lo, hi))
    at = F.floor(F.try_divide((x - a).cast("double"), (b - a).cast("double")) * F.lit(float(BINS)))
    return F.greatest(F.lit(0), F.least(F.coalesce(at, F.lit(0)), F.lit(BINS - 1))).cast("int")


def _split_ends(b: Column, v: Column, lo: Column, hi: Column) -> Column:
    """The range's two ends get bins of their own, so that a pass always
    splits a range, even if DOUBLE cannot tell its ends apart."""
    return F.when(v == lo, F.lit(-1)).when(v == hi, F.lit(BINS)).otherwise(b)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list:
    """Exact ``probs`` quantiles of ``col`` (NULL and NaN ignored); ``None``
    for an empty column. Two numbers a quantile and ``BINS`` rows an open
    range reach the driver per pass."""
    kind = df.select(_numbers(df, col).alias("v")).schema["v"].dataType
    v = F.col("__v")
    vals = df.select(_numbers(df, col).alias("__v")).where(_usable(v, kind))
    n, lo, hi = vals.agg(F.count(v), F.min(v), F.max(v)).first()
    if not n:
        return [None] * len(probs)
    ranges = [(lo, hi, max(1, min(n, math.ceil(p * n)))) for p in probs]  # rank within the range
    while True:
        open_ = sorted({(a, b) for a, b, _ in ranges if a != b})
        if not open_:
            return [a for a, _, _ in ranges]

        def inside(a, b) -> Column:
            return (v >= F.lit(a).cast(kind)) & (v <= F.lit(b).cast(kind))

        any_open = F.lit(False)
        for a, b in open_:
            any_open = any_open | inside(a, b)
        in_bins = F.array(*[F.when(inside(a, b), F.struct(
            F.lit(i).alias("i"), _split_ends(_bin(v, F.lit(a).cast(kind), F.lit(b).cast(kind), kind), v,
                                             F.lit(a).cast(kind), F.lit(b).cast(kind)).alias("bin")))
            for i, (a, b) in enumerate(open_)])
        rows = (vals.where(any_open).select(v, F.explode(F.array_compact(in_bins)).alias("at"))
                .groupBy("at.i", "at.bin").agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
                .orderBy("i", "bin").collect())
        bins = {key: [r for r in rows if r.i == i] for i, key in enumerate(open_)}
        ranges = [_narrowed(bins[a, b], rank) if a != b else (a, b, rank) for a, b, rank in ranges]


def _narrowed(bins: list, rank: int) -> tuple:
    for r in bins:
        if rank <= r.n:
            return r.lo, r.hi, rank
        rank -= r.n
    raise RuntimeError("the input changed while its quantiles were computed")


def quantile_by_group_exact(df: DataFrame, keys: Sequence[str], value: str, p: float = 0.5,
                            name: str | None = None, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Exact ``p``-quantile of ``value`` per group, one row per group that has
    a value (a NULL key is a group like any other).

    The groups' ranges are a table of one row per group, joined to the rows
    of groups that are still open. A group of over ``share_rows`` rows is dealt
    into shares of about that size by a hash of the whole row (``df``'s other
    columns included), not of the value, so a group that has one value nearly
    everywhere spreads as well; its range is copied to each share, and counts
    per (group, bin) are pre-aggregated there. Groups that large are few: one
    row for each ``share_rows`` rows of the table at most. The state is
    checkpointed each pass in the shared folder."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    name = name or f"q{int(round(p * 100))}_{value}"
    ks = list(keys)
    v = F.col("__v")
    kind = df.select(_numbers(df, value).alias("v")).schema["v"].dataType
    data = df.select(*ks, _numbers(df, value).alias("__v"), F.xxhash64(*df.columns).alias("__row")).where(_usable(v, kind))
    state = (data.groupBy(*ks).agg(F.count(F.lit(1)).alias("__n"), F.min(v).alias("__lo"), F.max(v).alias("__hi"))
             .select(*ks, "__lo", "__hi", F.greatest(F.lit(1), F.ceil(F.col("__n") * F.lit(p))).cast("long").alias("__rank"),
                     F.ceil(F.col("__n") / F.lit(share_rows)).cast("int").alias("__shares"))
             .checkpoint())
    data = _dealt(data, state, ks)
    closed = F.col("__lo") == F.col("__hi")
    done = state.where(closed)
    while True:
        active = state.where(~closed)
        if active.isEmpty():
            return done.select(*ks, F.col("__lo").alias(name))
        state = _narrow_groups(data, active, ks, kind).checkpoint()
        done = done.unionByName(state.where(closed))


def _dealt(data: DataFrame, state: DataFrame, ks: list[str]) -> DataFrame:
    """Rows with their share of the group: 0 unless the group has several."""
    large = state.where("__shares > 1").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(ks)], "__shares")
    same = F.lit(True)
    for i, k in enumerate(ks):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    share = F.coalesce(F.pmod(F.col("__row"), F.col("__shares")), F.lit(0)).cast("int")
    return data.join(large, same, "left").select(*ks, "__v", share.alias("__salt"))


def _narrow_groups(data: DataFrame, active: DataFrame, ks: list[str], kind: T.DataType) -> DataFrame:
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    ranges = active.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(ks)], "__lo", "__hi", "__rank", "__shares",
                           F.explode(F.sequence(F.lit(0), F.col("__shares") - 1)).alias("__at"))
    same = F.col("__salt") == F.col("__at")
    for i, k in enumerate(ks):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = data.join(ranges, same).where((v >= lo) & (v <= hi))
    counts = (joined.groupBy(*ks, _split_ends(_bin(v, lo, hi, kind), v, lo, hi).alias("__bin"), "__rank", "__shares")
              .agg(F.count(F.lit(1)).alias("__c"), F.min(v).alias("__blo"), F.max(v).alias("__bhi")))
    upto = Window.partitionBy(*ks).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("__cum", F.sum("__c").over(upto)).where(F.col("__cum") >= F.col("__rank"))
    first = cum.groupBy(*ks).agg(F.min_by(F.struct("__rank", "__c", "__cum", "__blo", "__bhi", "__shares"), F.col("__bin")).alias("__h"))
    return first.select(*ks, F.col("__h.__blo").alias("__lo"), F.col("__h.__bhi").alias("__hi"),
                        (F.col("__h.__rank") - (F.col("__h.__cum") - F.col("__h.__c"))).alias("__rank"),
                        F.col("__h.__shares").alias("__shares"))
