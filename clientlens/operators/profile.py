"""Whole-table profiles: counts, summary statistics, null counts, correlation,
spread, IQR fences and clipping, per-partition row counts.

Where the reference runs one job per column or per metric, these fuse the
work into a single aggregate over one scan and reshape the one-row result
afterwards (unpivot / explode), so the cost is one pass whatever the number of
columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions.columns import fixed_point_mean, winsorized
from clientlens.operators.groups import Cols, _keys, _rounded, mean
from clientlens.operators.quantiles import exact_quantiles


def total_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; give ``order`` for a deterministic choice."""
    return (df.orderBy(*order) if order else df).limit(n)


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int | None = None,
                     scale: dict[str, int] | None = None) -> DataFrame:
    """count, mean, sample stddev, min and max of each column, one row per
    column, as DOUBLE (``describe()`` returns strings; this stays typed).
    ``digits`` rounds mean and stddev; ``scale`` gives columns with a fixed
    number of decimals an exact mean (see ``fixed_point_mean``)."""
    scale = scale or {}

    def mean_of(c: str) -> Column:
        if c in scale and digits is not None:
            return fixed_point_mean(c, scale[c], digits)
        return F.avg(c)

    stats = {"count": F.count, "mean": mean_of, "stddev": F.stddev_samp,
             "min": F.min, "max": F.max}
    wide = df.agg(*[fn(c).alias(f"{c}__{s}") for c in cols for s, fn in stats.items()])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"{c}__count").cast("bigint").alias("count"),
                 *[(_rounded(F.col(f"{c}__{s}").cast("double"), digits)
                    if s in ("mean", "stddev") else F.col(f"{c}__{s}").cast("double")).alias(s)
                   for s in list(stats)[1:]])
        for c in cols])
    return wide.select(F.inline(rows))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None,
                only_positive: bool = True) -> DataFrame:
    """NULL count of every column in one scan, long form (column_name,
    null_count); by default only columns that have NULLs, like the report."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "null_count")
    return long.where(F.col("null_count") > 0) if only_positive else long


def corr(df: DataFrame, a: str, b: str, name: str | None = None,
         digits: int | None = None) -> DataFrame:
    """Pearson correlation (a single-pass co-moment aggregate)."""
    return df.agg(_rounded(F.corr(a, b), digits).alias(name or f"corr_{a}_{b}"))


def spread_by_group(df: DataFrame, keys: Cols, value: str, sample: bool = False,
                    digits: int | None = 2, names: dict | None = None,
                    scale: int | None = None) -> DataFrame:
    """Mean, standard deviation, min, max of ``value`` per group.

    The HiveQL ``STDDEV`` is the *population* deviation, Spark's ``stddev``
    the sample one; ``sample`` picks which (population by default)."""
    names = {"avg": f"avg_{value}", "stddev": f"stddev_{value}",
             "min": f"min_{value}", "max": f"max_{value}", **(names or {})}
    sd = F.stddev_samp(value) if sample else F.stddev_pop(value)
    ks = _keys(keys)
    return (df.groupBy(*ks)
            .agg(mean(value, digits, scale).alias(names["avg"]),
                 _rounded(sd, digits).alias(names["stddev"]),
                 F.min(value).alias(names["min"]), F.max(value).alias(names["max"]))
            .orderBy(F.desc_nulls_last(names["avg"]), *ks))


def accuracy_for(rel_error: float) -> int:
    """``percentile_approx`` accuracy for a relative rank error (0.01 -> 100)."""
    return max(1, int(round(1.0 / rel_error)))


def fence_struct(df: DataFrame, col: str, k: float, rel_error: float) -> Column:
    """One-row aggregate: struct(q1, q3, lower, upper) of ``col``."""
    q = F.percentile_approx(F.col(col).cast("double"), [0.25, 0.75], accuracy_for(rel_error))
    q1, q3 = q[0], q[1]
    return F.struct(q1.alias("q1"), q3.alias("q3"),
                    (q1 - F.lit(k) * (q3 - q1)).alias("lower"),
                    (q3 + F.lit(k) * (q3 - q1)).alias("upper"))


def approx_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                  rel_error: float = 0.01) -> dict[str, tuple[float | None, float | None]]:
    """IQR fences of each column from one ``approxQuantile`` job (its
    per-partition sketches are merged by a tree aggregate, so no single task
    receives one sketch per map task); two numbers come back per column."""
    if not cols:
        return {}
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    quartiles = data.approxQuantile(list(cols), [0.25, 0.75], rel_error)
    out = {}
    for c, q in zip(cols, quartiles):
        f = _fences(q[0], q[1], k) if len(q) == 2 else _fences(None, None, k)
        out[c] = (f["lower"], f["upper"])
    return out


def iqr_fences(df: DataFrame, col: str, k: float = 1.5, rel_error: float = 0.01,
               exact: bool = False, in_plan: bool = False) -> DataFrame:
    """One row: q1, q3, lower = q1 - k*IQR, upper = q3 + k*IQR. The quartiles
    come from a sketch with relative rank error ``rel_error`` (like
    ``approxQuantile``; ``in_plan`` keeps it a lazy one-row aggregate), or
    are exact with ``exact=True``."""
    if in_plan and not exact:
        return df.agg(fence_struct(df, col, k, rel_error).alias("f")).select("f.*")
    if exact:
        q1, q3 = exact_quantiles(df, col, [0.25, 0.75])
    else:
        data = df.select(F.col(col).cast("double").alias(col))
        q = data.approxQuantile(col, [0.25, 0.75], rel_error)
        q1, q3 = (q[0], q[1]) if len(q) == 2 else (None, None)
    return df.sparkSession.range(1).select(*[
        F.lit(x).cast("double").alias(n) for n, x in _fences(q1, q3, k).items()])


def _fences(q1: float | None, q3: float | None, k: float) -> dict[str, float | None]:
    if q1 is None or q3 is None:
        return {"q1": None, "q3": None, "lower": None, "upper": None}
    return {"q1": q1, "q3": q3, "lower": q1 - k * (q3 - q1), "upper": q3 + k * (q3 - q1)}


def winsorize_iqr(df: DataFrame, col: str, out_col: str | None = None, k: float = 1.5,
                  rel_error: float = 0.01, fit_on: DataFrame | None = None,
                  exact: bool = False, in_plan: bool = False) -> DataFrame:
    """Clip ``col`` to its IQR fences (result DOUBLE, NULL stays NULL).

    The fences come from ``fit_on`` (default: ``df`` itself); pass the training
    part to keep test rows out of the fit. By default they are fitted with
    one tree-aggregated ``approxQuantile`` job (rank error ``rel_error``) and
    applied as two constants. ``exact=True`` computes exact quartiles
    (``exact_quantiles``: a few passes, scale-safe). ``in_plan=True`` keeps
    everything lazy instead: the fences are one scalar subquery bound to a
    struct column, so the sketch runs once, but every task's sketch is then
    merged in a single final task.
    """
    src = fit_on if fit_on is not None else df
    target = out_col or col
    if in_plan and not exact:
        fences = src.select(fence_struct(src, col, k, rel_error)).scalar()
        tmp = "__iqr_fences"
        return (df.withColumn(tmp, fences)
                .withColumn(target, winsorized(col, F.col(f"{tmp}.lower"), F.col(f"{tmp}.upper")))
                .drop(tmp))
    if exact:
        f = _fences(*exact_quantiles(src, col, [0.25, 0.75]), k)
        lo, hi = f["lower"], f["upper"]
    else:
        lo, hi = approx_fences(src, [col], k, rel_error)[col]
    return df.withColumn(target, winsorized(col, F.lit(lo).cast("double"), F.lit(hi).cast("double")))


def partition_stats(df: DataFrame, num_partitions: int, *keys: str,
                    count_name: str = "row_count") -> DataFrame:
    """Rows per partition of a repartition into ``num_partitions`` by a hash
    of ``keys`` (round-robin when none), empty partitions included.

    The rows are really repartitioned and counted by the partition they are
    in; only the key columns travel. Without keys no column does. A
    bare group-by loses empty partitions, so the counts are left-joined from
    ``range(num_partitions)``; both sides have at most that many rows.
    """
    slim = df.select(*keys)
    parts = slim.repartition(num_partitions, *keys) if keys else slim.repartition(num_partitions)
    return _rows_by_partition(parts, num_partitions, count_name)


def partition_rows(df: DataFrame, num_partitions: int, at: Column, count_name: str = "row_count") -> DataFrame:
    """Rows per partition when ``at`` names each row's partition (modulo their
    number; NULL: partition 0), empty partitions included."""
    parts = df.select(F.coalesce(at.cast("int"), F.lit(0)).alias("__at")).repartitionById(num_partitions, "__at")
    return _rows_by_partition(parts, num_partitions, count_name)


def _rows_by_partition(parts: DataFrame, num_partitions: int, count_name: str) -> DataFrame:
    counts = parts.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias(count_name))
    ids = parts.sparkSession.range(num_partitions).select(F.col("id").cast("int").alias("partition_id"))
    return (ids.join(counts, "partition_id", "left")
            .select("partition_id", F.coalesce(count_name, F.lit(0)).alias(count_name))
            .orderBy("partition_id"))


def partition_keys(df: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """Per key of a hash repartition: in how many partitions its rows lie (1,
    if the repartition holds its promise)."""
    parts = df.select(*keys).repartition(num_partitions, *keys)
    seen = parts.withColumn("__at", F.spark_partition_id()).groupBy(*keys, "__at").agg(F.count(F.lit(1)).alias("__n"))
    return seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("__n").alias("row_count"))
