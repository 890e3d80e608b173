"""Grouped analyses: counts, means, medians, rates, top-k, bands, cross-tabs.

Each function takes a DataFrame plus column names and returns a lazy
DataFrame. All aggregations are algebraic (count/sum/avg/min/max/count_if)
or sketch-based (``percentile_approx``), so Catalyst plans them as a partial
aggregate before the shuffle and a final one after it: a hot key that holds a
third of the rows is collapsed to one partial row per task before anything
moves, which is why none of these needs salting. Orderings append the group
key as a tie-break so top-k results are deterministic; a top-k is
``orderBy().limit()``, planned as ``TakeOrderedAndProject`` (per-partition
top-k, then a k-row merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientlens.functions.columns import exact_sum, fixed_point_mean, month_ordinal, percent, quarter_of, rounded_ratio
from clientlens.schema import MONTHS

Cols = str | Sequence[str]


def _keys(keys: Cols) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def mean(value: str, digits: int | None = 2, scale: int | None = None) -> Column:
    """Mean of ``value`` rounded to ``digits``. Give ``scale`` (the fixed
    number of decimals the values carry, e.g. 2 for money) to sum exactly in
    integer units: the result is then identical in every engine and layout."""
    if scale is not None and digits is not None:
        return fixed_point_mean(value, scale, digits)
    return _rounded(F.avg(value), digits)


def count_by(df: DataFrame, keys: Cols, name: str = "count",
             order_by_count: bool = False) -> DataFrame:
    """Row count per group (MR-2 two-key count, counts by derived category)."""
    ks = _keys(keys)
    out = df.groupBy(*ks).agg(F.count(F.lit(1)).alias(name))
    if order_by_count:
        return out.orderBy(F.desc(name), *ks)
    return out.orderBy(*ks)


def avg_by_group(df: DataFrame, keys: Cols, value: str, name: str | None = None,
                 count_name: str | None = "count", digits: int | None = 2,
                 descending: bool = True, skip_null: bool = True,
                 scale: int | None = None) -> DataFrame:
    """Mean of ``value`` per group (+ row count), sorted by the mean.

    ``skip_null`` drops rows whose value is NULL before grouping, so the count
    covers only rows that contributed to the mean and a group whose values are
    all NULL is absent (the map/reduce jobs skip unparsable rows this way).
    """
    ks = _keys(keys)
    name = name or f"avg_{value}"
    src = df.where(F.col(value).isNotNull()) if skip_null else df
    aggs = [mean(value, digits, scale).alias(name)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    order = F.desc_nulls_last(name) if descending else F.asc_nulls_last(name)
    return src.groupBy(*ks).agg(*aggs).orderBy(order, *ks)


def avg_median_by_group(df: DataFrame, keys: Cols, avg_col: str, median_col: str,
                        avg_name: str | None = None, median_name: str | None = None,
                        count_name: str | None = None, digits: int | None = 2,
                        accuracy: int = 10000, scale: int | None = None,
                        median: str = "sketch") -> DataFrame:
    """Mean of one column and median of another per group.

    ``median="sketch"`` (default) is ``percentile_approx``: a mergeable
    quantile sketch with relative rank error ``1/accuracy``, aggregated
    partially like the mean. ``median="histogram"`` is exact for a median
    column with few distinct values and stays cheap for hot groups: one scan
    counts rows per (group, value) and carries the partial sums of the mean
    along, so the median is read off the cumulative counts and the mean off
    the summed parts; with many distinct values per group use another mode.
    ``median="exact"`` is exact for any column (``quantile_by_group_exact``: a
    few passes of per-group binning). ``median="kll"`` is a sketch as well,
    salted by map task and merged in a second stage, for groups whose
    per-task sketches are too many for one reducer. NULL keys are a group in
    every mode.
    """
    ks = _keys(keys)
    avg_name = avg_name or f"avg_{avg_col}"
    median_name = median_name or f"median_{median_col}"
    if median == "histogram":
        out = _avg_median_histogram(df, ks, avg_col, median_col, avg_name, median_name,
                                    count_name, digits, scale)
    elif median in ("exact", "kll"):
        from clientlens.operators.quantiles import quantile_by_group_exact
        from clientlens.operators.sketches import merge_sketches, quantile_sketches, sketch_quantiles
        aggs = [mean(avg_col, digits, scale).alias(avg_name)]
        if count_name:
            aggs.append(F.count(F.lit(1)).alias(count_name))
        if median == "exact":
            med = quantile_by_group_exact(df, ks, median_col, 0.5, median_name)
        else:
            med = sketch_quantiles(merge_sketches(quantile_sketches(df, ks, median_col), ks), [0.5], [median_name])
        med = med.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(ks)], median_name)
        agg = df.groupBy(*ks).agg(*aggs)
        same = F.lit(True)
        for i, k in enumerate(ks):
            same = same & agg[k].eqNullSafe(med[f"__k{i}"])
        out = agg.join(med, same, "left").drop(*[f"__k{i}" for i in range(len(ks))])
    elif median == "sketch":
        aggs = [mean(avg_col, digits, scale).alias(avg_name),
                F.percentile_approx(median_col, 0.5, accuracy).alias(median_name)]
        if count_name:
            aggs.append(F.count(F.lit(1)).alias(count_name))
        out = df.groupBy(*ks).agg(*aggs)
    else:
        raise ValueError("median must be 'sketch', 'histogram', 'exact' or 'kll'")
    return out.orderBy(F.desc_nulls_last(avg_name), *ks)


def _avg_median_histogram(df, ks, avg_col, median_col, avg_name, median_name, count_name,
                          digits, scale) -> DataFrame:
    v = F.col(median_col)
    if scale is not None and digits is not None:
        part = F.round(F.col(avg_col) * F.lit(float(10 ** scale))).cast("bigint")
        summed = exact_sum(part)
    else:
        part = F.col(avg_col).cast("double")
        summed = F.sum(part)
    hist = df.groupBy(*ks, median_col).agg(
        F.count(F.lit(1)).alias("__rows"), summed.alias("__sum"),
        F.count(part).alias("__n"))
    upto = Window.partitionBy(*ks).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*ks)
    counted = F.when(v.isNotNull(), F.col("__rows")).otherwise(0)
    ranked = hist.withColumns({"__cum": F.sum(counted).over(upto),
                               "__nv": F.sum(counted).over(whole)})
    target = F.greatest(F.lit(1), F.ceil(F.col("__nv") * F.lit(0.5)))
    total, n = F.sum("__sum"), F.sum("__n")
    if scale is not None and digits is not None:
        avg = rounded_ratio(total, n, scale, digits)
    else:
        avg = _rounded(F.try_divide(total, n.cast("double")), digits)
    aggs = [avg.alias(avg_name),
            F.min(F.when(v.isNotNull() & (F.col("__cum") >= target), v)).alias(median_name)]
    if count_name:
        aggs.append(F.sum("__rows").alias(count_name))
    return ranked.groupBy(*ks).agg(*aggs)


def filtered_count_by_group(df: DataFrame, cond: Column, keys: Cols,
                            name: str = "count") -> DataFrame:
    """Count of rows matching ``cond`` per group; groups without a match are
    absent (filter first, then group)."""
    ks = _keys(keys)
    return (df.where(cond).groupBy(*ks).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), *ks))


def rate_agg(hit: Column, total_name: str, hits_name: str | None,
             rate_name: str, digits: int | None) -> list[Column]:
    total = F.count(F.lit(1))
    hits = F.count_if(hit)
    cols = [total.alias(total_name)]
    if hits_name:
        cols.append(hits.alias(hits_name))
    cols.append(percent(hits, total, digits).alias(rate_name))
    return cols


def rate_by_group(df: DataFrame, keys: Cols, hit: Column, total_name: str = "total",
                  hits_name: str | None = "hits", rate_name: str = "rate_pct",
                  digits: int | None = 2) -> DataFrame:
    """Total rows, rows matching ``hit`` and their percentage per group; a
    group with no hit has rate 0.0 (it is still present)."""
    ks = _keys(keys)
    return (df.groupBy(*ks).agg(*rate_agg(hit, total_name, hits_name, rate_name, digits))
            .orderBy(F.desc_nulls_last(rate_name), *ks))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows under ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def topk_rate(df: DataFrame, keys: Cols, hit: Column, k: int = 3, total_name: str = "total",
              hits_name: str | None = "hits", rate_name: str = "rate_pct",
              digits: int | None = 2) -> DataFrame:
    """Top-k groups by hit rate (ties by key)."""
    ks = _keys(keys)
    rated = df.groupBy(*ks).agg(*rate_agg(hit, total_name, hits_name, rate_name, digits))
    return top_k(rated, k, F.desc_nulls_last(rate_name), *ks)


def topk_avg_with_rate(df: DataFrame, keys: Cols, value: str, hit: Column, k: int = 5,
                       avg_name: str | None = None, rate_name: str = "rate_pct",
                       digits: int | None = 2, scale: int | None = None) -> DataFrame:
    """Top-k groups by mean ``value``, each with its hit rate."""
    ks = _keys(keys)
    avg_name = avg_name or f"avg_{value}"
    total = F.count(F.lit(1))
    out = df.groupBy(*ks).agg(
        mean(value, digits, scale).alias(avg_name),
        percent(F.count_if(hit), total, digits).alias(rate_name))
    return top_k(out, k, F.desc_nulls_last(avg_name), *ks)


def busiest(df: DataFrame, key: str, hit: Column, total_name: str = "total_contacts",
            rate_name: str = "success_rate_pct", digits: int | None = 2,
            k: int = 1) -> DataFrame:
    """Group(s) with the most rows, with their hit rate (arg-max; ties by key)."""
    out = df.groupBy(key).agg(*rate_agg(hit, total_name, None, rate_name, digits))
    return top_k(out, k, F.desc(total_name), F.asc(key))


def months_dim(df: DataFrame, month_name: str = "month") -> DataFrame:
    """The 12-row calendar dimension (month, month_num) built in the plan."""
    n = F.col("id").cast("int")
    return df.sparkSession.range(1, len(MONTHS) + 1).select(
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), n).alias(month_name),
        n.alias("month_num"))


def monthly_trend(df: DataFrame, month: str, name: str = "contact_volume",
                  align: bool = True) -> DataFrame:
    """Contacts per month in calendar order.

    ``align=True`` reindexes onto the full 12-month list: an absent month is
    a row with NULL count and names outside the list are dropped. The
    12-row dimension is the preserved side of a left join, so it cannot be
    the build side; the counts side is already aggregated (one row per
    distinct month), and AQE broadcasts it after measuring its size.
    ``align=False`` is the plain SQL form: every month seen, unknown names
    ordered last.
    """
    counts = df.groupBy(F.col(month).alias("month")).agg(F.count(F.lit(1)).alias(name))
    if not align:
        return (counts.withColumn("month_num", month_ordinal("month"))
                .orderBy("month_num", "month"))
    dim = months_dim(df, "month")
    return (dim.join(counts, "month", "left")
            .select("month", "month_num", name).orderBy("month_num"))


def month_quarter(df: DataFrame, month: str) -> DataFrame:
    """Distinct (month, quarter) pairs; unmapped month -> NULL quarter."""
    return (df.select(F.col(month).alias("month"), quarter_of(month).alias("quarter"))
            .distinct().orderBy("month"))


def avg_by_quarter(df: DataFrame, month: str, value: str, name: str | None = None,
                   digits: int | None = 2, scale: int | None = None) -> DataFrame:
    """Mean ``value`` per calendar quarter derived from a month name."""
    name = name or f"avg_{value}"
    return (df.groupBy(quarter_of(month).alias("quarter"))
            .agg(mean(value, digits, scale).alias(name))
            .orderBy(F.asc_nulls_first("quarter")))


def month_status_crosstab(df: DataFrame, month: str, status: str, yes: str = "yes",
                          no: str = "no", yes_name: str = "yes_count",
                          no_name: str = "no_count", total_name: str = "total") -> DataFrame:
    """Month x status counts: yes, no, total = yes + no; other statuses count
    in neither but their month still appears (with zeros). One pass, two
    conditional counts (what a two-value pivot compiles to)."""
    return (df.groupBy(F.col(month).alias("month"))
            .agg(F.count_if(F.col(status) == yes).alias(yes_name),
                 F.count_if(F.col(status) == no).alias(no_name))
            .withColumn(total_name, F.col(yes_name) + F.col(no_name))
            .orderBy(month_ordinal("month"), "month"))


def pivot_counts(df: DataFrame, index: str, column: str,
                 values: Sequence | None = None) -> DataFrame:
    """Counts of ``index`` x ``column`` as a wide table, missing cells 0.

    With ``values`` this is one aggregation of conditional counts (one
    shuffle, stable schema); ``groupBy().pivot()`` would plan two
    aggregations. Without them Spark's pivot first runs a distinct job to
    find the values (bounded by ``spark.sql.pivotMaxValues``).
    """
    if values is None:
        out = df.groupBy(index).pivot(column).count()
        value_cols = [c for c in out.columns if c != index]
        return out.fillna(0, subset=value_cols).orderBy(index)
    return (df.groupBy(index)
            .agg(*[F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values])
            .orderBy(index))


def band_stats(df: DataFrame, band: Column, value: str, band_name: str = "band",
               avg_name: str | None = None, count_name: str = "count",
               min_name: str | None = None, max_name: str | None = None,
               digits: int | None = 2, scale: int | None = None) -> DataFrame:
    """Mean, count, min and max of ``value`` per derived band, sorted by band
    label as text (``"100s"`` sorts before ``"20s"``). Rows whose band or
    value is NULL (unparsable input) are skipped."""
    avg_name = avg_name or f"avg_{value}"
    min_name = min_name or f"min_{value}"
    max_name = max_name or f"max_{value}"
    return (df.select(band.alias(band_name), F.col(value))
            .where(F.col(band_name).isNotNull() & F.col(value).isNotNull())
            .groupBy(band_name)
            .agg(mean(value, digits, scale).alias(avg_name),
                 F.count(F.lit(1)).alias(count_name),
                 F.min(value).alias(min_name), F.max(value).alias(max_name))
            .orderBy(band_name))


def topk_band_avg(df: DataFrame, band: Column, value: str, cond: Column | None = None,
                  k: int = 5, band_name: str = "band", avg_name: str | None = None,
                  count_name: str = "count", digits: int | None = 2,
                  scale: int | None = None) -> DataFrame:
    """Top-k bands by mean ``value`` among rows matching ``cond``."""
    avg_name = avg_name or f"avg_{value}"
    src = df.where(cond) if cond is not None else df
    out = (src.groupBy(band.alias(band_name))
           .agg(mean(value, digits, scale).alias(avg_name),
                F.count(F.lit(1)).alias(count_name)))
    return top_k(out, k, F.desc_nulls_last(avg_name), F.asc(band_name))


def above_avg_by_group(df: DataFrame, value: str, keys: Cols, flag: Column | None = None,
                       name: str = "count") -> DataFrame:
    """Rows above the global mean of ``value`` (strict ``>``) that also match
    ``flag``, counted per group.

    The mean is a scalar subquery evaluated inside the same plan: no driver
    round trip and no cross join; Spark runs the one-row aggregate once and
    feeds its value into the filter of the main scan.
    """
    mean = df.select(F.avg(value)).scalar()
    cond = F.col(value) > mean
    if flag is not None:
        cond = cond & flag
    return filtered_count_by_group(df, cond, keys, name)


def global_metrics(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Several global aggregates in one scan (one job instead of one thread
    and one pass per metric)."""
    return df.agg(*[c.alias(n) for n, c in metrics.items()])


def hit_rate(hit: Column, digits: int | None = 2) -> Column:
    return percent(F.count_if(hit), F.count(F.lit(1)), digits)


__all__ = [
    "count_by", "avg_by_group", "avg_median_by_group", "filtered_count_by_group",
    "rate_by_group", "top_k", "topk_rate", "topk_avg_with_rate", "busiest",
    "monthly_trend", "month_quarter", "avg_by_quarter", "month_status_crosstab",
    "pivot_counts", "band_stats", "topk_band_avg", "above_avg_by_group",
    "global_metrics", "mean", "hit_rate", "months_dim",
]
