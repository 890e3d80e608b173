"""Feature preparation shared by batch training, tuning and stream scoring.

Sentinels, clipping and missing numbers are a stage of the fitted pipeline, so
a saved model prepares batch and streaming rows exactly as its training rows.
The split does not depend on partitioning, and the fitted stages (indexers,
encoder, scaler) are all distributed aggregates: label counts, one summary
pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions.columns import replace_sentinel
from clientlens.operators.quantiles import exact_quantiles
from clientlens.session import ensure_checkpoint_dir

PREPARED = "_prepared"


@dataclass(frozen=True)
class Preparation:
    """Fitted preparation of the numeric columns: per column the median that
    stands in for a missing number, and for clipped columns the IQR fences."""

    medians: dict[str, float]
    fences: dict[str, tuple[float, float]] = field(default_factory=dict)
    sentinel_cols: tuple[str, ...] = ()
    sentinel: int = -1
    replacement: int = 0

    def stage(self) -> SQLTransformer:
        """Adds ``<column>_prepared`` for each numeric column: sentinel ->
        replacement, NULL and NaN -> median, clipped to the fences."""
        parts = []
        for c, median in self.medians.items():
            x = f"CAST(`{c}` AS DOUBLE)"
            if c in self.sentinel_cols:
                x = f"IF({x} = {self.sentinel}, {float(self.replacement)!r}D, {x})"
            x = f"COALESCE(NANVL({x}, CAST(NULL AS DOUBLE)), {median!r}D)"
            if c in self.fences:
                low, high = self.fences[c]
                x = f"LEAST(GREATEST({x}, {low!r}D), {high!r}D)"
            parts.append(f"{x} AS `{c}{PREPARED}`")
        return SQLTransformer(statement=f"SELECT *{''.join(', ' + x for x in parts)} FROM __THIS__")


def fit_preparation(train: DataFrame, num_cols: Sequence[str], clip_cols: Sequence[str] = (),
                    sentinel_cols: Sequence[str] = (), k: float = 1.5, rel_error: float = 0.01,
                    sentinel: int = -1, replacement: int = 0, exact: bool = False) -> Preparation:
    """Fit the preparation on the training part: one tree-aggregated
    ``approxQuantile`` job for all columns (``exact``: exact quartiles).

    NULL and NaN do not count; a column without any number gets median 0.
    Three numbers per column come to the driver."""
    cols = list(num_cols)
    values = train.select(*[(replace_sentinel(c, sentinel, replacement) if c in sentinel_cols else F.col(c))
                            .cast("double").alias(c) for c in cols])
    probs = [0.25, 0.5, 0.75]
    if exact:
        found = [exact_quantiles(values, c, probs) for c in cols]
    else:
        found = values.approxQuantile(cols, probs, rel_error) if cols else []
    medians, fences = {}, {}
    for c, q in zip(cols, found):
        q1, median, q3 = q if len(q) == 3 and q[0] is not None else (None, 0.0, None)
        medians[c] = float(median)
        if c in clip_cols and q1 is not None:
            fences[c] = (float(q1 - k * (q3 - q1)), float(q3 + k * (q3 - q1)))
    return Preparation(medians, fences, tuple(sentinel_cols), sentinel, replacement)


def hash_bucket(key: str | Column, buckets: int, salt: str = "") -> Column:
    """A bucket of the row key from the first 32 bits of its MD5, the same in
    every engine and for every partitioning."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(salt), k.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def split_column(key: str | Column, train_pct: int = 80, buckets: int = 100) -> Column:
    """``True`` for the training part, by ``hash_bucket`` (``randomSplit``
    changes with the number of partitions)."""
    return hash_bucket(key, buckets) < F.lit(train_pct * buckets // 100)


def hash_split(df: DataFrame, key: str | Column, train_pct: int = 80,
               buckets: int = 100) -> tuple[DataFrame, DataFrame]:
    """Training and test part; a row without a key is in the test part."""
    cond = F.coalesce(split_column(key, train_pct, buckets), F.lit(False))
    return df.where(cond), df.where(~cond)


def string_indexer(cols: Sequence[str], out_cols: Sequence[str] | None = None,
                   order: str = "frequencyDesc", handle_invalid: str = "keep") -> StringIndexer:
    """One multi-column indexer: most frequent label -> 0.0, ties by label;
    unseen labels get the extra index ``len(labels)`` with ``keep``."""
    return StringIndexer(inputCols=list(cols),
                         outputCols=list(out_cols or [f"{c}_idx" for c in cols]),
                         stringOrderType=order, handleInvalid=handle_invalid)


def dictionary(df: DataFrame, column: str, index_col: str = "index") -> DataFrame:
    """(column, index_col): each known value with its place, most frequent
    first, ties by value, as ``string_indexer`` numbers them, but found by a
    distributed sort: the driver gets one row count per sorted partition, never
    the values. NULL is no value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    ensure_checkpoint_dir(df.sparkSession)
    # the place is the partition's number, then the row's within it
    placed = counts.orderBy(F.desc("__n"), column).select(column, F.monotonically_increasing_id().alias("__at")).checkpoint()
    part = F.shiftright("__at", 33)
    before, total = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        before.append((r["part"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(before, "__part long, __before long")
    return placed.join(offsets, part == F.col("__part")).select(
        column, (F.col("__before") + F.col("__at") - F.shiftleft("__part", 33)).cast("double").alias(index_col))


def dictionary_index(df: DataFrame, column: str, known: DataFrame, index_col: str = "index") -> DataFrame:
    """``df`` with the place of its value in a ``dictionary``; a value that is
    not there, NULL included, gets the number of known values."""
    rest = known.agg(F.count(F.lit(1)).cast("double")).scalar()
    values = known.select(F.col(column).alias("__value"), F.col(index_col).alias("__index"))
    return df.join(values, df[column] == F.col("__value"), "left").select(*[df[c] for c in df.columns], F.coalesce("__index", rest).alias(index_col))


def feature_pipeline(cat_cols: Sequence[str], num_cols: Sequence[str],
                     label_col: str | None = "y", classifier=None,
                     preparation: Preparation | None = None) -> Pipeline:
    """[preparation ->] indexers -> one-hot -> label index -> assembler
    (``features_raw``) -> scaler (``features``, unit sample std, no
    centring) [-> classifier].

    The label is indexed alphabetically (``no`` = 0, ``yes`` = 1) so its
    meaning does not depend on which class is more frequent. The indexer's
    slot for unknown values is the last one, which the encoder drops, so a
    column has one slot per known value and an unknown value is all zeros.
    Without a preparation a missing number is an error: it would turn into
    NaN and, through the scaler, wipe the feature of every row.
    """
    idx = [f"{c}_idx" for c in cat_cols]
    ohe = [f"{c}_ohe" for c in cat_cols]
    numbers = [f"{c}{PREPARED}" if preparation else c for c in num_cols]
    stages = [preparation.stage()] if preparation else []
    if idx:
        stages += [string_indexer(cat_cols, idx),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="error", dropLast=True)]
    if label_col:
        # labels must be known (no extra "unseen" class); scoring drops the
        # label column, so rows without one are still scored
        stages.append(StringIndexer(inputCol=label_col, outputCol="label",
                                    stringOrderType="alphabetAsc", handleInvalid="error"))
    stages += [VectorAssembler(inputCols=ohe + numbers, outputCol="features_raw",
                               handleInvalid="error"),
               StandardScaler(inputCol="features_raw", outputCol="features",
                              withMean=False, withStd=True)]
    if classifier is not None:
        stages.append(classifier)
    return Pipeline(stages=stages)


def slot_names(df: DataFrame, vector_col: str = "features_raw") -> list[str]:
    """Names of the vector slots from the assembler's ``ml_attr`` metadata
    (``month_ohe_jan`` ..., numeric columns by name), in slot order."""
    attrs = df.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    named = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [n.removesuffix(PREPARED) for _, n in sorted(named)]
