"""Upsert sink: the newest event of each key over all micro-batches.

Every micro-batch is reduced to one row per key and written to its own folder
(``batch_id=N``, overwritten by a replay). Which row of a key wins is decided
by the event's own order, never by the batch that brought it, so replays and
events that come late do not change the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens.streaming.streams import BATCH_COL, nonempty_batches


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``order`` columns (NULLs lowest,
    then the other columns, so ties have one result). NULL keys are one key. A hash
    aggregate with a partial step: a hot key moves one row per task."""
    ks, cols = list(keys), df.columns
    rest = [c for c in cols if c not in ks and c not in order]
    # null flags first: max over a struct orders its fields from the left
    rank: list[Column] = []
    for c in [*order, *rest]:
        rank += [F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`")]
    named = [c.alias(f"f{i}") for i, c in enumerate(rank)]
    best = df.groupBy(*[F.col(f"`{k}`") for k in ks]).agg(F.max(F.struct(*named)).alias("__best"))
    at = {c: F.col(f"__best.f{2 * i + 1}").alias(c) for i, c in enumerate([*order, *rest])}
    return best.select(*[at.get(c, F.col(f"`{c}`")) for c in cols])


def upsert_writer(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes micro-batch N, reduced to the
    newest row per key, to ``path/batch_id=N``; empty batches are skipped."""
    def write(batch: DataFrame, batch_id: int) -> None:
        newest_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/{BATCH_COL}={batch_id}")
    return nonempty_batches(write)


def upserted(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
             schema: T.StructType, base: str | None = None, after: int = -1) -> DataFrame:
    """The newest row per key of the batches beyond number ``after`` and of
    ``base``, a table that ``compact_upserts`` wrote of the batches up to it.
    No batch written yet: no rows."""
    log_schema = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.IntegerType())])
    try:
        log = spark.read.schema(log_schema).parquet(path).where(F.col(BATCH_COL) > after).drop(BATCH_COL)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], schema)
    rows = log.unionByName(spark.read.schema(schema).parquet(base)) if base else log
    return newest_per_key(rows, keys, order)


def compact_upserts(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
                    schema: T.StructType, out: str, through: int,
                    base: str | None = None, after: int = -1) -> None:
    """Write the newest row per key of the batches up to number ``through``
    (and of an earlier ``base`` of those up to ``after``) to ``out``, so that
    readers need only the batches after it. The batches stay."""
    log_schema = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.IntegerType())])
    log = (spark.read.schema(log_schema).parquet(path)
           .where((F.col(BATCH_COL) > after) & (F.col(BATCH_COL) <= through)).drop(BATCH_COL))
    rows = log.unionByName(spark.read.schema(schema).parquet(base)) if base else log
    newest_per_key(rows, keys, order).write.mode("errorifexists").parquet(out)
