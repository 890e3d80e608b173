"""Registry of every fixture plan and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientlens.plans import batch, io, models, streams
from clientlens.plans.oracle import BATCH_SQL, IO_SQL, MODEL_SQL, STREAM_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    out.update(batch.QUERIES)
    out.update(streams.QUERIES)
    out.update(io.QUERIES)
    out.update(models.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {**BATCH_SQL, **STREAM_SQL, **IO_SQL, **MODEL_SQL}
    return {k: v for k, v in out.items() if k in queries()}
