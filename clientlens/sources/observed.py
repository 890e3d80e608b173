"""Metrics of a table taken while it is written, without a second scan."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def table_metrics(df: DataFrame, extra: dict[str, Column] | None = None,
                  columns: Sequence[str] | None = None) -> dict[str, Column]:
    """``row_count``, ``null_<column>`` for each column, and ``extra``."""
    nulls = {f"null_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in (df.columns if columns is None else columns)}
    return {"row_count": F.count(F.lit(1)), **nulls, **(extra or {})}


def observed_write(df: DataFrame, path: str, metrics: dict[str, Column], fmt: str = "parquet",
                   mode: str = "errorifexists") -> dict[str, Any]:
    """Write ``df`` and return the metrics of the rows written (one value
    each; no rows: counts 0, means NULL). They are collected by the writing
    tasks themselves, right before the sink, so a task that is run again is
    counted once."""
    seen = Observation()
    named = [c.alias(n) for n, c in metrics.items()]
    df.observe(seen, *named).write.mode(mode).format(fmt).save(path)
    return seen.get


def observe_stream(df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
    """``df`` whose micro-batches report ``metrics`` under ``name`` in the
    query's progress."""
    return df.observe(name, *[c.alias(n) for n, c in metrics.items()])


def batch_metrics(query: StreamingQuery, name: str) -> dict[int, dict[str, Any]]:
    """Metrics per micro-batch of a stream with ``observe_stream``, of as many
    last batches as the query keeps (``spark.sql.streaming.numRecentProgressUpdates``,
    100 unless set)."""
    out = {}
    for p in query.recentProgress:
        row = (p.observedMetrics or {}).get(name)
        if row is not None:
            out[p.batchId] = row.asDict()
    return out
