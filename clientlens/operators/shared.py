"""One scan for several analyses: persisted while they run, released after."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def shared_scan(df: DataFrame, columns: Sequence[str] | None = None,
                level: StorageLevel = StorageLevel.DISK_ONLY) -> Iterator[DataFrame]:
    """``df`` cut down to ``columns`` and kept at ``level`` for the analyses in
    the ``with`` block; the first one that runs fills it. Released at the end,
    after an error too, so run (or write) the analyses inside the block.

    The level is the executors' disks unless told otherwise: columns of a table beyond
    the cluster's memory would push out what the analyses themselves need.
    Blocks of a lost executor are read from the source again.
    """
    kept = (df.select(*columns) if columns is not None else df).persist(level)
    try:
        yield kept
    finally:
        kept.unpersist(blocking=True)
