"""Catalog tables that keep their partitioning: bucketed, sorted, appended to.

A grouping or join on the bucket columns reads such a table without an
exchange, so the shuffle is paid once, when rows are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                    files_per_bucket: int = 1, path: str | None = None) -> DataFrame:
    """Append ``df`` to a Parquet catalog table of ``buckets`` buckets by the
    hash of ``keys``, sorted by them; the table is created if missing and must
    have the same buckets otherwise (Spark refuses other ones). Returns the
    table. No rows: an empty table, or the table as it was.

    Each task writes one file of one bucket. ``files_per_bucket`` deals a
    bucket's rows to several tasks by a hash of the whole row, so a key that
    holds a third of all rows is not one task's work.
    """
    ks = list(keys)
    bucket = F.pmod(F.hash(*ks), F.lit(buckets))  # the hash that bucketed tables use
    share = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
    dealt = df.repartitionById(buckets * files_per_bucket, (bucket * files_per_bucket + share).cast("int"))
    writer = dealt.write.format("parquet").mode("append").bucketBy(buckets, *ks).sortBy(*ks)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
