"""Helpers shared by the training-data operators.

Texts reach the tasks as Arrow batches (Spark bounds a batch by rows and by
bytes) and are worked on as UTF-8 bytes in pieces of a few MB, so a task's
memory follows one piece or one document, never a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from clientlens.session import ensure_checkpoint_dir

#: A-Z to a-z; every other byte, so every non-ASCII character, stays.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of text that are held as Python words at once.
PIECE = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's texts as bytes; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_text(values: list[bytes]) -> pa.Array:
    """Bytes as a string column; bytes that are not UTF-8 stay as they came."""
    return pa.compute.cast(pa.array(values, pa.binary()), options=pa.compute.CastOptions(pa.string(), allow_invalid_utf8=True))


def pieces(batch: pa.RecordBatch, column: int, most: int = PIECE, field: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch of about ``most`` bytes of text (one row at least),
    each with its texts; ``field``: the text's name in a struct column."""

    def text(part: pa.RecordBatch) -> pa.Array:
        found = part.column(column)
        return found if field is None else found.field(found.type.get_field_index(field))

    lengths = [n or 0 for n in pa.compute.binary_length(text(batch)).to_pylist()]
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            part = batch.slice(start, i - start)
            yield part, utf8(text(part))
            start, size = i, 0
        size += n
    if start < len(lengths):
        part = batch.slice(start)
        yield part, utf8(text(part))
