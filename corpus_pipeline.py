"""A training-corpus pipeline over ``documents``: quality, near copies,
repeated passages, benchmark leaks, source mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientlens.llm import decontaminate, mixing, quality, simhash, substring
from clientlens.llm.common import read
from clientlens.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts are
    scored like any other; no rows: no rows."""
    return quality.good_documents(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the least id."""
    return simhash.one_per_component(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that an earlier document has."""
    return substring.without_repeats(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", neardup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mix_stage),
]

#: No SQL for the pipeline: trained scorer, hashed fingerprints, random rounding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``. Between stages the rows go
    through Parquet in the shared folder; a file is deleted when the stage
    that reads it is written, so only the last one's input stays."""
    docs, path = read(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        target = scratch_path(spark, "pipeline", f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(target)
        if path:
            _delete(spark, path)
        docs, path = spark.read.parquet(target), target
    return STAGES[-1][1](spark, docs, sf_dir)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
