"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is wanted ``target / source_size`` times, between 0
and 2: its whole copies are fixed and the fraction is a copy probability.
Pivotal steps pair two fractional documents of a source and move words of
probability from one to the other, in a random direction whose mean is zero,
until one of them is integral; the words that the source is expected to give
stay the same in each step. The documents of a source are cut into groups of
bounded size that run side by side; each leaves one fractional document at
most, and those meet in groups of ``FAN`` per level up a reduction tree until
one a source is left, which is rounded to the nearer whole. Larger documents
go first in a group, so the smaller ones settle them and little is left over.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import cut, pieces

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2.0
#: Documents of a source that meet in one group; residuals per group above.
LEAF = 2_000
FAN = 64


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row: the other columns as a struct, size): the number of words of each
    text (null: 0)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t.split()) for t in texts], pa.int64())],
                                                 names=["row", "size"])

    rows = docs.select(F.struct(*(c for c in docs.columns if c != text_col)).alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, f"row {rows.schema['row'].dataType.simpleString()}, size long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   limit: float = LIMIT) -> DataFrame:
    """(source, size) rows -> (sid, source, docs, source_size, target).

    Sources in code point order, null last, weigh ``weights`` in turn and get
    ``share`` of all words; none gets over ``limit`` times its own, the excess
    goes to the others by weight. The level at which the targets meet the
    share is found with one small aggregate a step; no source list is held by
    the driver or by one task.
    """
    spark = sizes.sparkSession
    ordered = cut(sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
                  .orderBy(F.asc_nulls_last("source")))
    ranked = ordered.rdd.zipWithIndex().map(lambda x: (x[1], *x[0], float(weights[x[1] % len(weights)])))
    table = cut(spark.createDataFrame(ranked, "sid long, source string, docs long, source_size long, weight double"))
    words, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (words or 0) / (weight or 1.0)
    while True:
        full = F.col("source_size") * limit <= F.col("weight") * level
        held, free = table.agg(F.sum(F.when(full, F.col("source_size") * limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        higher = (share * words - (held or 0.0)) / free
        if higher <= level:
            break
        level = higher
    return table.select("sid", "source", "docs", "source_size",
                        F.least(F.col("source_size") * limit, F.col("weight") * level).alias("target"))


def _chance(a: int, b: int, level: int) -> float:
    """A number in [0, 1) that depends on the pair alone, so reruns agree."""
    return xxhash.xxh64_intdigest(struct.pack("<qqq", a, b, level)) / 2 ** 64


def pivot(p: float, s: int, q: float, t: int, chance: float) -> tuple[float, float]:
    """One step between documents of s and t words: probabilities after it.
    p * s + q * t stays; one of the two becomes 0 or 1."""
    up = min((1 - p) * s, q * t)
    down = min(p * s, (1 - q) * t)
    if chance * (up + down) < down:
        return (1.0, q - up / t) if up == (1 - p) * s else (p + up / s, 0.0)
    return (0.0, q + down / t) if down == p * s else (p - down / s, 1.0)


def _settle(batches: Iterator[pa.RecordBatch], level: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sid, grp, size desc, h): each group with at most one
    fractional document left (none on the last level)."""
    held: dict | None = None

    def integral(x: float) -> bool:
        return x in (0.0, 1.0)

    def closing(row: dict) -> dict:
        return row | {"p": float(row["p"] > 0.5 or row["p"] == 0.5 and _chance(row["h"], row["h"], -1) < 0.5)} if last else row

    for batch in batches:
        done: list[dict] = []
        for row in batch.to_pylist():
            if held and (held["sid"], held["grp"]) != (row["sid"], row["grp"]):
                done.append(closing(held))
                held = None
            if integral(row["p"]):
                done.append(row)
            elif held is None:
                held = row
            else:
                held["p"], row["p"] = pivot(held["p"], held["size"], row["p"], row["size"], _chance(held["h"], row["h"], level))
                left = [x for x in (held, row) if not integral(x["p"])]
                done += [x for x in (held, row) if integral(x["p"])]
                held = left[0] if left else None
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=batch.schema)
        schema = batch.schema
    if held:
        yield pa.RecordBatch.from_pylist([closing(held)], schema=schema)


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, keys: tuple[str, ...] = ()) -> DataFrame:
    """(id: long, source, size) rows -> the same rows with source_size, target
    and copies (0 to ``limit``), the number of times the mix takes them.
    ``keys``: further long columns that belong to the id.

    Each source's words taken are its target up to one document. Rows of size
    0 are never drawn (0 copies). Null sources are one source, the last in
    order; null ids and repeated rows are documents of their own. Reruns
    agree, whatever the partitions. No rows: no rows.
    """
    sizes = cut(sizes.select(F.col("id").cast("long").alias("id"), *keys, F.col("source").cast("string").alias("source"),
                             F.col("size").cast("long").alias("size")))
    targets = source_targets(sizes, weights, share, limit).withColumnRenamed("source", "of")
    wanted = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (sizes.join(targets, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("whole", F.floor(wanted)).withColumn("p", wanted - F.col("whole"))
            .withColumn("h", F.xxhash64("id", *keys, "sid", "size"))
            .withColumn("grp", F.pmod(F.xxhash64("h"), F.ceil(F.col("docs") / LEAF)))
            .select("id", *keys, "source", "size", "sid", "docs", "source_size", "target", "whole", "p", "h", "grp"))
    settled, level = None, 0
    groups = -(-(sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 0) // LEAF)
    while True:
        last = groups <= 1
        args = (level, last)
        dealt = (rows.repartition("sid", "grp").sortWithinPartitions("sid", "grp", F.desc("size"), "h")
                 .mapInArrow(lambda it, args=args: _settle(it, *args), rows.schema))
        if last:
            settled = dealt if settled is None else settled.unionByName(dealt)
            return settled.select("id", *keys, "source", "size", "source_size", "target",
                                  (F.col("whole") + F.col("p").cast("long")).alias("copies"))
        dealt = cut(dealt)
        whole = dealt.where("p = 0 or p = 1")
        settled = whole if settled is None else settled.unionByName(whole)
        rows = dealt.where("p > 0 and p < 1").withColumn("grp", F.floor(F.col("grp") / FAN))
        groups, level = -(-groups // FAN), level + 1


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents (all columns) that the mix takes, with size, source_size,
    target, copies and taken (words, repeats counted). Exact repeats of a row
    are drawn once and get the same copies. Columns of these names that the
    documents already have are replaced."""
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    # a document is known by two hashes of its id, source and text
    of = ("of.doc_id", "of.source", "of.text")
    rows = docs.select(F.struct("doc_id", "source", "text").alias("of"), F.struct(*own).alias("row")).select(
        "row", F.xxhash64(*of).alias("h1"), F.xxhash64(F.lit(1), *of[::-1]).alias("h2"))
    sizes = word_counts(rows.select("h1", "h2", F.col("row.source").alias("source"), F.col("row.text").alias("text"))).select("row.*", "size")
    mixed = mix(sizes.dropDuplicates(["h1", "h2"]).withColumnRenamed("h1", "id"), keys=("h2",)).where("copies > 0").select(
        F.col("id").alias("h1"), "h2", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    return rows.join(mixed, ["h1", "h2"]).select("row.*", "size", "source_size", "target", "copies", "taken")
