"""MinHash document fingerprints.

A text's words (A-Z lower-cased, runs of other characters than space and
U+0009 to U+000D) give shingles of five; fewer words are one shingle. Each of
``PERMUTATIONS`` universal hash permutations of the 32-bit shingle hashes,
run over all shingles at once in numpy, leaves its least value. The share of
equal values of two fingerprints estimates the Jaccard likeness of their
shingle sets. ``near_duplicates`` joins documents on bands of their
signatures and verifies the pairs by the true Jaccard of their shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import LOWER, cut, pieces
from clientlens.llm.components import connected_components

PERMUTATIONS = 64
SHINGLE = 5
SEED = 20
#: Ranges of ids at most; their bounds and first ids are all that the driver holds.
MOST_RANGES = 10_000
BANDS = 16
LIKENESS = 0.8


def _constants() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    a = r.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)  # odd: a permutation
    return a, r.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)


def shingle_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the text's shingles, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashed[j:n + j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ out >> np.uint64(29)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least value of each permutation (no shingles: the largest value)."""
    a, b = _constants()
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), 4096):
        np.minimum(least, (a[:, None] * low[i:i + 4096] + b[:, None]).min(axis=1), out=least)
    return least


def fingerprint(text: bytes) -> bytes:
    """The low 16 bits of each least value, big-endian."""
    return (signature(shingle_hashes(text)) & np.uint32(0xFFFF)).astype(">u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal values of two fingerprints."""
    return float((np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")).mean())


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, ghost, id desc, text), each range followed by
    the first document of the next: every document with its neighbour."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held = None  # range, id, text, fingerprint of the document that waits for its neighbour
    for batch in batches:
        for part, texts in pieces(batch, 3):
            out: list[tuple] = []
            for at, doc, ghost, raw in zip(*(part.column(i).to_pylist() for i in range(3)), texts, strict=True):
                if ghost and (held is None or held[0] != at):
                    continue  # a second first document with the same id
                text, own = raw.decode("utf-8", "surrogateescape"), fingerprint(raw)
                if held is not None:
                    before, n = held[2], len(held[2])
                    edited = (before[:n - n // 2] + text[:n // 2]).encode("utf-8", "surrogateescape")
                    changed = fingerprint(edited)
                    out.append((held[1], n, hashlib.sha256(edited).hexdigest(), held[3].hex(), changed.hex(),
                                likeness(held[3], changed), likeness(held[3], own)))
                held = None if ghost else (at, doc, text, own)
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id (after the last one
    the first); the edited text has the last half of a text replaced by as
    many first characters of the next one. Null texts are empty; a null id
    comes last; rows that share an id follow each other in order of the text;
    a single document is its own neighbour; no rows: no rows.

    Ids alone are read first, to cut them into ranges of about equal size.
    The texts are then shuffled once, to their range; the first document of
    each range goes to the range before as well.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    ids = docs.select(order.alias("o"))
    count = min(MOST_RANGES, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    quantiles = ids.selectExpr("cast(o as double) o").approxQuantile("o", [i / count for i in range(1, count)], 0.25 / count) if count > 1 else []
    bounds = np.unique(np.array([int(max(-(2.0 ** 63), min(q, 2.0 ** 63 - 1024))) for q in quantiles], np.int64))

    def ranges(o: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, o, "left")  # larger ids first

    @F.pandas_udf("int")
    def range_of(o: pd.Series) -> pd.Series:
        return pd.Series(ranges(o.to_numpy()).astype(np.int32))

    heads = {r.at: r.head for r in ids.groupBy(range_of("o").alias("at")).agg(F.max("o").alias("head")).collect()}
    filled = sorted(heads)
    before = {heads[at]: filled[i - 1] for i, at in enumerate(filled)}
    head_ids = np.array(sorted(before), np.int64)
    ahead = np.array([before[h] for h in head_ids.tolist()], np.int32)

    @F.pandas_udf("at int, ahead int")
    def placed(o: pd.Series) -> pd.DataFrame:
        o = o.to_numpy()
        i = np.minimum(np.searchsorted(head_ids, o), max(len(head_ids) - 1, 0))
        first = head_ids[i] == o if len(head_ids) else np.zeros(len(o), bool)
        return pd.DataFrame({"at": ranges(o).astype(np.int32), "ahead": np.where(first, ahead[i] if len(ahead) else 0, -1).astype(np.int32)})

    rows = docs.select(order.alias("o"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    own = F.struct(F.col("place.at").alias("at"), F.lit(False).alias("ghost"))
    other = F.struct(F.col("place.ahead").alias("at"), F.lit(True).alias("ghost"))
    dealt = (rows.withColumn("place", placed("o"))
             .withColumn("to", F.explode(F.when(F.col("place.ahead") >= 0, F.array(own, other)).otherwise(F.array(own))))
             .select("to.at", "id", "to.ghost", "text", "o")
             .repartitionById(count, "at").sortWithinPartitions("at", "ghost", F.desc("o"), "text"))
    return dealt.select("at", "id", "ghost", "text").mapInArrow(
        _neighbours, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                     "edited_fingerprint string, near_edited double, near_next double")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, tid, bands): a hash of the shingle sequence, equal
    for equal words, and the hashed bands of the signature."""
    for batch in batches:
        for part, texts in pieces(batch, 1):
            tid, bands = [], []
            for text in texts:
                hashes = shingle_hashes(text)
                tid.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sign = signature(hashes).reshape(BANDS, -1)
                bands.append(np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(sign)], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(tid, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))],
                                             names=["id", "tid", "bands"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch, 1):
            sets = [np.unique(shingle_hashes(t)).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["tid", "shingles"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKENESS) -> tuple[DataFrame, DataFrame]:
    """(links, classes): links (a, b, jaccard), a < b, between the texts' first
    documents for every pair of different texts that shares a signature band
    and has a Jaccard of ``least`` or more; classes (doc_id, first_id,
    class_id, n_links) of every document: the first with its words, the least
    id reachable through links, and the number of links of its text.

    Copies are one text before anything is joined. The band join is an inner
    equi-join whose skewed keys Spark can split; of the bands that a pair
    shares only the first yields it. Null texts are empty, and all texts
    without words are one text; null ids are left out of the classes; no rows:
    no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    signed = cut(rows.mapInArrow(_signed, "id long, tid long, bands array<long>"))
    texts = signed.groupBy("tid").agg(F.min("id").alias("first"), F.min("bands").alias("bands"))
    keyed = texts.select("first", "bands", F.posexplode("bands").alias("band", "key"))
    left, right = keyed.alias("l"), keyed.alias("r")
    earlier = F.exists(F.zip_with(F.slice("l.bands", F.lit(1), F.col("l.band")), F.slice("r.bands", F.lit(1), F.col("r.band")),
                                  lambda x, y: x == y), lambda x: x)
    pairs = (left.join(right, (F.col("l.band") == F.col("r.band")) & (F.col("l.key") == F.col("r.key")) & (F.col("l.first") < F.col("r.first")))
             .where(~earlier).select(F.col("l.first").alias("a"), F.col("r.first").alias("b")))
    pairs = cut(pairs)
    some = pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct()
    firsts = rows.join(some, F.col("id") == F.col("k"), "left_semi").dropDuplicates(["id"])
    sets = firsts.mapInArrow(_shingle_sets, "tid long, shingles array<long>").withColumnRenamed("tid", "k")
    both = (pairs.join(sets.select(F.col("k").alias("a"), F.col("shingles").alias("s")), "a")
            .join(sets.select(F.col("k").alias("b"), F.col("shingles").alias("t")), "b"))
    same = F.size(F.array_intersect("s", "t"))
    links = cut(both.select("a", "b", (same / (F.size("s") + F.size("t") - same)).alias("jaccard")).where(F.col("jaccard") >= least))
    roots = connected_components(links).select(F.col("node").alias("first"), "root")
    degree = (links.select(F.explode(F.array("a", "b")).alias("first")).groupBy("first").agg(F.count("*").alias("n_links")))
    classes = (signed.select("id", "tid").join(texts.select("tid", "first"), "tid").join(roots, "first", "left").join(degree, "first", "left")
               .select(F.col("id").alias("doc_id"), F.col("first").alias("first_id"), F.coalesce("root", "first").alias("class_id"),
                       F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return links, classes
