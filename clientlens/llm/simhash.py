"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A document's 64-bit fingerprint is cut into three segments. Two fingerprints
at Hamming distance 2 or less agree exactly on one segment at least
(pigeonhole) and differ in 2 bits at most on the next. Each segment is padded
to 23 bits and decoded with the perfect binary Golay code [23, 12]: the
codewords nearest to the word and to each of its 23 neighbours, 1 or 6 of
them, are its keys, and words at distance 2 or less share a key (both are
next to a common word). So (exact segment i, key of segment i+1) for i in
0..2, at most 18 keys a fingerprint, finds every pair; the exact distance
verifies it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import LOWER, cut, pieces
from clientlens.llm.components import connected_components

SEED = 42
MAX_BITS = 2
#: (first bit, width) of the segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the binary Golay code.
GOLAY = 0b110001110101
#: Fingerprints of a bucket that are compared with each other; the members of
#: larger buckets are linked through their one-bit neighbours instead.
BUCKET = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the whole text's word shingles (no words: 0)."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]).tolist()
    size = min(shingle, len(words))
    n = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts[:n], starts[size:], strict=True)),
                         np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 255 * 128):  # bytes hold the sums of 255 rows
        part = hashes[i:i + 255 * 128].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        ones += bits[whole:].sum(axis=0, dtype=np.uint8)
        if whole:
            ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit polynomials by the generator (the syndromes)."""
    out = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, GOLAY << (bit - 11), 0)
    return out


def _errors() -> np.ndarray:
    """The one error pattern of weight 3 or less of each syndrome."""
    bits = [1 << i for i in range(23)]
    patterns = [0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i]),
                *(a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j])]
    table = np.zeros(1 << 11, np.int64)
    table[_remainders(np.array(patterns))] = patterns
    return table


_TABLE: list[np.ndarray] = []


def golay_keys(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the 12-bit codeword indices of the word and its 23
    neighbours: 24 columns, repeats as -1."""
    if not _TABLE:
        _TABLE.append(_errors())
    near = words.astype(np.int64)[:, None] ^ np.array([0, *(1 << i for i in range(23))])
    index = np.sort((near ^ _TABLE[0][_remainders(near)]) >> 11, axis=1)
    index[:, 1:][index[:, 1:] == index[:, :-1]] = -1
    return index


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch, 1):
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values), part.column(2)], names=["id", "fp", "tid"])


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        bits = fps.view(np.uint64)
        cut_out = [((bits >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
        for i in range(len(SEGMENTS)):
            index = golay_keys(cut_out[(i + 1) % len(SEGMENTS)])
            row, col = np.nonzero(index >= 0)
            keys = (i << 40) | (cut_out[i][row] << 12) | index[row, col]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[row])], names=["key", "fp"])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: list[int], links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of the links between positions of one bucket."""
    parent = list(range(len(fps)))
    kept = []
    for a, b in links:
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((fps[min(a, b)], fps[max(a, b)]))
    return kept


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, fp) -> links (a, b) that span each bucket's links;
    (a, a) for the members of a bucket of over BUCKET fingerprints, which are
    streamed through and never held."""

    def links(key: np.ndarray, fp: np.ndarray) -> Iterator[tuple[int, int]]:
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        sizes = np.diff(edges)
        large = np.repeat(sizes > BUCKET, sizes)
        yield from zip(fp[large].tolist(), fp[large].tolist(), strict=True)
        key, fp = key[~large], fp[~large]
        near: list[np.ndarray] = []
        for gap in range(1, min(BUCKET, len(key))):
            same = np.flatnonzero(key[gap:] == key[:-gap])
            if not len(same):
                break
            same = same[_distance(fp[same], fp[same + gap]) <= MAX_BITS]
            near.append(np.column_stack([same, same + gap]))
        found = np.concatenate(near) if near else np.zeros((0, 2), np.int64)
        start = np.searchsorted(key, key[found[:, 0]], "left")  # of each link's bucket
        order = np.argsort(start, kind="stable")
        for of in np.split(found[order], np.flatnonzero(np.diff(start[order])) + 1):
            if len(of):
                first = int(np.searchsorted(key, key[of[0, 0]], "left"))
                yield from _forest(fp[first:first + BUCKET].tolist(), (of - first).tolist())

    def table(rows: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])

    held_key, held_fp, open_large = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if open_large is not None:  # a large bucket goes on
            n = int(np.searchsorted(key, open_large, "right"))
            if n:
                yield table([(x, x) for x in fp[:n].tolist()])
            key, fp = key[n:], fp[n:]
            if not len(key):
                continue
            open_large = None
        key, fp = np.concatenate([held_key, key]), np.concatenate([held_fp, fp])
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1], "left"))
        if len(key) - last > BUCKET:
            open_large, last = key[-1], len(key)
        rows = list(links(key[:last], fp[:last])) if last else []
        held_key, held_fp = key[last:], fp[last:]
        if rows:
            yield table(rows)
    if len(held_key):
        rows = list(links(held_key, held_fp))
        if rows:
            yield table(rows)


def _neighbour_links(members: DataFrame) -> DataFrame:
    """Links of the members of large buckets: fingerprints within 2 bits share
    a word that is within 1 bit of both, and all fingerprints around a word,
    65 at most, are within 2 bits of each other."""
    words = members.select("a", F.explode(F.concat(F.array("a"), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("a").bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), i))))).alias("word"))
    around = words.groupBy("word").agg(F.sort_array(F.collect_set("a")).alias("s")).where(F.size("s") > 1)
    return around.select(F.explode(F.slice("s", 2, 64)).alias("a"), F.col("s")[0].alias("b"))


def simhash_links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) whose connected components
    are those of all pairs at distance 2 or less."""
    keys = fps.select("fp").mapInArrow(_bucket_keys, "key long, fp long")
    found = cut(keys.repartition("key").sortWithinPartitions("key", "fp")
                .mapInArrow(_bucket_links, "a long, b long").distinct())
    return found.where("a <> b").unionByName(_neighbour_links(found.where("a = b").select("a")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, keys: bool = False) -> DataFrame:
    """One row per document: (doc_id, fingerprint, component_id); with ``keys``
    also tid, a hash of the text that tells documents of one id apart, and
    root, a fingerprint that tells components apart which share their least id.

    Documents are linked when their fingerprints differ in 2 bits or fewer;
    component_id is the least id reachable, the document's own included.
    Null or wordless texts have fingerprint zero and are linked like any
    other; fewer words than a shingle: the whole sequence is one shingle.
    Repeated rows each come back. A null id is passed over in minima
    (component_id is null only if the whole component has no id). No rows:
    no rows. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), _tid(text_col).alias("tid"))
    fps = cut(rows.mapInArrow(lambda it: _fingerprints(it, shingle), "id long, fp long, tid long"))
    distinct = fps.groupBy("fp").agg(F.min("id").alias("first"))
    roots = connected_components(simhash_links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return fps.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["tid", "root"] if keys else []))


def _tid(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The documents (all columns) of which one stays of each component: the
    one with the smallest doc_id and, of texts that share it, the smallest hash;
    of rows that repeat an id and text one. Unrelated texts that share an id
    are in different components, so each stays. Rows with a null doc_id cannot
    be named and stay."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("did"), _tid("text").alias("own"))
    stay = (simhash_components(docs, keys=True).where("doc_id is not null").groupBy("root")
            .agg(F.min(F.struct("doc_id", "tid")).alias("first")).select(F.col("first.doc_id").alias("did"), F.col("first.tid").alias("own")))
    kept = rows.where("did is not null").join(stay, ["did", "own"], "left_semi").dropDuplicates(["did", "own"])
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))
